"""Processing only what is new or changed, run after run.

Every delivery of a record has a sequence number.  What was processed is kept as
disjoint intervals of sequence numbers; what a run has to do is the available
range minus those intervals, so that gaps left by failures and late commits are
found however far the numbers went on.  Intervals are committed together with
the output that was made from them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.ordered import Scan
from strandline.sources import files

#: Sequence numbers per bucket of the scans below.
SPAN = 1_000_000.0
#: Most runs of a history; its cut times are held by every task.
MAX_RUNS = 10_000


def merge_intervals(intervals: DataFrame, key: str = "source") -> DataFrame:
    """Closed integer intervals (key, lo, hi), in any order and overlapping -> disjoint ones; neighbours are joined.

    Null bounds and lo > hi don't count.
    """
    d = intervals.filter("lo <= hi").select(key, "lo", "hi").distinct()
    scan = Scan(d, [key], "lo", ["hi"], SPAN).prefix(F.col("hi"), "max", False, "reach")
    d = scan.runs(F.col("reach").isNull() | (F.col("lo") > F.col("reach") + 1)).result()
    return d.groupBy(key, "run_no").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("run_no")


def subtract_intervals(available: DataFrame, processed: DataFrame, key: str = "source") -> DataFrame:
    """Available minus processed intervals: what is left to do, disjoint and ordered by nothing.

    Bounds are turned into events (+1 at a start, -1 after an end) of both sides;
    a stretch is left where an available interval is open and no processed one is.
    No interval is joined with another.
    """
    a, p = merge_intervals(available, key), merge_intervals(processed, key)

    def events(d: DataFrame, side: str) -> DataFrame:
        both = F.array(F.struct(F.col("lo").alias("at"), F.lit(1).alias("v")), F.struct((F.col("hi") + 1).alias("at"), F.lit(-1).alias("v")))
        e = d.select(key, F.explode(both).alias("e"))
        other = F.lit(0)
        return e.select(
            key, "e.at", (F.col("e.v") if side == "a" else other).alias("a"), (F.col("e.v") if side == "p" else other).alias("p")
        )

    e = events(a, "a").unionByName(events(p, "p")).groupBy(key, "at").agg(F.sum("a").alias("a"), F.sum("p").alias("p"))
    # The stretch before an event is the one that just ended there: it looks back at the last event, never ahead, so that
    # a source of any size stays spread over its buckets.
    scan = Scan(e, [key], "at", [], SPAN).prefix(F.col("a"), "sum", False, "open_a").prefix(F.col("p"), "sum", False, "open_p")
    e = scan.previous(["at"], "before").result()
    left = e.filter("open_a > 0 and open_p = 0 and before.at < at")
    return merge_intervals(left.select(key, F.col("before.at").alias("lo"), (F.col("at") - 1).alias("hi")), key)


def merged(intervals: Column) -> Column:
    """Array of struct<lo, hi> of one record, in any order and overlapping -> disjoint ones in order; neighbours are joined.

    For the few intervals of one record; those of a whole source are rows, see :func:`merge_intervals`.
    """
    def step(acc: Column, x: Column) -> Column:
        last = F.try_element_at(acc, F.lit(-1))
        wider = F.struct(last["lo"].alias("lo"), F.greatest(last["hi"], x["hi"]).alias("hi"))
        return F.when((F.size(acc) > 0) & (x["lo"] <= last["hi"] + 1), F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(wider))).otherwise(F.concat(acc, F.array(x)))

    return F.aggregate(F.array_sort(F.filter(intervals, lambda x: x["lo"] <= x["hi"])), F.array().cast("array<struct<lo:bigint,hi:bigint>>"), step)


def subtracted(available: Column, processed: Column) -> Column:
    """What of one record's disjoint intervals is left without the others: arrays of struct<lo, hi>."""
    def step(acc: Column, p: Column) -> Column:
        def around(x: Column) -> Column:
            before = F.struct(x["lo"].alias("lo"), F.least(x["hi"], p["lo"] - 1).alias("hi"))
            after = F.struct(F.greatest(x["lo"], p["hi"] + 1).alias("lo"), x["hi"].alias("hi"))
            return F.array(before, after)

        return F.filter(F.flatten(F.transform(acc, around)), lambda x: x["lo"] <= x["hi"])

    return F.aggregate(processed, available, step)


class Ledger:
    """Committed intervals and outputs under one folder of shared storage.

    The folder may be on any file system Spark reads.  A commit is a folder of its
    own with the output, the merged intervals after it, and, written last, one
    small file that makes it count.  A run that dies
    before that file leaves nothing behind that is ever read; a run that is
    repeated finds its records still missing from the intervals, and one that
    was committed finds them present.  Two runs at once can't both commit: the
    file of commit n is put in place exclusively.
    """

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _commits(self) -> list[int]:
        return sorted(int(x) for x in files.names(self.spark, f"{self.path}/commits") if x.isdigit())

    def _folder(self, n: int) -> str:
        return json.loads(files.read(self.spark, f"{self.path}/commits/{n}"))["folder"]

    def processed(self) -> DataFrame:
        """Disjoint intervals (source, lo, hi) of everything committed."""
        done = self._commits()
        if not done:
            return self.spark.createDataFrame([], "source string, lo long, hi long")
        return self.spark.read.parquet(f"{self.path}/{self._folder(done[-1])}/intervals")

    def pending(self, available: DataFrame) -> DataFrame:
        """Intervals of ``available`` that no commit covers."""
        return subtract_intervals(available, self.processed())

    def commit(self, intervals: DataFrame, output: DataFrame) -> int:
        """Write ``output`` and the merged intervals, then make both count; returns the number of the commit."""
        n = max(self._commits(), default=0) + 1
        folder = f"data/{n}-{uuid.uuid4().hex}"
        output.write.parquet(f"{self.path}/{folder}/output")
        done = self.processed().unionByName(intervals.select("source", "lo", "hi"))
        merge_intervals(done).write.parquet(f"{self.path}/{folder}/intervals")
        files.create(self.spark, f"{self.path}/commits/{n}", json.dumps({"folder": folder}))  # fails if another run committed number n meanwhile
        return n

    def outputs(self) -> DataFrame | None:
        """All committed outputs, each once, with the number of the commit in column ``commit``."""
        out = None
        for n in self._commits():
            d = self.spark.read.parquet(f"{self.path}/{self._folder(n)}/output").withColumn("commit", F.lit(n))
            out = d if out is None else out.unionByName(d)
        return out

    def latest(self, key: str) -> DataFrame | None:
        """Committed rows, for each ``key`` those of the last commit that has it: what was done again replaces what was done before."""
        d = self.outputs()
        if d is None:
            return None
        last = d.groupBy(key).agg(F.max("commit").alias("commit"))
        return d.join(last, [key, "commit"]).drop("commit")


def _content() -> Column:
    """What has to be processed again if it changes; null is a value."""
    return F.struct("title", "published_at", "duration_seconds")


def pending_by_run(deliveries: DataFrame, runs: DataFrame, outcomes: DataFrame) -> DataFrame:
    """What each run has to process: run_no, video_id, and the intervals it would commit.

    Deliveries get sequence numbers per video in order of (ingested_at, row_id).
    A run has the numbers up to its cut available.  A run that logged a video done
    has committed the intervals its output stands on; nothing else counts as
    processed, whatever a crashed run did besides.  The available numbers minus the
    processed ones are the gaps, late commits and failures included.  A video with a
    gap is pending, unless the content at the end of the gap is the one processed
    last (deliveries repeated unchanged, or taken back, leave a gap but no work).
    Cuts may be out of order: then processed numbers may not be available any more,
    which is found by the subtraction the other way round.

    A video's deliveries are first reduced to one row per (video, run that saw
    them first): their number and the last content.  So a video with very many
    deliveries has at most as many rows as there are runs.  Deliveries without a
    video or an ingestion time are seen by no run.

    Returns run_no, video_id, gaps and commits (arrays of struct<lo, hi>): the
    numbers to process, and the processed intervals merged with them.
    """
    r = runs.filter("run_no is not null and cut_at is not null").select("run_no", "cut_at").distinct()
    history = r.orderBy("cut_at", "run_no").limit(MAX_RUNS + 1).collect()
    if len(history) > MAX_RUNS:
        raise ValueError(f"more than {MAX_RUNS} runs")
    intervals = "array<struct<lo:bigint,hi:bigint>>"
    if not history:
        none = F.array().cast(intervals)
        return deliveries.select(F.lit(0).alias("run_no"), F.col("video_id").cast("string"), none.alias("gaps"), none.alias("commits")).filter("false")
    # distinct cuts in order; a delivery is first seen at the first cut that is not before it
    cuts = sorted({x.cut_at for x in history})
    step = {c: i + 1 for i, c in enumerate(cuts)}
    steps = F.array(*[F.lit(c) for c in cuts])
    seen_at = F.size(F.filter(steps, lambda c: c < F.col("ingested_at"))) + 1
    d = deliveries.filter("video_id is not null and ingested_at is not null").filter(F.col("ingested_at") <= F.lit(cuts[-1])).select(
        "video_id", seen_at.alias("step"), F.struct("ingested_at", "row_id").alias("place"), _content().alias("content")
    )
    d = d.groupBy("video_id", "step").agg(F.count("*").alias("n"), F.max_by("content", "place").alias("content"))
    avail = d.groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("step", "n", "content"))).alias("avail"))

    # a logged run counts with the step of its cut; runs that aren't in the history have none
    numbered = F.broadcast(outcomes.sparkSession.createDataFrame([(x.run_no, step[x.cut_at]) for x in history], "run_no int, step int"))  # at most MAX_RUNS rows
    done = outcomes.filter("status = 'done' and video_id is not null and run_no is not null").select("video_id", "run_no").distinct()
    done = done.join(numbered, "run_no", "left").groupBy("video_id").agg(F.array_sort(F.collect_list(F.struct("run_no", "step"))).alias("done"))
    j = avail.join(done, "video_id", "left")
    # the numbers available after each step that brought some are [1, hi], with the content at hi
    ends = F.transform(
        "avail",
        lambda x, i: F.struct(
            x["step"].alias("step"),
            F.aggregate(F.slice("avail", 1, i + 1), F.lit(0).cast("long"), lambda acc, y: acc + y["n"]).alias("hi"),
            x["content"].alias("content"),
        ),
    )
    at = F.array(*[F.struct(F.lit(x.run_no).alias("run_no"), F.lit(step[x.cut_at]).alias("step")) for x in sorted(history, key=lambda x: x.run_no)])
    j = j.select("video_id", "done", ends.alias("ends")).select("*", F.explode(at).alias("run"))

    def upto(s: Column) -> Column:
        """The last of ``ends`` at or before step s; null before the first."""
        return F.try_element_at(F.filter("ends", lambda e: e["step"] <= s), F.lit(-1))

    def up_to_number(hi: Column) -> Column:
        return F.filter(F.array(F.struct(F.lit(1).cast("long").alias("lo"), F.coalesce(hi, F.lit(0)).cast("long").alias("hi"))), lambda x: x["lo"] <= x["hi"])

    last = F.try_element_at(F.filter("done", lambda q: q["run_no"] < F.col("run.run_no")), F.lit(-1))
    j = j.select("video_id", F.col("run.run_no").alias("run_no"), upto(F.col("run.step")).alias("now"), last.alias("last"), "ends").filter("now is not null")
    j = j.withColumn("then", upto(F.col("last.step")))
    # the intervals the video's last commit stands on, and those of this run
    j = j.withColumns({"available": up_to_number(F.col("now.hi")), "processed": up_to_number(F.col("then.hi"))})
    j = j.withColumns({"gaps": subtracted(F.col("available"), F.col("processed")), "gone": subtracted(F.col("processed"), F.col("available"))})
    unlike = F.col("last").isNull() | ~F.col("now.content").eqNullSafe(F.col("then.content"))
    todo = j.filter((F.size("gaps") + F.size("gone") > 0) & unlike)
    return todo.select("run_no", "video_id", "gaps", merged(F.concat(subtracted(F.col("processed"), F.col("gone")), F.col("gaps"))).alias("commits"))


def available_intervals(deliveries: DataFrame, source: Column) -> DataFrame:
    """Sequence numbers ``seq`` present in a delivery table as intervals (source, lo, hi), for a :class:`Ledger`."""
    d = deliveries.filter("seq is not null").select(source.alias("source"), F.col("seq").alias("lo"), F.col("seq").alias("hi"))
    return merge_intervals(d.distinct())
