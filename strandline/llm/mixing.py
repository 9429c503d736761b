"""Documents of several sources -> a mix in which each source holds its target share of all tokens.

Poisson replication: a document of a source is used as often as a Poisson
variable with the source's rate says, obtained by inverting its distribution at
a number in (0, 1) hashed from the document's id, at most ``max_uses`` times.  As
the rate grows, a document gets its first, second, ... use at certain rates, its
*steps*, which depend on its number alone.  So the rate of a source whose mean
repetition is the target one (tokens wanted over tokens there are, uses capped) is
the place among the steps of all its documents up to which their tokens add up to
what is wanted.  It is found by histograms of the steps, refined where the sum is
crossed, whose size doesn't depend on the corpus.  Of the few steps at the
crossing those are taken that fit, in their order, so that a long document just
there doesn't spoil the share of a small source.  Each document is repeated by its
count, and all uses are shuffled globally by a hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.tokens import VOCABULARY, with_sizes
from strandline.session import cut

#: Most sources; bins of a histogram; most steps looked at one by one where the sum of a source is crossed.
MAX_SOURCES, BINS, CLOSE = 1000, 1024, 1000
#: Logarithms of the smallest and the largest rate.
LEAST, MOST = np.log(1e-12), np.log(1e6)
#: A target is met if the tokens are so near to those wanted.
TOLERANCE = 0.01


def at_most(k: int, rate: np.ndarray) -> np.ndarray:
    """Poisson distribution function at ``k``."""
    term = np.exp(-rate)
    total = term.copy()
    for i in range(1, k + 1):
        term = term * rate / i
        total += term
    return total


def steps_of(u: np.ndarray, most: int) -> np.ndarray:
    """(documents x most) logarithms of the rates at which a document with number ``u`` gets its 1st, 2nd, ... use.

    The distribution falls with the rate, so a document has k + 1 uses or more where it is under u at k.
    """
    out = np.empty((len(u), most))
    for k in range(most):
        lo, hi = np.full(len(u), LEAST), np.full(len(u), MOST)
        for _ in range(52):
            mid = (lo + hi) / 2
            low = at_most(k, np.exp(mid)) < u
            hi, lo = np.where(low, mid, hi), np.where(low, lo, mid)
        out[:, k] = hi
    return out


def uses_of(u: np.ndarray, rate: float, most: int) -> np.ndarray:
    """How often documents with the numbers ``u`` are used at a rate."""
    return (steps_of(u, most) <= np.log(rate)).sum(1)


def crossed(sums: np.ndarray, wanted: float) -> int:
    """The bin in which the running sum reaches ``wanted``; the number of bins if none does."""
    return int(np.searchsorted(np.cumsum(sums), wanted, "left"))


def top_up(steps: list[tuple[float, int, int]], missing: float) -> list[int]:
    """(step, doc_id, tokens) -> the ids that get one more use each time they occur: those that fit what is missing, in order of their steps.

    A step that would exceed it is taken only if that comes nearer than leaving it out, as the last one.
    """
    steps, out = sorted(steps), []
    for _, doc, tokens in steps:
        if tokens <= missing:
            out.append(doc)
            missing -= tokens
    taken, rest = list(out), []
    for _, doc, tokens in steps:
        if doc in taken:
            taken.remove(doc)
        else:
            rest.append((abs(tokens - missing), doc))
    if rest and min(rest)[0] < missing:
        out.append(min(rest)[1])
    return out


def _targets(targets: DataFrame) -> dict[str, tuple[float, int]]:
    rows = targets.filter("source is not null").groupBy("source").agg(F.max("target_share").alias("s"), F.max("max_uses").alias("m")).limit(MAX_SOURCES + 1).collect()
    if len(rows) > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    whole = sum(max(r.s or 0.0, 0.0) for r in rows) or 1.0
    return {r.source: (max(r.s or 0.0, 0.0) / whole, max(r.m or 0, 0)) for r in rows}


def _with_steps(d: DataFrame, most: dict[str, int]) -> DataFrame:
    """Add ``steps``: the logarithms of the rates at which a document is used once more."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            steps: list = [None] * len(b)
            for source, at in b.groupby("source").indices.items():
                for i, s in zip(at, steps_of(b["u"].to_numpy()[at], most[source])):
                    steps[i] = s
            b["steps"] = steps
            yield b[["doc_id", "source", "tokens", "steps"]]

    return d.select("doc_id", "source", "tokens", "u").mapInPandas(run, "doc_id long, source string, tokens int, steps array<double>")


def _places(d: DataFrame, wanted: dict[str, float]) -> dict[str, tuple[float, list[int]]]:
    """For each source the step up to which all are taken, and the ids that get one more use beyond it (once per occurrence)."""
    spark = d.sparkSession
    steps = d.select("source", "doc_id", "tokens", F.explode("steps").alias("x"))

    def ranged(spans: dict[str, tuple[float, float]]) -> DataFrame:
        """Steps of the sources in their spans; one row per source is broadcast."""
        r = spark.createDataFrame([(s, float(a), float(b)) for s, (a, b) in spans.items()], "source string, a double, b double")
        return steps.join(F.broadcast(r), "source").filter("x >= a and x < b")

    open_ = {s: (LEAST, MOST + 1) for s, w in wanted.items() if w > 0}
    missing, out, close = dict(wanted), {s: (-np.inf, []) for s in wanted}, {}
    while open_:
        bin_ = F.least(F.floor((F.col("x") - F.col("a")) / (F.col("b") - F.col("a")) * BINS), F.lit(BINS - 1)).cast("int")
        got = ranged(open_).groupBy("source", bin_.alias("bin")).agg(F.sum("tokens").alias("t"), F.count("*").alias("n"), F.min("x").alias("lo"), F.max("x").alias("hi"))
        hist = {s: {} for s in open_}
        for r in got.toLocalIterator():  # at most sources x BINS rows
            hist[r.source][r.bin] = r
        for s, bins in hist.items():
            rows = [bins[i] for i in sorted(bins)]
            i = crossed(np.array([r.t for r in rows], float), missing[s])
            if i >= len(rows):  # all uses there are don't exceed what is wanted
                out[s] = (np.inf, [])
                open_.pop(s)
                continue
            missing[s] -= sum(r.t for r in rows[:i])
            a, b = rows[i].lo, np.nextafter(rows[i].hi, np.inf)
            if rows[i].n <= CLOSE or a == rows[i].hi:
                # the bins after it, as long as there are few steps
                n, j = rows[i].n, i + 1
                while j < len(rows) and n + rows[j].n <= CLOSE:
                    n, j = n + rows[j].n, j + 1
                close[s] = (a, np.nextafter(rows[j - 1].hi, np.inf))
                open_.pop(s)
            else:
                open_[s] = (a, b)
    if close:
        near: dict[str, list] = {s: [] for s in close}
        # at most CLOSE steps of each source, but for documents whose numbers are the very same
        for r in ranged(close).select("source", "x", "doc_id", "tokens").toLocalIterator():
            near[r.source].append((r.x, r.doc_id, r.tokens))
        for s, (a, _) in close.items():
            out[s] = (a, top_up(near[s], missing[s]))
    return out


def mix(
    documents: DataFrame, targets: DataFrame, total_tokens: float | None = None, seed: int = 1, vocabulary: str = VOCABULARY
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, source, text), (source, target_share, max_uses) -> the uses, and the shares reached.

    ``total_tokens`` is the size of the mix; by default, as many as the documents of
    the sources have.  A source gets its target share of it, or, where its uses don't
    suffice for that, all of them; no other source gives up tokens for it.

    Uses: doc_id, source, use_no (from 1), tokens, place (a hash; the rows are in
    its order).  Report, one row per target: source, target_share, max_uses, docs,
    tokens_available, docs_used, uses, tokens, share (of all tokens used), wanted_tokens,
    feasible (its uses suffice), met (within 1 % of the tokens wanted).  A source
    without documents is reported as not met.  Documents of other sources, with a
    null source, or without text aren't used.  Targets that don't sum to 1 are
    scaled.  Documents of the same id have the same number of uses.
    """
    spark = documents.sparkSession
    goal = _targets(targets)
    d = documents.select("doc_id", "source", "text").filter(F.col("source").isin(list(goal)) & F.col("doc_id").isNotNull())
    d = with_sizes(d, "text", vocabulary).filter("tokens > 0")
    u = (F.shiftrightunsigned(F.xxhash64("doc_id", F.lit(seed)), 11) + 0.5) / float(1 << 53)
    d = cut(_with_steps(d.withColumn("u", u), {s: m for s, (_, m) in goal.items()}))

    have = {r.source: r.t for r in d.groupBy("source").agg(F.sum("tokens").alias("t")).collect()}  # a row per source
    total = float(sum(have.values())) if total_tokens is None else float(total_tokens)
    wanted = {s: share * total if m > 0 and have.get(s, 0) > 0 else 0.0 for s, (share, m) in goal.items()}
    places = _places(d, wanted)
    limits = spark.createDataFrame([(s, float(x)) for s, (x, _) in places.items()], "source string, upto double")
    more = [(s, i) for s, (_, ids) in places.items() for i in ids]
    more = spark.createDataFrame(more, "source string, doc_id long").groupBy("source", "doc_id").agg(F.count("*").alias("more"))
    counted = d.join(F.broadcast(limits), "source").join(F.broadcast(more), ["source", "doc_id"], "left")  # a row, and at most CLOSE rows, per target
    n: Column = F.size(F.filter("steps", lambda x: x < F.col("upto"))) + F.coalesce("more", F.lit(0))
    counted = counted.withColumn("n", n.cast("int"))
    used = counted.filter("n > 0").select("doc_id", "source", "tokens", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("use_no"))
    place = F.xxhash64("doc_id", "use_no", F.lit(seed + 1))
    shuffled = used.withColumn("place", place).repartitionByRange("place", "doc_id", "use_no").sortWithinPartitions("place", "doc_id", "use_no")

    got = counted.groupBy("source").agg(
        F.count("*").alias("docs"),
        F.sum("tokens").alias("tokens_available"),
        F.count_if(F.col("n") > 0).alias("docs_used"),
        F.sum("n").alias("uses"),
        F.sum(F.col("n") * F.col("tokens")).alias("tokens"),
    )
    plan_rows = spark.createDataFrame([(s, share, m, float(share * total)) for s, (share, m) in goal.items()], "source string, target_share double, max_uses int, wanted_tokens double")
    report = plan_rows.join(got, "source", "left").na.fill(0)
    all_tokens = report.agg(F.sum("tokens").alias("all_tokens")).withColumn("one", F.lit(1))
    report = report.withColumn("one", F.lit(1)).join(all_tokens, "one").drop("one")
    share = F.when(F.col("all_tokens") > 0, F.col("tokens") / F.col("all_tokens")).otherwise(0.0)
    met = F.abs(F.col("tokens") - F.col("wanted_tokens")) <= TOLERANCE * F.col("wanted_tokens")
    feasible = F.col("max_uses") * F.col("tokens_available") >= F.col("wanted_tokens")
    return shuffled, report.withColumns({"share": share, "feasible": feasible & (F.col("wanted_tokens") > 0), "met": met & (F.col("wanted_tokens") > 0)}).drop("all_tokens")
