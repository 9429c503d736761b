"""Whole pipelines: catalogue, sync, estimate, comparison, site, alignment of one import."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import agreement, aligner, corpus, costs, incremental, rollups, rules, spans, sync, titles
from strandline.sources import documents, feeds, sinks


def build_catalog(spark: SparkSession, out: str, pages: str | None = None, durations: str | None = None, feed: str | None = None) -> DataFrame:
    """Listing or feed -> catalogue and review list; returns a summary row."""
    c = titles.build_catalog(feeds.read_catalog_source(spark, pages, durations, feed))
    sinks.write_catalog(c, out)
    c = spark.read.parquet(f"{out}/catalog")
    return c.agg(
        F.count("*").alias("entries"),
        F.count_if((F.col("confidence") < 0.6) | (F.size("leftovers") > 0)).alias("to_review"),
        F.count_if("date_corrected").alias("corrected"),
        F.count_distinct(F.when(F.col("person_key") != "", F.col("person_key"))).alias("persons"),
    )


def transcribe(windows: DataFrame, transcriber) -> DataFrame:
    """The pluggable step: ``transcriber`` maps (video_id, window_no, window_start, window_end) to rows with ``response``.

    No call is made here.  Returns anchored, de-duplicated segments: video_id, seg_no, t0, t1, text.
    """
    raw = documents.parse_model_output(transcriber(windows))
    s = spans.anchor_absolute(spans.valid_segments(raw), ["video_id", "window_no"])
    s = s.withColumn("order", F.col("window_no") * 1_000_000 + F.col("seg_no"))
    d = spans.dedupe_overlap(s, "video_id", "order", "text")
    return d.select("video_id", F.col("order").alias("seg_no"), "t0", "t1", "text")


def run_sync(
    spark: SparkSession, catalog: DataFrame, takes: DataFrame, segments: DataFrame, verses: DataFrame, out: str, *,
    days: int | None = None, now: str | None = None, before: str | None = None, limit: int | None = None, force: bool = False, run: str | None = None,
) -> DataFrame:
    """Filter, plan, align what isn't done, write the timelines, report.

    A recording whose fold fails is reported, and tried again next time; finished
    ones are skipped.  ``limit`` 0 means none, and so does ``days`` 0.  Rows and the
    intervals of segment numbers they were made from are committed together
    (:class:`strandline.operators.incremental.Ledger`); a recording done again
    replaces what it had.  Returns video_id, status, coverage, error.
    """
    if days is not None and now is None:
        raise ValueError("days counts back from now: give both")
    c = rules.with_decision(catalog)
    if days is not None:
        c = rules.within_last_days(c, now, days)
    if before:
        c = rules.before_day(c, before)
    queue = rules.queue(c, limit)
    ledger = incremental.Ledger(spark, f"{out}/ledger")
    done = documents_done(ledger)
    todo = sync.pending(queue, done, force).join(takes.select("video_id", "take_id"), "video_id")
    mine = segments.join(todo.select("take_id"), "take_id", "left_semi")
    rows = aligner.align(mine, corpus.build_corpus(verses)).join(todo.select("video_id", "take_id"), "take_id")
    rows.write.mode("overwrite").parquet(f"{out}/new")
    rows = spark.read.parquet(f"{out}/new")
    texts = segments.drop("video_id").join(takes.select("video_id", "take_id"), "take_id")
    status = sync.outcomes(queue, done if not force else done.limit(0), texts, rows)
    status.write.mode("overwrite").parquet(f"{out}/last_sync")
    good = rows.filter("error is null")
    if good.limit(1).count():
        used = mine.join(good.select("take_id").distinct(), "take_id", "left_semi").filter("seg_id is not null")
        used = used.select(F.col("take_id").cast("string").alias("source"), F.col("seg_id").alias("lo"), F.col("seg_id").alias("hi"))
        ledger.commit(used, good)
    sinks.append_report(sync.report(spark.read.parquet(f"{out}/last_sync")), f"{out}/reports", run or str(uuid.uuid4()))
    return spark.read.parquet(f"{out}/last_sync")


def documents_done(ledger: incremental.Ledger) -> DataFrame:
    """Videos with a committed timeline; none where nothing was committed yet."""
    d = ledger.outputs()
    return ledger.spark.createDataFrame([], "video_id string") if d is None else d.select("video_id").distinct()


def synced_timeline(spark: SparkSession, out: str) -> DataFrame | None:
    """The timelines of all runs of :func:`run_sync` into ``out``, each recording from the last run that did it."""
    return incremental.Ledger(spark, f"{out}/ledger").latest("video_id")


def planned_windows(catalog: DataFrame, window: float = 600, overlap: float = 20, default: float = 900) -> DataFrame:
    """What a transcriber is asked: video_id, window_no, window_start, window_end; unknown durations are planned with a default."""
    w = spans.plan_windows(rules.planned_duration(F.col("duration_seconds"), default), window, overlap)
    d = catalog.select("video_id", F.posexplode(w).alias("window_no", "w"))
    return d.select("video_id", "window_no", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))


def estimate(catalog: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Costs per model, and what the rules keep out."""
    d = rules.with_decision(catalog)
    return costs.estimate(d), costs.skipped_counts(d)


def compare(timeline: DataFrame, takes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Metrics per model, and the verdict on their agreement."""
    m = agreement.model_metrics(agreement.take_metrics(timeline, takes))
    return m, agreement.verdict(agreement.pair_agreement(timeline, takes))


def site(spark: SparkSession, catalog: DataFrame, takes: DataFrame, timeline: DataFrame, verses: DataFrame, chapters: DataFrame, out: str) -> DataFrame:
    """All tables an index of pages needs, each written under its name; returns one row: pages, analysed.

    The records and ranges are written first and read back, so that they are computed once.
    """
    rollups.records(catalog, takes).write.mode("overwrite").parquet(f"{out}/records")
    spans.verse_ranges(timeline).write.mode("overwrite").parquet(f"{out}/ranges")
    recs, ranges = spark.read.parquet(f"{out}/records"), spark.read.parquet(f"{out}/ranges")
    tables = {
        "day_index": rollups.day_index(recs),
        "day_pages": rollups.day_pages(recs),
        "video_pages": rollups.video_pages(recs, timeline, verses, chapters),
        "chapter_pages": rollups.chapter_pages(recs, ranges),
        "chapter_index": rollups.chapter_index(ranges, chapters),
        "person_pages": rollups.person_pages(recs),
        "person_index": rollups.person_index(recs),
        "home_stats": rollups.home_stats(recs, ranges),
        "home_recent_days": rollups.home_recent_days(recs, ranges, chapters),
        "recited_lines": rollups.recited_lines(recs, ranges, chapters),
    }
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{out}/{name}")
    read = lambda n: spark.read.parquet(f"{out}/{n}")
    pages = (
        read("day_index").select(F.lit("day").alias("kind"), F.col("day").alias("key"))
        .unionByName(read("chapter_pages").select(F.lit("chapter").alias("kind"), F.col("chapter").cast("string").alias("key")).distinct())
        .unionByName(read("person_index").select(F.lit("person").alias("kind"), F.col("person_key").alias("key")))
        .unionByName(recs.filter("take_id is not null").select(F.lit("video").alias("kind"), F.col("video_id").alias("key")))
    )
    # and the three pages that list chapters, persons and recent days
    return pages.agg((F.count("*") + 3).alias("pages"), F.count_if(F.col("kind") == "video").alias("analysed"))
