"""Planning and reporting a resumable run: what is done, what is cached, what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Coverage under which a finished recording is worth a look.
REVIEW_LIMIT = 0.85


def pending(queue: DataFrame, done: DataFrame, force: bool = False) -> DataFrame:
    """Entries without a timeline yet; all of them if forced."""
    return queue if force else queue.join(done.select("video_id").distinct(), "video_id", "left_anti")


def with_source(entries: DataFrame, cached: DataFrame, force: bool = False) -> DataFrame:
    """Add ``source``: ``cache`` where a transcript exists (whatever its model), else ``transcribe``."""
    have = cached.select("video_id").distinct().withColumn("__c", F.lit(not force))
    d = entries.join(have, "video_id", "left")
    return d.withColumn("source", F.when(F.coalesce("__c", F.lit(False)), "cache").otherwise("transcribe")).drop("__c")


def outcomes(queue: DataFrame, done: DataFrame, segments: DataFrame, timeline: DataFrame) -> DataFrame:
    """Status of each entry after a run: video_id, status, coverage, error.

    ``skipped``: it was done before.  ``failed``: its fold failed.  ``done``: it has
    rows.  ``empty``: a transcript without text; no timeline is written, so it is
    looked at again next time.  ``missing``: no transcript.
    ``timeline`` carries video_id and the aligner's columns.
    """
    ids = lambda d: d.select("video_id").distinct()
    flag = lambda d, n: ids(d).withColumn(n, F.lit(True))
    rows = timeline.groupBy("video_id").agg(
        F.count("t0").alias("n"), F.count_if(F.col("surah").isNotNull()).alias("hit"), F.max("error").alias("error")
    )
    d = (
        queue.select("video_id")
        .join(flag(done, "is_done"), "video_id", "left")
        .join(flag(segments, "has_text"), "video_id", "left")
        .join(rows, "video_id", "left")
    )
    status = (
        F.when(F.col("is_done"), "skipped")
        .when(F.col("error").isNotNull(), "failed")
        .when(F.col("n") > 0, "done")
        .when(F.col("has_text"), "empty")
        .otherwise("missing")
    )
    cover = F.when(status == "done", F.floor(F.col("hit") / F.col("n") * 1000 + 0.5) / 1000)
    return d.select("video_id", status.alias("status"), cover.alias("coverage"), "error")


def report(status: DataFrame) -> DataFrame:
    """One row: attempted, done, skipped, empty, failed, needs_review (done with low coverage)."""
    n = lambda s: F.count_if(F.col("status") == s)
    low = (F.col("status") == "done") & (F.col("coverage") < REVIEW_LIMIT)
    return status.agg(
        F.count("*").alias("attempted"),
        *[n(s).alias(s) for s in ("done", "skipped", "empty", "failed")],
        F.count_if(low).alias("needs_review"),
    )


def review_list(status: DataFrame, limit: int = 10) -> DataFrame:
    """The finished recordings with the lowest coverage: a report of ``limit`` rows."""
    low = status.filter((F.col("status") == "done") & (F.col("coverage") < REVIEW_LIMIT))
    return low.orderBy("coverage", "video_id").limit(limit)
