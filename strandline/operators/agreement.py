"""Comparing takes of the same recordings: metrics by model, and how far two takes agree."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.functions.similarity import lcs_agreement


def take_metrics(timeline: DataFrame, takes: DataFrame) -> DataFrame:
    """Per take: segments, unmatched, coverage, mean confidence of the matched (0 if none), failed (no rows)."""
    hit = F.col("surah").isNotNull()
    m = timeline.groupBy("take_id").agg(
        F.count("*").alias("segments"),
        F.count_if(~hit).alias("unmatched"),
        F.avg(F.when(hit, F.col("conf"))).alias("mean_conf"),
    )
    n = F.coalesce("segments", F.lit(0))
    return takes.join(m, "take_id", "left").select(
        "take_id",
        "video_id",
        "model",
        n.alias("segments"),
        F.coalesce("unmatched", F.lit(0)).alias("unmatched"),
        F.when(n > 0, (F.col("segments") - F.col("unmatched")) / F.col("segments")).otherwise(0.0).alias("coverage"),
        F.coalesce("mean_conf", F.lit(0.0)).alias("mean_conf"),
        (n == 0).alias("failed"),
    )


def model_metrics(metrics: DataFrame) -> DataFrame:
    """Per model, averages over the takes that gave rows, and how many did not; nulls where none did."""
    ok = ~F.col("failed")
    avg = lambda c: F.avg(F.when(ok, F.col(c)))
    return metrics.groupBy("model").agg(
        F.count_if(ok).alias("runs"),
        F.count_if("failed").alias("failed"),
        avg("segments").alias("avg_segments"),
        avg("coverage").alias("avg_coverage"),
        avg("mean_conf").alias("avg_conf"),
        avg("unmatched").alias("avg_unmatched"),
    )


def pair_agreement(timeline: DataFrame, takes: DataFrame) -> DataFrame:
    """Agreement of the first two takes of different models of each recording: video_id, take_a, take_b, agreement.

    Recordings with takes of one model only have no row.  LCS over the verses named, by the longer of both.
    """
    first = (
        takes.filter("model is not null and video_id is not null")
        .groupBy("video_id", "model")
        .agg(F.min("take_id").alias("take_id"))
    )
    nth = F.row_number().over(W.partitionBy("video_id").orderBy("take_id"))
    first = first.withColumn("n", nth).filter("n <= 2")
    pairs = (
        first.groupBy("video_id")
        .agg(F.max(F.when(F.col("n") == 1, F.col("take_id"))).alias("take_a"), F.max(F.when(F.col("n") == 2, F.col("take_id"))).alias("take_b"))
        .filter("take_b is not null")
    )
    verses = timeline.filter("surah is not null and ayah is not null").join(first.select("take_id"), "take_id", "left_semi")
    keys = verses.groupBy("take_id").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("t0", "out_no", "surah", "ayah"))),
            lambda x: F.concat_ws(":", x["surah"].cast("string"), x["ayah"].cast("string")),
        ).alias("keys")
    )
    a = keys.select(F.col("take_id").alias("take_a"), F.col("keys").alias("a"))
    b = keys.select(F.col("take_id").alias("take_b"), F.col("keys").alias("b"))
    d = pairs.join(a, "take_a", "left").join(b, "take_b", "left")
    return d.select("video_id", "take_a", "take_b", lcs_agreement(F.col("a"), F.col("b")).alias("agreement"))


def verdict(pairs: DataFrame) -> DataFrame:
    """Mean agreement and what it means: interchangeable above 0.95, close above 0.85, else different; null mean of no pair."""
    d = pairs.agg(F.count("agreement").alias("pairs"), F.avg("agreement").alias("mean_agreement"))
    m = F.col("mean_agreement")
    return d.withColumn(
        "verdict", F.when(m > 0.95, "interchangeable").when(m > 0.85, "close").when(m.isNotNull(), "different")
    )
