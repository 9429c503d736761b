"""Reading the tables, and the views of them that most operators start from.

A delivery table holds several rows per record; the views keep one, by a
``row_number`` limit, which Spark also applies before the shuffle
(WindowGroupLimit), so a key with very many copies moves one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.session import ship


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep_last(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first by ``order``.  Null keys form a group of their own."""
    rank = "__rank"
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) == 1).drop(rank)


def current_catalog(deliveries: DataFrame) -> DataFrame:
    """The latest delivery of each video (``ingested_at``, ties by ``row_id``)."""
    return keep_last(
        deliveries.filter("video_id is not null"),
        ["video_id"],
        [F.col("ingested_at").desc_nulls_last(), F.col("row_id").desc()],
    )


def clean_timeline(rows: DataFrame) -> DataFrame:
    """Each (take_id, out_no) once, the copy loaded last."""
    return keep_last(
        rows,
        ["take_id", "out_no"],
        [F.col("loaded_at").desc_nulls_last(), F.col("t0"), F.col("t1"), F.col("surah"), F.col("ayah"), F.col("conf")],
    )


def clean_segments(rows: DataFrame) -> DataFrame:
    """Each seg_id once, the copy loaded last."""
    return keep_last(
        rows,
        ["seg_id"],
        [F.col("loaded_at").desc_nulls_last(), F.col("t0"), F.col("t1"), F.col("arabic")],
    )


def current_takes(takes: DataFrame) -> DataFrame:
    """The take that stands for a video: generated last, ties by take_id."""
    return keep_last(
        takes.filter("video_id is not null"),
        ["video_id"],
        [F.col("generated_at").desc_nulls_last(), F.col("take_id").desc()],
    )
