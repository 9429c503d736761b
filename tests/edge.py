"""Folders with all tables empty, or with rows of nulls and one row twice, made from the schemas of the smallest tables."""

from __future__ import annotations

import os

from compare import DATA
from pyspark.sql import functions as F

SOURCE = f"{DATA}/sf0.001"


def tables():
    return [f.removesuffix(".parquet") for f in sorted(os.listdir(SOURCE)) if f.endswith(".parquet")]


def empty_folder(spark, folder: str) -> str:
    for t in tables():
        spark.read.parquet(f"{SOURCE}/{t}.parquet").limit(0).write.parquet(f"{folder}/{t}.parquet")
    return folder


def null_folder(spark, folder: str) -> str:
    """Two rows of nulls, and one real row three times with an extra column whose name clashes with results'."""
    for t in tables():
        d = spark.read.parquet(f"{SOURCE}/{t}.parquet")
        one = d.limit(1)
        nulls = one.select(*[F.lit(None).cast(x.dataType).alias(x.name) for x in d.schema])
        all_ = one.union(one).union(one).union(nulls).union(nulls)
        for extra in ("code", "field", "n", "key", "rank", "kind", "label", "reason"):
            if extra not in d.columns:
                all_ = all_.withColumn(extra, F.lit("x"))
        all_.write.parquet(f"{folder}/{t}.parquet")
    return folder
