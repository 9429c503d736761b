"""Sinks: tables by key, the catalogue with its review list, reports, pages of an index."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.functions.text import escape_html
from strandline.operators.titles import needs_review


def write_by_key(df: DataFrame, path: str, key: str, buckets: int = 64) -> None:
    """Overwrite a table partitioned by a hash of its key: a partition per key would be a file per recording.

    Filters on the key also need the ``bucket`` it is in: see :func:`bucket_of`.
    """
    d = df.withColumn("bucket", bucket_of(key, buckets))
    d.repartition(buckets, "bucket").sortWithinPartitions("bucket", key).write.mode("overwrite").partitionBy("bucket").parquet(path)


def bucket_of(key: str, buckets: int = 64):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_catalog(catalog: DataFrame, path: str) -> None:
    """The catalogue and the list of what was not understood, as two tables."""
    catalog.write.mode("overwrite").parquet(f"{path}/catalog")
    needs_review(catalog).write.mode("overwrite").parquet(f"{path}/unparsed")


def append_report(report: DataFrame, path: str, run: str) -> None:
    """Append one run's report."""
    report.withColumn("run", F.lit(run)).coalesce(1).write.mode("append").json(path)


def export_json(df: DataFrame, path: str) -> None:
    """One JSON object per line."""
    df.write.mode("overwrite").json(path)


def day_pages_html(days: DataFrame, lines: DataFrame, path: str) -> int:
    """Bare pages, one text row per day with its recordings' headings and lines; returns the number of pages.

    ``days``: day, place, video_id; ``lines``: video_id, heading, line.
    """
    row = F.concat(F.lit("<li><b>"), escape_html(F.coalesce("heading", F.lit(""))), F.lit("</b> "), escape_html(F.coalesce("line", F.lit(""))), F.lit("</li>"))
    d = days.join(lines, "video_id", "left").select("day", F.struct("place", row.alias("row")).alias("r"))
    d = d.groupBy("day").agg(F.array_join(F.transform(F.array_sort(F.collect_list("r")), lambda x: x["row"]), "\n").alias("body"))
    page = F.concat(F.lit("<h1>"), "day", F.lit("</h1>\n<ul>\n"), "body", F.lit("\n</ul>\n"))
    d.select("day", page.alias("html")).write.mode("overwrite").parquet(path)
    return days.select("day").distinct().count()
