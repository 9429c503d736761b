"""Feeds (RSS/Atom) and pages of a REST listing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.text import decode_entities, strip
from strandline.functions.times import parse_iso_duration

PAGE = "items array<struct<videoId:string, title:string, publishedAt:string>>, nextPageToken string"
DURATIONS = "items array<struct<id:string, duration:string>>"


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Feed files as entries."""
    return entries_of_feed(spark.read.text(path, wholetext=True))


def entries_of_feed(feeds: DataFrame, value: str = "value") -> DataFrame:
    """XML texts -> video_id, title, published_at, duration_seconds (null: a feed has none).

    An entry that lacks its id, title or time, or has an empty one, is dropped.
    Titles are decoded and trimmed.
    """
    e = feeds.select(F.explode(F.regexp_extract_all(value, F.lit(r"(?s)<entry>(.*?)</entry>"), F.lit(1))).alias("e"))
    tag = lambda name: F.regexp_extract("e", rf"(?s)<{name}>(.*?)</{name}>", 1)
    d = e.select(tag("yt:videoId").alias("video_id"), tag("media:title").alias("title"), tag("published").alias("published_at"))
    d = d.filter("video_id <> '' and title <> '' and published_at <> ''")
    return d.select(
        "video_id", strip(decode_entities(F.col("title"))).alias("title"), "published_at", F.lit(None).cast("double").alias("duration_seconds")
    )


def read_pages(spark: SparkSession, path: str, max_videos: int | None = None) -> DataFrame:
    """Saved pages of a listing (page-<n>.json, one document each) -> video_id, title, published_at.

    ``max_videos`` stops after the page that reaches it, as the paged scan does,
    so up to a page more may come out.
    """
    p = spark.read.schema(PAGE).json(path, multiLine=True, pathGlobFilter="*.json")
    p = p.withColumn("page", F.regexp_extract("_metadata.file_name", r"(\d+)\.json$", 1).try_cast("int"))
    if max_videos is not None:
        # one row per page: 50 videos each, so this is small against what it lists
        from pyspark.sql import Window as W

        before = F.sum(F.size("items")).over(W.orderBy("page").rowsBetween(W.unboundedPreceding, -1))
        p = p.withColumn("before", F.coalesce(before, F.lit(0))).filter(F.col("before") < max_videos)
    i = p.select(F.explode("items").alias("i"))
    return i.select(F.col("i.videoId").alias("video_id"), "i.title", F.col("i.publishedAt").alias("published_at"))


def with_durations(videos: DataFrame, durations: DataFrame) -> DataFrame:
    """Add duration_seconds from (id, ISO duration); null where the lookup failed or is absent."""
    d = durations.select(F.col("id").alias("video_id"), parse_iso_duration(F.col("duration")).alias("duration_seconds"))
    return videos.join(d.dropDuplicates(["video_id"]), "video_id", "left")


def read_catalog_source(spark: SparkSession, pages: str | None, durations: str | None, feed: str | None) -> DataFrame:
    """The paged listing where it is given (it has durations), else the feed."""
    if pages:
        looked_up = spark.read.schema(DURATIONS).json(durations, multiLine=True).select(F.explode("items").alias("i")).select("i.*")
        return with_durations(read_pages(spark, pages), looked_up)
    if feed:
        return read_feed(spark, feed)
    raise ValueError("neither pages nor a feed is given")
