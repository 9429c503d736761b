"""JSON documents on disk: transcripts, catalogues, timelines, imports.  Schemas are explicit; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.text import strip
from strandline.functions.times import parse_clock
from strandline.sources import files

SEGMENT = "struct<t0:double, t1:double, arabic:string>"
RAW_SEGMENT = "struct<start:string, end:string, arabic:string>"
TRANSCRIPT = f"model string, windows int, segments array<{SEGMENT}>"
ENTRY = (
    "struct<videoId:string, title:string, publishedAt:string, durationSeconds:double, date:string, mosque:string, prayer:string, "
    "isAdhaan:boolean, sheikh:string, sheikhKey:string, confidence:double, leftovers:array<string>, dateCorrected:boolean>"
)
CATALOG = f"channelId string, generatedAt string, count int, entries array<{ENTRY}>"
TIMELINE = (
    "videoId string, generatedAt string, modelVersion string, alignerVersion string, coverage double, "
    "segments array<struct<t0:double, t1:double, surah:int, ayah:int, conf:double, partial:boolean>>"
)


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """One document per file.  A file that isn't JSON of this shape gives a row of nulls (PERMISSIVE)."""
    return spark.read.schema(schema).json(path, multiLine=True, pathGlobFilter="*.json")


def read_json_folder(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Like :func:`read_json`; a folder that doesn't exist, or has no document, is empty, on any file system."""
    if not any(x.endswith(".json") for x in files.names(spark, path)):
        return spark.createDataFrame([], schema)
    return read_json(spark, path, schema)


def read_transcripts(spark: SparkSession, path: str) -> DataFrame:
    """Cached transcripts ``<video_id>.transcript.json`` -> video_id, model, windows, seg_no, t0, t1, arabic.

    The id is that of the file; a transcript without segments has one row with a null seg_no.
    """
    d = read_json_folder(spark, path, TRANSCRIPT)
    name = F.col("_metadata.file_name") if d.inputFiles() else F.lit(None).cast("string")
    d = d.select(F.regexp_extract(name, r"^(.*)\.transcript\.json$", 1).alias("video_id"), "model", "windows", F.posexplode_outer("segments").alias("seg_no", "s"))
    return d.select("video_id", "model", "windows", "seg_no", "s.t0", "s.t1", "s.arabic")


def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """A catalogue document as entries."""
    e = read_json(spark, path, CATALOG).select(F.explode("entries").alias("e"))
    names = {
        "videoId": "video_id", "title": "title", "publishedAt": "published_at", "durationSeconds": "duration_seconds", "date": "rec_date",
        "mosque": "venue", "prayer": "session", "isAdhaan": "is_adhaan", "sheikh": "person", "sheikhKey": "person_key",
        "confidence": "confidence", "leftovers": "leftovers", "dateCorrected": "date_corrected",
    }
    d = e.select(*[F.col(f"e.{a}").alias(b) for a, b in names.items()])
    return d.withColumn("date_corrected", F.coalesce("date_corrected", F.lit(False)))


def read_timelines(spark: SparkSession, path: str) -> DataFrame:
    """A folder of timelines (it may be missing) -> video_id, coverage, aligner_version, out_no, t0, t1, surah, ayah, conf, is_partial."""
    d = read_json_folder(spark, path, TIMELINE)
    d = d.select("videoId", "coverage", "alignerVersion", F.posexplode_outer("segments").alias("out_no", "s"))
    return d.select(
        F.col("videoId").alias("video_id"), "coverage", F.col("alignerVersion").alias("aligner_version"), "out_no",
        "s.t0", "s.t1", "s.surah", "s.ayah", "s.conf", F.coalesce("s.partial", F.lit(False)).alias("is_partial"),
    )


def import_manual(spark: SparkSession, path: str) -> DataFrame:
    """A transcript made by hand: an array of segments, or an object with ``segments``; clocks or seconds.

    Returns model (``manual-import``), windows (1), seg_no, t0, t1, arabic.  Rows
    with unreadable or reversed times or a blank text are dropped.
    """
    t = spark.read.text(path, wholetext=True)
    either = "struct<t0:string, t1:string, start:string, end:string, arabic:string>"
    as_object = F.from_json("value", f"struct<segments:array<{either}>>")["segments"]
    rows = F.coalesce(F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", f"array<{either}>")), as_object)
    d = t.select(F.posexplode(rows).alias("seg_no", "s"))
    time = lambda a, b: F.coalesce(F.col(f"s.{a}").try_cast("double"), parse_clock(F.col(f"s.{b}")))
    d = d.select("seg_no", time("t0", "start").alias("t0"), time("t1", "end").alias("t1"), strip(F.col("s.arabic")).alias("arabic"))
    d = d.filter("t0 is not null and t1 > t0 and arabic <> ''")
    return d.select(F.lit("manual-import").alias("model"), F.lit(1).alias("windows"), "seg_no", "t0", "t1", "arabic")


def parse_model_output(windows: DataFrame, value: str = "response") -> DataFrame:
    """Raw answers of a transcriber (one row per window, a JSON text each) as raw segments; unreadable or empty ones give none.

    Keeps the other columns; adds seg_no, start, end, text.
    """
    keep = [c for c in windows.columns if c != value]
    segs = F.from_json(value, f"struct<segments:array<{RAW_SEGMENT}>>")["segments"]
    d = windows.select(*keep, F.posexplode(segs).alias("seg_no", "s"))
    return d.select(*keep, "seg_no", "s.start", "s.end", F.col("s.arabic").alias("text"))
