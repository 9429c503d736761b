"""Timed spans: windows, anchoring, overlap removal, merging, ranges."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.functions.text import strip
from strandline.functions.times import parse_clock, round_to
from strandline.operators.ordered import Scan
from strandline.session import ship, width

#: A gap of this many seconds or more keeps equal neighbours apart.
MERGE_GAP = 1.0


def plan_windows(duration: Column, window: float = 600, overlap: float = 20) -> Column:
    """Array of (start, end) seconds that cover a duration with overlapping windows.

    A duration up to one window gives one window; null gives null.  The overlap
    has to be shorter than the window.
    """
    if not 0 <= overlap < window:
        raise ValueError("the overlap must be shorter than the window")
    step = window - overlap
    last = F.when(duration <= window, F.lit(0)).otherwise(F.ceil((duration - window) / step)).cast("int")

    def at(i: Column) -> Column:
        end = F.when(duration <= window, duration).otherwise(F.least(duration, i * step + window))
        return F.struct(F.floor(i * step).cast("long").alias("start"), F.ceil(end).cast("long").alias("end"))

    return F.when(duration.isNotNull(), F.transform(F.sequence(F.lit(0), last), at))


def valid_segments(raw: DataFrame) -> DataFrame:
    """Rows whose clocks ``start`` and ``end`` can be read, in order, with a text; the rest is dropped, as at the source."""
    return (
        raw.withColumns({"t0": parse_clock(F.col("start")), "t1": parse_clock(F.col("end")), "text": strip(F.col("text"))})
        .filter("t0 is not null and t1 is not null and t1 > t0 and text <> ''")
        .drop("start", "end")
    )


def anchor_absolute(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Times of each window (``keys``; columns window_start, window_end, t0, t1) as times of the whole recording.

    They are taken as absolute already if the window starts at 0, or if all of
    them lie in the window's range and beyond its length; otherwise its start is
    added.  Null times stay null.
    """
    ends = segments.groupBy(*keys).agg(F.min("t0").alias("__lo"), F.max("t1").alias("__hi"))
    start, end = F.col("window_start"), F.col("window_end")
    is_absolute = (start == 0) | (
        (F.col("__lo") >= start - 1) & (F.col("__hi") <= end + 5) & (F.col("__hi") > end - start)
    )
    shift = F.when(F.coalesce(is_absolute, F.lit(False)), F.lit(0.0)).otherwise(start.cast("double"))
    joined = segments.join(ends, keys, "left").withColumn("__shift", shift)
    return joined.withColumns({"t0": F.col("t0") + F.col("__shift"), "t1": F.col("t1") + F.col("__shift")}).drop(
        "__lo", "__hi", "__shift"
    )


def dedupe_overlap(segments: DataFrame, key: str, order: str, text: str) -> DataFrame:
    """Drop what the next window heard again, and trim what overlaps.

    In order of t0 (ties: ``order``), against the last row kept: a row is dropped
    if it begins more than 0.5 s before that row's end with the same text; begins
    at that end if it begins before it; and is dropped if under 0.2 s remain.
    Each row depends on the last one kept, so a ``lag`` can't say it.  But where a
    row begins at or after all earlier ends, nothing before it matters; these cuts
    split a recording into short stretches, and those into Arrow batches that are
    folded with the last row kept as their only state.
    Rows with a null time are dropped.  Returns key, order, t0, t1, text.
    """
    ship(segments.sparkSession)
    kinds = dict(segments.dtypes)
    t = segments.filter("t0 is not null and t1 is not null").select(key, order, F.col("t0").cast("double"), F.col("t1").cast("double"), F.col(text).alias("__x"))
    scan = Scan(t, [key], "t0", [order]).prefix(F.col("t1"), "max", False, "__reach")
    t = scan.runs(F.col("__reach").isNull() | (F.col("t0") >= F.col("__reach")), "__part").result()
    t = t.withColumn("__s", F.xxhash64(strip(F.coalesce("__x", F.lit("")))))

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        group, end, said = None, None, None
        for b in batches:
            at, starts = [], []
            for i, (k, p, t0, t1, s) in enumerate(zip(b[key], b["__part"], b["t0"], b["t1"], b["__s"])):
                if (k, p) != group:
                    group, end = (k, p), None
                if end is not None and t0 < end:
                    if t0 < end - 0.5 and s == said:
                        continue
                    t0 = end
                if t1 - t0 < 0.2:
                    continue
                end, said = t1, s
                at.append(i)
                starts.append(t0)
            out = b.iloc[at][[key, order, "t0", "t1", "__x"]]
            yield out.assign(t0=starts)

    d = t.select(key, "__part", "t0", order, "t1", "__x", "__s").repartition(width(t), key, "__part").sortWithinPartitions(key, "__part", "t0", order)
    d = d.mapInPandas(fold, f"`{key}` {kinds[key]}, `{order}` {kinds[order]}, t0 double, t1 double, __x string")
    return d.withColumnRenamed("__x", text)


def merge_adjacent(timeline: DataFrame, key: str = "take_id", order: str = "out_no") -> DataFrame:
    """One row per stretch of neighbours with the same verse and less than ``MERGE_GAP`` s between.

    In order of t0, then ``order``.  Null verses never merge.  A stretch keeps
    the first t0, the last t1, the highest confidence, and is partial only if its
    first piece and all later ones are.
    """
    t = timeline.select(key, order, "t0", "t1", "surah", "ayah", "conf", F.coalesce("is_partial", F.lit(False)).alias("is_partial"))
    scan = Scan(t, [key], "t0", [order]).previous(["surah", "ayah", "t1"])
    same = (
        (F.col("prev.surah") == F.col("surah"))
        & F.col("prev.ayah").eqNullSafe(F.col("ayah"))
        & (F.col("t0") - F.col("prev.t1") < MERGE_GAP)
    )
    t = scan.runs(~F.coalesce(same, F.lit(False))).result()
    place = F.struct(F.col("t0").isNull(), "t0", order)
    return (
        t.groupBy(key, "run_no")
        .agg(
            F.min_by("t0", place).alias("t0"),
            F.max_by("t1", place).alias("t1"),
            F.first("surah").alias("surah"),
            F.first("ayah").alias("ayah"),
            round_to(F.max("conf"), 3).alias("conf"),
            F.bool_and("is_partial").alias("is_partial"),
            F.count("*").alias("pieces"),
        )
        .withColumn("run_no", F.col("run_no").cast("long"))
    )


def verse_ranges(timeline: DataFrame, key: str = "take_id", order: str = "out_no") -> DataFrame:
    """Ranges of consecutive verses: key, range_no, chapter, from_verse, to_verse, start_seconds.

    Rows without a verse neither count nor break a range; a repeated verse stays
    inside; anything else but the next verse of the chapter begins a new range.
    """
    t = timeline.filter("surah is not null and ayah is not null").select(key, order, "t0", "surah", "ayah")
    scan = Scan(t, [key], "t0", [order]).previous(["surah", "ayah"])
    inside = (F.col("prev.surah") == F.col("surah")) & (F.col("ayah") - F.col("prev.ayah")).isin(0, 1)
    t = scan.runs(~F.coalesce(inside, F.lit(False)), "range_no").result()
    return t.groupBy(key, "range_no").agg(
        F.first("surah").alias("chapter"),
        F.min("ayah").alias("from_verse"),
        F.max("ayah").alias("to_verse"),
        F.min_by("t0", F.struct(F.col("t0").isNull(), "t0", order)).alias("start_seconds"),
    )


def coverage(timeline: DataFrame, takes: DataFrame, key: str = "take_id") -> DataFrame:
    """Share of a take's rows that name a verse, to 3 digits; 0 for takes without rows, which are kept."""
    n = timeline.groupBy(key).agg(
        F.count("*").alias("segments"), F.count_if(F.col("surah").isNotNull()).alias("matched")
    )
    return (
        takes.select(key)
        .distinct()
        .join(n, key, "left")
        .select(
            key,
            F.coalesce("segments", F.lit(0)).alias("segments"),
            F.coalesce("matched", F.lit(0)).alias("matched"),
            F.when(F.col("segments") > 0, round_to(F.col("matched") / F.col("segments"), 3)).otherwise(0.0).alias("coverage"),
        )
    )


def number_rows(df: DataFrame, keys: list[str], order: list[Column], name: str = "pos") -> DataFrame:
    """Position from 0 in the given order."""
    return df.withColumn(name, F.row_number().over(W.partitionBy(*keys).orderBy(*order)) - 1)
