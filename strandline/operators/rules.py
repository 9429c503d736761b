"""Which recordings are analysed, and why the others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline import constants as C
from strandline.functions.text import lookup
from strandline.functions.times import day_of


def audibility(session: Column) -> Column:
    """``audible``, ``silent`` or ``unknown`` (all other sessions, and none)."""
    return F.when(session.isin(C.AUDIBLE), "audible").when(session.isin(C.SILENT), "silent").otherwise("unknown")


def decide(is_adhaan: Column, session: Column) -> Column:
    """Reason code; the first rule that applies counts, and unknown audibility is analysed."""
    return (
        F.when(F.coalesce(is_adhaan, F.lit(False)), "adhaan")
        .when(session.isNull() | (session == ""), "unparsed-title")
        .when(audibility(session) == "silent", "silent-recitation")
        .otherwise("ok")
    )


def with_decision(catalog: DataFrame, session: str = "session") -> DataFrame:
    """Add ``reason`` and ``analyze``."""
    d = catalog.withColumn("reason", decide(F.col("is_adhaan"), F.col(session)))
    return d.withColumn("analyze", F.col("reason") == "ok")


def reason_label(reason: Column) -> Column:
    return lookup(C.REASON_LABELS, reason)


def within_last_days(catalog: DataFrame, now: str, days: int) -> DataFrame:
    """Published in the last ``days`` days before ``now`` (an ISO time, given for repeatability); unreadable times drop out."""
    since = F.to_timestamp(F.lit(now)) - F.make_dt_interval(F.lit(days))
    return catalog.filter(F.coalesce(F.try_to_timestamp("published_at"), F.lit(None)) >= since)


def before_day(catalog: DataFrame, day: str) -> DataFrame:
    """Days before ``day``, compared as text."""
    return catalog.filter(day_of(F.col("rec_date"), F.col("published_at")) < day)


def planned_duration(duration: Column, default: float = 1500) -> Column:
    """Seconds to plan windows for: the duration, or a default where none is known (1500 for one recording, 900 in bulk runs)."""
    return F.coalesce(duration, F.lit(float(default)))


def queue(catalog: DataFrame, limit: int | None = None) -> DataFrame:
    """Entries to analyse, newest first; a limit counts before finished work is taken out, 0 means none, None all."""
    q = catalog.filter("analyze").orderBy(F.col("published_at").desc_nulls_last(), "video_id")
    return q if limit is None else q.limit(limit)
