"""What analysing a catalogue would cost: grouped sums times a rate card."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline import constants as C
from strandline.functions.text import lookup

# Model, label, USD per million tokens of video input, audio input, output.
RATE_CARD = [
    ("gemini-3.6-flash", "Gemini 3.6 Flash", 1.5, 1.5, 7.5),
    ("gemini-3.5-flash", "Gemini 3.5 Flash", 1.5, 1.5, 9.0),
    ("gemini-3.5-flash-lite", "Gemini 3.5 Flash-Lite", 0.3, 0.3, 2.5),
]


def seconds_of(duration: Column, session: Column) -> Column:
    """Struct (seconds, assumed): the reported duration if positive, else what its session usually takes."""
    usual = F.coalesce(lookup(C.ASSUMED_SECONDS, session), F.lit(C.ASSUMED_SECONDS_DEFAULT)).cast("double")
    known = F.coalesce(duration > 0, F.lit(False))
    return F.struct(F.when(known, duration).otherwise(usual).alias("seconds"), (~known).alias("assumed"))


def totals(decided: DataFrame, session: str = "session") -> DataFrame:
    """One row: videos, seconds, and how many durations were assumed; zeros for an empty catalogue."""
    d = decided.filter("analyze").select(seconds_of(F.col("duration_seconds"), F.col(session)).alias("d"))
    return d.agg(
        F.count("*").alias("videos"),
        F.coalesce(F.sum("d.seconds"), F.lit(0.0)).alias("seconds"),
        F.count_if("d.assumed").alias("assumed"),
    )


def estimate(decided: DataFrame, rates: list[tuple] = RATE_CARD, session: str = "session") -> DataFrame:
    """One row per model of the rate card, with token counts and costs: the one row of totals, once per rate."""
    cards = [F.struct(*[F.lit(v).alias(c) for v, c in zip(r, ("model", "label", "v", "a", "o"))]) for r in rates]
    s, r, m = F.col("seconds"), F.col("r"), 1_000_000.0
    return (
        totals(decided, session)
        .withColumn("r", F.explode(F.array(*cards)))
        .withColumns(
            {
                "model": r["model"],
                "label": r["label"],
                "video_tokens": s * C.VIDEO_TOKENS_PER_SECOND,
                "audio_tokens": s * C.AUDIO_TOKENS_PER_SECOND,
                "output_tokens": s / 60 * C.OUTPUT_TOKENS_PER_MINUTE,
            }
        )
        .withColumns(
            {
                "input_cost": F.col("video_tokens") / m * r["v"] + F.col("audio_tokens") / m * r["a"],
                "output_cost": F.col("output_tokens") / m * r["o"],
            }
        )
        .withColumn("total", F.col("input_cost") + F.col("output_cost"))
        .withColumn("batch_total", F.col("total") * C.BATCH_FACTOR)
        .drop("r")
    )


def skipped_counts(decided: DataFrame) -> DataFrame:
    """How many entries each reason keeps out."""
    return decided.filter("not analyze").groupBy("reason").agg(F.count("*").alias("n"))
