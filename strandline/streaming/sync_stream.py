"""The resumable run as a stream: new segment files are aligned once, whatever happens in between.

``trigger(availableNow=True)`` with a checkpoint takes the place of a scheduler
that skips finished work: files seen in a committed batch aren't read again, and
a batch that failed is repeated as a whole under the same number.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.operators import aligner
from strandline.tables import clean_segments

SEGMENTS = "seg_id long, take_id long, video_id string, seg_no int, t0 double, t1 double, arabic string, loaded_at timestamp"


def align_new_files(
    spark: SparkSession, segments_dir: str, corpus: DataFrame, out_dir: str, checkpoint_dir: str, options: aligner.AlignOptions = aligner.AlignOptions()
) -> None:
    """Align all takes of files that arrived since the last call; a take's segments must arrive in one batch.

    Of copies of a segment the one loaded last counts, as in a batch run.  Each
    batch overwrites its own folder, so a repeated batch leaves no copies; a take
    that arrives again in a later batch is read from that one: see :func:`aligned`.
    """
    stream = spark.readStream.schema(SEGMENTS).parquet(segments_dir)

    def batch(df: DataFrame, number: int) -> None:
        rows = aligner.align(clean_segments(df), corpus, options)
        rows.write.mode("overwrite").parquet(f"{out_dir}/batch={number}")

    q = stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint_dir).trigger(availableNow=True).start()
    q.awaitTermination()


def aligned(spark: SparkSession, out_dir: str) -> DataFrame:
    """The timelines of all batches, each take from the last batch that has it."""
    d = spark.read.parquet(out_dir)
    last = d.groupBy("take_id").agg(F.max("batch").alias("batch"))
    return d.join(last, ["take_id", "batch"]).drop("batch")


def deliveries_per_day(stream: DataFrame, delay: str = "2 days") -> DataFrame:
    """Deliveries per ingestion day and feed; in append mode, rows later than ``delay`` behind the newest are dropped by the watermark."""
    e = stream.withWatermark("ingested_at", delay)
    return e.groupBy(F.window("ingested_at", "1 day").alias("day"), "feed").agg(F.count("*").alias("deliveries"))


def run_to_table(counts: DataFrame, out_dir: str, checkpoint_dir: str) -> None:
    """Run an aggregation over everything available and keep its complete result as a table, replaced by each batch."""

    def batch(df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(out_dir)

    q = counts.writeStream.outputMode("complete").foreachBatch(batch).option("checkpointLocation", checkpoint_dir)
    q.trigger(availableNow=True).start().awaitTermination()
