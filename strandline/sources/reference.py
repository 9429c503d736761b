"""The reference store: chapters, verses, translations, as four tables of a folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.tables import keep_last

TABLES = ("surah", "ayah", "translation_source", "translation")


class StoreError(ValueError):
    """A table isn't what it has to be."""


def check_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Raise where a primary key is null or repeated."""
    null = F.lit(False)
    for k in keys:
        null = null | F.col(k).isNull()
    bad = df.groupBy(*keys).agg(F.count("*").alias("n")).filter((F.col("n") > 1) | null).limit(5).collect()
    if bad:
        raise StoreError(f"{name}: keys repeated or null: {bad}")
    return df


def check_count(df: DataFrame, expected: int, name: str) -> DataFrame:
    """Raise unless there are exactly so many rows (a canonical text is complete or it is wrong)."""
    n = df.count()
    if n != expected:
        raise StoreError(f"{name}: {n} rows instead of {expected}")
    return df


def write_store(path: str, surah: DataFrame, ayah: DataFrame, expected_verses: int | None = None) -> None:
    """Replace chapters and verses as a whole, after checking keys and, where given, the number of verses."""
    check_unique(surah, ["id"], "surah")
    check_unique(ayah, ["surah", "ayah"], "ayah")
    if expected_verses is not None:
        check_count(ayah, expected_verses, "ayah")
    # sorted by key, so that row groups can be skipped by their bounds; it takes the place of a secondary index
    surah.orderBy("id").write.mode("overwrite").parquet(f"{path}/surah")
    ayah.sort("surah", "ayah").write.mode("overwrite").parquet(f"{path}/ayah")


def add_translations(spark: SparkSession, path: str, sources: dict[str, tuple[str, str, str, DataFrame]]) -> dict[str, str | None]:
    """Add translations: id -> (name, author, language, rows of surah, ayah, text).

    One that fails (no rows, an unreadable file) is reported and doesn't stop the
    others; each replaces its own partition only.  Repeated keys: the last row by ``seq``
    (if there is such a column) wins.  Returns id -> error or None.
    """
    out: dict[str, str | None] = {}
    done = []
    for key, (name, author, language, rows) in sources.items():
        try:
            order: list[Column] = [F.col("seq").desc()] if "seq" in rows.columns else [F.col("text")]
            d = keep_last(rows, ["surah", "ayah"], order).select("surah", "ayah", "text").filter("text is not null")
            if not d.limit(1).count():
                raise StoreError("no rows")
            d.sort("surah", "ayah").write.mode("overwrite").parquet(f"{path}/translation/source_id={key}")
            done.append((key, name, author, language))
            out[key] = None
        except Exception as e:  # noqa: BLE001 - each source for itself
            out[key] = str(e)[:300]
    if done:
        # a row per source, in a folder of its own: adding a source again replaces it
        for key, *rest in done:
            new = spark.createDataFrame([tuple(rest)], "name string, author string, language string")
            new.coalesce(1).write.mode("overwrite").parquet(f"{path}/translation_source/id={key}")
    return out


def chapters(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/surah").orderBy("id")


def verses(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/ayah")


def translation(spark: SparkSession, path: str, source_id: str) -> DataFrame:
    """One translation; only its partition is read."""
    return spark.read.parquet(f"{path}/translation").filter(F.col("source_id") == source_id).select("surah", "ayah", "text")


def translation_label(spark: SparkSession, path: str, source_id: str) -> str:
    """Its author, or its id where it isn't known."""
    d = spark.read.parquet(f"{path}/translation_source").filter(F.col("id").cast("string") == source_id).select("author").limit(1).collect()
    return d[0].author if d and d[0].author else source_id


def with_translation(all_verses: DataFrame, texts: DataFrame) -> DataFrame:
    """Verses with a column ``translation``; null where there is none."""
    return all_verses.join(texts.withColumnRenamed("text", "translation"), ["surah", "ayah"], "left")
