"""Forward and reverse indexes: by day, by chapter, by person, per recording, and the front page.

``records`` below is a catalogue entry with its decision and, if it was analysed,
its take: columns video_id, title, published_at, rec_date, venue, session,
is_adhaan, person, person_key, duration_seconds, reason, take_id.  ``ranges`` is
the result of ``verse_ranges``.  All orders have a tie-break by video_id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline import constants as C
from strandline.functions.text import lookup
from strandline.functions.times import clock, day_of, pretty_date, watch_link
from strandline.operators.ordered import Scan
from strandline.operators.rules import reason_label, with_decision

#: Confidence under which a verse is shown as doubtful.
DOUBTFUL = 0.8
#: A chapter whose ranges are left out of the front page's labels.
OPENER_CHAPTER = 1
RECENT_DAYS, LABELS = 14, 6


def records(catalog: DataFrame, takes: DataFrame) -> DataFrame:
    """Entries with their decision and, where there is one, the take that stands for the video."""
    d = with_decision(catalog).join(takes.select("video_id", "take_id"), "video_id", "left")
    return d.withColumn("day", day_of(F.col("rec_date"), F.col("published_at")))


def session_label(session: Column) -> Column:
    return F.initcap(session)


def range_label(name: Column, verses: Column, lo: Column, hi: Column) -> Column:
    """The chapter's name if the range is all of it, else with its verses."""
    one = F.concat(name, F.lit(" "), lo.cast("string"))
    return (
        F.when((lo == 1) & (hi == verses), name)
        .when(lo == hi, one)
        .otherwise(F.concat(one, F.lit("–"), hi.cast("string")))
    )


def chapter_name(chapter: Column, name: Column) -> Column:
    return F.coalesce(name, F.concat(F.lit("Surah "), chapter.cast("string")))


def label_ranges(ranges: DataFrame, chapters: DataFrame) -> DataFrame:
    """Add ``label``; chapters without an entry are called by their number."""
    meta = chapters.select(F.col("id").alias("chapter"), "name_simple", "verses_count")
    d = ranges.join(meta, "chapter", "left")
    name = chapter_name(F.col("chapter"), F.col("name_simple"))
    return d.withColumn("label", range_label(name, F.col("verses_count"), F.col("from_verse"), F.col("to_verse"))).drop(
        "name_simple", "verses_count"
    )


def day_index(recs: DataFrame) -> DataFrame:
    """Recordings and analysed recordings per day."""
    return recs.filter("day is not null").groupBy("day").agg(
        F.count("*").alias("recordings"), F.count("take_id").alias("analysed")
    )


def day_rank(session: Column, is_adhaan: Column, venue: Column) -> Column:
    """Place on a day's page: by session, recordings before calls, one venue before the other."""
    base = F.coalesce(lookup({s: i for i, s in enumerate(C.DAY_ORDER)}, session), F.lit(99))
    return (
        base * 4
        + F.when(F.coalesce(is_adhaan, F.lit(False)), 2).otherwise(0)
        + F.when(venue == "madeenah", 1).otherwise(0)
    )


def day_pages(recs: DataFrame) -> DataFrame:
    """Each day's recordings with their place on its page; ties in catalogue order."""
    rank = day_rank(F.col("session"), F.col("is_adhaan"), F.col("venue"))
    w = W.partitionBy("day").orderBy("day_rank", F.col("published_at").desc_nulls_last(), "video_id")
    d = recs.filter("day is not null").withColumn("day_rank", rank)
    return d.select("day", F.row_number().over(w).alias("place"), "video_id", "session", "is_adhaan", "day_rank")


def video_pages(recs: DataFrame, timeline: DataFrame, verses: DataFrame, chapters: DataFrame) -> DataFrame:
    """Each analysed recording's rows with text, link, clock, and flags; a null verse is ``not identified``.

    ``verses`` may have a column ``translation``.  Texts that are missing are ''.
    """
    key = ["surah", "ayah"]
    if "translation" not in verses.columns:
        verses = verses.withColumn("translation", F.lit(None).cast("string"))
    texts = verses.select(*key, F.col("text_uthmani").alias("verse_text"), "translation")
    meta = chapters.select(F.col("id").alias("surah"), "name_simple")
    d = recs.filter("take_id is not null").select("video_id", "take_id").join(timeline, "take_id")
    d = d.drop(timeline["video_id"]) if "video_id" in timeline.columns else d
    d = d.join(texts, key, "left").join(meta, "surah", "left")
    hit = F.col("surah").isNotNull() & F.col("ayah").isNotNull()
    name = F.concat(
        chapter_name(F.col("surah"), F.col("name_simple")), F.lit(" "), F.concat_ws(":", F.col("surah").cast("string"), F.col("ayah").cast("string"))
    )
    return d.select(
        "video_id",
        "take_id",
        "out_no",
        F.when(hit, name).otherwise("not identified").alias("reference"),
        clock(F.col("t0")).alias("at"),
        watch_link(F.col("video_id"), F.col("t0")).alias("link"),
        F.when(hit, F.coalesce("verse_text", F.lit(""))).alias("verse_text"),
        F.when(hit, F.coalesce("translation", F.lit(""))).alias("translation"),
        (hit & (F.col("conf") < DOUBTFUL)).alias("doubtful"),
        (hit & F.coalesce("is_partial", F.lit(False))).alias("partial"),
    )


def newest_first(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Add ``place`` from 1 within ``key``, by rec_date descending (ISO days as texts; null and '' last), then ``order``.

    Counted per month and carried over, so that a key with a third of all rows isn't numbered by one task.
    """
    # the first three numbers of an ISO day as one; a text of another shape has its place by its letters within the last bucket
    day = F.when(F.col("rec_date").rlike("^\\d{4}-\\d{2}-\\d{2}$"), F.translate("rec_date", "-", "").cast("int"))
    d = df.withColumns({"__day": -day, "__text": _descending_text(F.coalesce("rec_date", F.lit("")))})
    return Scan(d, [key], "__day", ["__text", *order], 100.0).prefix(F.lit(1), "sum", True, "place").result().drop("__day", "__text")


def _descending_text(c: Column) -> Column:
    """A text that sorts the other way round: its bytes inverted, longer ones before their beginnings."""
    return F.concat(F.translate(F.hex(c), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))


def chapter_pages(recs: DataFrame, ranges: DataFrame) -> DataFrame:
    """Each chapter's occurrences, newest first; a recording without a venue has none (it isn't given one)."""
    d = ranges.join(recs.filter("take_id is not null"), "take_id")
    return newest_first(d, "chapter", ["video_id", "range_no"]).select(
        "chapter",
        "place",
        "video_id",
        "range_no",
        "from_verse",
        "to_verse",
        "rec_date",
        "venue",
        watch_link(F.col("video_id"), F.col("start_seconds")).alias("link"),
    )


def chapter_index(ranges: DataFrame, chapters: DataFrame) -> DataFrame:
    """All chapters with how often and in how many takes they occur, 0 included."""
    n = ranges.groupBy(F.col("chapter").alias("id")).agg(
        F.count("*").alias("occurrences"), F.count_distinct("take_id").alias("takes")
    )
    return chapters.join(n, "id", "left").select(
        "id", "name_simple", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("occurrences", "takes")]
    )


def person_pages(recs: DataFrame) -> DataFrame:
    """Each person's recordings, newest first."""
    d = newest_first(recs.filter("person_key <> ''"), "person_key", ["video_id"])
    return d.select("person_key", "place", "video_id", "rec_date", "session")


def person_index(recs: DataFrame) -> DataFrame:
    """Persons by number of recordings, with the name on their newest one."""
    newest = F.struct("published_at", "video_id")
    return (
        recs.filter("person_key <> ''")
        .groupBy("person_key")
        .agg(F.max_by("person", newest).alias("person"), F.count("*").alias("recordings"))
        .orderBy(F.col("recordings").desc(), "person_key")
    )


def home_stats(recs: DataFrame, ranges: DataFrame) -> DataFrame:
    """One row: recordings, analysed, chapters, days."""
    a = recs.agg(
        F.count("*").alias("recordings"), F.count("take_id").alias("analysed"), F.count_distinct("day").alias("days")
    ).withColumn("one", F.lit(1))
    b = ranges.agg(F.count_distinct("chapter").alias("chapters")).withColumn("one", F.lit(1))
    return a.join(b, "one").drop("one")


def home_recent_days(recs: DataFrame, ranges: DataFrame, chapters: DataFrame, days: int = RECENT_DAYS) -> DataFrame:
    """The last days with a pretty date, counts, and up to six distinct labels in order of first sight, without the opener."""
    recent = day_index(recs).orderBy(F.col("day").desc()).limit(days)
    labelled = label_ranges(ranges, chapters).filter(F.col("chapter") != OPENER_CHAPTER)
    seen = (
        recs.filter("take_id is not null")
        .join(F.broadcast(recent.select("day")), "day", "left_semi")  # at most ``days`` rows
        .join(labelled, "take_id")
        .groupBy("day", "label")
        .agg(F.min(F.struct(F.col("published_at").isNull(), _descending("published_at"), "video_id", "range_no")).alias("first"))
        .groupBy("day")
        .agg(F.array_sort(F.collect_list(F.struct("first", "label"))).alias("l"))
        .select("day", F.slice(F.transform("l", lambda x: x["label"]), 1, LABELS).alias("labels"))
    )
    return recent.join(seen, "day", "left").select(
        "day",
        pretty_date(F.col("day")).alias("pretty"),
        "recordings",
        "analysed",
        F.array_join(F.coalesce("labels", F.array().cast("array<string>")), " · ").alias("labels"),
    )


def _descending(column: str) -> Column:
    """A text that sorts the other way round than an ISO time."""
    return F.translate(F.col(column), "0123456789", "9876543210")


def recited_lines(recs: DataFrame, ranges: DataFrame, chapters: DataFrame) -> DataFrame:
    """What a card says: why it was not analysed, that nothing was found, or the ranges in order."""
    labelled = label_ranges(ranges, chapters)
    text = labelled.groupBy("take_id").agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("range_no", "label"))), lambda x: x["label"]), " · "
        ).alias("said")
    )
    d = recs.select("video_id", "take_id", "reason", "title", "session", "is_adhaan").join(text, "take_id", "left")
    line = (
        F.when(F.col("take_id").isNull(), reason_label(F.col("reason")))
        .when(F.col("said").isNull(), "No Qur'an detected in the audio.")
        .otherwise(F.col("said"))
    )
    heading = (
        F.when(F.coalesce("is_adhaan", F.lit(False)), F.concat(F.coalesce(session_label(F.col("session")), F.lit("Prayer")), F.lit(" Adhan")))
        .when(F.col("session").isNotNull(), session_label(F.col("session")))
        .otherwise(F.col("title"))
    )
    return d.select("video_id", heading.alias("heading"), line.alias("line"))
