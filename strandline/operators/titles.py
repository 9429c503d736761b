"""Titles typed by people -> columns, a confidence, and what was left over.

One narrow projection: token arrays and higher-order functions, no shuffle, no
Python.  Each recogniser takes the tokens it understands; the rest is reported.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline import constants as C
from strandline.functions.text import fold, let, lookup, plain_letters, squeeze
from strandline.functions.times import round_to


def tidy(title: Column) -> Column:
    """A title with straight quotes and single spaces; empty for null."""
    return squeeze(F.translate(F.coalesce(title, F.lit("")), "‘’ʻʼ`", "'''''"))


def _day(token: Column) -> Column:
    raw = F.regexp_replace(token, "[^0-9A-Za-z]", "")
    n = F.regexp_extract(raw, r"(?i)^(\d{1,2})(st|nd|rd|th)?$", 1).try_cast("int")
    return F.when(n.between(1, 31), n)


def _year(token: Column) -> Column:
    raw = F.regexp_replace(token, "[^0-9]", "")
    n = raw.try_cast("int")
    return F.when((F.length(raw) == 4) & n.between(1990, 2100), n).when(F.length(raw) == 2, 2000 + n)


def _at(array: Column, i: Column) -> Column:
    return F.try_element_at(array, i + 1)


def _find_date(t: Column, k: Column) -> Column:
    """Struct (i, iso) of the first place where day, month and a usable year follow each other; null if there is none."""
    n = F.size(t)
    places = F.when(n >= 3, F.sequence(F.lit(0), n - 3)).otherwise(F.array().cast("array<int>"))
    # few places have a month; only these are looked at more closely
    places = F.filter(places, lambda i: _at(k, i + 1).isin(list(C.MONTHS)))
    read = F.transform(
        places,
        lambda i: F.struct(
            i.alias("i"), _day(_at(t, i)).alias("d"), lookup(C.MONTHS, _at(k, i + 1)).alias("m"), _year(_at(t, i + 2)).alias("y")
        ),
    )
    hit = F.filter(read, lambda x: x["d"].isNotNull() & x["m"].isNotNull() & x["y"].isNotNull())
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    return F.try_element_at(
        F.transform(hit, lambda x: F.struct(x["i"].alias("i"), F.concat_ws("-", x["y"].cast("string"), pad(x["m"]), pad(x["d"])).alias("iso"))),
        F.lit(1),
    )


def _recognise(date: Column, free: Column) -> Column:
    """Struct of all columns from the date and the tokens (i, t, k) outside it."""
    first = lambda cond: F.try_element_at(F.filter(free, cond), F.lit(1))
    # the dictionaries don't share a key, so each recogniser's first hit stands for itself
    hits = F.struct(
        first(lambda x: x["k"].isin(list(C.VENUES))).alias("v"),
        first(lambda x: x["k"].isin(list(C.SESSIONS))).alias("s"),
        first(lambda x: x["k"].isin(C.HONORIFICS)).alias("h"),
        F.exists(free, lambda x: x["k"].isin(C.CALLS)).alias("call"),
    )

    def rest_of(h: Column) -> Column:
        session = lookup(C.SESSIONS, h["s"]["k"])
        taken = lambda x: (
            x["i"].eqNullSafe(h["v"]["i"])
            | x["i"].eqNullSafe(h["s"]["i"])
            | x["i"].eqNullSafe(h["h"]["i"])
            | x["k"].isin(C.CALLS)
            | F.coalesce((session == "eid") & (x["i"] > h["s"]["i"]) & x["k"].isin(C.EID_QUALIFIERS), F.lit(False))
        )
        after = lambda x: F.coalesce(x["i"] > h["h"]["i"], F.lit(False))

        def columns(left: Column) -> Column:
            name = F.array_join(F.transform(F.filter(left, after), lambda x: x["t"]), " ")
            rest = F.filter(left, lambda x: ~after(x) & ~x["k"].isin(C.NOISE))
            part = lambda cond, w: F.when(cond, F.lit(w)).otherwise(0.0)
            confidence = (
                part(date.isNotNull(), 0.3)
                + part(h["v"].isNotNull(), 0.25)
                + part(h["s"].isNotNull() | h["call"], 0.3)
                + part(name != "", 0.15)
            )
            return F.struct(
                date["iso"].alias("rec_date"),
                lookup(C.VENUES, h["v"]["k"]).alias("venue"),
                session.alias("session"),
                h["call"].alias("is_adhaan"),
                F.when(name != "", name).alias("person"),
                F.when(name != "", fold(name)).alias("person_key"),
                round_to(confidence, 2).alias("confidence"),
                F.transform(rest, lambda x: x["t"]).alias("leftovers"),
            )

        return let(F.filter(free, lambda x: ~taken(x)), columns)

    return let(hits, rest_of)


def parse_title(title: Column) -> Column:
    """A title as one struct; each intermediate is computed once, so filters on its fields stay cheap."""

    def with_tokens(s: Column) -> Column:
        # letters are decomposed once for the whole title; its spaces stay where they are
        t = F.filter(F.split(s, " "), lambda x: x != "")
        k = F.transform(F.filter(F.split(plain_letters(s), " "), lambda x: x != ""), lambda x: F.regexp_replace(x, "[^a-z0-9]", ""))
        return let(t, lambda t: let(k, lambda k: let(_find_date(t, k), lambda d: with_date(t, k, d))))

    def with_date(t: Column, k: Column, d: Column) -> Column:
        each = F.transform(t, lambda x, i: F.struct(i.alias("i"), x.alias("t"), _at(k, i).alias("k")))
        outside = lambda x: d.isNull() | ~x["i"].between(d["i"], d["i"] + 2)
        return let(F.filter(each, lambda x: (x["k"] != "") & outside(x)), lambda free: _recognise(d, free))

    return let(tidy(title), with_tokens)


TITLE_COLUMNS = ["rec_date", "venue", "session", "is_adhaan", "person", "person_key", "confidence", "leftovers"]


def parse_titles(df: DataFrame, title: str = "title") -> DataFrame:
    """Add the columns of a parsed title.

    rec_date, venue, session, is_adhaan, person, person_key, confidence (0..1),
    leftovers.  Nothing found gives nulls, confidence 0 and, for a blank or null
    title, no leftovers.  Columns of these names are replaced.
    """
    d = df.withColumn("__p", parse_title(F.col(title)))
    return d.withColumns({c: F.col(f"__p.{c}") for c in TITLE_COLUMNS}).drop("__p")


def reconcile_date(rec_date: Column, published_at: Column, slack_days: int = C.UPLOAD_SLACK_DAYS) -> Column:
    """Struct (rec_date, date_corrected): a date more than ``slack_days`` after the upload gives way to the upload's.

    A recording can't follow its upload, but may precede it, so only dates ahead
    are corrected.  Null or impossible dates, and unreadable uploads, change nothing.
    """
    upload = F.substring(published_at, 1, 10)
    ahead = F.datediff(F.try_to_date(rec_date, "yyyy-MM-dd"), F.try_to_date(upload, "yyyy-MM-dd"))
    wrong = F.coalesce((ahead > slack_days) & upload.rlike(r"^\d{4}-\d{2}-\d{2}$"), F.lit(False))
    return F.struct(F.when(wrong, upload).otherwise(rec_date).alias("rec_date"), wrong.alias("date_corrected"))


def build_catalog(raw: DataFrame) -> DataFrame:
    """Raw uploads (video_id, title, published_at, duration_seconds) as catalogue entries.

    Parsed, dates reconciled, one narrow projection; order them with
    :func:`newest_first` where an order is wanted.
    """
    d = parse_titles(raw)
    d = d.withColumn("__r", reconcile_date(F.col("rec_date"), F.col("published_at")))
    return d.withColumns({"rec_date": F.col("__r.rec_date"), "date_corrected": F.col("__r.date_corrected")}).drop("__r")


def newest_first(catalog: DataFrame) -> DataFrame:
    """By published_at descending as text, ties by video_id."""
    return catalog.orderBy(F.col("published_at").desc_nulls_last(), "video_id")


def needs_review(catalog: DataFrame, limit: float = C.CONFIDENCE_LIMIT) -> DataFrame:
    """Entries that were not understood: low confidence or leftovers."""
    return catalog.filter((F.col("confidence") < limit) | (F.size("leftovers") > 0))
