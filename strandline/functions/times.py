"""Durations, clocks, dates, rounding and money.  Lenient: what can't be read gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline.functions.text import strip


def round_to(c: Column, digits: int) -> Column:
    """floor(x * 10^d + 0.5) / 10^d in doubles, the rounding all published figures use (``round`` differs on ties)."""
    return F.floor(c * float(10**digits) + 0.5) / float(10**digits)


def parse_iso_duration(c: Column) -> Column:
    """``P1DT2H3M4.5S`` in seconds; ``P`` and ``PT`` give 0; anything else null."""
    shape = r"^P(?:([\d.]+)D)?(?:T(?:([\d.]+)H)?(?:([\d.]+)M)?(?:([\d.]+)S)?)?$"

    def part(i: int) -> Column:
        g = F.regexp_extract(c, shape, i)
        return F.when(g == "", F.lit(0.0)).otherwise(g.try_cast("double"))

    total = part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)
    return F.when(c.rlike(shape), total)


def parse_clock(c: Column) -> Column:
    """``1:02:03``, ``12:34`` or ``45`` in seconds; an empty part is 0; other shapes and negative parts give null."""
    parts = F.transform(
        F.split(strip(c), ":", -1),
        lambda p: F.when(strip(p) == "", F.lit(0.0)).when(
            strip(p).rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), strip(p).try_cast("double")
        ),
    )
    bad = F.exists(parts, lambda p: p.isNull() | (p < 0) | (p > 1.7e308))
    n = F.size(parts)
    p = [F.try_element_at(parts, F.lit(i)) for i in (1, 2, 3)]
    return (
        F.when(c.isNull() | bad, F.lit(None).cast("double"))
        .when(n == 1, p[0])
        .when(n == 2, p[0] * 60 + p[1])
        .when(n == 3, p[0] * 3600 + p[1] * 60 + p[2])
    )


def clock(seconds: Column) -> Column:
    """``m:ss`` or ``h:mm:ss``, fractions cut off."""
    s = F.floor(seconds).cast("long")
    h, m, r = F.floor(s / 3600).cast("long"), F.floor((s % 3600) / 60).cast("long"), s % 60
    ms = F.concat(F.lpad(r.cast("string"), 2, "0"))
    return F.when(h > 0, F.concat_ws(":", h.cast("string"), F.lpad(m.cast("string"), 2, "0"), ms)).when(
        s.isNotNull(), F.concat_ws(":", m.cast("string"), ms)
    )


def watch_link(video_id: Column, seconds: Column, base: str = "https://www.youtube.com/watch?v=") -> Column:
    """A link to the second of a video."""
    return F.concat(F.lit(base), video_id, F.lit("&t="), F.floor(seconds).cast("string"), F.lit("s"))


def pretty_date(day: Column) -> Column:
    """``Saturday 25 July 2026`` of an ISO day; null where it is no day."""
    return F.date_format(F.try_to_date(day, "yyyy-MM-dd"), "EEEE d MMMM yyyy")


def day_of(rec_date: Column, published_at: Column) -> Column:
    """The day a recording belongs to: its own date, else that of its publication (texts, compared as such)."""
    return F.coalesce(rec_date, F.substring(published_at, 1, 10))


def usd(c: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(c, 2))


def hours(seconds: Column) -> Column:
    return F.concat(F.format_number(seconds / 3600, 1), F.lit(" h"))


def percent(part: Column, whole: Column) -> Column:
    """An integer percentage as text; ``0%`` of nothing."""
    return F.concat(F.when(whole > 0, F.floor(100 * part / whole + 0.5)).otherwise(0).cast("long").cast("string"), F.lit("%"))
