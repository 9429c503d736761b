"""Recordings longer than a limit -> pieces within it, cut at pauses, overlapping their predecessor.

Where a piece ends depends on where it begins, so the cuts of a recording are a
chain.  A recording is worked on in ranges of its time axis, none of which needs
the others: for a range, with a halo of one piece beyond its end, a worker makes
a boundary table: for each second a piece may begin at in the range's entry
zone, at which second the first piece beyond the range begins, and how many
pieces begin before.  Tables of neighbouring ranges are put together to one, as a
tree, and going down it tells where each range is really entered; prefix sums of
the counts give the piece numbers; then each range emits its pieces by itself.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.session import width as tasks
from strandline.tables import current_catalog

#: Seconds of a range; it must be longer than a piece.
RANGE = 1800
#: Tables that are put together at once.
FAN = 64


def ends_of(lo: int, hi: int, pauses: np.ndarray, limit: int, overlap: int) -> np.ndarray:
    """For each start from ``lo`` to ``hi`` - 1: where a piece that isn't the last ends."""
    last = np.full(hi - lo + limit, -1, np.int64)  # the latest pause at or before each second from lo on
    p = pauses[(pauses >= lo) & (pauses < lo + len(last))]
    last[p - lo] = p
    last = np.maximum.accumulate(last)
    start = np.arange(lo, hi)
    at = last[start - lo + limit] if hi > lo else start
    return np.where(at > start + overlap, at, start + limit)


def table_of(lo: int, hi: int, end: int, pauses: np.ndarray, limit: int, overlap: int) -> tuple[np.ndarray, np.ndarray]:
    """Boundary table of a range: for each entry second, the start beyond it (-1: the recording ended) and the pieces begun.

    The range at 0 is entered at 0 only.  The starts inside a range are a list of
    links, each to the next start; links are doubled until all lead out of it.
    """
    stop = min(hi, end)
    start = np.arange(lo, stop)
    out = ends_of(lo, stop, pauses, limit, overlap) - overlap
    out[end - start <= limit] = -1
    n = np.ones(len(out), np.int64)
    while (inside := (out >= 0) & (out < hi)).any():
        at = out[inside] - lo
        n_new, out_new = n[at], out[at]
        n[inside] += n_new
        out[inside] = out_new
    entries = 1 if lo == 0 else limit
    return out[:entries], n[:entries]


def composed(tables: list[tuple[int, np.ndarray, np.ndarray]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables (lo, exits, counts) of ranges of ``width`` in a row -> the one table of all of them."""
    lo, out, n = tables[0][0], tables[0][1].copy(), tables[0][2].copy()
    for at, exits, counts in tables[1:]:
        # a piece is shorter than a range, so none is passed over
        inside = (out >= at) & (out < at + width)
        i = out[inside] - at
        n[inside] += counts[i]
        out[inside] = exits[i]
    return out, n


def cut(lo: int, hi: int, end: int, pauses: np.ndarray, limit: int, overlap: int, start: int) -> list[tuple[int, int]]:
    """The pieces that begin in [lo, hi), entered at ``start``."""
    ends = ends_of(lo, min(hi, end) + 1, pauses, limit, overlap)
    out = []
    while start < hi:
        if end - start <= limit:
            out.append((start, end))
            break
        stop = int(ends[start - lo])
        out.append((start, stop))
        start = stop - overlap
    return out


def _sorted(pauses) -> np.ndarray:
    return np.array([], np.int64) if pauses is None else np.sort(np.asarray(pauses, np.int64))


def _grouped(tables: DataFrame, width: int) -> DataFrame:
    """The tables of up to FAN ranges in a row: video_id, no (of the group), chain."""
    return tables.groupBy("video_id", F.floor(F.col("no") / FAN).cast("int").alias("no")).agg(F.array_sort(F.collect_list(F.struct("no", "exits", "counts"))).alias("chain"))


def _chain(links, width: int) -> list[tuple[int, np.ndarray, np.ndarray]]:
    return [(x["no"] * width, np.array(x["exits"], np.int64), np.array(x["counts"], np.int64)) for x in links]


def _compose(width: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [composed(_chain(links, width), width) for links in b["chain"]]
            yield pd.DataFrame({"video_id": b["video_id"], "no": b["no"], "exits": [g[0] for g in got], "counts": [g[1] for g in got]})

    return run


def _enter(width: int):
    """Where each member of a group is entered, and how many pieces begin before (prefix sums of the counts)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for v, links, start, before in zip(b["video_id"], b["chain"], b["start"], b["before"]):
                for x in links:
                    lo = x["no"] * width
                    if start < lo or start >= lo + width:  # the recording ended, or an entry beyond
                        continue
                    rows.append((v, x["no"], start, before))
                    start, before = x["exits"][start - lo], before + x["counts"][start - lo]
            yield pd.DataFrame(rows, columns=["video_id", "no", "start", "before"])

    return run


def split_recordings(recordings: DataFrame, pauses: DataFrame, limit: int = 600, overlap: int = 20, width: int = RANGE) -> DataFrame:
    """(video_id, duration_seconds), (video_id, at_s) -> video_id, piece_no, start_s, end_s of recordings above ``limit``.

    Piece 1 begins at 0.  While more than ``limit`` remains, a piece ends at the
    latest pause more than ``overlap`` and at most ``limit`` after its start, else
    ``limit`` after it, and the next one begins ``overlap`` before that end; the last
    ends at the duration, rounded up.  Null durations, unordered, repeated and null
    pauses and those after the end do no harm; recordings without pauses are cut
    at the limit.  ``video_id`` must be unique among the recordings.
    """
    if not 0 <= overlap < limit < width:
        raise ValueError("the overlap must be shorter than the limit, and that shorter than a range")
    long = recordings.filter(F.col("duration_seconds") > limit).select("video_id", F.ceil("duration_seconds").cast("int").alias("end"))
    ranges = long.select("video_id", "end", F.explode(F.sequence(F.lit(0), ((F.col("end") - 1) / width).cast("int"))).alias("no"))
    # a pause belongs to its range, and as halo to the one before; seconds are distinct, which bounds a range's pauses
    p = pauses.filter("video_id is not null and at_s >= 0").select("video_id", F.col("at_s").cast("int").alias("at_s")).distinct()
    own = F.floor(F.col("at_s") / width).cast("int")
    p = p.withColumn("no", F.explode(F.when(F.col("at_s") % width <= limit, F.array(own, own - 1)).otherwise(F.array(own))))
    p = p.groupBy("video_id", "no").agg(F.collect_list("at_s").alias("pauses"))
    r = ranges.join(p, ["video_id", "no"], "left")

    def tables(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            got = [table_of(no * width, (no + 1) * width, end, _sorted(ps), limit, overlap) for no, end, ps in zip(b["no"], b["end"], b["pauses"])]
            yield pd.DataFrame({"video_id": b["video_id"], "no": b["no"], "exits": [g[0] for g in got], "counts": [g[1] for g in got]})

    r = r.select("video_id", "no", "end", "pauses")
    r = r.repartition(tasks(r), "video_id", "no")
    schema = "video_id string, no int, exits array<long>, counts array<long>"
    levels = [r.mapInPandas(tables, schema)]
    # groups of tables become one, level by level, until a recording has one group: so no task holds more than FAN tables of it
    longest = (long.agg(F.max("end")).first()[0] or 0) / width
    while longest > FAN ** len(levels):
        levels.append(_grouped(levels[-1], width * FAN ** (len(levels) - 1)).mapInPandas(_compose(width * FAN ** (len(levels) - 1)), schema))
    # and the other way round: where a group is entered tells where its members are
    entered = None
    for depth in range(len(levels) - 1, -1, -1):
        w = width * FAN**depth
        groups = _grouped(levels[depth], w)
        if entered is None:
            groups = groups.withColumns({"start": F.lit(0).cast("long"), "before": F.lit(0).cast("long")})
        else:
            groups = groups.join(entered, ["video_id", "no"])
        entered = groups.mapInPandas(_enter(w), "video_id string, no int, start long, before long")
    entries = r.join(entered, ["video_id", "no"])

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for v, no, end, ps, start, before in zip(*(b[c] for c in ("video_id", "no", "end", "pauses", "start", "before"))):
                got = cut(no * width, (no + 1) * width, end, _sorted(ps), limit, overlap, int(start))
                rows += [(v, int(before) + i + 1, s, e) for i, (s, e) in enumerate(got)]
            yield pd.DataFrame(rows, columns=["video_id", "piece_no", "start_s", "end_s"])

    return entries.select("video_id", "no", "end", "pauses", "start", "before").mapInPandas(
        emit, "video_id string, piece_no int, start_s int, end_s int"
    )


def catalog_pieces(deliveries: DataFrame, pauses: DataFrame, limit: int = 600, overlap: int = 20) -> DataFrame:
    """Pieces of each video whose latest delivery has a duration above the limit."""
    c = current_catalog(deliveries.select("video_id", "duration_seconds", "ingested_at", "row_id"))
    return split_recordings(c.select("video_id", "duration_seconds"), pauses, limit, overlap)
