"""Overlapping, nested and gapped intervals -> continuous periods and the gaps between them.

Integer intervals are decomposed into canonical dyadic blocks: block (k, i) is
[i * 2^k, (i + 1) * 2^k).  Blocks under a present ancestor go, sibling pairs merge
upward, and adjacent blocks coalesce into periods.

The axis is cut into cells of 2^``CELL`` (decomposition stops there), which bounds
the blocks of one cell (fewer than 2^(CELL + 1)) whatever the number of intervals,
and spreads a hot key over its cells.  The same reduction runs twice: on each
batch where it was read, so that a key with very many intervals leaves only its
few periods to be shuffled, and on each cell after the shuffle.  Last, the
periods of neighbouring cells are stitched.  The whole cells an interval goes
through are an interval of a coarser axis, which is worked on in the same way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.operators.ordered import Scan
from strandline.session import ship, width

#: A cell is 2^20 units: for milliseconds, 17.5 minutes.
CELL = 20
#: Rows reduced at once.
ROWS = 50_000
#: Cells are stitched in buckets of 2^4.
BUCKET_LEVELS = 4


def blocks_of(start: np.ndarray, end: np.ndarray, cell: int = CELL) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Canonical blocks of intervals that lie within one cell each: (number of the interval, level, idx).

    The left border at level k is ceil(start / 2^k), the right one floor(end / 2^k);
    where a border is odd, its block can't be part of a larger one.
    """
    who, levels, places = [], [], []
    n = np.arange(len(start))
    lo, hi = start.astype(np.int64), end.astype(np.int64)
    for k in range(cell + 1):
        open_ = lo < hi
        if not open_.any():
            break
        n, lo, hi = n[open_], lo[open_], hi[open_]
        left = (lo & 1).astype(bool) if k < cell else np.ones(len(lo), bool)
        right = (hi & 1).astype(bool) & (k < cell)
        who += [n[left], n[right]]
        places += [lo[left], hi[right] - 1]
        levels.append(np.full(left.sum() + right.sum(), k))
        lo, hi = (lo + 1) >> 1, hi >> 1
    if not who:
        return n[:0], lo[:0], lo[:0]
    return np.concatenate(who), np.concatenate(levels), np.concatenate(places)


def merge_cells(key: np.ndarray, cell: np.ndarray, level: np.ndarray, idx: np.ndarray, top: int = CELL):
    """Blocks of whole cells -> periods (group number, start, end), ordered.

    ``key`` numbers the (key, cell) groups.  Vectorised over all groups at once.
    """
    start = idx << level
    order = np.lexsort((-level, start, key))
    key, level, idx, start = key[order], level[order], idx[order], start[order]
    end = start + (np.int64(1) << level)
    # blocks nest or are disjoint: one that ends within reach of an earlier block has an ancestor (or copy) here
    local = (start - (cell[order] << top)) + key * (np.int64(1) << (top + 1))
    reach = np.maximum.accumulate(local + (end - start))
    covered = np.zeros(len(key), bool)
    covered[1:] = (local[1:] + (end - start)[1:]) <= reach[:-1]
    keep = ~covered
    key, level, idx = key[keep], level[keep], idx[keep]
    # sibling pairs become their parent, level by level
    done_k, done_l, done_i = [], [], []
    cur_k, cur_i = np.empty(0, key.dtype), np.empty(0, idx.dtype)
    for k in range(top + 1):
        here = level == k
        g, i = np.concatenate([key[here], cur_k]), np.concatenate([idx[here], cur_i])
        if k == top or not len(g):
            done_k.append(g), done_i.append(i), done_l.append(np.full(len(g), k))
            cur_k, cur_i = np.empty(0, key.dtype), np.empty(0, idx.dtype)
            continue
        o = np.lexsort((i, g))
        g, i = g[o], i[o]
        pair = np.zeros(len(g), bool)
        pair[:-1] = (g[1:] == g[:-1]) & (i[:-1] & 1 == 0) & (i[1:] == i[:-1] + 1)
        second = np.zeros(len(g), bool)
        second[1:] = pair[:-1]
        cur_k, cur_i = g[pair], i[pair] >> 1
        rest = ~(pair | second)
        done_k.append(g[rest]), done_i.append(i[rest]), done_l.append(np.full(rest.sum(), k))
    g, i, lv = np.concatenate(done_k), np.concatenate(done_i), np.concatenate(done_l)
    s = i << lv
    o = np.lexsort((s, g))
    g, s, e = g[o], s[o], (s + (np.int64(1) << lv))[o]
    if not len(g):
        return g, s, e
    # adjacent blocks coalesce
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (s[1:] > e[:-1])
    first = new.nonzero()[0]
    last = np.append(first[1:], len(g)) - 1
    return g[first], s[first], e[last]


def reduce_cells(key: np.ndarray, c: np.ndarray, s: np.ndarray, e: np.ndarray, row: np.ndarray, cell: int):
    """Intervals that lie within one cell each -> (row a key is at, cell, start, end): the periods of each (key, cell)."""
    # equal pieces are one
    code = pd.factorize(key)[0][row]
    order = np.lexsort((e, s, c, code))
    code, c, s, e, row = code[order], c[order], s[order], e[order], row[order]
    if len(code):
        same = np.zeros(len(code), bool)
        same[1:] = (code[1:] == code[:-1]) & (c[1:] == c[:-1]) & (s[1:] == s[:-1]) & (e[1:] == e[:-1])
        code, c, s, e, row = code[~same], c[~same], s[~same], e[~same], row[~same]
    change = np.ones(len(code), bool)
    change[1:] = (code[1:] != code[:-1]) | (c[1:] != c[:-1])
    group = change.cumsum() - 1
    who, level, idx = blocks_of(s, e, cell)
    g, ps, pe = merge_cells(group[who], c[who], level, idx, cell)
    at = change.nonzero()[0][g]
    return row[at], c[at], ps, pe


def reduce_batch(key: np.ndarray, start: np.ndarray, end: np.ndarray, cell: int = CELL):
    """Intervals of any keys -> (row a key is at, tier, cell, start, end): their periods, cut at the borders of cells.

    In tier 0 a unit is 1; in tier n it is a cell of tier n - 1.  An interval over
    several cells becomes its parts in the first and the last of them, and the cells
    between, which are one interval of the next tier: so it has at most two pieces
    in each tier, however long it is.
    """
    out: list[list[np.ndarray]] = [[], [], [], [], []]
    row, tier = np.arange(len(start)), 0
    while len(row):
        first, last = start >> cell, (end - 1) >> cell
        one = first == last
        edge = (first + 1) << cell, last << cell
        c = np.concatenate([first[one], first[~one], last[~one]])
        s = np.concatenate([start[one], start[~one], edge[1][~one]])
        e = np.concatenate([end[one], edge[0][~one], end[~one]])
        r = np.concatenate([row[one], row[~one], row[~one]])
        got_row, got_c, got_s, got_e = reduce_cells(key, c, s, e, r, cell)
        for o, x in zip(out, (got_row, np.full(len(got_row), tier), got_c, got_s, got_e)):
            o.append(x)
        between = first + 1 < last
        start, end, row = (first + 1)[between], last[between], row[between]
        tier += 1
    return tuple(np.concatenate(o) if o else np.empty(0, np.int64) for o in out)


def periods_in_cells(intervals: DataFrame, key: str, start: str, end: str, cell: int = CELL) -> DataFrame:
    """Intervals [start, end) -> periods of each cell and tier: key, tier, cell, s, e (in units of the tier)."""
    kind = dict(intervals.dtypes)[key]
    schema = f"{key} {kind}, tier long, cell long, s long, e long"
    names = [key, "tier", "cell", "s", "e"]

    def batch(t: pa.Table, row: np.ndarray, *columns: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([t[key].combine_chunks().take(pa.array(row)), *map(pa.array, columns)], names=names)

    def fresh(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(held)
        return batch(t, *reduce_batch(t[key].to_pandas().to_numpy(), t[start].to_numpy(), t[end].to_numpy(), cell))

    def before(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for x in batches:
            held.append(x)
            n += x.num_rows
            if n >= ROWS:
                yield fresh(held)
                held, n = [], 0
        if n:
            yield fresh(held)

    def again(t: pa.Table) -> Iterator[pa.RecordBatch]:
        keys, tiers = t[key].to_pandas().to_numpy(), t["tier"].to_numpy()
        for tier in np.unique(tiers):
            at = (tiers == tier).nonzero()[0]
            c, s, e = (t[x].to_numpy()[at] for x in ("cell", "s", "e"))
            row, *got = reduce_cells(keys, c, s, e, at, cell)
            yield batch(t, row, np.full(len(row), tier), *got)

    def after(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # rows come by key, tier and cell; what the last cell of a chunk was reduced to goes on with the next chunk
        held: pa.Table | None = None
        for x in batches:
            t = pa.Table.from_batches([x])
            held = t if held is None else pa.concat_tables([held, t])
            if held.num_rows < ROWS:
                continue
            ends = [held[c][-1].as_py() for c in names[:3]]
            done = pa.Table.from_batches(again(held))
            last = np.logical_and.reduce([done[c].to_pandas().to_numpy() == v for c, v in zip(names[:3], ends)])
            yield from done.filter(pa.array(~last)).to_batches()
            held = done.filter(pa.array(last))
        if held is not None and held.num_rows:
            yield from again(held)

    local = intervals.select(key, start, end).mapInArrow(before, schema)
    return local.repartition(width(local), key, "tier", "cell").sortWithinPartitions(key, "tier", "cell").mapInArrow(after, schema)


def periods_and_gaps(intervals: DataFrame, key: str, start: str, end: str, cell: int = CELL) -> DataFrame:
    """Integer intervals [start, end) -> key, kind (``period``, ``gap``), start, end.

    Intervals that touch make one period.  Rows with a null key or bound, or with
    start >= end, don't count; an entity without others has no row.  Gaps are the
    stretches between two neighbouring periods of an entity.
    """
    ship(intervals.sparkSession)
    ok = intervals.filter(F.col(key).isNotNull() & (F.col(start) < F.col(end)))
    p = periods_in_cells(ok.select(key, F.col(start).cast("long").alias(start), F.col(end).cast("long").alias(end)), key, start, end, cell)
    unit = F.col("tier") * cell
    absolute = lambda c: F.call_function("shiftleft", F.col(c), unit.cast("int")).alias(c)
    p = p.select(key, absolute("s"), absolute("e"))
    # Periods of neighbouring cells are stitched by buckets of the axis: an entity with very many periods stays spread.
    scan = Scan(p, [key], "s", ["e"], float(1 << (cell + BUCKET_LEVELS))).prefix(F.col("e"), "max", False, "reach")
    begins = F.col("reach").isNull() | (F.col("reach") < F.col("s"))
    p = scan.runs(begins, "n").result()
    p = p.groupBy(key, "n").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.max(F.when(begins, F.col("reach"))).alias("before"))
    both = F.array(
        F.struct(F.lit("period").alias("kind"), F.col("s").alias("a"), F.col("e").alias("b")),
        F.when(F.col("before").isNotNull(), F.struct(F.lit("gap").alias("kind"), F.col("before").alias("a"), F.col("s").alias("b"))),
    )
    d = p.select(key, F.explode(both).alias("x")).filter("x is not null")
    return d.select(key, "x.kind", F.col("x.a").alias(start), F.col("x.b").alias(end))


#: A character that shows: none of whitespace, separators, controls and format characters.
VISIBLE = r"[^\s\p{Z}\p{Cc}\p{Cf}\x{115F}\x{1160}\x{3164}\x{FFA0}\x{2800}\x{FE00}-\x{FE0F}]"


def audible_periods(segments: DataFrame, cell: int = CELL) -> DataFrame:
    """Periods and gaps of each take's segments that have both times, t1 > t0, and a text that shows something.

    Returns take_id, kind, start_ms, end_ms; times rounded to milliseconds.  Copies of a row change nothing.
    """
    ms = lambda c: F.round(F.col(c) * 1000).cast("long")
    d = segments.select("take_id", "t0", "t1", "arabic").filter(F.col("t1") > F.col("t0")).filter(F.col("arabic").rlike(VISIBLE))
    d = d.select("take_id", ms("t0").alias("start_ms"), ms("t1").alias("end_ms"))
    return periods_and_gaps(d, "take_id", "start_ms", "end_ms", cell)
