"""Runs of identical or near-identical consecutive events -> one event each, with count and duration.

Per entity, neighbouring runs are merged, the most similar pair first, from a
linked list with a priority queue, until no pair meets the limits of similarity
and gap.  No merge ever crosses a place where the gap limit is exceeded or where
the two events can't become similar whatever is merged around them (other
chapters; at similarity 1, other keys).  So the stretches between such places are
independent, and the result is that of one pass over everything.

An entity of any size is spread: the events are range-partitioned by (entity,
time), each task agglomerates what it has, and of the stretches cut by the border
of a partition only the runs of equal events are passed on, to be put together in
a second pass.  Pairs of equal events are at the top of the queue and leave its
keys as they are, so a part of a stretch may process them alone, in any order:
a run of millions of copies is one node after the first pass.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.session import width
from strandline.tables import clean_timeline

_OUT = "entity long, first_no long, last_no long, t0 double, t1 double, n long, key1 long, key2 long, has boolean, weight double, open int"
_COLS = [c.split()[0] for c in _OUT.split(", ")]
#: A stretch of so many nodes merges its equal neighbours before more is read.
CHUNK = 100_000


def similarity(a: tuple, b: tuple) -> float:
    """Of the verses two runs stand for: 1 if equal, less the further apart in one chapter, 0 across chapters or without a verse."""
    if a[0] is None or a[1] is None or b[0] is None or b[1] is None or a[0] != b[0]:
        return 0.0
    return 1.0 / (1 + abs(a[1] - b[1]))


class Runs:
    """Ordered runs as columns: what each spans, how many rows it has, and the key of its longest part with that part's length."""

    __slots__ = ("entity", "first", "last", "t0", "t1", "n", "key1", "key2", "has", "weight")

    def __init__(self, *columns):
        self.entity, self.first, self.last, self.t0, self.t1, self.n, self.key1, self.key2, self.has, self.weight = columns

    def columns(self) -> list:
        return [getattr(self, c) for c in self.__slots__]

    def __len__(self) -> int:
        return len(self.first)

    def cut(self, lo: int, hi: int) -> Runs:
        return Runs(*(c[lo:hi] for c in self.columns()))

    def pick(self, at) -> Runs:
        return Runs(*(c[at] for c in self.columns()))

    @staticmethod
    def join(parts: list[Runs]) -> Runs:
        return parts[0] if len(parts) == 1 else Runs(*(np.concatenate(c) for c in zip(*(p.columns() for p in parts))))


def agglomerate(r: Runs, min_similarity: float, max_gap: float, steps: list[int] | None = None, starts: np.ndarray | None = None) -> Runs:
    """Merge neighbours, most similar pair first (ties: the earlier one), until none meets both limits.

    The runs are a linked list; the priority queue holds the pairs of neighbours
    that meet the limits.  Several stretches may be given at once: no pair is made
    across ``starts``, the first runs of stretches (by default, those after
    :func:`borders`).  ``steps`` gets the number of merges.
    """
    size = len(r)
    if size < 2:
        return r
    joined = np.ones(size + 1, bool)  # whether a run may be merged with what is before it
    joined[borders(r, min_similarity, max_gap) if starts is None else starts] = False
    t0, t1, n, weight, last = r.t0.tolist(), r.t1.tolist(), r.n.tolist(), r.weight.tolist(), r.last.tolist()
    key = list(zip(r.key1.tolist(), r.key2.tolist()))
    nxt, prev, alive = list(range(1, size + 1)), list(range(-1, size - 1)), [True] * size
    may = joined.tolist()

    # the first pairs: neighbours without a border have a verse each, of one chapter
    i = joined[1:size].nonzero()[0]
    first = 1.0 / (1 + np.abs(r.key2[i + 1] - r.key2[i]))
    i, first = i[first >= min_similarity], first[first >= min_similarity]
    queue = list(zip((-first).tolist(), i.tolist(), (i + 1).tolist()))
    heapq.heapify(queue)

    def offer(i: int, j: int) -> None:
        if may[j] and t0[j] - t1[i] < max_gap:  # a null time is NaN, and never near
            s = similarity(key[i], key[j])
            if s >= min_similarity and s > 0:
                heapq.heappush(queue, (-s, i, j))

    merged = 0
    while queue:
        s, i, j = heapq.heappop(queue)
        # a pair is stale if either side went, they are no neighbours any more, or a key changed meanwhile
        if not (alive[i] and alive[j]) or nxt[i] != j or -s != similarity(key[i], key[j]):
            continue
        merged += 1
        if key[j] == key[i]:
            weight[i] += weight[j]
        elif weight[j] > weight[i]:
            key[i], weight[i] = key[j], weight[j]
        last[i], t1[i], n[i], alive[j] = last[j], t1[j], n[i] + n[j], False
        nxt[i] = k = nxt[j]
        if k < size:
            prev[k] = i
            offer(i, k)
        if prev[i] >= 0 and may[i]:
            offer(prev[i], i)
    if steps is not None:
        steps.append(merged)
    at = np.array(alive).nonzero()[0]
    out = r.pick(at)
    new = lambda c, old: np.array(c, old.dtype)[at]
    out.last, out.t1, out.n, out.weight = new(last, r.last), new(t1, r.t1), new(n, r.n), new(weight, r.weight)
    out.key1, out.key2 = (np.array(c, np.int64)[at] for c in zip(*key))
    return out


def borders(r: Runs, min_similarity: float, max_gap: float) -> np.ndarray:
    """Places (index of the run after) no merge can cross: another entity, the gap limit, keys that can't become similar."""
    with np.errstate(invalid="ignore"):
        near = (r.entity[1:] == r.entity[:-1]) & (r.t0[1:] - r.t1[:-1] < max_gap)
    like = r.has[1:] & r.has[:-1] & (r.key1[1:] == r.key1[:-1])
    if min_similarity >= 1:
        like &= r.key2[1:] == r.key2[:-1]
    return (~(near & like)).nonzero()[0] + 1


def _runs(b: pd.DataFrame) -> Runs:
    return Runs(*(b[c].to_numpy() for c in _COLS[:10]))


def _frame(parts: list[Runs], is_open: int, min_rows: int) -> pd.DataFrame:
    r = Runs.join(parts)
    f = pd.DataFrame(dict(zip(_COLS, r.columns())))
    f["open"] = is_open
    return f if is_open else f[f["n"] >= min_rows]


class _Pass:
    """One partition's runs in order; gives back frames of finished runs, and of those of stretches its borders cut."""

    def __init__(self, min_similarity: float, max_gap: float, min_rows: int, cut_borders: bool):
        self.s, self.g, self.min_rows = min_similarity, max_gap, min_rows
        self.held: Runs | None = None  # the last stretch, which may go on
        self.first = cut_borders  # whether the next stretch to end is the first one

    def _equal(self, r: Runs) -> Runs:
        """A part of a stretch with its equal neighbours merged: the queue's first steps, whatever comes before or after."""
        return agglomerate(r, 1.0, self.g)

    def feed(self, r: Runs) -> Iterator[pd.DataFrame]:
        if not len(r):
            return
        if self.held is not None:
            r = Runs.join([self.held, r])
        at = borders(r, self.s, self.g)
        if not len(at):
            self.held = self._equal(r) if len(r) > CHUNK else r
            return
        start = 0
        if self.first:
            yield _frame([self._equal(r.cut(0, at[0]))], 1, self.min_rows)
            self.first, start = False, 1
        # stretches of one run have no pair: they are taken together, the others go through the queue
        edges = np.concatenate([[0], at])[start:]
        length = np.diff(edges)
        single = edges[:-1][length == 1]
        done = [r.pick(single)] if len(single) and self.min_rows <= r.n[single].max() else []
        several = length[length > 1]
        if len(several):
            rows = np.concatenate([np.zeros(edges[0], bool), np.repeat(length > 1, length)])
            done.append(agglomerate(r.cut(0, edges[-1]).pick(rows), self.s, self.g, starts=np.cumsum(several) - several))
        if done:
            yield _frame(done, 0, self.min_rows)
        rest = r.cut(at[-1], len(r))
        self.held = self._equal(rest) if len(rest) > CHUNK else rest

    def finish(self, is_open: bool) -> Iterator[pd.DataFrame]:
        if self.held is not None:
            r = self._equal(self.held) if is_open else agglomerate(self.held, self.s, self.g)
            yield _frame([r], int(is_open), self.min_rows)
        self.held = None


def collapse(events: DataFrame, min_similarity: float = 1.0, max_gap: float = 1.0, min_rows: int = 1) -> DataFrame:
    """Events (entity, no, t0, t1, key1, key2) -> runs: entity, first_no, last_no, t0, t1, n, key1, key2.

    Order: t0 (nulls last), then no.  A null key is like nothing, not even another
    null; a null time never continues a run.  ``t0``, ``t1`` are those of the first
    and last row, ``n`` the rows; ``key1``, ``key2`` stand for the longest part
    (null where either is null).  Only runs of ``min_rows`` rows or more are
    returned.  Events with a null entity are dropped; equal (entity, no) must have
    been removed before.
    """
    has = F.col("key1").isNotNull() & F.col("key2").isNotNull()
    long = lambda c: F.when(has, F.col(c)).otherwise(0).cast("long")
    lasts = F.coalesce(F.col("t1") - F.col("t0"), F.lit(0.0)).cast("double")
    e = events.filter("entity is not null").select(
        F.col("entity").cast("long"), F.col("no").cast("long").alias("first_no"), F.col("no").cast("long").alias("last_no"),
        F.col("t0").cast("double"), F.col("t1").cast("double"), F.lit(1).cast("long").alias("n"),
        long("key1").alias("key1"), long("key2").alias("key2"), has.alias("has"), lasts.alias("weight"), F.lit(0).alias("open"),
    )
    place = [F.col("entity"), F.col("t0").asc_nulls_last(), F.col("first_no")]
    e = e.repartitionByRange(width(e), *place).sortWithinPartitions(*place)

    def first_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = _Pass(min_similarity, max_gap, min_rows, True)
        for b in batches:
            yield from p.feed(_runs(b))
        yield from p.finish(True)

    def second_pass(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        p = _Pass(min_similarity, max_gap, min_rows, False)
        for b in batches:
            whole = b["open"] == 0
            if whole.any():
                yield b[whole]
            yield from p.feed(_runs(b[~whole]))
        yield from p.finish(False)

    one = e.mapInPandas(first_pass, _OUT)
    # cut stretches meet by entity; all other runs pass through where their number sends them
    to = F.when(F.col("open") == 1, F.col("entity")).otherwise(F.xxhash64("entity", "first_no"))
    two = one.repartition(width(e), to).sortWithinPartitions("open", *place)
    two = two.mapInPandas(second_pass, _OUT)
    for c in ("key1", "key2"):
        two = two.withColumn(c, F.when(F.col("has"), F.col(c)))
    return two.drop("open", "has", "weight")


def timeline_runs(timeline: DataFrame, min_rows: int = 2) -> DataFrame:
    """Runs of one verse in a timeline: take_id, first_no, last_no, rows, duration (seconds), surah, ayah."""
    t = clean_timeline(timeline).select(F.col("take_id").alias("entity"), F.col("out_no").alias("no"), "t0", "t1", F.col("surah").alias("key1"), F.col("ayah").alias("key2"))
    r = collapse(t, 1.0, 1.0, min_rows)
    return r.select(
        F.col("entity").alias("take_id"), F.col("first_no").cast("int").alias("first_no"), F.col("last_no").cast("int").alias("last_no"),
        F.col("n").alias("rows"), (F.col("t1") - F.col("t0")).alias("duration"), F.col("key1").cast("int").alias("surah"), F.col("key2").cast("int").alias("ayah"),
    )
