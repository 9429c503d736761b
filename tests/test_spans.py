import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from strandline.operators import dyadic, ordered, spans


def windows(spark, *durations):
    df = spark.createDataFrame([(d,) for d in durations], "d double").coalesce(1)
    return [None if r[0] is None else [tuple(x) for x in r[0]] for r in df.select(spans.plan_windows(F.col("d"))).collect()]


def test_windows(spark):
    a, b, c, d = windows(spark, 529.0, 1500.0, None, 600.5)
    assert a == [(0, 529)] and [x[0] for x in b] == [0, 580, 1160] and b[-1][1] == 1500 and c is None and d == [(0, 600), (580, 601)]
    with pytest.raises(ValueError):
        spans.plan_windows(F.col("d"), 20, 20)


def test_valid_segments(spark):
    rows = [("0:01", "0:02", " a "), ("0:02", "0:01", "b"), ("x", "0:01", "c"), ("0:01", "0:02", " "), (None, "0:02", "d"), ("0:01", "0:02", None)]
    d = spans.valid_segments(spark.createDataFrame(rows, "start string, end string, text string"))
    assert [tuple(r) for r in d.select("t0", "t1", "text").collect()] == [(1.0, 2.0, "a")]


def test_anchor(spark):
    rows = [("v", 0, 0, 600, 5.0, 9.0), ("v", 1, 580, 1180, 5.0, 9.0), ("w", 1, 580, 1180, 590.0, 700.0)]
    d = spans.anchor_absolute(spark.createDataFrame(rows, "v string, w int, window_start int, window_end int, t0 double, t1 double"), ["v", "w"])
    assert sorted((r.v, r.w, r.t0, r.t1) for r in d.collect()) == [("v", 0, 5, 9), ("v", 1, 585, 589), ("w", 1, 590, 700)]


def dedupe(rows):
    out = []
    for o, t0, t1, x in sorted(rows, key=lambda r: (r[1], r[0])):
        p = out[-1] if out else None
        if p and t0 < p[2] - 0.5 and x.strip() == p[3].strip():
            continue
        if p and t0 < p[2]:
            t0 = p[2]
        if t1 - t0 < 0.2:
            continue
        out.append((o, t0, t1, x))
    return out


@pytest.mark.parametrize("seed", range(3))
def test_dedupe_overlap(spark, seed):
    r = random.Random(seed)
    rows = [(k, i, a := r.randrange(0, 4000) / 2, a + r.choice([0.0, 0.5, 1, 3, 7, 40]), r.choice("ab")) for k in (1, 2) for i in range(300)]
    rows.append((3, 0, None, 1.0, "a"))
    df = spark.createDataFrame(rows, "k long, o int, t0 double, t1 double, x string")
    got = sorted(tuple(x) for x in spans.dedupe_overlap(df, "k", "o", "x").collect())
    assert got == sorted((k, *x) for k in (1, 2) for x in dedupe([q[1:] for q in rows if q[0] == k]))


def timeline(seed, n=400):
    r = random.Random(seed)
    rows, t = [], 0.0
    for i in range(n):
        s, a = (None, None) if r.random() < 0.1 else (r.choice([1, 2]), r.choice([1, 2, 3]))
        rows.append((7, i, t, t + 1, s, a, r.choice([0.5, 0.75]), r.choice([True, False, None])))
        t += 1 + r.choice([0, 0.5, 2, 3000])
    return rows


SCHEMA = "take_id long, out_no int, t0 double, t1 double, surah int, ayah int, conf double, is_partial boolean"


@pytest.mark.parametrize("seed", range(3))
def test_merge_and_ranges(spark, seed):
    rows = timeline(seed)
    df = spark.createDataFrame(rows, SCHEMA)
    merged, ranges = [], []
    for _, _, t0, t1, s, a, c, p in rows:
        m = merged[-1] if merged else None
        if m and m[2] is not None and (m[2], m[3]) == (s, a) and t0 - m[1] < 1.0:
            m[1], m[4], m[5] = t1, max(m[4], c), m[5] and bool(p)
        else:
            merged.append([t0, t1, s, a, c, bool(p)])
        if s is None:
            continue
        x = ranges[-1] if ranges else None
        if x and x[0] == s and a == x[2] + 1:
            x[2] = a
        elif not (x and x[0] == s and a == x[2]):
            ranges.append([s, a, a, t0])
    got = [list(r)[2:8] for r in sorted(spans.merge_adjacent(df).collect(), key=lambda r: r.run_no)]
    assert got == merged
    got = [list(r)[2:] for r in sorted(spans.verse_ranges(df).collect(), key=lambda r: r.range_no)]
    assert got == ranges


def test_empty_tables(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert spans.merge_adjacent(df).count() == spans.verse_ranges(df).count() == 0
    takes = spark.createDataFrame([(1,)], "take_id long")
    assert [tuple(r) for r in spans.coverage(df, takes).collect()] == [(1, 0, 0, 0.0)]


def test_previous_across_buckets(spark):
    rows = [(1, i, float(i * 700)) for i in range(50)] + [(1, 99, None), (None, 1, 5.0), (None, 2, 9000.0)]
    df = spark.createDataFrame(rows, "k long, o int, t double")
    got = {(r.k, r.o): r.p and r.p.o for r in ordered.with_previous(df, ["k"], "t", ["o"], ["o"], name="p").collect()}
    want = {(1, 0): None, (None, 1): None, (None, 2): 1, (1, 99): 49} | {(1, i): i - 1 for i in range(1, 50)}
    assert got == want


def periods(intervals):
    out = []
    for s, e in sorted(intervals):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return out


@pytest.mark.parametrize("cell", [3, 8, 20])
def test_dyadic(spark, cell):
    r = random.Random(cell)
    rows = [(k, s := r.randrange(0, 3000), s + r.choice([1, 2, 5, 17, 64, 300])) for k in range(20) for _ in range(r.choice([1, 5, 40]))]
    rows += [(5, 9, 9), (5, 10, 3), (None, 1, 2), (5, None, 3), (6, 4, None), (99, 8, 8)] + rows[:30]
    df = spark.createDataFrame(rows, "k long, s long, e long")
    got = dyadic.periods_and_gaps(df, "k", "s", "e", cell).collect()
    for k in range(20):
        want = periods([(s, e) for q, s, e in rows if q == k and s is not None and e is not None and s < e])
        assert sorted([x.s, x.e] for x in got if x.k == k and x.kind == "period") == want
        assert sorted([x.s, x.e] for x in got if x.k == k and x.kind == "gap") == [[a[1], b[0]] for a, b in zip(want, want[1:])]
    assert not [x for x in got if x.k in (None, 99)]


def test_blocks_are_canonical():
    spans_ = [(3, 8), (0, 8), (5, 5), (7, 8), (8, 15), (17, 23)]
    who, level, idx = dyadic.blocks_of(np.array([a for a, _ in spans_]), np.array([b for _, b in spans_]), 3)
    got = [sorted((int(i) << int(k), (int(i) + 1) << int(k)) for w, k, i in zip(who, level, idx) if w == n) for n in range(len(spans_))]
    assert got == [[(3, 4), (4, 8)], [(0, 8)], [], [(7, 8)], [(8, 12), (12, 14), (14, 15)], [(17, 18), (18, 20), (20, 22), (22, 23)]]


def test_hot_cell_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(dyadic, "ROWS", 50)
    r = random.Random(9)
    rows = [("k", s := r.randrange(0, 4000), s + r.choice([1, 3])) for _ in range(3000)] + [(str(i), i, i + 2) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, s long, e long").repartition(5)
    got = dyadic.periods_and_gaps(df, "k", "s", "e", 10).collect()
    for k in ("k", "7"):
        assert sorted([x.s, x.e] for x in got if x.k == k and x.kind == "period") == periods([(s, e) for q, s, e in rows if q == k])


def test_very_long_intervals(spark):
    rows = [("a", 0, 10**15), ("a", 10**15 + 5, 10**15 + 9), ("a", 7, 9), ("b", -(2**40) - 3, 2**41 + 1), ("b", 2**41 + 1, 2**41 + 2), ("c", 5, 6), ("c", 2**45, 2**45 + 2**30)]
    df = spark.createDataFrame(rows, "k string, s long, e long")
    want = [
        ("a", "gap", 10**15, 10**15 + 5), ("a", "period", 0, 10**15), ("a", "period", 10**15 + 5, 10**15 + 9), ("b", "period", -(2**40) - 3, 2**41 + 2),
        ("c", "gap", 6, 2**45), ("c", "period", 5, 6), ("c", "period", 2**45, 2**45 + 2**30),
    ]
    assert sorted(tuple(r) for r in dyadic.periods_and_gaps(df, "k", "s", "e").collect()) == want


def test_audible(spark):
    rows = [(1, 0.0, 1.0, "a"), (1, 1.0, 2.0, "b"), (1, 3.0, 4.0, "​  "), (1, 5.0, 4.0, "c"), (1, 6.0, 7.0005, "[x]"), (2, None, 1.0, "a"), (3, 0.0, 1.0, None), (3, 0.0, 1.0, "")]
    df = spark.createDataFrame(rows, "take_id long, t0 double, t1 double, arabic string")
    got = sorted(tuple(r) for r in dyadic.audible_periods(df).collect())
    assert got == [(1, "gap", 2000, 6000), (1, "period", 0, 2000), (1, "period", 6000, 7001)]
    assert dyadic.audible_periods(df.filter("false")).count() == 0
