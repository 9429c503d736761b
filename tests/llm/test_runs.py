import random

import numpy as np
import pytest

from strandline.llm import runs

S = "entity long, no long, t0 double, t1 double, key1 long, key2 long"


def make(seed, n=500, entities=3):
    r = random.Random(seed)
    rows = []
    for e in range(entities):
        t = 0.0
        for i in range(n if e else n * 3):
            k = (None, None) if r.random() < 0.1 else (1, r.randrange(1, 3)) if r.random() < 0.9 else (2, 1)
            rows.append((e, i, t, t + 1, *k))
            t += 1 + r.choice([0, 0.2, 0.9, 1.0, 5])
    r.shuffle(rows)
    return rows


def plain(rows, min_rows):
    out = []
    last = None
    for e, no, t0, t1, a, b in sorted(rows, key=lambda x: (x[0], x[2] is None, x[2] or 0, x[1])):
        if last and last[0] == e and a is not None and b is not None and (a, b) == last[4] and t0 is not None and last[3] is not None and t0 - last[3] < 1.0:
            last[2], last[3], last[5] = no, t1, last[5] + 1
        else:
            last = [e, no, no, t1, (a, b), 1]
            out.append(last)
    return sorted((e, f, l, n) for e, f, l, _, _, n in out if n >= min_rows)


@pytest.mark.parametrize("seed,min_rows", [(1, 1), (2, 2), (3, 2)])
def test_identical(spark, seed, min_rows):
    rows = make(seed) + [(9, 0, None, 1.0, 1, 1), (9, 1, None, 2.0, 1, 1), (None, 1, 0.0, 1.0, 1, 1), (8, 0, 0.0, None, 1, 1), (8, 1, 0.5, 1.0, 1, 1)]
    df = spark.createDataFrame(rows, S).repartition(6)
    got = sorted((r.entity, r.first_no, r.last_no, r.n) for r in runs.collapse(df, 1.0, 1.0, min_rows).collect())
    assert got == plain([r for r in rows if r[0] is not None], min_rows)


def brute(rows, limit, gap):
    """Greedy agglomeration of one entity over everything: lists of first, last, rows, t1, key, weight."""
    nodes = [[no, no, 1, t0, t1, (a, b), t1 - t0] for _, no, t0, t1, a, b in sorted(rows, key=lambda x: (x[2], x[1]))]
    while True:
        best = None
        for i, (x, y) in enumerate(zip(nodes, nodes[1:])):
            s = runs.similarity(x[5], y[5])
            if y[3] - x[4] < gap and s >= limit and s > 0 and (best is None or s > best[0]):
                best = (s, i)
        if best is None:
            return [tuple(n[:3]) for n in nodes]
        x, y = nodes[best[1]], nodes.pop(best[1] + 1)
        x[1], x[2], x[4] = y[1], x[2] + y[2], y[4]
        if x[5] == y[5]:
            x[6] += y[6]
        elif y[6] > x[6]:
            x[5], x[6] = y[5], y[6]


def columns(n, key2=None):
    one = np.ones(n, np.int64)
    t = np.arange(n) * 1.0
    return runs.Runs(one, np.arange(n), np.arange(n), t, t + 1, one, one, one if key2 is None else np.array(key2), np.ones(n, bool), one * 1.0)


def test_every_merge_is_a_step_of_the_queue(monkeypatch):
    steps = []
    got = runs.agglomerate(columns(50), 1.0, 1.0, steps)
    assert steps == [49] and (got.n.tolist(), got.last.tolist()) == ([50], [49])
    # a stretch longer than a chunk comes out the same
    monkeypatch.setattr(runs, "CHUNK", 7)
    keys = [1, 1, 1, 2, 2, 5, 5, 4, 4, 4, 9, 9, 1, 2] * 4
    whole = runs.agglomerate(columns(56, keys), 0.5, 1.0)
    p = runs._Pass(0.5, 1.0, 1, False)
    r = columns(56, keys)
    got = [f for i in range(0, 56, 5) for f in p.feed(r.cut(i, i + 5))] + list(p.finish(False))
    assert sorted(x for f in got for x in zip(f["first_no"], f["last_no"], f["n"])) == list(zip(whole.first, whole.last, whole.n))


def test_only_border_nodes_of_a_hot_entity_travel(spark):
    df = spark.range(20_000).selectExpr("1L entity", "id no", "double(id) t0", "double(id) + 0.5 t1", "1L key1", "id div 7 key2").repartition(5)
    p = runs._Pass(1.0, 1.0, 1, True)
    n = 20_000
    r = columns(n, np.arange(n) // 7)
    frames = list(p.feed(r)) + list(p.finish(True))
    assert sum((f["open"] == 1).sum() for f in frames) == 2
    got = sorted((r.first_no, r.last_no, r.n) for r in runs.collapse(df).collect())
    assert got == [(i, min(i + 6, 19_999), min(7, 20_000 - i)) for i in range(0, 20_000, 7)]


def test_near_identical(spark):
    rows = make(4, 60, 2)
    df = spark.createDataFrame(rows, S).repartition(5)
    got = {}
    for r in runs.collapse(df, 0.5, 2.0).collect():
        got.setdefault(r.entity, []).append((r.first_no, r.last_no, r.n))
    for e in (0, 1):
        want = brute([r for r in rows if r[0] == e], 0.5, 2.0)
        assert sorted(got[e]) == sorted(want)


def test_one_run_of_all_rows(spark):
    df = spark.range(5000).selectExpr("1L entity", "id no", "double(id) t0", "double(id) + 0.5 t1", "1L key1", "1L key2").repartition(7)
    assert [(r.first_no, r.last_no, r.n, r.t0, r.t1) for r in runs.collapse(df).collect()] == [(0, 4999, 5000, 0.0, 4999.5)]


def test_timeline(spark):
    s = "take_id long, out_no int, t0 double, t1 double, surah int, ayah int, conf double, loaded_at timestamp"
    import datetime as dt

    at = dt.datetime(2024, 1, 1)
    rows = [(1, 0, 0.0, 1.0, 1, 1, 0.5, at), (1, 0, 0.0, 1.0, 1, 1, 0.5, at), (1, 1, 1.5, 2.0, 1, 1, 0.5, at), (1, 2, 3.0, 4.0, 1, 1, 0.5, at)]
    got = [tuple(r)[:5] for r in runs.timeline_runs(spark.createDataFrame(rows, s)).collect()]
    assert got == [(1, 0, 1, 2, 2.0)]
    assert runs.timeline_runs(spark.createDataFrame([], s)).count() == 0
