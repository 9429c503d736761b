import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from strandline.operators import incremental, sync
from strandline.sources import files


def test_intervals(spark):
    f = lambda rows: spark.createDataFrame(rows, "source string, lo long, hi long")
    r = random.Random(3)
    a = [(k, x := r.randrange(500), x + r.randrange(40)) for k in "ab" for _ in range(30)] + [("a", 9, 3), ("a", None, 3)]
    p = [(k, x := r.randrange(500), x + r.randrange(20)) for k in "ab" for _ in range(25)]
    cover = lambda rows, k: {i for s, lo, hi in rows if s == k and lo is not None for i in range(lo, hi + 1)}
    left = [tuple(x) for x in incremental.subtract_intervals(f(a), f(p)).collect()]
    for k in "ab":
        assert cover(left, k) == cover(a, k) - cover(p, k)
        mine = sorted(x for x in left if x[0] == k)
        assert all(x[2] + 1 < y[1] for x, y in zip(mine, mine[1:]))
    assert incremental.merge_intervals(f([])).count() == 0
    assert incremental.subtract_intervals(f([("z", 1, 5)]), f([])).collect()[0][1:] == (1, 5)


def test_intervals_of_one_record(spark):
    r = random.Random(5)
    some = lambda n: [(x := r.randrange(60), x + r.randrange(-1, 9)) for _ in range(n)]
    rows = [(i, some(r.randrange(6)), some(r.randrange(6))) for i in range(60)]
    d = spark.createDataFrame(rows, "i int, a array<struct<lo:bigint,hi:bigint>>, p array<struct<lo:bigint,hi:bigint>>")
    m = d.select("i", incremental.merged(F.col("a")).alias("a"), incremental.merged(F.col("p")).alias("p"))
    cover = lambda xs: {k for lo, hi in xs for k in range(lo, hi + 1)}
    for x, (_, a, p) in zip(m.withColumn("left", incremental.subtracted(F.col("a"), F.col("p"))).orderBy("i").collect(), rows):
        assert cover(x.a) == cover(a) and cover(x.left) == cover(a) - cover(p)
        assert all(y.hi + 1 < z.lo for y, z in zip(x.a, x.a[1:])) and len(cover(x.left)) == sum(y.hi - y.lo + 1 for y in x.left)


def test_ledger_survives_failure_and_late_commits(spark, tmp_path):
    led = incremental.Ledger(spark, str(tmp_path))
    avail = lambda *rows: spark.createDataFrame(list(rows), "source string, lo long, hi long")
    out = lambda *ids: spark.createDataFrame([(i,) for i in ids], "id long")
    assert led.outputs() is None and led.latest("id") is None
    todo = led.pending(avail(("s", 1, 10)))
    assert [tuple(x) for x in todo.collect()] == [("s", 1, 10)]
    led.commit(avail(("s", 1, 4), ("s", 8, 10)), out(1, 2, 3, 4, 8, 9, 10))
    # a run that dies after writing its data, before its commit
    bad = incremental.Ledger(spark, str(tmp_path))
    try:
        bad.commit(avail(("s", 5, 7)), out(5).selectExpr("raise_error('lost') id"))
    except Exception:
        pass
    assert sorted(tuple(x) for x in led.pending(avail(("s", 1, 12))).collect()) == [("s", 5, 7), ("s", 11, 12)]
    led.commit(avail(("s", 5, 7), ("s", 11, 12)), out(5, 6, 7, 11, 12))
    assert led.pending(avail(("s", 1, 12))).count() == 0
    assert sorted(x.id for x in led.outputs().collect()) == list(range(1, 13))
    assert [tuple(x) for x in led.processed().collect()] == [("s", 1, 12)]
    led.commit(avail(("s", 3, 3)), out(3))
    assert led.outputs().count() == 13 and led.latest("id").count() == 12
    with pytest.raises(FileExistsError):
        files.create(spark, f"{tmp_path}/commits/3", "{}")


def day(n):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=n)


D = "row_id long, video_id string, title string, published_at string, duration_seconds double, ingested_at timestamp"


def brute(deliveries, runs, outcomes):
    out = set()

    def content(v, cut):
        mine = [d for d in deliveries if d[1] == v and d[5] is not None and d[5] <= cut]
        return max(mine, key=lambda d: (d[5], d[0]))[2:5] if mine else None

    cuts = dict(runs)
    for n, cut in runs:
        for v in {d[1] for d in deliveries if d[1] is not None}:
            c = content(v, cut)
            done = [q for q, w, s in outcomes if w == v and s == "done" and q < n]
            if c is not None and (not done or c != content(v, cuts[max(done)])):
                out.add((n, v))
    return out


@pytest.mark.parametrize("seed", range(4))
def test_pending_by_run(spark, seed):
    r = random.Random(seed)
    runs = [(i + 1, day(10 * i + 10)) for i in range(6)]
    if seed == 3:  # cuts out of order
        runs = [(n, c) for (n, _), (_, c) in zip(runs, r.sample(runs, 6))]
    deliveries = [
        (i, r.choice(["a", "b", "c", "d", None]), r.choice(["x", "y", None]), "p", r.choice([1.0, None]), r.choice([None, *[day(x) for x in range(70)]]))
        for i in range(60)
    ]
    outcomes = [(n, v, s) for n, _ in runs for v in "abcde" for s in ["done", "failed"] if r.random() < 0.3]
    outcomes += outcomes[:3]
    d = spark.createDataFrame(deliveries, D)
    rs = spark.createDataFrame(runs, "run_no int, cut_at timestamp")
    o = spark.createDataFrame(outcomes, "run_no int, video_id string, status string")
    got = [tuple(x)[:2] for x in incremental.pending_by_run(d, rs, o).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(deliveries, runs, outcomes)
    assert incremental.pending_by_run(d, rs.filter("false"), o).count() == 0
    assert incremental.pending_by_run(d.filter("false"), rs, o).count() == 0


def test_status(spark):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "video_id string")
    t = spark.createDataFrame([("a", 0.0, 1, None), ("a", 1.0, None, None), ("e", None, None, "ValueError: x")], "video_id string, t0 double, surah int, error string")
    s = sync.outcomes(ids("a", "b", "c", "d", "e"), ids("b"), ids("a", "c", "e"), t)
    assert {r.video_id: (r.status, r.coverage) for r in s.collect()} == {
        "a": ("done", 0.5), "b": ("skipped", None), "c": ("empty", None), "d": ("missing", None), "e": ("failed", None)
    }
    r = sync.report(s).collect()[0]
    assert (r.attempted, r.done, r.skipped, r.empty, r.failed, r.needs_review) == (5, 1, 1, 1, 1, 1)
    assert sync.pending(ids("a", "b"), ids("b")).count() == 1 and sync.pending(ids("a", "b"), ids("b"), force=True).count() == 2
    assert {r.source for r in sync.with_source(ids("a"), ids("a"), force=True).collect()} == {"transcribe"}
