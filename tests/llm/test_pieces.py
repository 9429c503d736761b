import math
import random

import pytest

from strandline.llm import pieces


def plain(d, ps, limit, overlap):
    end, s, out = math.ceil(d), 0, []
    while end - s > limit:
        p = [x for x in ps if s + overlap < x <= s + limit]
        e = max(p) if p else s + limit
        out.append((s, e))
        s = e - overlap
    return [*out, (s, end)]


@pytest.mark.parametrize("seed,width,fan", [(1, 7200, 64), (2, 700, 3), (3, 1800, 4)])
def test_like_plain(spark, seed, width, fan, monkeypatch):
    monkeypatch.setattr(pieces, "FAN", fan)
    r = random.Random(seed)
    rec = [(f"v{i}", r.choice([None, 0.0, 600.0, 600.5, 601.0, 1180.0, 7200.0, 7201.0, r.uniform(600, 30000)])) for i in range(60)]
    pauses = [(v, r.randrange(0, 31000)) for v, d in rec if d and r.random() < 0.8 for _ in range(r.choice([1, 20, 200]))]
    pauses += pauses[:50] + [("v1", None), (None, 5), ("other", 5), ("v2", -3)]
    r.shuffle(pauses)
    a = spark.createDataFrame(rec, "video_id string, duration_seconds double")
    b = spark.createDataFrame(pauses, "video_id string, at_s int")
    got = {}
    for x in pieces.split_recordings(a, b, 600, 20, width).orderBy("video_id", "piece_no").collect():
        got.setdefault(x.video_id, []).append((x.piece_no, x.start_s, x.end_s))
    for v, d in rec:
        if d is None or d <= 600:
            assert v not in got
        else:
            ps = [p for w, p in pauses if w == v and p is not None]
            assert got[v] == [(i + 1, *x) for i, x in enumerate(plain(d, ps, 600, 20))]


def test_empty_and_checks(spark):
    a = spark.createDataFrame([], "video_id string, duration_seconds double")
    b = spark.createDataFrame([], "video_id string, at_s int")
    assert pieces.split_recordings(a, b).count() == 0
    one = spark.createDataFrame([("v", 1000.0)], "video_id string, duration_seconds double")
    assert [tuple(r) for r in pieces.split_recordings(one, b).collect()] == [("v", 1, 0, 600), ("v", 2, 580, 1000)]
    with pytest.raises(ValueError):
        pieces.split_recordings(one, b, 600, 600)
