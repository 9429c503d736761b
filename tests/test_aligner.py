"""The fold against a plain sequential version, and the behaviours it is for."""

import math
import random

import pytest

from strandline.functions.text import py_skeleton
from strandline.operators import aligner, corpus

LETTERS = "بتثجحخدرزسشصضطظعغفقكلمنهو"


def word(r):
    return "".join(r.choice(LETTERS) for _ in range(r.randrange(3, 6)))


def make_corpus(seed, n=300):
    r = random.Random(seed)
    common = [word(r) for _ in range(30)]
    verses = []
    for i in range(n):
        ws = [r.choice(common) if r.random() < 0.3 else word(r) for _ in range(r.randrange(2, 14))]
        verses.append((i // 20 + 1, i % 20 + 1, ws))
    for k in (40, 45, 50):  # a refrain
        verses[k] = (*verses[k][:2], ["نعمه", "ربكم", "تكذبون"])
    return verses


def lev(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def sim(a, b):
    return 1.0 if not a and not b else 1 - lev(a, b) / max(len(a), len(b))


def score(q, v):
    if not q or not v:
        return 0.0, 0.0
    p = q[: len(v) + 1]
    hit = sum(w in v for w in p)
    return 0.55 * sim(p, v) + 0.25 * (hit / len(v)) + 0.2 * (hit / len(p)), hit / len(v)


def test_distances_and_scores():
    r = random.Random(1)
    verses = make_corpus(1, 60)
    ix = aligner.Index(verses, aligner.AlignOptions())
    for _ in range(300):
        pos = r.randrange(60)
        v = verses[pos][2]
        q = tuple(r.choice(v) if r.random() < 0.6 else word(r) for _ in range(r.randrange(1, 16)))
        assert ix.distances(q, pos) == [lev(q[:k], v) for k in range(len(q) + 1)]
        assert ix.score(q, pos) == pytest.approx(score(list(q), v))
        low, high = max(1, len(v) // 2), min(len(q), math.ceil(len(v) * 1.5) + 1)
        tried = [(sim(list(q[:k]), v), k) for k in range(low, high + 1)]
        best = max(tried)[1] if tried else min(len(q), len(v))
        assert ix.extent(q, pos) == (len(q) if len(q) - best <= 2 else best)


def fold(rows, verses):
    ix = aligner.Index(verses, aligner.AlignOptions())
    return [[verses[p][:2] if p is not None else None, round(c, 3)] for _, _, p, c, _ in aligner.align_one(rows, ix)]


def text(verse):
    return " ".join(verse[2])


def test_perfect_transcript():
    verses = make_corpus(2)
    rows = [(i * 5.0, i * 5.0 + 4, text(v)) for i, v in enumerate(verses[20:40])]
    assert [x[0] for x in fold(rows, verses)] == [v[:2] for v in verses[20:40]]


def test_refrain_walks_forward():
    verses = make_corpus(3)
    rows = [(i * 5.0, i * 5.0 + 4, text(v)) for i, v in enumerate(verses[38:52])]
    assert [x[0] for x in fold(rows, verses)] == [v[:2] for v in verses[38:52]]


def test_merged_span_splits_and_word_errors():
    verses = make_corpus(4)
    long = [v for v in verses[100:104]]
    rows = [(0.0, 40.0, " ".join(map(text, long)))]
    got = aligner.align_one(rows, aligner.Index(verses, aligner.AlignOptions()))
    assert [verses[x[2]][:2] for x in got] == [v[:2] for v in long]
    assert all(a[1] == pytest.approx(b[0], abs=0.002) for a, b in zip(got, got[1:])) and got[-1][1] <= 40
    v = max(verses[110:120], key=lambda v: len(v[2]))
    ws = list(v[2])
    ws[1] = "خطا"
    assert fold([(0.0, 4.0, " ".join(ws))], verses)[0][0] == v[:2]


def test_refusal_and_boilerplate():
    verses = make_corpus(5)
    opener = py_skeleton(aligner.C.BOILERPLATE)
    got = fold([(0.0, 1.0, "كلام غريب تماما هنا"), (1.0, 2.0, opener), (2.0, 5.0, text(verses[7]))], verses)
    assert got[0][0] is None and got[1] == [None, 0.0] and got[2][0] == verses[7][:2]


def test_reconcile_backward():
    verses = make_corpus(6)
    same = ["وقال", "الذين", "كفروا", "مثلهم"]
    verses[60], verses[160] = (*verses[60][:2], same), (*verses[160][:2], same)
    rows = [(0.0, 4.0, " ".join(same)), (5.0, 9.0, text(verses[161]))]
    assert [x[0] for x in fold(rows, verses)] == [verses[160][:2], verses[161][:2]]
    rows[1] = (5.0, 9.0, text(verses[61]))
    assert [x[0] for x in fold(rows, verses)] == [verses[60][:2], verses[61][:2]]
    rows[1] = (5.0, 9.0, text(verses[220]))  # a jump stays as it is
    assert fold(rows, verses)[1][0] == verses[220][:2]


def test_align_over_spark(spark):
    verses = make_corpus(7)
    v = spark.createDataFrame([(s, a, " ".join(ws)) for s, a, ws in verses], "surah int, ayah int, text_uthmani string")
    c = corpus.build_corpus(v)
    rows = [(t, i, i * 5.0, i * 5.0 + 4, text(verses[t * 10 + i])) for t in range(8) for i in range(6)]
    rows += [(9, 0, None, 1.0, "a"), (None, 0, 0.0, 1.0, "a"), (9, 1, 0.0, 1.0, None), (9, 2, 0.0, 1.0, "  "), (10, 0, 0.0, 1.0, "abc")]
    random.Random(1).shuffle(rows)
    s = spark.createDataFrame(rows, "take_id long, seg_no int, t0 double, t1 double, arabic string")
    got = {}
    for r in aligner.align(s, c).orderBy("take_id", "out_no").collect():
        got.setdefault(r.take_id, []).append((r.surah, r.ayah))
    for t in range(8):
        assert got[t] == [verses[t * 10 + i][:2] for i in range(6)]
    assert 9 not in got
    assert aligner.align(s.filter("false"), c).count() == 0
    with pytest.raises(ValueError):
        aligner.align(s, c, aligner.AlignOptions(max_verses=10))


def test_candidates_find_rare_words(spark):
    verses = make_corpus(8)
    v = spark.createDataFrame([(s, a, " ".join(ws)) for s, a, ws in verses], "surah int, ayah int, text_uthmani string")
    c = corpus.build_corpus(v)
    s = spark.createDataFrame([(text(verses[33]),), ("",), (None,), ("xyz",)], "arabic string")
    m = {r.norm: r for r in corpus.match_texts(s, "arabic", c).collect()}
    assert len(m) == 1 and (m[text(verses[33])].surah, m[text(verses[33])].ayah) == verses[33][:2]
