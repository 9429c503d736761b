import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strandline.functions import similarity, text, times


def one(spark, column, *values, schema="x string"):
    rows = [(v,) for v in values]
    return [r[0] for r in spark.createDataFrame(rows, schema).coalesce(1).select(column).collect()]


def test_skeleton_unifies(spark):
    a, b, c, d, e = one(spark, text.skeleton(F.col("x")), "مَدْرَسَةٌ", "مدرسه", "abc 12", None, "كتاب۔  آخر")
    assert a == b and c == "" and d == "" and e == "كتب خر"


def test_skeleton_like_python(spark):
    xs = ["أَنْ يُؤْمِنَ", "ۓ ا", "ک ی", "ـــ", "   ", "لا إله", "ٱلْعَـٰلَمِينَ"]
    assert one(spark, text.skeleton(F.col("x")), *xs) == [text.py_skeleton(x) for x in xs]


def test_words_of_nothing(spark):
    assert one(spark, text.words(F.col("x")), "", "a b") == [[], ["a", "b"]]


def test_fold(spark):
    xs = ["Al-Ḥāmid ʻAlī", "ﬁne ½ Ⅻ", "Jumu'ah", "", None, "ＦＵＬＬ", "İ", "straße"]
    assert one(spark, text.fold(F.col("x")), *xs) == [None if x is None else text.py_fold(x) for x in xs]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=12), min_size=30, max_size=30))
def test_fold_any_text(spark, xs):
    # only characters whose lower case Java and Python see alike
    assert one(spark, text.fold(F.col("x")), *xs) == [text.py_fold(x) for x in xs]


def test_entities(spark):
    got = one(spark, text.decode_entities(F.col("x")), "&lt;a&gt; &amp;lt; &#39;&#65;&#1575;&#128512;&#0; &#x41;", "", None)
    assert got == ["<a> &lt; 'Aا😀&#0; &#x41;", "", None]


def test_strip(spark):
    assert one(spark, text.strip(F.col("x")), " ﻿ a b 　", " ") == ["a b", ""]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


words = st.lists(st.sampled_from("abcdefgh"), max_size=9)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(words, words), min_size=40, max_size=40))
def test_word_distance(spark, pairs):
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>").coalesce(1)
    got = [r[0] for r in df.select(similarity.word_distance(F.col("a"), F.col("b"))).collect()]
    assert got == [levenshtein(a, b) for a, b in pairs]


def test_similarity(spark):
    df = spark.createDataFrame([(["a", "b"], ["a", "b"]), (["a", "b", "c"], ["a", "b"]), ([], [])], "a array<string>, b array<string>").coalesce(1)
    got = [r[0] for r in df.select(similarity.sequence_similarity(F.col("a"), F.col("b"))).collect()]
    assert got == pytest.approx([1, 2 / 3, 1])


@given(words, words)
def test_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(row[j + 1], new[j]))
        row = new
    assert similarity.lcs_length(a, b) == row[-1]


def test_durations(spark):
    xs = ["PT8M49S", "PT1H2M3S", "PT45S", "P1DT1S", "P", "PT", "junk", "PT1.2.3S", None]
    assert one(spark, times.parse_iso_duration(F.col("x")), *xs) == [529, 3723, 45, 86401, 0, 0, None, None, None]


def test_clocks(spark):
    xs = ["01:13", "1:02:03", "45", " 7 ", ":30", "", "abc", "-1", "1:2:3:4", None]
    assert one(spark, times.parse_clock(F.col("x")), *xs) == [73, 3723, 45, 7, 30, 0, None, None, None, None]


def test_clock_and_dates(spark):
    assert one(spark, times.clock(F.col("x")), 0.0, 59.9, 3723.5, None, schema="x double") == ["0:00", "0:59", "1:02:03", None]
    assert one(spark, times.pretty_date(F.col("x")), "2026-07-25", "2024-02-31", None) == ["Saturday 25 July 2026", None, None]
    assert one(spark, times.round_to(F.col("x"), 3), 0.5075, 1.0004999, schema="x double") == [0.507, 1.0]


def test_composition_has_one_case():
    assert unicodedata.normalize("NFC", "ۓ") == "ۓ"
