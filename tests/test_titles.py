import pytest
from pyspark.sql import functions as F

from strandline.operators import costs, rules, titles

CASES = [
    ("12th Feb 2024 Makkah Fajr Sheikh Test Name", dict(rec_date="2024-02-12", venue="makkah", session="fajr", person="Test Name", confidence=1.0, leftovers=[])),
    ("3 March 24 Madinah Isha Adhaan", dict(rec_date="2024-03-03", venue="madeenah", session="isha", is_adhaan=True, person=None, confidence=0.85)),
    ("1st Jan 1010 Makkah Fajr", dict(rec_date=None, leftovers=["1st", "Jan", "1010"], confidence=0.55)),
    ("5th May 2024 Eid ul Fitr Makkah", dict(session="eid", leftovers=[])),
    ("Maghrib led by Sheikh ‘Abd Allah Q'adi", dict(session="maghrib", person="'Abd Allah Q'adi", person_key="abdallahqadi", leftovers=[])),
    ("constructor", dict(venue=None, session=None, leftovers=["constructor"], confidence=0.0)),
    ("Makkah Madinah Fajr Asr", dict(venue="makkah", session="fajr", leftovers=["Madinah", "Asr"])),
    ("", dict(confidence=0.0, leftovers=[], person=None, is_adhaan=False)),
    (None, dict(confidence=0.0, leftovers=[], person=None, is_adhaan=False)),
    ("  ", dict(confidence=0.0, leftovers=[])),
]


def test_titles(spark):
    df = spark.createDataFrame([(i, c[0]) for i, c in enumerate(CASES)], "i int, title string")
    got = {r.i: r.asDict() for r in titles.parse_titles(df).collect()}
    for i, (title, want) in enumerate(CASES):
        assert {k: got[i][k] for k in want} == want, title


def test_long_title(spark):
    df = spark.createDataFrame([("x " * 3000 + "Sheikh A",)], "title string")
    r = titles.parse_titles(df).collect()[0]
    assert len(r.leftovers) == 3000 and r.person == "A"


@pytest.mark.parametrize(
    "title,upload,date,corrected",
    [
        ("2034-05-01", "2024-05-01T10:00:00Z", "2024-05-01", True),
        ("2024-06-01", "2024-05-01T10:00:00Z", "2024-05-01", True),
        ("2024-05-03", "2024-05-01T10:00:00Z", "2024-05-01", True),
        ("2024-05-02", "2024-05-01T10:00:00Z", "2024-05-02", False),
        ("2024-05-01", "2024-05-01T10:00:00Z", "2024-05-01", False),
        ("2014-05-01", "2024-05-01T10:00:00Z", "2014-05-01", False),
        (None, "2024-05-01T10:00:00Z", None, False),
        ("2024-05-09", "soon", "2024-05-09", False),
        ("2024-05-09", None, "2024-05-09", False),
        ("2024-02-31", "2024-01-01T00:00:00Z", "2024-02-31", False),
    ],
)
def test_reconcile(spark, title, upload, date, corrected):
    df = spark.createDataFrame([(title, upload)], "a string, b string")
    assert tuple(df.select(titles.reconcile_date(F.col("a"), F.col("b")).alias("r")).select("r.*").collect()[0]) == (date, corrected)


def test_rules(spark):
    rows = [(True, "fajr"), (False, None), (None, "asr"), (False, "witr"), (False, "kusuf"), (None, "")]
    d = rules.with_decision(spark.createDataFrame(rows, "is_adhaan boolean, session string").coalesce(1))
    assert [r.reason for r in d.collect()] == ["adhaan", "unparsed-title", "silent-recitation", "ok", "ok", "unparsed-title"]


def test_costs(spark):
    rows = [(False, "fajr", 3600.0), (False, "witr", None), (False, "isha", 0.0), (True, "fajr", 9.0)]
    d = rules.with_decision(spark.createDataFrame(rows, "is_adhaan boolean, session string, duration_seconds double"))
    r = {x.model: x for x in costs.estimate(d).collect()}
    x = r["gemini-3.5-flash-lite"]
    assert (x.videos, x.seconds, x.assumed) == (3, 5400, 2)
    assert x.total == pytest.approx(5400 * 92 / 1e6 * 0.3 + 90 * 350 / 1e6 * 2.5) and x.batch_total == pytest.approx(x.total / 2)
    empty = costs.estimate(d.filter("false")).collect()
    assert len(empty) == 3 and empty[0].total == 0


def test_filters(spark):
    rows = [("a", "2024-05-01T00:00:00Z", None), ("b", "2023-01-01T00:00:00Z", "2023-01-02"), ("c", "junk", None), ("d", None, None)]
    d = spark.createDataFrame(rows, "video_id string, published_at string, rec_date string")
    assert [r.video_id for r in rules.within_last_days(d, "2024-05-02T00:00:00Z", 3).collect()] == ["a"]
    assert {r.video_id for r in rules.before_day(d, "2024-01-01").collect()} == {"b"}
