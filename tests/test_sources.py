import json

import pytest
from pyspark.sql import functions as F

from strandline.operators import rollups, spans
from strandline.plans import pipelines
from strandline.sources import documents, feeds, paged, reference, sinks
from strandline.streaming import sync_stream


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value))


def test_feed(spark, tmp_path):
    e = "<entry><yt:videoId>{}</yt:videoId><media:title>{}</media:title><published>{}</published></entry>"
    put(tmp_path / "feed.xml", "<feed>" + e.format("a", " A &amp; B &#39;c&#39; ", "2024-01-01") + "\n" + e.format("b", "", "x") + e.format("", "t", "x") + "</feed>")
    got = [tuple(r) for r in feeds.read_feed(spark, str(tmp_path / "feed.xml")).collect()]
    assert got == [("a", "A & B 'c'", "2024-01-01", None)]


def pages(tmp_path):
    item = lambda i: {"videoId": f"v{i}", "title": f"{i}th Jan 2024 Makkah Fajr", "publishedAt": "2024-01-0%dT00:00:00Z" % i}
    put(tmp_path / "p/page-1.json", {"items": [item(1), item(2)], "nextPageToken": "2"})
    put(tmp_path / "p/page-2.json", {"items": [item(3)], "nextPageToken": "3"})
    put(tmp_path / "p/page-3.json", {"items": [item(4)]})
    put(tmp_path / "d/1.json", {"items": [{"id": "v1", "duration": "PT1M"}, {"id": "v2", "duration": "junk"}]})
    return str(tmp_path / "p"), str(tmp_path / "d")


def test_pages_and_catalog(spark, tmp_path):
    p, d = pages(tmp_path)
    assert feeds.read_pages(spark, p).count() == 4
    assert feeds.read_pages(spark, p, 2).count() == 2 and feeds.read_pages(spark, p, 3).count() == 3
    r = pipelines.build_catalog(spark, str(tmp_path / "out"), p, d).collect()[0]
    assert r.entries == 4 and r.persons == 0
    got = {x.video_id: x.duration_seconds for x in spark.read.parquet(str(tmp_path / "out/catalog")).collect()}
    assert got == {"v1": 60.0, "v2": None, "v3": None, "v4": None}
    with pytest.raises(ValueError):
        feeds.read_catalog_source(spark, None, None, None)


def test_paged_source(spark, tmp_path):
    put(tmp_path / "first.json", {"items": [{"videoId": "a", "title": "t", "publishedAt": "p"}] * 2, "nextPageToken": "x"})
    put(tmp_path / "x.json", {"items": [{"videoId": "b"}]})
    spark.dataSource.register(paged.PagedListing)
    d = spark.read.format("paged_listing").option("folder", str(tmp_path))
    assert d.load().count() == 3
    assert d.option("max_videos", "1").load().count() == 2  # the limit is looked at after a page


def test_documents(spark, tmp_path):
    put(tmp_path / "c/ab.transcript.json", {"model": "m", "windows": 1, "segments": [{"t0": 1, "t1": 2.5, "arabic": "x"}]})
    put(tmp_path / "c/cd.transcript.json", {"model": "m", "windows": 1, "segments": []})
    got = sorted((r.video_id, r.seg_no, r.t1) for r in documents.read_transcripts(spark, str(tmp_path / "c")).collect())
    assert got == [("ab", 0, 2.5), ("cd", None, None)]
    assert documents.read_transcripts(spark, str(tmp_path / "none")).count() == 0
    assert documents.read_timelines(spark, str(tmp_path / "none")).count() == 0
    put(tmp_path / "t/a.json", {"videoId": "a", "coverage": 1, "segments": [{"t0": 0, "t1": 1, "surah": None, "ayah": None, "conf": 0.1}]})
    assert [(r.surah, r.is_partial) for r in documents.read_timelines(spark, str(tmp_path / "t")).collect()] == [(None, False)]
    put(tmp_path / "cat.json", {"entries": [{"videoId": "a", "title": "t", "isAdhaan": True}]})
    r = documents.read_catalog(spark, str(tmp_path / "cat.json")).collect()[0]
    assert (r.video_id, r.is_adhaan, r.date_corrected, r.duration_seconds) == ("a", True, False, None)


def test_import(spark, tmp_path):
    rows = [{"start": "0:01", "end": "0:03", "arabic": " a "}, {"start": "0:05", "end": "0:04", "arabic": "b"}, {"t0": 7, "t1": 8, "arabic": "c"}]
    put(tmp_path / "a.json", rows)
    put(tmp_path / "b.json", {"segments": rows})
    for n in "ab":
        got = [tuple(r) for r in documents.import_manual(spark, str(tmp_path / f"{n}.json")).collect()]
        assert got == [("manual-import", 1, 0, 1.0, 3.0, "a"), ("manual-import", 1, 2, 7.0, 8.0, "c")]


def test_transcribe(spark):
    w = spark.createDataFrame([("v", 0, 0, 600), ("v", 1, 580, 1180)], "video_id string, window_no int, window_start int, window_end int")
    answer = F.when(F.col("window_no") == 0, '{"segments":[{"start":"9:50","end":"9:58","arabic":"x"}]}').otherwise(
        '{"segments":[{"start":"0:10","end":"0:18","arabic":"x"},{"start":"0:30","end":"0:40","arabic":"y"}]}'
    )
    got = pipelines.transcribe(w, lambda d: d.withColumn("response", answer)).orderBy("t0").collect()
    assert [(r.t0, r.t1, r.text) for r in got] == [(590.0, 598.0, "x"), (610.0, 620.0, "y")]
    assert pipelines.transcribe(w, lambda d: d.withColumn("response", F.lit("no json"))).count() == 0


def test_store(spark, tmp_path):
    s = spark.createDataFrame([(2, "B", 3), (1, "A", 2)], "id int, name_simple string, verses_count int")
    a = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "surah int, ayah int, text_uthmani string")
    p = str(tmp_path / "store")
    reference.write_store(p, s, a, 2)
    with pytest.raises(reference.StoreError):
        reference.write_store(p, s, a, 3)
    with pytest.raises(reference.StoreError):
        reference.write_store(p, s.union(s), a)
    rows = spark.createDataFrame([(1, 1, "old", 1), (1, 1, "new", 2)], "surah int, ayah int, text string, seq int")
    got = reference.add_translations(spark, p, {"t1": ("T", "Author", "en", rows), "t2": ("U", "", "en", rows.filter("false"))})
    assert got["t1"] is None and "no rows" in got["t2"]
    assert [r.id for r in reference.chapters(spark, p).collect()] == [1, 2]
    assert reference.translation_label(spark, p, "t1") == "Author" and reference.translation_label(spark, p, "t2") == "t2"
    v = reference.with_translation(reference.verses(spark, p), reference.translation(spark, p, "t1"))
    assert {(r.ayah, r.translation) for r in v.collect()} == {(1, "new"), (2, None)}


@pytest.fixture
def site_tables(spark):
    c = spark.createDataFrame(
        [("a", "t", "2024-01-02T00:00:00Z", 60.0, "2024-01-02", "makkah", "fajr", False, "P", "p"), ("b", "t2", "2024-01-01T00:00:00Z", None, None, None, "asr", None, None, None)],
        "video_id string, title string, published_at string, duration_seconds double, rec_date string, venue string, session string, is_adhaan boolean, person string, person_key string",
    )
    t = spark.createDataFrame([("a", 1)], "video_id string, take_id long")
    tl = spark.createDataFrame([(1, 0, 0.0, 1.0, 2, 1, 0.9, None), (1, 1, 1.0, 2.0, 2, 2, 0.7, True), (1, 2, 2.0, 3.0, None, None, 0.1, None)], "take_id long, out_no int, t0 double, t1 double, surah int, ayah int, conf double, is_partial boolean")
    v = spark.createDataFrame([(2, 1, "x"), (2, 2, "y")], "surah int, ayah int, text_uthmani string")
    s = spark.createDataFrame([(1, "One", 7), (2, "Two", 2), (3, "Three", 5)], "id int, name_simple string, verses_count int")
    return c, t, tl, v, s


def test_site(spark, tmp_path, site_tables):
    out = str(tmp_path / "site")
    r = pipelines.site(spark, *site_tables, out).collect()[0]
    assert (r.pages, r.analysed) == (2 + 1 + 1 + 1 + 3, 1)
    read = lambda n: spark.read.parquet(f"{out}/{n}").collect()
    assert {(x.id, x.occurrences) for x in read("chapter_index")} == {(1, 0), (2, 1), (3, 0)}
    assert {(x.video_id, x.heading, x.line) for x in read("recited_lines")} == {("a", "Fajr", "Two"), ("b", "Asr", "Silent recitation — nothing audible to transcribe")}
    assert [(x.reference, x.doubtful, x.partial) for x in sorted(read("video_pages"), key=lambda x: x.out_no)] == [("Two 2:1", False, False), ("Two 2:2", True, True), ("not identified", False, False)]
    assert [(x.day, x.labels) for x in sorted(read("home_recent_days"))] == [("2024-01-01", ""), ("2024-01-02", "Two")]
    lines = spark.read.parquet(f"{out}/recited_lines")
    assert sinks.day_pages_html(spark.read.parquet(f"{out}/day_pages"), lines, f"{out}/html") == 2
    assert "<b>Fajr</b> Two" in {x.day: x.html for x in read("html")}["2024-01-02"]


def test_labels(spark):
    r = spark.createDataFrame([(1, 1, 2, 1, 2, 0.0), (1, 2, 2, 1, 1, 0.0), (1, 3, 9, 3, 5, 0.0)], "take_id long, range_no long, chapter int, from_verse int, to_verse int, start_seconds double")
    s = spark.createDataFrame([(2, "Two", 2)], "id int, name_simple string, verses_count int")
    assert {x.range_no: x.label for x in rollups.label_ranges(r, s).collect()} == {1: "Two", 2: "Two 1", 3: "Surah 9 3–5"}


def test_sync_runs_twice(spark, tmp_path, site_tables):
    c, t, _, v, _ = site_tables
    seg = spark.createDataFrame([(1, 1, "a", 0, 0.0, 2.0, "abc")], "seg_id long, take_id long, video_id string, seg_no int, t0 double, t1 double, arabic string")
    v = v.withColumn("text_uthmani", F.lit("بسم ربك"))
    seg = seg.withColumn("arabic", F.lit("بسم ربك"))
    out = str(tmp_path / "sync")
    assert [(r.video_id, r.status) for r in pipelines.run_sync(spark, c, t, seg, v, out).collect()] == [("a", "done")]
    assert [(r.video_id, r.status) for r in pipelines.run_sync(spark, c, t, seg, v, out).collect()] == [("a", "skipped")]
    assert pipelines.run_sync(spark, c, t, seg, v, out, limit=0).count() == 0
    # done again, it replaces what it had; every run leaves a report
    n = pipelines.synced_timeline(spark, out).count()
    assert [r.status for r in pipelines.run_sync(spark, c, t, seg, v, out, force=True).collect()] == ["done"]
    assert pipelines.synced_timeline(spark, out).count() == n == 1
    assert spark.read.json(f"{out}/reports").count() == 4
    assert pipelines.run_sync(spark, c, t, seg, v, out, days=0, now="2030-01-01T00:00:00Z").count() == 0
    with pytest.raises(ValueError):
        pipelines.run_sync(spark, c, t, seg, v, out, days=90)


def test_windows_of_unknown_durations(spark):
    c = spark.createDataFrame([("a", None), ("b", 30.0)], "video_id string, duration_seconds double")
    got = sorted(tuple(r) for r in pipelines.planned_windows(c).collect())
    assert got == [("a", 0, 0, 600), ("a", 1, 580, 900), ("b", 0, 0, 30)]


def test_translations_again(spark, tmp_path):
    rows = spark.createDataFrame([(1, 1, "x")], "surah int, ayah int, text string")
    for author in ("A", "B"):
        assert reference.add_translations(spark, str(tmp_path), {"131": ("n", author, "en", rows), "none": ("n", "x", "en", rows.filter("false"))})["131"] is None
    assert spark.read.parquet(f"{tmp_path}/translation_source").count() == 1
    assert reference.translation_label(spark, str(tmp_path), "131") == "B" and reference.translation_label(spark, str(tmp_path), "none") == "none"


def test_stream_reads_files_once(spark, tmp_path, site_tables):
    v = site_tables[3].withColumn("text_uthmani", F.lit("بسم ربك"))
    from strandline.operators.corpus import build_corpus

    seg = lambda take: spark.sql(f"select cast({take} as bigint) seg_id, cast({take} as bigint) take_id, 'a' video_id, 0 seg_no, 0D t0, 2D t1, 'بسم ربك' arabic, timestamp'2024-01-01' loaded_at")
    src, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    for take in (1, 2):
        seg(take).write.mode("append").parquet(src)
        sync_stream.align_new_files(spark, src, build_corpus(v), out, ck)
        assert sorted(r.take_id for r in spark.read.parquet(out).collect()) == list(range(1, take + 1))
    sync_stream.align_new_files(spark, src, build_corpus(v), out, ck)
    assert spark.read.parquet(out).count() == 2


def test_sinks(spark, tmp_path, site_tables):
    sinks.write_by_key(site_tables[0], str(tmp_path / "k"), "video_id", 4)
    assert spark.read.parquet(str(tmp_path / "k")).filter((F.col("video_id") == "a") & (F.col("bucket") == sinks.bucket_of("video_id", 4))).count() == 1
    sinks.append_report(spark.sql("select 1 n"), str(tmp_path / "r"), "1")
    sinks.append_report(spark.sql("select 2 n"), str(tmp_path / "r"), "2")
    assert spark.read.json(str(tmp_path / "r")).count() == 2
    sinks.export_json(site_tables[0], str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2
    assert spans.number_rows(site_tables[0], [], [F.col("video_id")]).orderBy("video_id").first().pos == 0
