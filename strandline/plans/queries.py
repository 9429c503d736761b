"""The queries of the core over the tables of a folder, each with its SQL."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline import constants as C
from strandline.functions.similarity import best_prefix_length, sequence_similarity
from strandline.functions.text import decode_entities, escape_html, fold, is_boilerplate, skeleton, words
from strandline.functions.times import clock, day_of, parse_clock, parse_iso_duration, pretty_date
from strandline.operators import agreement, aligner, corpus, costs, dyadic, incremental, rollups, rules, spans, sync, titles
from strandline.plans.registry import Registry
from strandline.session import shared_dir
from strandline.sources import files
from strandline.sources.feeds import entries_of_feed
from strandline.streaming import sync_stream
from strandline.tables import clean_segments, clean_timeline, current_catalog, current_takes, keep_last, load

R = Registry()

#: Times that would otherwise be "now".
NOW, BEFORE, DAYS = "2026-05-02T00:00:00Z", "2026-03-01", 90
#: What the example recordings' analysis is planned with.
WINDOW, OVERLAP = 600, 20


def _values(d: dict | list) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in (kv if isinstance(kv, tuple) else (kv,))) + ")" for kv in (d.items() if isinstance(d, dict) else d))


def _list(d) -> str:
    return "[" + ", ".join(f"'{x}'" for x in d) + "]"


def _map(d: dict) -> str:
    return "MAP {" + ", ".join(f"'{k}': {v!r}" if not isinstance(v, str) else f"'{k}': '{v}'" for k, v in d.items()) + "}"


# --- views of the tables --------------------------------------------------------------------------------------------

CAT = """cat AS (SELECT video_id, title, published_at, duration_seconds, rec_date, mosque AS venue, prayer AS session,
  is_adhaan, sheikh AS person, sheikh_key AS person_key, confidence, leftovers FROM catalog_entries WHERE video_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ingested_at DESC NULLS LAST, row_id DESC) = 1)"""
TL = """tl AS (SELECT * FROM timeline_segments
  QUALIFY row_number() OVER (PARTITION BY take_id, out_no ORDER BY loaded_at DESC NULLS LAST, t0, t1, surah, ayah, conf) = 1)"""
SEG = """seg AS (SELECT * FROM transcript_segments
  QUALIFY row_number() OVER (PARTITION BY seg_id ORDER BY loaded_at DESC NULLS LAST, t0, t1, arabic) = 1)"""
TAKES = """takes AS (SELECT video_id, take_id FROM transcripts WHERE video_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY generated_at DESC NULLS LAST, take_id DESC) = 1)"""
REASON = f"""CASE WHEN coalesce(is_adhaan, false) THEN 'adhaan' WHEN session IS NULL OR session = '' THEN 'unparsed-title'
  WHEN session IN ('{"', '".join(C.SILENT)}') THEN 'silent-recitation' ELSE 'ok' END"""
RECS = f"""recs AS (SELECT cat.*, {REASON} AS reason, take_id, coalesce(rec_date, substr(published_at, 1, 10)) AS day
  FROM cat LEFT JOIN takes USING (video_id))"""
RANGES = f"""{TL}, nn AS (SELECT *, lag(surah) OVER w AS ps, lag(ayah) OVER w AS pa FROM tl WHERE surah IS NOT NULL AND ayah IS NOT NULL
  WINDOW w AS (PARTITION BY take_id ORDER BY t0 NULLS LAST, out_no)),
numbered AS (SELECT *, sum(CASE WHEN ps = surah AND ayah - pa IN (0, 1) THEN 0 ELSE 1 END)
  OVER (PARTITION BY take_id ORDER BY t0 NULLS LAST, out_no) AS range_no FROM nn),
ranges AS (SELECT take_id, range_no, any_value(surah) AS chapter, min(ayah) AS from_verse, max(ayah) AS to_verse,
  arg_min(t0, out_no + 1e9 * t0) AS start_seconds FROM numbered GROUP BY ALL)"""
NAME = "coalesce(name_simple, 'Surah ' || chapter)"
LABELLED = f"""labelled AS (SELECT ranges.*, CASE WHEN from_verse = 1 AND to_verse = verses_count THEN {NAME}
  WHEN from_verse = to_verse THEN {NAME} || ' ' || from_verse ELSE {NAME} || ' ' || from_verse || '–' || to_verse END AS label
  FROM ranges LEFT JOIN surah ON chapter = id)"""
SKEL = f"""trim(regexp_replace(translate(regexp_replace(nfc_normalize(coalesce(%s, '')),
  '[\\x{{0610}}-\\x{{061A}}\\x{{064B}}-\\x{{065F}}\\x{{0670}}\\x{{06D6}}-\\x{{06ED}}\\x{{08D3}}-\\x{{08FF}}\\x{{0640}}]', '', 'g'),
  '{"".join(C.SKELETON_TO)}{C.SKELETON_DROP}', '{"".join(C.SKELETON_TO.values())}'), '[^\\x{{0621}}-\\x{{064A}}]+', ' ', 'g'), ' ')"""
WORDS = "list_filter(string_split(%s, ' '), lambda w: w <> '')"
FOLD = "regexp_replace(lower(strip_accents(%s)), '[^a-z0-9]', '', 'g')"
CORPUS = f"""norms AS (SELECT surah, ayah, row_number() OVER (ORDER BY surah, ayah) - 1 AS pos, {SKEL % "text_uthmani"} AS norm FROM ayah),
corpus AS (SELECT *, {WORDS % "norm"} AS words FROM norms)"""
R3 = "floor((%s) * 1000 + 0.5) / 1000"
R6 = "round(%s, 10)"


def catalog(spark: SparkSession, d: str) -> DataFrame:
    names = {"mosque": "venue", "prayer": "session", "sheikh": "person", "sheikh_key": "person_key"}
    cols = "video_id title published_at duration_seconds rec_date mosque prayer is_adhaan sheikh sheikh_key confidence leftovers".split()
    return current_catalog(load(spark, d, "catalog_entries")).select(*[F.col(c).alias(names.get(c, c)) for c in cols])


def timeline(spark: SparkSession, d: str) -> DataFrame:
    return clean_timeline(load(spark, d, "timeline_segments"))


def segments(spark: SparkSession, d: str) -> DataFrame:
    return clean_segments(load(spark, d, "transcript_segments"))


def takes(spark: SparkSession, d: str) -> DataFrame:
    return current_takes(load(spark, d, "transcripts"))


def records(spark: SparkSession, d: str) -> DataFrame:
    return rollups.records(catalog(spark, d), takes(spark, d))


def verse_corpus(spark: SparkSession, d: str) -> DataFrame:
    return corpus.build_corpus(load(spark, d, "ayah"))


# --- text -----------------------------------------------------------------------------------------------------------


@R.add("normalise_text", f"WITH {SEG} SELECT seg_id, {SKEL % 'arabic'} AS norm, len({WORDS % (SKEL % 'arabic')}) AS n_words FROM seg")
def normalise_text(spark, d):
    norm = skeleton(F.col("arabic"))
    return segments(spark, d).select("seg_id", norm.alias("norm"), F.size(words(norm)).cast("long").alias("n_words"))


@R.add("fold_keys", f"SELECT row_id, {FOLD % 'sheikh'} AS folded, {FOLD % 'sheikh'} IS NOT DISTINCT FROM sheikh_key AS same FROM catalog_entries")
def fold_keys(spark, d):
    f = fold(F.col("sheikh"))
    return load(spark, d, "catalog_entries").select("row_id", f.alias("folded"), f.eqNullSafe(F.col("sheikh_key")).alias("same"))


@R.add(
    "entity_round_trip",
    "SELECT doc_id, md5(text) AS digest, true AS same FROM documents",
)
def entity_round_trip(spark, d):
    """Escaping and decoding gives back the text; the digest is of the result."""
    back = decode_entities(F.concat(escape_html(F.col("text"))))
    return load(spark, d, "documents").select("doc_id", F.md5(back.cast("binary")).alias("digest"), back.eqNullSafe(F.col("text")).alias("same"))


# --- corpus and matching --------------------------------------------------------------------------------------------


@R.add("corpus_table", f"WITH {CORPUS} SELECT pos, surah, ayah, norm, len(words) AS n_words FROM corpus")
def corpus_table(spark, d):
    return verse_corpus(spark, d).select(F.col("pos").cast("long").alias("pos"), "surah", "ayah", "norm", F.col("n_words").cast("long").alias("n_words"))


@R.add(
    "idf_table",
    f"""WITH {CORPUS}, p AS (SELECT DISTINCT pos, unnest(words) AS word FROM corpus)
SELECT word, count(*) AS df, round(ln((SELECT count(*) FROM corpus) / count(*)), 6) AS idf FROM p GROUP BY word""",
)
def idf_table(spark, d):
    return corpus.idf_table(verse_corpus(spark, d)).select("word", "df", F.round("idf", 6).alias("idf"))


CANDIDATES = f"""{SEG}, {CORPUS}, p AS (SELECT DISTINCT pos, unnest(words) AS word FROM corpus),
n AS (SELECT count(*) AS n FROM corpus),
idf AS (SELECT word, ln(any_value(n.n) / count(*)) AS idf FROM p, n GROUP BY word HAVING count(*) <= any_value(n.n) / 5),
texts AS (SELECT DISTINCT {SKEL % "arabic"} AS norm FROM seg),
asked AS (SELECT DISTINCT norm, unnest({WORDS % "norm"}) AS word FROM texts WHERE norm <> ''),
hits AS (SELECT norm, pos, round(sum(idf), 9) AS idf_sum FROM asked JOIN p USING (word) JOIN idf USING (word) GROUP BY ALL),
top AS (SELECT *, row_number() OVER (PARTITION BY norm ORDER BY idf_sum DESC, pos) AS rank FROM hits QUALIFY rank <= {corpus.CANDIDATES})"""


@R.add("candidates_topk", f"WITH {CANDIDATES} SELECT norm, pos, round(idf_sum, 6) AS idf_sum, rank FROM top")
def candidates_topk(spark, d):
    found = corpus.candidates(corpus.texts_of(segments(spark, d), "arabic"), verse_corpus(spark, d))
    return found.select("norm", F.col("pos").cast("long").alias("pos"), F.round("idf_sum", 6).alias("idf_sum"), F.col("rank").cast("long").alias("rank"))


# Words of a pair become ASCII characters by their place in the verse's distinct words; a verse has fewer than 90.
SPELL = "coalesce(list_aggregate(list_transform(%s, lambda w: chr(33 + coalesce(list_position(vocabulary, w), 0)::INT)), 'string_agg', ''), '')"
SCORED = f"""{CANDIDATES}, pairs AS (SELECT top.norm, top.pos, surah, ayah, words AS verse, list_distinct(words) AS vocabulary, {WORDS % "top.norm"} AS query
  FROM top JOIN corpus USING (pos)),
cut AS (SELECT *, query[1:least(len(query), len(verse) + 1)] AS prefix FROM pairs),
dist AS (SELECT *, levenshtein({SPELL % "prefix"}, {SPELL % "verse"}) AS d, len(list_filter(prefix, lambda w: list_contains(verse, w))) AS hit FROM cut),
scored AS (SELECT norm, pos, surah, ayah, query, verse, vocabulary, 0.55::DOUBLE * (1 - d::DOUBLE / greatest(len(prefix), len(verse))) + 0.25::DOUBLE * (hit::DOUBLE / len(verse))
  + 0.2::DOUBLE * (hit::DOUBLE / len(prefix)) AS score, hit::DOUBLE / len(verse) AS coverage FROM dist)"""


@R.add("score_candidates", f"WITH {SCORED} SELECT norm, pos, surah, ayah, round(score, 6) AS score, round(coverage, 6) AS coverage FROM scored")
def score_candidates(spark, d):
    texts = corpus.texts_of(segments(spark, d), "arabic")
    c = verse_corpus(spark, d)
    scored = corpus.score_candidates(corpus.candidates(texts, c), c)
    return scored.select("norm", F.col("pos").cast("long").alias("pos"), "surah", "ayah", F.round("score", 6).alias("score"), F.round("coverage", 6).alias("coverage"))


BEST = f"""best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY norm ORDER BY round(score, 9) DESC, pos) = 1),
tried AS (SELECT norm, pos, len(query) AS q, len(verse) AS l, query, verse, vocabulary,
  greatest(1, len(verse) // 2) AS low, least(len(query), ceil(len(verse) * 1.5)::INT + 1) AS high FROM best WHERE score >= {corpus.MIN_CONFIDENCE}),
lengths AS (SELECT *, unnest(range(low, high + 1)) AS k FROM tried),
sims AS (SELECT norm, k, 1 - levenshtein({SPELL % "query[1:k]"}, {SPELL % "verse"})::DOUBLE / greatest(k, l) AS s FROM lengths),
longest AS (SELECT norm, arg_max(k, s * 1e9 + k) AS k FROM sims GROUP BY norm),
extent AS (SELECT tried.norm, CASE WHEN q - coalesce(k, least(q, l)) <= 2 THEN q ELSE coalesce(k, least(q, l)) END AS consumed FROM tried LEFT JOIN longest USING (norm))"""


@R.add(
    "match_texts",
    f"""WITH {SCORED}, {BEST} SELECT t.norm, CASE WHEN score >= {corpus.MIN_CONFIDENCE} THEN b.pos END AS pos,
  CASE WHEN score >= {corpus.MIN_CONFIDENCE} THEN surah END AS surah, CASE WHEN score >= {corpus.MIN_CONFIDENCE} THEN ayah END AS ayah,
  round(coalesce(score, 0), 6) AS conf, consumed FROM texts t LEFT JOIN best b USING (norm) LEFT JOIN extent USING (norm) WHERE t.norm <> ''""",
)
def match_texts(spark, d):
    m = corpus.match_texts(segments(spark, d), "arabic", verse_corpus(spark, d))
    return m.select("norm", F.col("pos").cast("long").alias("pos"), "surah", "ayah", F.round("conf", 6).alias("conf"), F.col("consumed").cast("long").alias("consumed"))


@R.add(
    "verse_similarity",
    f"""WITH {CORPUS}, pairs AS (SELECT a.surah, a.ayah, a.words AS query, b.words AS verse, list_distinct(b.words) AS vocabulary
  FROM corpus a JOIN corpus b ON b.pos = a.pos + 1)
SELECT surah, ayah, round(1 - levenshtein({SPELL % "query"}, {SPELL % "verse"})::DOUBLE / greatest(len(query), len(verse)), 6) AS similarity FROM pairs""",
)
def verse_similarity(spark, d):
    """Similarity of each verse to the next one, and how much of it that one would take."""
    c = verse_corpus(spark, d)
    after = c.select((F.col("pos") - 1).alias("pos"), F.col("words").alias("next_words"))
    return c.join(after, "pos").select("surah", "ayah", F.round(sequence_similarity(F.col("words"), F.col("next_words")), 6).alias("similarity"))


@R.add(
    "best_prefix",
    f"""WITH {SEG}, {TL}, {CORPUS}, p AS (SELECT DISTINCT tl.surah, tl.ayah, {WORDS % (SKEL % "arabic")} AS query, words AS verse FROM seg JOIN tl USING (take_id, t0)
  JOIN corpus c ON c.surah = tl.surah AND c.ayah = tl.ayah),
tried AS (SELECT *, list_distinct(verse) AS vocabulary, len(query) AS q, len(verse) AS l, greatest(1, len(verse) // 2) AS low, least(len(query), ceil(len(verse) * 1.5)::INT + 1) AS high,
  array_to_string(query, ' ') AS text FROM p WHERE len(query) > 0),
lengths AS (SELECT *, unnest(range(low, high + 1)) AS k FROM tried),
sims AS (SELECT surah, ayah, text, k, 1 - levenshtein({SPELL % "query[1:k]"}, {SPELL % "verse"})::DOUBLE / greatest(k, l) AS s FROM lengths),
longest AS (SELECT surah, ayah, text, arg_max(k, s * 1e9 + k) AS k FROM sims GROUP BY ALL)
SELECT surah, ayah, text, CASE WHEN q - coalesce(k, least(q, l)) <= 2 THEN q ELSE coalesce(k, least(q, l)) END AS consumed FROM tried LEFT JOIN longest USING (surah, ayah, text)""",
)
def best_prefix(spark, d):
    """How many leading words of each text its timeline's verse takes (one row per text and verse)."""
    s = segments(spark, d).select("take_id", "t0", words(skeleton(F.col("arabic"))).alias("query"))
    t = timeline(spark, d).filter("surah is not null").select("take_id", "t0", "surah", "ayah")
    c = verse_corpus(spark, d).select("surah", "ayah", F.col("words").alias("verse"))
    p = s.join(t, ["take_id", "t0"]).join(c, ["surah", "ayah"]).filter(F.size("query") > 0).select("surah", "ayah", "query", "verse").distinct()
    return p.select("surah", "ayah", F.array_join("query", " ").alias("text"), best_prefix_length(F.col("query"), F.col("verse")).cast("long").alias("consumed"))


@R.add("align_takes")
def align_takes(spark, d):
    """The aligner over all takes."""
    return aligner.align(segments(spark, d), verse_corpus(spark, d))


@R.add(
    "boilerplate_texts",
    f"WITH {SEG} SELECT seg_id, {SKEL % "arabic"} = {SKEL % ("'" + C.BOILERPLATE + "'")} AS boilerplate FROM seg",
)
def boilerplate_texts(spark, d):
    return segments(spark, d).select("seg_id", is_boilerplate(F.col("arabic")).alias("boilerplate"))


@R.add(
    "neighbour_verses",
    f"""WITH {TL}, {CORPUS}, m AS (SELECT DISTINCT surah, ayah FROM tl WHERE surah IS NOT NULL)
SELECT m.surah, m.ayah, n.pos AS near FROM m JOIN corpus c USING (surah, ayah) JOIN corpus n ON n.pos BETWEEN c.pos AND c.pos + 3""",
)
def neighbour_verses(spark, d):
    """The verse matched and the three after it, for each verse that was matched."""
    m = timeline(spark, d).filter("surah is not null").select("surah", "ayah").distinct()
    return corpus.neighbours(m, verse_corpus(spark, d)).select("surah", "ayah", F.col("near").cast("long").alias("near"))


# --- spans ----------------------------------------------------------------------------------------------------------

MERGED = f"""{TL}, prev AS (SELECT *, lag(surah) OVER w AS ps, lag(ayah) OVER w AS pa, lag(t1) OVER w AS pt FROM tl
  WINDOW w AS (PARTITION BY take_id ORDER BY t0 NULLS LAST, out_no)),
flag AS (SELECT *, sum(CASE WHEN ps = surah AND pa IS NOT DISTINCT FROM ayah AND t0 - pt < {spans.MERGE_GAP} THEN 0 ELSE 1 END)
  OVER (PARTITION BY take_id ORDER BY t0 NULLS LAST, out_no) AS run_no FROM prev)"""


@R.add(
    "merge_adjacent",
    f"""WITH {MERGED} SELECT take_id, run_no::BIGINT AS run_no, min(t0) AS t0, arg_max(t1, t0 * 1e6 + out_no) AS t1, any_value(surah) AS surah, any_value(ayah) AS ayah,
  {R3 % "max(conf)"} AS conf, bool_and(coalesce(is_partial, false)) AS is_partial, count(*) AS pieces FROM flag GROUP BY take_id, run_no""",
)
def merge_adjacent(spark, d):
    return spans.merge_adjacent(timeline(spark, d))


@R.add("verse_ranges", f"WITH {RANGES} SELECT take_id, range_no::BIGINT AS range_no, chapter, from_verse, to_verse, start_seconds FROM ranges")
def verse_ranges(spark, d):
    return spans.verse_ranges(timeline(spark, d))


@R.add(
    "dedupe_overlap",
    f"""WITH RECURSIVE {SEG}, ordered AS (SELECT take_id, seg_no, t0, t1, arabic, trim(regexp_replace(coalesce(arabic, ''), '^[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}\\x{{FEFF}}]+|[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}\\x{{FEFF}}]+$', '', 'g')) AS x,
  row_number() OVER (PARTITION BY take_id ORDER BY t0, seg_no, t1, arabic) AS n FROM seg WHERE t0 IS NOT NULL AND t1 IS NOT NULL),
fold AS (
  SELECT take_id, n, seg_no, t0, t1, arabic, t1 - t0 >= 0.2 AS kept, CASE WHEN t1 - t0 >= 0.2 THEN t1 END AS end_, CASE WHEN t1 - t0 >= 0.2 THEN x END AS said FROM ordered WHERE n = 1
  UNION ALL
  SELECT o.take_id, o.n, o.seg_no, CASE WHEN o.t0 < f.end_ THEN f.end_ ELSE o.t0 END, o.t1, o.arabic, k.keep,
    CASE WHEN k.keep THEN o.t1 ELSE f.end_ END, CASE WHEN k.keep THEN o.x ELSE f.said END
  FROM fold f JOIN ordered o ON o.take_id = f.take_id AND o.n = f.n + 1,
  LATERAL (SELECT NOT coalesce(o.t0 < f.end_ - 0.5 AND o.x = f.said, false) AND o.t1 - CASE WHEN o.t0 < f.end_ THEN f.end_ ELSE o.t0 END >= 0.2 AS keep) k)
SELECT take_id, seg_no, t0, t1, arabic FROM fold WHERE kept""",
)
def dedupe_overlap(spark, d):
    return spans.dedupe_overlap(segments(spark, d), "take_id", "seg_no", "arabic")


@R.add(
    "plan_windows",
    f"""WITH {CAT}, w AS (SELECT video_id, duration_seconds AS d, unnest(range(0, CASE WHEN duration_seconds <= {WINDOW} THEN 1
  ELSE ceil((duration_seconds - {WINDOW}) / {WINDOW - OVERLAP})::BIGINT + 1 END)) AS i FROM cat WHERE duration_seconds IS NOT NULL)
SELECT video_id, i * {WINDOW - OVERLAP} AS start_s, ceil(least(d, i * {WINDOW - OVERLAP} + {WINDOW}))::BIGINT AS end_s FROM w""",
)
def plan_windows(spark, d):
    w = F.explode(spans.plan_windows(F.col("duration_seconds"), WINDOW, OVERLAP))
    return catalog(spark, d).select("video_id", w.alias("w")).select("video_id", F.col("w.start").alias("start_s"), F.col("w.end").alias("end_s"))


@R.add(
    "anchor_absolute",
    f"""WITH {SEG}, win AS (SELECT *, floor(t0 / 600) * 580 AS ws, floor(t0 / 600) AS no FROM seg WHERE t0 IS NOT NULL AND t1 IS NOT NULL),
ends AS (SELECT take_id, no, min(CASE WHEN take_id % 2 = 0 THEN t0 ELSE t0 - ws END) AS lo, max(CASE WHEN take_id % 2 = 0 THEN t1 ELSE t1 - ws END) AS hi FROM win GROUP BY ALL)
SELECT seg_id, round(CASE WHEN take_id % 2 = 0 THEN t0 ELSE t0 - ws END + CASE WHEN ws = 0 OR (lo >= ws - 1 AND hi <= ws + 600 + 5 AND hi > 600) THEN 0 ELSE ws END, 6) AS t0
FROM win JOIN ends USING (take_id, no)""",
)
def anchor_absolute(spark, d):
    """Segments as if told per window of 600 s: absolute in every second take, relative to the window in the others."""
    s = segments(spark, d).filter("t0 is not null and t1 is not null")
    no = F.floor(F.col("t0") / 600)
    shift = F.when(F.col("take_id") % 2 == 0, 0.0).otherwise(no * 580.0)
    s = s.withColumns({"no": no, "window_start": no * 580, "window_end": no * 580 + 600})
    s = s.withColumns({"t0": F.col("t0") - shift, "t1": F.col("t1") - shift})
    return spans.anchor_absolute(s, ["take_id", "no"]).select("seg_id", F.round("t0", 6).alias("t0"))


@R.add(
    "take_coverage",
    f"""WITH {TL}, n AS (SELECT take_id, count(*) AS s, count(surah) AS m FROM tl GROUP BY take_id)
SELECT take_id, coalesce(s, 0) AS segments, coalesce(m, 0) AS matched, CASE WHEN s > 0 THEN {R3 % "m / s"} ELSE 0.0 END AS coverage
FROM (SELECT DISTINCT take_id FROM transcripts) LEFT JOIN n USING (take_id)""",
)
def take_coverage(spark, d):
    return spans.coverage(timeline(spark, d), load(spark, d, "transcripts"))


@R.add(
    "low_confidence",
    f"WITH {TL} SELECT take_id, count(*) FILTER (WHERE surah IS NOT NULL AND conf < 0.75) AS low FROM tl GROUP BY take_id",
)
def low_confidence(spark, d):
    """Matched rows per take that are under 0.75."""
    return timeline(spark, d).groupBy("take_id").agg(F.count_if(F.col("surah").isNotNull() & (F.col("conf") < 0.75)).alias("low"))


# --- times ----------------------------------------------------------------------------------------------------------


@R.add("parse_iso_duration", f"WITH {CAT} SELECT video_id, floor(duration_seconds) AS seconds, 0.0 AS zero, NULL::DOUBLE AS junk FROM cat")
def parse_iso_duration_query(spark, d):
    """Durations spelled out and read back, the empty duration, and junk."""
    s = F.floor("duration_seconds").cast("long")
    h, m, r = F.floor(s / 3600), F.floor((s % 3600) / 60), s % 60
    part = lambda n, u: F.when(n > 0, F.concat(n.cast("string"), F.lit(u))).otherwise("")
    iso = F.when(s.isNotNull(), F.concat(F.lit("PT"), part(h, "H"), part(m, "M"), part(r, "S")))
    return catalog(spark, d).select(
        "video_id",
        parse_iso_duration(iso).alias("seconds"),
        parse_iso_duration(F.lit("PT")).alias("zero"),
        parse_iso_duration(F.lit("PT1.2.3S")).alias("junk"),
    )


@R.add("clock_round_trip", f"""WITH {SEG} SELECT seg_id, floor(t0) AS seconds, CASE WHEN t0 >= 3600 THEN floor(t0 / 3600)::INT || ':' || lpad((floor(t0)::INT % 3600 // 60)::VARCHAR, 2, '0')
  ELSE (floor(t0)::INT // 60)::VARCHAR END || ':' || lpad((floor(t0)::INT % 60)::VARCHAR, 2, '0') AS shown FROM seg""")
def clock_round_trip(spark, d):
    shown = clock(F.col("t0"))
    return segments(spark, d).select("seg_id", parse_clock(shown).alias("seconds"), shown.alias("shown"))


@R.add(
    "pretty_days",
    f"""WITH {CAT}, days AS (SELECT DISTINCT coalesce(rec_date, substr(published_at, 1, 10)) AS day FROM cat)
SELECT day, strftime(try_cast(day AS DATE), '%A %-d %B %Y') AS pretty FROM days""",
)
def pretty_days(spark, d):
    days = catalog(spark, d).select(day_of(F.col("rec_date"), F.col("published_at")).alias("day")).distinct()
    return days.select("day", pretty_date(F.col("day")).alias("pretty"))


# --- titles and rules -----------------------------------------------------------------------------------------------

_NFKD = FOLD % "t"
PARSED = f"""raw AS (SELECT * FROM catalog_entries WHERE video_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ingested_at DESC NULLS LAST, row_id DESC) = 1),
tok AS (SELECT video_id, published_at, list_filter(string_split(trim(regexp_replace(translate(coalesce(title, ''), '‘’ʻʼ`', ''''''''''''), '[\\s\\x{{00A0}}\\x{{2000}}-\\x{{200A}}\\x{{202F}}\\x{{3000}}\\x{{FEFF}}]+', ' ', 'g')), ' '), lambda t: t <> '') AS t FROM raw),
words AS (SELECT video_id, unnest(t) AS t, generate_subscripts(t, 1) AS i FROM tok),
keyed AS (SELECT video_id, i, t, {_NFKD} AS k, regexp_replace(t, '[^0-9A-Za-z]', '', 'g') AS an, regexp_replace(t, '[^0-9]', '', 'g') AS dg FROM words),
read AS (SELECT *, CASE WHEN regexp_full_match(an, '(?i)[0-9]{{1,2}}(st|nd|rd|th)?') AND regexp_extract(an, '^[0-9]{{1,2}}')::INT BETWEEN 1 AND 31 THEN regexp_extract(an, '^[0-9]{{1,2}}')::INT END AS dd,
  {_map(C.MONTHS)}[k] AS mm, CASE WHEN length(dg) = 4 AND dg::INT BETWEEN 1990 AND 2100 THEN dg::INT WHEN length(dg) = 2 THEN 2000 + dg::INT END AS yy,
  {_map(C.VENUES)}[k] AS v, {_map(C.SESSIONS)}[k] AS s, list_contains({_list(C.CALLS)}, k) AS is_call, list_contains({_list(C.HONORIFICS)}, k) AS is_hon,
  list_contains({_list(C.EID_QUALIFIERS)}, k) AS is_q, list_contains({_list(C.NOISE)}, k) AS is_noise FROM keyed),
dates AS (SELECT a.video_id, min_by(struct_pack(i := a.i, iso := b2.yy || '-' || lpad(b1.mm::VARCHAR, 2, '0') || '-' || lpad(a.dd::VARCHAR, 2, '0')), a.i) AS d
  FROM read a JOIN read b1 ON b1.video_id = a.video_id AND b1.i = a.i + 1 JOIN read b2 ON b2.video_id = a.video_id AND b2.i = a.i + 2
  WHERE a.dd IS NOT NULL AND b1.mm IS NOT NULL AND b2.yy IS NOT NULL GROUP BY a.video_id),
free AS (SELECT r.* FROM read r LEFT JOIN dates USING (video_id) WHERE k <> '' AND (d IS NULL OR i NOT BETWEEN d.i AND d.i + 2)),
firsts AS (SELECT video_id, min(i) FILTER (WHERE v IS NOT NULL) AS vi, min(i) FILTER (WHERE s IS NOT NULL) AS si, min(i) FILTER (WHERE is_hon) AS hi,
  bool_or(is_call) AS call, arg_min(v, i) FILTER (WHERE v IS NOT NULL) AS venue, arg_min(s, i) FILTER (WHERE s IS NOT NULL) AS session FROM free GROUP BY video_id),
rest AS (SELECT f.*, hi IS NOT NULL AND i > hi AS after FROM free f JOIN firsts USING (video_id)
  WHERE NOT coalesce(i = vi, false) AND NOT coalesce(i = si, false) AND NOT coalesce(i = hi, false) AND NOT is_call AND NOT coalesce(session = 'eid' AND i > si AND is_q, false)),
named AS (SELECT video_id, string_agg(t, ' ' ORDER BY i) FILTER (WHERE after) AS person, list(t ORDER BY i) FILTER (WHERE NOT after AND NOT is_noise) AS leftovers FROM rest GROUP BY video_id),
p0 AS (SELECT tok.video_id, tok.published_at, d.iso AS title_date, venue, session, coalesce(call, false) AS is_adhaan, person, {FOLD % "person"} AS person_key,
  floor((CASE WHEN d IS NOT NULL THEN 0.3::DOUBLE ELSE 0 END + CASE WHEN venue IS NOT NULL THEN 0.25::DOUBLE ELSE 0 END + CASE WHEN session IS NOT NULL OR call THEN 0.3::DOUBLE ELSE 0 END
  + CASE WHEN person IS NOT NULL THEN 0.15::DOUBLE ELSE 0 END) * 100 + 0.5) / 100 AS confidence, coalesce(array_to_string(leftovers, '|'), '') AS leftovers
  FROM tok LEFT JOIN dates USING (video_id) LEFT JOIN firsts USING (video_id) LEFT JOIN named USING (video_id)),
parsed AS (SELECT * EXCLUDE (title_date), CASE WHEN date_diff('day', try_cast(substr(published_at, 1, 10) AS DATE), try_cast(title_date AS DATE)) > {C.UPLOAD_SLACK_DAYS} THEN substr(published_at, 1, 10) ELSE title_date END AS rec_date,
  coalesce(date_diff('day', try_cast(substr(published_at, 1, 10) AS DATE), try_cast(title_date AS DATE)) > {C.UPLOAD_SLACK_DAYS}, false) AS date_corrected FROM p0)"""


def parsed(spark, d):
    return titles.build_catalog(current_catalog(load(spark, d, "catalog_entries")).select("video_id", "title", "published_at", "duration_seconds"))


_P = "video_id, venue, session, is_adhaan, person, person_key, confidence, leftovers, rec_date, date_corrected"


@R.add("parse_titles", f"WITH {PARSED} SELECT {_P} FROM parsed")
def parse_titles(spark, d):
    return parsed(spark, d).withColumn("leftovers", F.array_join("leftovers", "|")).select(*_P.split(", "))


@R.add("review_queue", f"WITH {PARSED} SELECT video_id, confidence, leftovers FROM parsed WHERE confidence < {C.CONFIDENCE_LIMIT} OR leftovers <> ''")
def review_queue(spark, d):
    return titles.needs_review(parsed(spark, d)).select("video_id", "confidence", F.array_join("leftovers", "|").alias("leftovers"))


@R.add("corrected_dates", f"WITH {PARSED} SELECT video_id, rec_date FROM parsed WHERE date_corrected ORDER BY published_at DESC, video_id LIMIT 10")
def corrected_dates(spark, d):
    """The ten newest entries whose date was corrected: a report."""
    return titles.newest_first(parsed(spark, d).filter("date_corrected")).limit(10).select("video_id", "rec_date")


@R.add(
    "catalog_summary",
    f"""WITH {PARSED} SELECT count(*) AS entries, count(*) FILTER (WHERE confidence >= {C.CONFIDENCE_LIMIT}) AS understood,
  floor(100 * count(*) FILTER (WHERE confidence >= {C.CONFIDENCE_LIMIT}) / count(*) + 0.5)::BIGINT || '%' AS share, count(DISTINCT nullif(person_key, '')) AS persons FROM parsed""",
)
def catalog_summary(spark, d):
    from strandline.functions.times import percent

    ok = F.count_if(F.col("confidence") >= C.CONFIDENCE_LIMIT)
    return parsed(spark, d).agg(
        F.count("*").alias("entries"),
        ok.alias("understood"),
        percent(ok, F.count("*")).alias("share"),
        F.count_distinct(F.when(F.col("person_key") != "", F.col("person_key"))).alias("persons"),
    )


@R.add("decide_rules", f"""WITH {CAT} SELECT video_id, CASE WHEN session IN ('{"', '".join(C.AUDIBLE)}') THEN 'audible' WHEN session IN ('{"', '".join(C.SILENT)}') THEN 'silent' ELSE 'unknown' END AS audibility, {REASON} AS reason FROM cat""")
def decide_rules(spark, d):
    return rules.with_decision(catalog(spark, d)).select("video_id", rules.audibility(F.col("session")).alias("audibility"), "reason")


@R.add("skipped_counts", f"WITH {CAT}, r AS (SELECT {REASON} AS reason FROM cat) SELECT reason, {_map({k: v.replace(chr(39), chr(39) * 2) for k, v in C.REASON_LABELS.items()})}[reason] AS label, count(*) AS n FROM r WHERE reason <> 'ok' GROUP BY reason")
def skipped_counts(spark, d):
    return costs.skipped_counts(rules.with_decision(catalog(spark, d))).select("reason", rules.reason_label(F.col("reason")).alias("label"), "n")


@R.add(
    "recent_before",
    f"""WITH {CAT} SELECT video_id, published_at FROM cat WHERE try_cast(published_at AS TIMESTAMPTZ) >= TIMESTAMPTZ '{NOW}' - INTERVAL {DAYS} DAY
  AND coalesce(rec_date, substr(published_at, 1, 10)) < '{BEFORE}'""",
)
def recent_before(spark, d):
    c = rules.before_day(rules.within_last_days(catalog(spark, d), NOW, DAYS), BEFORE)
    return c.select("video_id", "published_at")


# --- costs ----------------------------------------------------------------------------------------------------------


@R.add(
    "estimate_cost",
    f"""WITH {CAT}, a AS (SELECT coalesce(CASE WHEN duration_seconds > 0 THEN duration_seconds END, {_map(C.ASSUMED_SECONDS)}[session], {C.ASSUMED_SECONDS_DEFAULT})::DOUBLE AS s,
  NOT coalesce(duration_seconds > 0, false) AS g FROM cat WHERE {REASON} = 'ok'),
t AS (SELECT count(*) AS videos, sum(s) AS seconds, count(*) FILTER (WHERE g) AS assumed FROM a),
m AS (SELECT * FROM (VALUES {_values([r for r in costs.RATE_CARD])}) AS v(model, label, vr, ar, orr))
SELECT model, videos, seconds, assumed, round(seconds * 60 / 1e6 * vr + seconds * 32 / 1e6 * ar, 4) AS input_cost, round(seconds / 60 * 350 / 1e6 * orr, 4) AS output_cost,
  round((seconds * 60 / 1e6 * vr + seconds * 32 / 1e6 * ar + seconds / 60 * 350 / 1e6 * orr) * 0.5, 4) AS batch_total FROM t, m""",
)
def estimate_cost(spark, d):
    e = costs.estimate(rules.with_decision(catalog(spark, d)))
    return e.select("model", "videos", "seconds", "assumed", *[F.round(c, 4).alias(c) for c in ("input_cost", "output_cost", "batch_total")])


# --- sources --------------------------------------------------------------------------------------------------------


@R.add(
    "parse_feed",
    f"WITH {CAT} SELECT video_id, trim(title) AS title, published_at FROM cat WHERE title IS NOT NULL AND title <> '' AND published_at <> ''",
)
def parse_feed(spark, d):
    """The catalogue written as one feed per day, and read back from it."""
    c = catalog(spark, d)
    entry = F.concat(
        F.lit("<entry><yt:videoId>"), "video_id", F.lit("</yt:videoId><media:title>"), escape_html(F.coalesce("title", F.lit(""))),
        F.lit("</media:title>\n<published>"), F.coalesce("published_at", F.lit("")), F.lit("</published></entry>"),
    )
    feeds = c.groupBy(F.substring("published_at", 1, 10).alias("day")).agg(
        F.concat(F.lit("<feed>"), F.array_join(F.collect_list(entry), "\n"), F.lit("</feed>")).alias("value")
    )
    return entries_of_feed(feeds).select("video_id", "title", "published_at")


@R.add(
    "upsert_last_wins",
    """SELECT take_id, out_no, surah, ayah, conf FROM timeline_segments
QUALIFY row_number() OVER (PARTITION BY take_id, out_no ORDER BY loaded_at DESC NULLS LAST, t0, t1, surah, ayah, conf) = 1""",
)
def upsert_last_wins(spark, d):
    return timeline(spark, d).select("take_id", "out_no", "surah", "ayah", "conf")


@R.add(
    "enrich_verses",
    f"""WITH {TL} SELECT tl.take_id, tl.out_no, coalesce(name_simple, 'Surah ' || tl.surah) AS chapter_name, coalesce(text_uthmani, '') AS verse_text
FROM tl LEFT JOIN surah ON tl.surah = id LEFT JOIN ayah a ON a.surah = tl.surah AND a.ayah = tl.ayah""",
)
def enrich_verses(spark, d):
    t = timeline(spark, d).select("take_id", "out_no", "surah", "ayah")
    t = t.join(load(spark, d, "ayah").select("surah", "ayah", "text_uthmani"), ["surah", "ayah"], "left")
    t = t.join(load(spark, d, "surah").select(F.col("id").alias("surah"), "name_simple"), "surah", "left")
    return t.select(
        "take_id", "out_no", rollups.chapter_name(F.col("surah"), F.col("name_simple")).alias("chapter_name"), F.coalesce("text_uthmani", F.lit("")).alias("verse_text")
    )


# --- roll-ups -------------------------------------------------------------------------------------------------------


@R.add("day_index", f"WITH {CAT}, {TAKES}, {RECS} SELECT day, count(*) AS recordings, count(take_id) AS analysed FROM recs WHERE day IS NOT NULL GROUP BY day")
def day_index(spark, d):
    return rollups.day_index(records(spark, d))


_RANK = f"""coalesce({_map({s: i for i, s in enumerate(C.DAY_ORDER)})}[session], 99) * 4 + CASE WHEN is_adhaan THEN 2 ELSE 0 END + CASE WHEN venue = 'madeenah' THEN 1 ELSE 0 END"""


@R.add(
    "day_pages",
    f"""WITH {CAT}, {TAKES}, {RECS} SELECT day, video_id, {_RANK} AS day_rank, row_number() OVER (PARTITION BY day ORDER BY {_RANK}, published_at DESC NULLS LAST, video_id) AS place
FROM recs WHERE day IS NOT NULL""",
)
def day_pages(spark, d):
    return rollups.day_pages(records(spark, d)).select("day", "video_id", "day_rank", F.col("place").cast("long").alias("place"))


@R.add(
    "video_pages",
    f"""WITH {CAT}, {TAKES}, {RECS}, {TL} SELECT video_id, tl.take_id, out_no, CASE WHEN tl.surah IS NULL OR tl.ayah IS NULL THEN 'not identified' ELSE coalesce(name_simple, 'Surah ' || tl.surah) || ' ' || tl.surah || ':' || tl.ayah END AS reference,
  CASE WHEN tl.surah IS NULL OR tl.ayah IS NULL THEN NULL ELSE coalesce(text_uthmani, '') END AS verse_text,
  coalesce(tl.surah IS NOT NULL AND tl.ayah IS NOT NULL AND conf < {rollups.DOUBTFUL}, false) AS doubtful, tl.surah IS NOT NULL AND tl.ayah IS NOT NULL AND coalesce(is_partial, false) AS partial,
  'https://www.youtube.com/watch?v=' || video_id || '&t=' || floor(t0)::BIGINT || 's' AS link
FROM (SELECT video_id, take_id FROM recs WHERE take_id IS NOT NULL) r JOIN (SELECT * EXCLUDE (video_id) FROM tl) tl USING (take_id) LEFT JOIN surah ON surah.id = tl.surah LEFT JOIN ayah a ON a.surah = tl.surah AND a.ayah = tl.ayah""",
)
def video_pages(spark, d):
    p = rollups.video_pages(records(spark, d), timeline(spark, d), load(spark, d, "ayah"), load(spark, d, "surah"))
    return p.select("video_id", "take_id", "out_no", "reference", "verse_text", F.coalesce("doubtful", F.lit(False)).alias("doubtful"), "partial", "link")


@R.add(
    "chapter_pages",
    f"""WITH {CAT}, {TAKES}, {RECS}, {RANGES} SELECT chapter, video_id, range_no::BIGINT AS range_no, from_verse, to_verse, rec_date, venue,
  row_number() OVER (PARTITION BY chapter ORDER BY coalesce(rec_date, '') DESC, video_id, range_no) AS place
FROM ranges JOIN recs USING (take_id)""",
)
def chapter_pages(spark, d):
    p = rollups.chapter_pages(records(spark, d), spans.verse_ranges(timeline(spark, d)))
    return p.select("chapter", "video_id", "range_no", "from_verse", "to_verse", "rec_date", "venue", F.col("place").cast("long").alias("place"))


@R.add(
    "chapter_index",
    f"""WITH {RANGES}, n AS (SELECT chapter, count(*) AS o, count(DISTINCT take_id) AS t FROM ranges GROUP BY chapter)
SELECT id, name_simple, coalesce(o, 0) AS occurrences, coalesce(t, 0) AS takes FROM surah LEFT JOIN n ON chapter = id""",
)
def chapter_index(spark, d):
    return rollups.chapter_index(spans.verse_ranges(timeline(spark, d)), load(spark, d, "surah"))


@R.add(
    "person_pages",
    f"""WITH {CAT} SELECT person_key, row_number() OVER (PARTITION BY person_key ORDER BY coalesce(rec_date, '') DESC, video_id) AS place, video_id, rec_date FROM cat WHERE person_key <> ''""",
)
def person_pages(spark, d):
    p = rollups.person_pages(records(spark, d))
    return p.select("person_key", F.col("place").cast("long").alias("place"), "video_id", "rec_date")


@R.add(
    "person_index",
    f"""WITH {CAT} SELECT person_key, arg_max(person, published_at || video_id) AS person, count(*) AS recordings FROM cat WHERE person_key <> '' GROUP BY person_key""",
)
def person_index(spark, d):
    return rollups.person_index(records(spark, d))


@R.add(
    "home_stats",
    f"""WITH {CAT}, {TAKES}, {RECS}, {RANGES} SELECT count(*) AS recordings, count(take_id) AS analysed, count(DISTINCT day) AS days, (SELECT count(DISTINCT chapter) FROM ranges) AS chapters FROM recs""",
)
def home_stats(spark, d):
    return rollups.home_stats(records(spark, d), spans.verse_ranges(timeline(spark, d)))


@R.add(
    "home_recent_days",
    f"""WITH {CAT}, {TAKES}, {RECS}, {RANGES}, {LABELLED}, days AS (SELECT day, count(*) AS recordings, count(take_id) AS analysed FROM recs WHERE day IS NOT NULL GROUP BY day ORDER BY day DESC LIMIT {rollups.RECENT_DAYS}),
o AS (SELECT day, label, row_number() OVER (PARTITION BY day ORDER BY published_at DESC NULLS LAST, video_id, range_no) AS n FROM recs JOIN labelled USING (take_id) WHERE chapter <> {rollups.OPENER_CHAPTER}),
g AS (SELECT day, label, min(n) AS n FROM o GROUP BY day, label),
f AS (SELECT * FROM g QUALIFY row_number() OVER (PARTITION BY day ORDER BY n) <= {rollups.LABELS}),
l AS (SELECT day, string_agg(label, ' · ' ORDER BY n) AS labels FROM f GROUP BY day)
SELECT day, strftime(try_cast(day AS DATE), '%A %-d %B %Y') AS pretty, recordings, analysed, coalesce(labels, '') AS labels FROM days LEFT JOIN l USING (day)""",
)
def home_recent_days(spark, d):
    return rollups.home_recent_days(records(spark, d), spans.verse_ranges(timeline(spark, d)), load(spark, d, "surah"))


@R.add("range_labels", f"WITH {RANGES}, {LABELLED} SELECT take_id, range_no::BIGINT AS range_no, label FROM labelled")
def range_labels(spark, d):
    return rollups.label_ranges(spans.verse_ranges(timeline(spark, d)), load(spark, d, "surah")).select("take_id", "range_no", "label")


@R.add(
    "recited_lines",
    f"""WITH {CAT}, {TAKES}, {RECS}, {RANGES}, {LABELLED}, said AS (SELECT take_id, string_agg(label, ' · ' ORDER BY range_no) AS said FROM labelled GROUP BY take_id)
SELECT video_id, CASE WHEN take_id IS NULL THEN {_map({k: v.replace(chr(39), chr(39) * 2) for k, v in C.REASON_LABELS.items()})}[reason] WHEN said IS NULL THEN 'No Qur''an detected in the audio.' ELSE said END AS line FROM recs LEFT JOIN said USING (take_id)""",
)
def recited_lines(spark, d):
    return rollups.recited_lines(records(spark, d), spans.verse_ranges(timeline(spark, d)), load(spark, d, "surah")).select("video_id", "line")


# --- runs -----------------------------------------------------------------------------------------------------------

DONE = "done AS (SELECT DISTINCT video_id FROM sync_outcomes WHERE status = 'done')"


@R.add("pending_work", f"WITH {CAT}, {DONE} SELECT video_id FROM cat WHERE {REASON} = 'ok' AND video_id NOT IN (SELECT video_id FROM done WHERE video_id IS NOT NULL)")
def pending_work(spark, d):
    """What a run over the whole queue would still have to do."""
    q = rules.with_decision(catalog(spark, d)).filter("analyze").select("video_id")
    return sync.pending(q, load(spark, d, "sync_outcomes").filter("status = 'done'"))


@R.add(
    "cached_work",
    f"WITH {CAT}, {DONE} SELECT video_id, CASE WHEN video_id IN (SELECT video_id FROM transcripts) THEN 'cache' ELSE 'transcribe' END AS source FROM cat WHERE {REASON} = 'ok' AND video_id NOT IN (SELECT video_id FROM done WHERE video_id IS NOT NULL)",
)
def cached_work(spark, d):
    return sync.with_source(pending_work(spark, d), load(spark, d, "transcripts"))


@R.add(
    "queue_limited",
    f"WITH {CAT}, {DONE}, q AS (SELECT video_id FROM cat WHERE {REASON} = 'ok' ORDER BY published_at DESC NULLS LAST, video_id LIMIT 100) SELECT video_id FROM q WHERE video_id NOT IN (SELECT video_id FROM done WHERE video_id IS NOT NULL)",
)
def queue_limited(spark, d):
    """A run limited to the 100 newest entries: the limit is the feature, and finished entries use it up."""
    q = rules.queue(rules.with_decision(catalog(spark, d)), 100).select("video_id")
    return sync.pending(q, load(spark, d, "sync_outcomes").filter("status = 'done'"))


OUTCOMES = f"""{CAT}, {TAKES}, {TL}, {SEG}, rows_ AS (SELECT takes.video_id, count(t0) AS n, count(surah) AS hit FROM takes JOIN tl USING (take_id) GROUP BY ALL),
have AS (SELECT DISTINCT takes.video_id FROM takes JOIN seg USING (take_id)),
status AS (SELECT video_id, CASE WHEN n > 0 THEN 'done' WHEN h.video_id IS NOT NULL THEN 'empty' ELSE 'missing' END AS status,
  CASE WHEN n > 0 THEN {R3 % "hit / n"} END AS coverage FROM cat LEFT JOIN rows_ USING (video_id) LEFT JOIN have h USING (video_id) WHERE {REASON} = 'ok')"""


def outcomes(spark, d):
    t = takes(spark, d).select("video_id", "take_id")
    rows = timeline(spark, d).drop("video_id").join(t, "take_id").withColumn("error", F.lit(None).cast("string"))
    texts = segments(spark, d).drop("video_id").join(t, "take_id")
    q = rules.with_decision(catalog(spark, d)).filter("analyze")
    return sync.outcomes(q, q.filter("false"), texts, rows)


@R.add("sync_outcomes_now", f"WITH {OUTCOMES} SELECT * FROM status")
def sync_outcomes_now(spark, d):
    return outcomes(spark, d).select("video_id", "status", "coverage")


@R.add(
    "sync_report",
    f"""WITH {OUTCOMES} SELECT count(*) AS attempted, count(*) FILTER (WHERE status = 'done') AS done, 0::BIGINT AS skipped, count(*) FILTER (WHERE status = 'empty') AS empty, 0::BIGINT AS failed,
  count(*) FILTER (WHERE status = 'done' AND coverage < {sync.REVIEW_LIMIT}) AS needs_review FROM status""",
)
def sync_report(spark, d):
    return sync.report(outcomes(spark, d))


@R.add("sync_review", f"WITH {OUTCOMES} SELECT video_id, coverage FROM status WHERE status = 'done' AND coverage < {sync.REVIEW_LIMIT} ORDER BY coverage, video_id LIMIT 10")
def sync_review(spark, d):
    return sync.review_list(outcomes(spark, d)).select("video_id", "coverage")


@R.add("run_outcomes", "SELECT run_no, status, count(DISTINCT video_id) AS videos FROM sync_outcomes GROUP BY ALL")
def run_outcomes(spark, d):
    """Logged outcomes per run; rows logged twice count once."""
    return load(spark, d, "sync_outcomes").groupBy("run_no", "status").agg(F.count_distinct("video_id").alias("videos"))


_SCRATCH: list[str] = []


def scratch(spark: SparkSession) -> str:
    """A folder in the shared one for what a query writes; folders of earlier queries are deleted once there are ten."""
    at = f"{shared_dir(spark)}/query-{uuid.uuid4().hex}"
    _SCRATCH.append(at)
    while len(_SCRATCH) > 10:
        files.delete(spark, _SCRATCH.pop(0))
    if len(_SCRATCH) == 1:
        atexit.register(_clear, spark)
    return at


def _clear(spark: SparkSession) -> None:
    try:
        while _SCRATCH:
            files.delete(spark, _SCRATCH.pop())
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


def as_pattern(path: str) -> str:
    """A path as a pattern that only it matches: a stream takes a plain path for a folder, though a table may be one file."""
    return path.removesuffix("parquet") + "parque[t]"


@R.add("stream_deliveries", "SELECT date_trunc('day', ingested_at)::DATE::VARCHAR AS day, feed, count(*) AS deliveries FROM catalog_entries GROUP BY ALL")
def stream_deliveries(spark, d):
    """Deliveries per day and feed, counted by a stream over the table's files, to its end."""
    at = scratch(spark)
    path = f"{d}/catalog_entries.parquet"
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(as_pattern(path))
    sync_stream.run_to_table(sync_stream.deliveries_per_day(stream), f"{at}/out", f"{at}/checkpoint")
    return spark.read.parquet(f"{at}/out").select(F.to_date("day.start").cast("string").alias("day"), "feed", "deliveries")


@R.add("stream_align")
def stream_align(spark, d):
    """The aligner as a resumable stream over the segment files."""
    at = scratch(spark)
    sync_stream.align_new_files(spark, as_pattern(f"{d}/transcript_segments.parquet"), verse_corpus(spark, d), f"{at}/out", f"{at}/checkpoint")
    return sync_stream.aligned(spark, f"{at}/out")


# --- takes compared -------------------------------------------------------------------------------------------------

METRICS = f"""{TL}, m AS (SELECT take_id, count(*) AS segments, count(*) - count(surah) AS unmatched, avg(conf) FILTER (WHERE surah IS NOT NULL) AS mc FROM tl GROUP BY take_id),
metrics AS (SELECT t.take_id, t.model, coalesce(segments, 0) AS segments, coalesce(unmatched, 0) AS unmatched,
  CASE WHEN segments > 0 THEN (segments - unmatched) / segments ELSE 0.0 END AS coverage, coalesce(mc, 0) AS mean_conf, coalesce(segments, 0) = 0 AS failed FROM transcripts t LEFT JOIN m USING (take_id))"""


@R.add("take_metrics", f"WITH {METRICS} SELECT take_id, segments, unmatched, {R6 % 'coverage'} AS coverage, {R6 % 'mean_conf'} AS mean_conf, failed FROM metrics")
def take_metrics(spark, d):
    m = agreement.take_metrics(timeline(spark, d), load(spark, d, "transcripts"))
    return m.select("take_id", "segments", "unmatched", F.round("coverage", 10).alias("coverage"), F.round("mean_conf", 10).alias("mean_conf"), "failed")


@R.add(
    "model_metrics",
    f"""WITH {METRICS} SELECT model, count(*) FILTER (WHERE NOT failed) AS runs, count(*) FILTER (WHERE failed) AS failed, round(avg(segments) FILTER (WHERE NOT failed), 6) AS avg_segments,
  round(avg(coverage) FILTER (WHERE NOT failed), 6) AS avg_coverage, round(avg(mean_conf) FILTER (WHERE NOT failed), 6) AS avg_conf FROM metrics GROUP BY model""",
)
def model_metrics(spark, d):
    m = agreement.model_metrics(agreement.take_metrics(timeline(spark, d), load(spark, d, "transcripts")))
    return m.select("model", "runs", "failed", *[F.round(c, 6).alias(c) for c in ("avg_segments", "avg_coverage", "avg_conf")])


@R.add("pair_agreement")
def pair_agreement(spark, d):
    return agreement.pair_agreement(timeline(spark, d), load(spark, d, "transcripts"))


@R.add("agreement_verdict")
def agreement_verdict(spark, d):
    return agreement.verdict(pair_agreement(spark, d))


# --- the general problems -------------------------------------------------------------------------------------------


@R.add(
    "p5_found",
    """WITH runs AS (SELECT DISTINCT run_no, cut_at FROM sync_runs WHERE run_no IS NOT NULL AND cut_at IS NOT NULL),
content AS (SELECT r.run_no, d.video_id, title, published_at, duration_seconds FROM runs r JOIN catalog_entries d ON d.ingested_at <= r.cut_at WHERE d.video_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY r.run_no, d.video_id ORDER BY ingested_at DESC, row_id DESC) = 1),
last AS (SELECT c.run_no, c.video_id, max(o.run_no) AS last_run FROM content c LEFT JOIN sync_outcomes o ON o.video_id = c.video_id AND o.status = 'done' AND o.run_no < c.run_no GROUP BY ALL)
SELECT c.run_no, c.video_id FROM content c JOIN last l USING (run_no, video_id) LEFT JOIN content p ON p.run_no = l.last_run AND p.video_id = c.video_id
WHERE l.last_run IS NULL OR c.title IS DISTINCT FROM p.title OR c.published_at IS DISTINCT FROM p.published_at OR c.duration_seconds IS DISTINCT FROM p.duration_seconds""",
)
def p5_found(spark, d):
    return pending_intervals(spark, d).select("run_no", "video_id")


def pending_intervals(spark, d):
    return incremental.pending_by_run(load(spark, d, "catalog_entries"), load(spark, d, "sync_runs"), load(spark, d, "sync_outcomes"))


@R.add(
    "p5_commits",
    """WITH runs AS (SELECT DISTINCT run_no, cut_at FROM sync_runs WHERE run_no IS NOT NULL AND cut_at IS NOT NULL),
content AS (SELECT r.run_no, d.video_id, title, published_at, duration_seconds, count(*) OVER (PARTITION BY r.run_no, d.video_id) AS hi FROM runs r JOIN catalog_entries d ON d.ingested_at <= r.cut_at WHERE d.video_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY r.run_no, d.video_id ORDER BY ingested_at DESC, row_id DESC) = 1),
last AS (SELECT c.run_no, c.video_id, max(o.run_no) AS last_run FROM content c LEFT JOIN sync_outcomes o ON o.video_id = c.video_id AND o.status = 'done' AND o.run_no < c.run_no GROUP BY ALL)
SELECT c.run_no, c.video_id, coalesce(p.hi, 0) + 1 AS lo, c.hi, 1::BIGINT AS from_no FROM content c JOIN last l USING (run_no, video_id) LEFT JOIN content p ON p.run_no = l.last_run AND p.video_id = c.video_id
WHERE l.last_run IS NULL OR c.title IS DISTINCT FROM p.title OR c.published_at IS DISTINCT FROM p.published_at OR c.duration_seconds IS DISTINCT FROM p.duration_seconds""",
)
def p5_commits(spark, d):
    """The gaps of each pending video (lo to hi) and where the interval begins that the run would commit with its output."""
    p = pending_intervals(spark, d).select("run_no", "video_id", F.explode("gaps").alias("g"), F.try_element_at("commits", F.lit(1))["lo"].alias("from_no"))
    return p.select("run_no", "video_id", "g.lo", "g.hi", "from_no")


@R.add(
    "p6_found",
    """WITH ok AS (SELECT DISTINCT take_id, round(t0 * 1000)::BIGINT AS s, round(t1 * 1000)::BIGINT AS e FROM transcript_segments WHERE t1 > t0
  AND regexp_matches(arabic, '[^\\s\\pZ\\p{Cc}\\p{Cf}\\x{115F}\\x{1160}\\x{3164}\\x{FFA0}\\x{2800}\\x{FE00}-\\x{FE0F}]')),
reach AS (SELECT *, max(e) OVER (PARTITION BY take_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS r FROM ok),
runs AS (SELECT *, sum(CASE WHEN r >= s THEN 0 ELSE 1 END) OVER (PARTITION BY take_id ORDER BY s, e) AS n FROM reach),
periods AS (SELECT take_id, n, min(s) AS s, max(e) AS e FROM runs GROUP BY ALL)
SELECT take_id, 'period' AS kind, s AS start_ms, e AS end_ms FROM periods UNION ALL
SELECT take_id, 'gap', lag(e) OVER (PARTITION BY take_id ORDER BY n), s FROM periods QUALIFY lag(e) OVER (PARTITION BY take_id ORDER BY n) IS NOT NULL""",
)
def p6_found(spark, d):
    return dyadic.audible_periods(load(spark, d, "transcript_segments"))
