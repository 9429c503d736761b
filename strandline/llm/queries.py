"""The queries of this package over the tables of a folder, with SQL where SQL can give the same rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from strandline.plans.registry import Registry
from strandline.tables import load

from strandline.llm import canon, glyphs, mixing, names, packing, pieces, runs, subjects  # isort: skip

R = Registry()

_OUTSIDE = "[^\\x20-\\x7E\\x{00E9}\\x{0621}-\\x{063A}\\x{0640}-\\x{0655}\\x{0670}]"


@R.add(
    "p2_found",
    f"""SELECT DISTINCT 'arabic' AS field, seg_id::VARCHAR AS rec_key FROM transcript_segments WHERE regexp_matches(arabic, '{_OUTSIDE}') OR nfc_normalize(arabic) <> arabic
UNION ALL SELECT DISTINCT 'text_uthmani', surah || ':' || ayah FROM ayah WHERE regexp_matches(text_uthmani, '{_OUTSIDE}') OR nfc_normalize(text_uthmani) <> text_uthmani""",
)
def p2_found(spark, d):
    a = glyphs.inconsistent(load(spark, d, "transcript_segments"), "seg_id", "arabic").select(F.lit("arabic").alias("field"), "rec_key")
    v = load(spark, d, "ayah").select(F.concat_ws(":", F.col("surah").cast("string"), F.col("ayah").cast("string")).alias("k"), "text_uthmani")
    return a.unionByName(glyphs.inconsistent(v, "k", "text_uthmani").select(F.lit("text_uthmani").alias("field"), "rec_key"))


@R.add("p3_found")
def p3_found(spark, d):
    return canon.map_values(load(spark, d, "catalog_entries"), load(spark, d, "canon_terms"))


@R.add("p1_found")
def p1_found(spark, d):
    return names.linked_pairs(p1_persons(spark, d))


@R.add("p1_persons")
def p1_persons(spark, d):
    """Each spelling with the smallest spelling of its person."""
    return names.resolve(load(spark, d, "catalog_entries"), "sheikh_key", "sheikh")


@R.add(
    "p4_found",
    """WITH t AS (SELECT * FROM timeline_segments QUALIFY row_number() OVER (PARTITION BY take_id, out_no ORDER BY loaded_at DESC NULLS LAST, t0, t1, surah, ayah, conf) = 1),
l AS (SELECT *, lag(surah) OVER w AS ps, lag(ayah) OVER w AS pa, lag(t1) OVER w AS pt FROM t WINDOW w AS (PARTITION BY take_id ORDER BY t0 NULLS LAST, out_no)),
r AS (SELECT *, sum(CASE WHEN ps = surah AND pa = ayah AND t0 - pt < 1.0 THEN 0 ELSE 1 END) OVER (PARTITION BY take_id ORDER BY t0 NULLS LAST, out_no) AS run FROM l)
SELECT take_id, first(out_no ORDER BY t0 NULLS LAST, out_no) AS first_no, last(out_no ORDER BY t0 NULLS LAST, out_no) AS last_no FROM r GROUP BY take_id, run HAVING count(*) > 1""",
)
def p4_found(spark, d):
    return runs.timeline_runs(load(spark, d, "timeline_segments")).select("take_id", "first_no", "last_no")


@R.add(
    "p4_runs",
    """WITH t AS (SELECT * FROM timeline_segments QUALIFY row_number() OVER (PARTITION BY take_id, out_no ORDER BY loaded_at DESC NULLS LAST, t0, t1, surah, ayah, conf) = 1),
l AS (SELECT *, lag(surah) OVER w AS ps, lag(ayah) OVER w AS pa, lag(t1) OVER w AS pt FROM t WINDOW w AS (PARTITION BY take_id ORDER BY t0 NULLS LAST, out_no)),
r AS (SELECT *, sum(CASE WHEN ps = surah AND pa = ayah AND t0 - pt < 1.0 THEN 0 ELSE 1 END) OVER (PARTITION BY take_id ORDER BY t0 NULLS LAST, out_no) AS run FROM l)
SELECT take_id, first(out_no ORDER BY t0 NULLS LAST, out_no) AS first_no, count(*) AS n_rows, round(last(t1 ORDER BY t0 NULLS LAST, out_no) - first(t0 ORDER BY t0 NULLS LAST, out_no), 6) AS duration,
  CASE WHEN bool_and(ayah IS NOT NULL) THEN any_value(surah) END AS surah, CASE WHEN bool_and(surah IS NOT NULL) THEN any_value(ayah) END AS ayah FROM r GROUP BY take_id, run""",
)
def p4_runs(spark, d):
    """The whole timeline collapsed: one event per run, single rows included, with count and duration."""
    r = runs.timeline_runs(load(spark, d, "timeline_segments"), 1)
    return r.select("take_id", "first_no", F.col("rows").alias("n_rows"), F.round("duration", 6).alias("duration"), "surah", "ayah")


@R.add(
    "p7_found",
    """WITH RECURSIVE v AS (SELECT video_id, ceil(duration_seconds)::INT AS dur FROM (SELECT * FROM catalog_entries WHERE video_id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY video_id ORDER BY ingested_at DESC NULLS LAST, row_id DESC) = 1) WHERE duration_seconds > 600),
p AS (SELECT video_id, list(DISTINCT at_s) AS pts FROM pause_points WHERE at_s IS NOT NULL GROUP BY video_id),
c AS (
  SELECT video_id, dur, coalesce(pts, []) AS pts, 1 AS piece_no, 0 AS start_s, coalesce(list_max(list_filter(coalesce(pts, []), lambda x: x > 20 AND x <= 600)), 600)::INT AS end_s FROM v LEFT JOIN p USING (video_id)
  UNION ALL
  SELECT video_id, dur, pts, piece_no + 1, s, CASE WHEN dur - s > 600 THEN coalesce(list_max(list_filter(pts, lambda x: x > s + 20 AND x <= s + 600)), s + 600) ELSE dur END::INT
  FROM (SELECT *, end_s - 20 AS s FROM c WHERE dur - start_s > 600))
SELECT video_id, piece_no, start_s, end_s FROM c""",
)
def p7_found(spark, d):
    return pieces.catalog_pieces(load(spark, d, "catalog_entries"), load(spark, d, "pause_points"))


@R.add("p8_containers")
def p8_containers(spark, d):
    """All documents in containers of the middle size, larger ones in the larger size; loss-bearing tokens limited too."""
    return packing.fill_containers(load(spark, d, "documents"), load(spark, d, "container_sizes"), max_loss_share=packing.LOSS_SHARE)


@R.add("p8_fill")
def p8_fill(spark, d):
    return packing.fill_report(p8_containers(spark, d))


@R.add("p9_selection")
def p9_selection(spark, d):
    """The mix: each use of a document, shuffled."""
    return mixing.mix(load(spark, d, "documents"), load(spark, d, "mix_targets"))[0]


@R.add("p9_shares")
def p9_shares(spark, d):
    return mixing.mix(load(spark, d, "documents"), load(spark, d, "mix_targets"))[1]


def _subjects(spark, d):
    docs = load(spark, d, "documents")
    features = subjects.featurise(docs)
    return docs, subjects.assign(features, subjects.train(features, load(spark, d, "subject_labels"), load(spark, d, "subjects")))


@R.add("p10_found")
def p10_found(spark, d):
    return _subjects(spark, d)[1].select("doc_id", "subject").distinct()


@R.add("p10_composition")
def p10_composition(spark, d):
    docs, found = _subjects(spark, d)
    return subjects.composition(found, docs)
