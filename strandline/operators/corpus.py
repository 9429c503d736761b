"""The ordered corpus, its inverted index with IDF weights, and candidate verses for a text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strandline.functions.similarity import best_prefix_length, spell
from strandline.functions.text import skeleton, words
from strandline.session import small_enough, width

#: Words in more than one verse of so many discriminate nothing.
COMMON = 5
CANDIDATES = 60
#: Up to so many verses the index is sent to all tasks.
MAX_VERSES = 200_000
MIN_CONFIDENCE = 0.62


def build_corpus(verses: DataFrame) -> DataFrame:
    """(surah, ayah, text_uthmani) -> pos, surah, ayah, text, norm, words, n_words.

    ``pos`` counts from 0 over the whole corpus, in (surah, ayah) order.  It needs
    one global order; the corpus is a fixed text, so this window stays small.
    Write the result once and reuse it.
    """
    pos = F.row_number().over(W.orderBy("surah", "ayah")) - 1
    d = verses.select(pos.alias("pos"), "surah", "ayah", F.col("text_uthmani").alias("text"))
    d = d.withColumn("norm", skeleton(F.col("text")))
    d = d.withColumn("words", words(F.col("norm")))
    return d.withColumn("n_words", F.size("words"))


def postings(corpus: DataFrame) -> DataFrame:
    """word, pos: each word of each verse once."""
    return corpus.select(F.explode(F.array_distinct("words")).alias("word"), "pos")


def idf_table(corpus: DataFrame) -> DataFrame:
    """word, df, idf = ln(verses / df), unsmoothed."""
    df = postings(corpus).groupBy("word").agg(F.count("*").alias("df"))
    # the number of verses travels as a column of the frequency rows, so that no join is needed
    total = corpus.agg(F.count("*").alias("n"))
    n = F.broadcast(total.withColumn("__one", F.lit(1)))
    return (
        df.withColumn("__one", F.lit(1)).join(n, "__one").select("word", "df", F.log(F.col("n") / F.col("df")).alias("idf"), "n")
    )


def texts_of(segments: DataFrame, text: str) -> DataFrame:
    """Distinct comparison texts (norm, words): equal texts are looked up once, however often they occur."""
    d = segments.select(skeleton(F.col(text)).alias("norm")).filter("norm <> ''").distinct()
    return d.withColumn("words", words(F.col("norm")))


def _keyed(texts: DataFrame) -> DataFrame:
    """Texts with a key of two hashes (128 bits), partitioned by it: what follows groups by numbers, not by long texts."""
    d = texts.select(F.xxhash64("norm").alias("h1"), F.xxhash64("norm", F.lit(1)).alias("h2"), "norm", "words")
    return d.repartition(width(d), "h1", "h2")


def candidates(texts: DataFrame, corpus: DataFrame, limit: int = CANDIDATES) -> DataFrame:
    """The ``limit`` verses of each text with the largest sum of IDF over shared words: h1, h2, norm, words, pos, idf_sum, rank.

    Words of more than a fifth of the verses don't count, which also keeps the
    join free of hot words.  Sums are compared to 9 digits, ties by ``pos``.
    The texts are partitioned once; the index is sent to them if the corpus has
    at most ``MAX_VERSES`` verses (else it is joined by shuffling).
    """
    weights = idf_table(corpus).filter(F.col("df") <= F.col("n") / COMMON).select("word", "idf")
    index = postings(corpus).join(weights, "word").withColumn("pos", F.col("pos").cast("int"))
    if small_enough(corpus, MAX_VERSES):
        index = F.broadcast(index)
    keyed = _keyed(texts)
    asked = keyed.select("h1", "h2", F.explode(F.array_distinct("words")).alias("word"))
    hits = asked.join(index, "word").groupBy("h1", "h2", "pos").agg(F.round(F.sum("idf"), 9).alias("idf_sum"))
    w = W.partitionBy("h1", "h2").orderBy(F.col("idf_sum").desc(), "pos")
    top = hits.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= limit)
    return top.join(keyed, ["h1", "h2"])


def _prepared(found: DataFrame, corpus: DataFrame) -> DataFrame:
    """Candidates with what their score is made of, except the distance; each part is a column, so none is computed twice."""
    verse = corpus.select("pos", "surah", "ayah", F.col("words").alias("verse"), F.array_distinct("words").alias("vocabulary"))
    if small_enough(corpus, MAX_VERSES):
        verse = F.broadcast(verse)
    d = found.join(verse, "pos")
    d = d.withColumn("prefix", F.slice("words", 1, F.least(F.size("words"), F.size("verse") + 1)))
    d = d.withColumn("at", F.transform("prefix", lambda w: F.array_position("vocabulary", w)))
    d = d.withColumn("hit", F.size(F.filter("at", lambda i: i > 0)))
    n, length = F.size("prefix"), F.size("verse")
    d = d.withColumns({"n": n, "l": length, "longest": F.greatest(n, length)})
    return d.withColumn("bag", 0.25 * (F.col("hit") / F.col("l")) + 0.2 * (F.col("hit") / F.col("n")))


def _scored(prepared: DataFrame) -> DataFrame:
    d = prepared.withColumn("at_verse", F.transform("verse", lambda w: F.array_position("vocabulary", w)))
    d = d.withColumn("distance", F.levenshtein(spell(F.col("at")), spell(F.col("at_verse"))))
    total = 0.55 * (1 - F.col("distance") / F.col("longest")) + 0.25 * (F.col("hit") / F.col("l")) + 0.2 * (F.col("hit") / F.col("n"))
    return d.select(
        "h1", "h2", "norm", "pos", "surah", "ayah", "rank", "words", "verse", total.alias("score"), (F.col("hit") / F.col("l")).alias("coverage")
    )


def score_candidates(found: DataFrame, corpus: DataFrame) -> DataFrame:
    """Candidates with surah, ayah, ``score`` and ``coverage``: the formula of :func:`strandline.functions.similarity.score`."""
    return _scored(_prepared(found, corpus))


def neighbours(matched: DataFrame, corpus: DataFrame, reach: int = 3) -> DataFrame:
    """(surah, ayah) -> near: the positions from the verse's own to ``reach`` after it, as far as the corpus goes.

    A band join written as equality: each verse names its few neighbours.
    """
    d = matched.join(corpus.select("surah", "ayah", "pos"), ["surah", "ayah"])
    d = d.withColumn("near", F.explode(F.sequence(F.col("pos"), F.col("pos") + reach)))
    return d.join(corpus.select(F.col("pos").alias("near")), "near", "left_semi")


def match_texts(segments: DataFrame, text: str, corpus: DataFrame, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """The best verse of each distinct text by itself: norm, pos, surah, ayah, conf, coverage, consumed.

    A text whose best score is under ``min_confidence`` keeps its row with a null
    claim, and so does a text without candidates (conf 0).
    """
    texts = texts_of(segments, text)
    p = _prepared(candidates(texts, corpus), corpus)
    # A score lies between the part for shared words alone and that with the smallest distance these words allow.  What
    # can't reach the surest candidate needs no edit distance.
    most = F.col("bag") + 0.55 * F.least("hit", "l") / F.col("longest")
    sure = F.max("bag").over(W.partitionBy("h1", "h2"))
    scored = _scored(p.withColumn("sure", sure).filter(most >= F.col("sure") - 1e-9))
    w = W.partitionBy("h1", "h2").orderBy(F.round("score", 9).desc(), "pos")
    best = scored.withColumn("__r", F.row_number().over(w)).filter("__r = 1")
    best = best.withColumn("ok", F.col("score") >= min_confidence)
    # the costly extent is computed for winners only
    best = best.select(
        "norm",
        *[F.when(F.col("ok"), F.col(c)).alias(c) for c in ("pos", "surah", "ayah", "coverage")],
        F.col("score").alias("conf"),
        F.when(F.col("ok"), best_prefix_length(F.col("words"), F.col("verse"))).alias("consumed"),
    )
    return texts.select("norm").join(best, "norm", "left").withColumn("conf", F.coalesce("conf", F.lit(0.0)))
