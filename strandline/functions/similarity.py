"""Word sequences: edit distance, similarity, composite score, longest common subsequence.

``levenshtein`` counts characters, so each pair of word arrays is first spelled
in an alphabet of its own: word number k of the pair becomes character k.  Then
one native call counts words.  No vocabulary table has to be joined.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters words are spelled in: from U+4E00 up to the surrogates.  A pair with more distinct words (34,559) is refused.
_FIRST, _MOST = 0x4E00, 0xD7FF - 0x4E00


def spell(places: Column) -> Column:
    """Numbers of words as one character each."""
    place = lambda i: F.when(i <= _MOST, F.hex(i + _FIRST)).otherwise(F.raise_error(F.lit(f"more than {_MOST} distinct words in a text")).cast("string"))
    return F.decode(F.unhex(F.array_join(F.transform(places, place), "")), "UTF-16BE")


def _spell(ws: Column, vocabulary: Column) -> Column:
    """Each word by its place in ``vocabulary``, as one character; place 0 for words it lacks."""
    return spell(F.transform(ws, lambda w: F.array_position(vocabulary, w)))


def word_distance(a: Column, b: Column) -> Column:
    """Levenshtein distance in words of two arrays (null words must be filtered before)."""
    v = F.array_distinct(b)
    # words of ``a`` that ``b`` lacks equal nothing: all of them become character 0 of the alphabet
    return F.levenshtein(_spell(a, v), _spell(b, v))


def sequence_similarity(a: Column, b: Column) -> Column:
    """1 - distance / longer length; 1 where both are empty."""
    longest = F.greatest(F.size(a), F.size(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - word_distance(a, b) / longest)


def overlap(prefix: Column, verse: Column) -> Column:
    """How many words of the prefix the verse has; words repeated in the prefix count each time."""
    return F.size(F.filter(prefix, lambda w: F.array_contains(verse, w)))


def score(query: Column, verse: Column) -> Column:
    """Struct of ``score`` and ``coverage`` of a verse against the leading words of a query; zeros where either is empty."""
    length, n = F.size(verse), F.size(query)
    prefix = F.slice(query, 1, F.greatest(F.least(n, length + 1), F.lit(1)))
    hit = overlap(prefix, verse)
    total = 0.55 * sequence_similarity(prefix, verse) + 0.25 * (hit / length) + 0.2 * (hit / F.size(prefix))
    empty = (length == 0) | (n == 0)
    return F.struct(
        F.when(empty, F.lit(0.0)).otherwise(total).alias("score"),
        F.when(empty, F.lit(0.0)).otherwise(hit / length).alias("coverage"),
    )


def best_prefix_length(query: Column, verse: Column) -> Column:
    """How many leading words of the query belong to the verse.

    The most similar of the lengths from half to one and a half times the verse;
    ties go to the longer; a tail of up to two words is taken along.
    """
    length, n = F.size(verse), F.size(query)
    low = F.greatest(F.lit(1), F.floor(length / 2).cast("int"))
    high = F.least(n, (F.ceil(length * 1.5) + 1).cast("int"))
    tried = F.transform(
        F.sequence(low, F.greatest(low, high)),
        lambda k: F.struct(sequence_similarity(F.slice(query, 1, k), verse).alias("s"), k.alias("k")),
    )
    best = F.when(low > high, F.least(n, length)).otherwise(F.array_max(tried)["k"])
    return F.when(n - best <= 2, n).otherwise(best)


def lcs_length(a: list, b: list) -> int:
    """Length of the longest common subsequence, one word operation of a long integer per element (bit-parallel)."""
    if not len(a) or not len(b):
        return 0
    where: dict = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for x in b:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(a) - v.bit_count()


@F.pandas_udf(T.DoubleType())
def lcs_agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    """LCS over the longer length; 1 where both are empty or null, 0 where one is.

    Spark has no such expression (Levenshtein allows substitutions), so this one is an Arrow function.
    """

    def one(x, y):
        n, m = (0 if x is None else len(x)), (0 if y is None else len(y))
        return 1.0 if n == m == 0 else lcs_length(x, y) / max(n, m) if n and m else 0.0

    return pd.Series([one(x, y) for x, y in zip(a, b)], dtype=np.float64)
