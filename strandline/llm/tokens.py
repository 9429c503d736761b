"""Sizes of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranks of a public byte-level BPE vocabulary, on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: the pattern that parts a text before the merges of that vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(4)
def encoding(vocabulary: str = VOCABULARY):
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def count(text: str | None, vocabulary: str = VOCABULARY) -> int:
    return len(encoding(vocabulary).encode_ordinary(text)) if text else 0


def with_sizes(df: DataFrame, text: str | Column, vocabulary: str = VOCABULARY) -> DataFrame:
    """Add ``tokens`` and ``prompt_tokens`` of whole texts, and drop the text; 0 for null and empty ones.

    The prompt is the first line of a text of several lines; a text of one line
    has none.  What follows bears the loss.
    """
    keep = [c for c in df.columns if c != text]

    def run(batches):
        for b in batches:
            out = b[keep].copy()
            texts = b[text].tolist()
            out["tokens"] = [count(t, vocabulary) for t in texts]
            out["prompt_tokens"] = [count(t.partition("\n")[0], vocabulary) if t and "\n" in t else 0 for t in texts]
            yield out

    kinds = dict(df.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "tokens int", "prompt_tokens int"])
    return df.mapInPandas(run, schema).withColumn("prompt_tokens", F.least("prompt_tokens", "tokens"))


def frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    return pd.DataFrame.from_records(rows, columns=names)
