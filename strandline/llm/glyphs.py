"""Texts that look the same but differ in their characters -> one consistent form.

The consistent form is NFC, with plain Arabic letters and their marks, ASCII and
é, U+0020 as the only space, and nothing invisible.

A mapping is derived from rules (compatibility forms, widths, spaces, invisible
characters) over all of Unicode and a short list of look-alikes, and checked for
conflicts.  To it come sequences: every base with a mark that composes with it,
also where the base is a look-alike, bases with two marks of which one composes,
and marks in another than their canonical order, each with its composed result.
All keys are compiled into a trie.  A transducer goes over a text once, grapheme
cluster by grapheme cluster (a base and what combines with it), and takes the
longest key at each place; invisible characters inside a key don't end it.
"""

from __future__ import annotations

import functools
import itertools
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other alphabets that look like ASCII letters.
LATIN_LOOKALIKES = {
    "а": "a", "в": "b", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d",
    "ԛ": "q", "ԝ": "w", "ѵ": "v", "ո": "n", "ս": "u", "ց": "g", "ɡ": "g", "ı": "i", "ɩ": "i", "к": "k", "м": "m", "т": "t", "н": "h",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "У": "Y", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "χ": "x", "γ": "y", "τ": "t",
    "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K", "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X",
}

# Arabic letters outside U+0621..U+064A that look like one inside.
ARABIC_LOOKALIKES = {
    "ک": "ك", "ڪ": "ك", "ہ": "ه", "ھ": "ه", "ە": "ه", "ۃ": "ة", "ے": "ي", "ێ": "ي", "ې": "ي", "ٱ": "ا", "ٲ": "أ", "ٳ": "إ", "ٵ": "أ",
    "ٶ": "ؤ", "ٷ": "ؤ", "ٸ": "ئ", "ۆ": "و", "ۇ": "و", "ۈ": "و", "ۋ": "و", "ٮ": "ب", "ٯ": "ق", "ں": "ن", "ڻ": "ن", "گ": "ك",
}

# Punctuation that looks like ASCII punctuation, beyond the compatibility forms.
PUNCTUATION = {
    "‘": "'", "’": "'", "ʼ": "'", "ʻ": "'", "‛": "'", "“": '"', "”": '"', "‐": "-", "‑": "-", "‒": "-", "–": "-", "—": "-", "−": "-",
    "٪": "%", "٫": ".", "٬": ",", "۔": ".", "،": ",", "؛": ";", "؟": "?", "⁄": "/", "∕": "/", "∗": "*", "…": "...",
}

#: Farsi yeh looks like yeh where it is joined to a next letter, and like alef maksura elsewhere.
FARSI_YEH, YEH, MAKSURA = "\u06CC", "\u064A", "\u0649"

#: Where characters with a category or decomposition of their own are: the planes between hold ideographs only, or nothing.
ASSIGNED = (*range(0x7F, 0x30000), *range(0xE0000, 0xE1000))

ALLOWED = r"\x20-\x7E\u00E9\u0621-\u063A\u0640-\u0655\u0670"
#: Marks that stay: vowel signs, shadda, sukun, maddah, hamza above and below, superscript alef.
MARKS = r"\u064B-\u0655\u0670"


def _is_invisible(ch: str) -> bool:
    return (
        unicodedata.category(ch) in ("Cf", "Cc") and ch not in "\t\n\r\x0b\x0c\x85"
    ) or ch in "\u034F\u115F\u1160\u17B4\u17B5\u3164\uFFA0" or 0xFE00 <= ord(ch) <= 0xFE0F or 0xE0000 <= ord(ch) <= 0xE01EF


@functools.cache
def compile_table() -> dict[str, str]:
    """Single characters -> their consistent form ('' where they vanish), checked.

    A conflict (two rules that disagree, a result that isn't stable, or one that
    isn't in the consistent form) raises: a table with one would make the form
    depend on the order of rules.
    """
    table: dict[str, str] = {}

    def put(ch: str, to: str, rule: str) -> None:
        if table.setdefault(ch, to) != to:
            raise ValueError(f"U+{ord(ch):04X}: {table[ch]!r} and {to!r} ({rule})")

    for at in (*range(0x20), *ASSIGNED):
        ch = chr(at)
        kind = unicodedata.category(ch)
        if kind in ("Zs", "Zl", "Zp") or ch in "\t\n\r\x0b\x0c\x85":
            put(ch, " ", "spaces")
        elif _is_invisible(ch):
            put(ch, "", "invisible")
        elif kind == "Nd" and at > 0x7F and not 0xFF00 <= at:
            put(ch, str(unicodedata.digit(ch)), "digits")
    for ch, to in (*LATIN_LOOKALIKES.items(), *ARABIC_LOOKALIKES.items(), *PUNCTUATION.items()):
        put(ch, to, "look-alikes")
    for at in ASSIGNED:
        ch = chr(at)
        if ch in table or not unicodedata.decomposition(ch).startswith("<"):
            continue
        # a mark's isolated form decomposes to a space (or tatweel) with it: the mark is meant
        to = unicodedata.normalize("NFKC", ch)
        if len(to) > 1 and to[0] in " ـ" and all(unicodedata.combining(x) for x in to[1:]):
            to = to[1:]
        put(ch, unicodedata.normalize("NFC", "".join(table.get(x, x) for x in to)), "compatibility forms")
    for ch, to in table.items():
        again = "".join(table.get(x, x) for x in to)
        if unicodedata.normalize("NFC", again) != to:
            raise ValueError(f"U+{ord(ch):04X}: {to!r} isn't stable")
    return table


@functools.cache
def compile_keys() -> dict[str, str]:
    """All keys of the transducer: single characters and sequences -> their consistent form; a conflict raises."""
    keys = dict(compile_table())
    alike: dict[str, list[str]] = {}
    for ch, to in keys.items():
        alike.setdefault(to, []).append(ch)

    def put(key: str) -> None:
        to = unicodedata.normalize("NFC", "".join(keys.get(x, x) for x in key))
        to = "".join(keys.get(x, x) for x in to)
        if keys.setdefault(key, to) != to:
            raise ValueError(f"{key!r}: {keys[key]!r} and {to!r}")

    marks = [chr(i) for i in (*range(0x064B, 0x0656), 0x0670)]
    bases = set()
    for at in ASSIGNED:
        ch = chr(at)
        parts = unicodedata.decomposition(ch)
        if not parts or parts.startswith("<"):
            continue
        pair = unicodedata.normalize("NFD", ch)
        if len(pair) == 2 and unicodedata.normalize("NFC", pair) == ch and unicodedata.combining(pair[1]):
            for base in (pair[0], *(x for x in alike.get(pair[0], ()) if len(x) == 1)):
                put(base + pair[1])
                if pair[1] in marks:
                    bases.add(base)
    for a, b in itertools.permutations(marks, 2):
        if unicodedata.normalize("NFC", a + b) != a + b:
            put(a + b)
        for base in bases:
            put(base + a + b)
    for three in itertools.permutations(marks, 3):
        if unicodedata.normalize("NFC", "".join(three)) != "".join(three):
            put("".join(three))
    return keys


class Transducer:
    """One pass over a text; clusters seen before are looked up whole."""

    MOST = 100_000  # clusters remembered

    def __init__(self) -> None:
        self.table = compile_table()
        self.trie: dict = {}
        for key, to in compile_keys().items():
            node = self.trie
            for c in key:
                node = node.setdefault(c, {})
            node[""] = to
        gone = "".join(re.escape(c) for c, to in self.table.items() if to == "")
        mark = r"\u0300-\u036F\u0610-\u061A\u064B-\u065F\u0670\u06D6-\u06DC\u06DF-\u06E4\u06E7\u06E8\u06EA-\u06ED\u08D3-\u08FF\u20D0-\u20FF\uFE20-\uFE2F"
        # a base with all that combines with it; Farsi yeh also looks at the letter after it
        self.cluster = re.compile(f"[\\s\\S][{mark}{gone}]*")
        self.plain = re.compile(r"[\x20-\x7E\u00E9\u0621-\u063A\u0640-\u064A]*")
        self.letter = re.compile(r"[\u0620-\u064A\u066E-\u06D3\uFB50-\uFDFF\uFE80-\uFEFC]")
        self.known: dict[str, str] = {}

    def _run(self, cluster: str) -> str:
        """The transducer over one cluster: the longest key at each place; what is in no key stays."""
        out, i, n, vanish = [], 0, len(cluster), self.table
        while i < n:
            node, j, best, end = self.trie, i, None, i + 1
            while j < n:
                c = cluster[j]
                if j > i and c not in node and vanish.get(c) == "":
                    j += 1  # invisible: the key goes on behind it
                    continue
                node = node.get(c)
                if node is None:
                    break
                j += 1
                if "" in node:
                    best, end = node[""], j
            if best is None:
                best = cluster[i]
            out.append(best)
            i = end
        done = "".join(out)
        # more marks on a base than any key has
        return done if unicodedata.is_normalized("NFC", done) else unicodedata.normalize("NFC", done)

    def form(self, text: str) -> str:
        """The consistent form.  Characters without a known look-alike inside it stay, composed."""
        if self.plain.fullmatch(text):
            return text
        out = []
        known = self.known
        for m in self.cluster.finditer(text):
            c = m[0]
            if c[0] == FARSI_YEH:
                joined = "\u200D" in c or self.letter.match(text, m.end())
                c = (YEH if joined else MAKSURA) + c[1:]
            to = known.get(c)
            if to is None:
                to = self._run(c)
                if len(known) < self.MOST:
                    known[c] = to
            out.append(to)
        # clusters can only meet in a composition where a mark came without its base
        return unicodedata.normalize("NFC", "".join(out))


@functools.cache
def _transducer() -> Transducer:
    return Transducer()


@F.pandas_udf(T.StringType())
def consistent(texts: pd.Series) -> pd.Series:
    """The consistent form of each text; null stays null, empty stays empty.

    No JVM expression composes characters, so this is an Arrow function; filter
    with :data:`SUSPICIOUS` first where only texts that may change are wanted.
    """
    t = _transducer()
    return pd.Series([None if x is None else t.form(x) for x in texts], dtype=object)


#: Holds for every text that isn't in the consistent form, and for some that are: characters outside it, marks that may
#: combine with their base, marks in a row.
SUSPICIOUS = rf"[^{ALLOWED}]|[\u0653-\u0655]|[{MARKS}]{{2}}"


def add_consistent(df: DataFrame, column: str, into: str) -> DataFrame:
    """Add the consistent form of a text column; null stays null."""
    return df.withColumn(into, consistent(F.col(column)))


def inconsistent(df: DataFrame, key: str, column: str) -> DataFrame:
    """Keys (as text, each once) of the records whose text changes in the transducer; null and empty texts are none."""
    d = df.select(F.col(key).cast("string").alias("rec_key"), F.col(column).alias("t")).filter(F.col("t").rlike(SUSPICIOUS))

    def changed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        form = _transducer().form
        for b in batches:
            yield b.loc[[form(x) != x for x in b["t"]], ["rec_key"]]

    # equal texts are common, so the texts themselves don't travel: the transducer runs where they were read
    return d.mapInPandas(changed, "rec_key string").distinct()
