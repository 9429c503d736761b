"""Text: the comparison skeleton, the folded key, entities, whitespace.

Null in, null out, unless a docstring says otherwise; empty and very long texts
need no care, since each function is one pass of JVM expressions.
"""

from __future__ import annotations

import functools
import re
import sys
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from strandline import constants as C

#: Whitespace as scripts of the web count it (with NBSP and U+FEFF), as a class for Java's regex.
SPACE = "[\\t\\n\\u000B\\f\\r \\u00A0\\u1680\\u2000-\\u200A\\u2028\\u2029\\u202F\\u205F\\u3000\\uFEFF]"


def strip(c: Column) -> Column:
    """Trim all Unicode whitespace (``trim`` takes off U+0020 only)."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def squeeze(c: Column) -> Column:
    """Runs of whitespace become one space; trimmed."""
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def skeleton(c: Column) -> Column:
    """The lossy comparison form of an Arabic text: bare consonants and single spaces.

    Null gives the empty string.  Composition has to be done for one sequence only
    (yeh barree with hamza above); all others end in the same skeleton anyway.
    """
    c = F.replace(F.coalesce(c, F.lit("")), F.lit("\u06D2\u0654"), F.lit(" "))
    c = F.regexp_replace(c, f"[{C.SKELETON_MARKS}]", "")
    c = F.translate(c, "".join(C.SKELETON_TO) + C.SKELETON_DROP, "".join(C.SKELETON_TO.values()))
    c = F.regexp_replace(c, "[^\\u0621-\\u064A]+", " ")
    return F.trim(c)


def is_boilerplate(c: Column) -> Column:
    """Whether a text is nothing but the opening formula; false for null."""
    return skeleton(c) == skeleton(F.lit(C.BOILERPLATE))


def words(skeleton_text: Column) -> Column:
    """The words of a skeleton; an empty array where there are none."""
    return F.filter(F.split(skeleton_text, " "), lambda w: w != "")


def py_skeleton(text: str | None) -> str:
    """:func:`skeleton` in Python, for the fold that owns its state and for tests."""
    text = unicodedata.normalize("NFC", text or "")
    text = re.sub(f"[{C.SKELETON_MARKS}]", "", text)
    text = text.translate(_PY_SKELETON)
    return re.sub("[^ء-ي]+", " ", text).strip(" ")


_PY_SKELETON = str.maketrans(C.SKELETON_TO | dict.fromkeys(C.SKELETON_DROP, ""))


@functools.cache
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """From the compatibility decompositions: characters that leave one ASCII letter or digit; those that leave several."""
    one, several = {}, {}
    for i in range(128, sys.maxunicode + 1):
        d = unicodedata.decomposition(ch := chr(i))
        if not d:
            continue
        rest = "".join(x for x in unicodedata.normalize("NFKD", ch) if x.isascii() and x.isalnum())
        if len(rest) == 1:
            one[ch] = rest
        elif rest:
            several[ch] = rest
    return "".join(one), "".join(one.values()), several


def plain_letters(c: Column) -> Column:
    """Lower case, with letters and digits decomposed to ASCII where they can be; everything else stays in its place."""
    src, dst, several = _fold_tables()
    long = "[" + "".join(several) + "]"
    table = F.create_map(*[F.lit(x) for kv in several.items() for x in kv])
    spelled = F.array_join(F.transform(F.split(c, ""), lambda x: F.coalesce(F.try_element_at(table, x), x)), "")
    one = F.when(c.rlike(long), spelled).otherwise(c)
    return F.lower(F.when(c.rlike("[^\\x00-\\x7F]"), F.translate(one, src, dst)).otherwise(c))


def fold(c: Column) -> Column:
    """The key form: compatibility-decomposed, without accents, lower case, ``[a-z0-9]`` only."""
    return F.regexp_replace(plain_letters(c), "[^a-z0-9]", "")


def py_fold(text: str) -> str:
    """:func:`fold` in Python."""
    text = "".join(ch for ch in unicodedata.normalize("NFKD", text) if not 0x300 <= ord(ch) <= 0x36F)
    return re.sub("[^a-z0-9]", "", text.lower())


def decode_entities(c: Column) -> Column:
    """The named entities lt, gt, quot, #39 and decimal references; amp last, so that ``&amp;lt;`` gives ``&lt;``."""
    for name, ch in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")):
        c = F.replace(c, F.lit(name), F.lit(ch))
    hit = "&#([0-9]{1,7});"
    # parts between the references, each followed by its character
    refs = F.regexp_extract_all(c, F.lit(hit), F.lit(1))
    parts = F.split(c, hit, -1)
    joined = F.array_join(
        F.transform(
            parts,
            lambda p, i: F.concat(p, F.when(i < F.size(refs), _from_code(F.try_element_at(refs, i + 1))).otherwise("")),
        ),
        "",
    )
    c = F.when(c.rlike(hit), joined).otherwise(c)
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def _from_code(digits: Column) -> Column:
    """A code point as text; what is no code point stays as it was written."""
    n = digits.cast("int")
    units = F.when(n < 65536, F.lpad(F.hex(n), 4, "0")).otherwise(
        F.concat(
            F.hex((F.shiftright(n - 65536, 10) + 0xD800).cast("int")), F.hex(((n - 65536).bitwiseAND(1023) + 0xDC00).cast("int"))
        )
    )
    ok = (n > 0) & (n <= 0x10FFFF) & ~n.between(0xD800, 0xDFFF)
    return F.when(ok, F.decode(F.unhex(units), "UTF-16BE")).otherwise(F.concat(F.lit("&#"), digits, F.lit(";")))


def escape_html(c: Column) -> Column:
    """The five characters that mean something in markup; & first."""
    for ch, to in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#39;")):
        c = F.replace(c, F.lit(ch), F.lit(to))
    return c


def lookup(table: dict[str, str] | dict[str, int], key: Column) -> Column:
    """A small fixed table as a map literal; null for unknown and null keys."""
    m = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    return F.try_element_at(m, key)


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    The optimizer copies the expression of an alias to each place that uses it
    when it pushes a filter down; what is bound inside one expression stays bound.
    """
    return F.element_at(F.transform(F.array(value), body), 1)
