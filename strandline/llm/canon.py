"""Freely entered values -> codes of a reference list; what names none of its terms is reported as unmatched.

The reference list (codes, labels, aliases) becomes a symmetric-delete
dictionary: every term under each of its forms with up to two characters left
out.  An entry finds all terms within edit distance two by leaving characters out
of itself, without being compared with the list.  Hits are ranked by a weighted
Damerau-Levenshtein distance (vowels, doubled letters, neighbouring keys and
letters of one sound are cheap) and by how frequent the term's entries are.

Values are looked up once per distinct spelling.  Spellings that have a term's
consonants and differ from it in vowels or letters of one sound only (another
romanisation) join the dictionary as aliases learned from all rows, and the rest
is looked up again: a typo of a romanisation is near to it, though far from the
listed term.  How many rows a spelling has doesn't matter for that, so that the
code of an entry doesn't depend on the size of the input.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline import constants as C
from strandline.session import cut, width

UNMATCHED = "unmatched"
#: Most terms a dictionary may hold in a task, and most learned aliases that join it; more of either are refused.
MAX_TERMS, MAX_LEARNED = 20_000, 5_000
#: The largest weighted distance by sound of an unlisted spelling that is learned.
LEARN_COST = 1.0

# Words that say nothing about the place or session named.
FILLER = {"at", "from", "in", "the", "live", "full", "hd", "4k", "new", "prayer", "salah", "salat", "salaat", "ksa", "main", "hall", "east", "door", "level", "1", "2", "3"}
VOWELS = set("aeiouy")
# Letters of one sound in romanisations.
SOUNDS = [{"w", "v"}, {"q", "k"}, {"z", "d"}, {"z", "t"}, {"s", "z"}, {"j", "g"}, {"d", "t"}, {"b", "p"}, {"k", "h"}]
ROWS = ["qwertyuiop", "asdfghjkl", "zxcvbnm"]
NEIGHBOURS = {frozenset((a, b)) for r in ROWS for a, b in zip(r, r[1:])} | {
    frozenset((a, b)) for r, q in zip(ROWS, ROWS[1:]) for i, a in enumerate(r) for b in q[max(0, i - 1) : i + 1]
}
SAME_SOUND = {frozenset(p) for s in SOUNDS for p in [tuple(s)]}


def plain(text: str | None) -> str:
    """Lower case words of letters and digits, accents and marks inside words taken out."""
    t = unicodedata.normalize("NFKD", text or "")
    t = "".join(c for c in t if not unicodedata.combining(c) and unicodedata.category(c) != "Cf" and c != "ـ")
    t = re.sub(r"(?<=\w)[-'’‘ʻʼ`´ʿʾ]+|[-'’‘ʻʼ`´ʿʾ]+(?=\w)", "", t.lower())
    return " ".join(re.findall(r"\w+", t.replace("_", " ")))


def key_of(text: str | None) -> str:
    """:func:`plain`, or, where nothing is left of a text of signs, the signs."""
    return plain(text) or (text or "").strip()


def sound(text: str) -> str:
    """A key of how a romanised text sounds: digraphs and doubled letters become one letter."""
    for a, b in (("dj", "j"), ("dh", "z"), ("th", "z"), ("kh", "k"), ("ou", "u"), ("oo", "u"), ("ee", "i"), ("aa", "a"), ("ph", "f"), ("v", "w")):
        text = text.replace(a, b)
    text = re.sub(r"(.)\1+", r"\1", text)
    return re.sub(r"h\b", "", text)


def consonants(text: str) -> str:
    return re.sub(r"[aeiouy]", "", text)


def romanises(a: str, b: str) -> bool:
    """Two spellings have the same consonants by sound, one for one: romanisations of one word, without a letter of a neighbouring key."""
    x, y = consonants(sound(a)), consonants(sound(b))
    return len(x) == len(y) and all(c == d or frozenset((c, d)) in SAME_SOUND for c, d in zip(x, y))


def _replace_cost(a: str, b: str) -> float:
    if a in VOWELS and b in VOWELS:
        return 0.4
    pair = frozenset((a, b))
    return 0.6 if pair in SAME_SOUND else 0.8 if pair in NEIGHBOURS else 1.0


def _drop_cost(s: str, i: int) -> float:
    if i and s[i - 1] == s[i] or i + 1 < len(s) and s[i + 1] == s[i]:
        return 0.4
    return 0.5 if s[i] == "h" else 0.7 if s[i] in VOWELS else 0.6 if s[i] == " " else 1.0


def distance(a: str, b: str) -> float:
    """Weighted Damerau-Levenshtein (restricted transposition)."""
    before: list[float] = []
    last = [0.0]
    for j in range(len(b)):
        last.append(last[-1] + _drop_cost(b, j))
    for i, x in enumerate(a):
        drop = _drop_cost(a, i)
        row = [last[0] + drop]
        for j, y in enumerate(b):
            best = last[j] if x == y else last[j] + _replace_cost(x, y)
            best = min(best, last[j + 1] + drop, row[j] + _drop_cost(b, j))
            if i and j and x == b[j - 1] and a[i - 1] == y and x != y:
                best = min(best, before[j - 1] + 0.8)
            row.append(best)
        before, last = last, row
    return last[-1]


def deletes(s: str, most: int) -> set[str]:
    out = level = {s}
    for _ in range(most):
        level = {x[:i] + x[i + 1 :] for x in level for i in range(len(x))}
        out = out | level
    return out


def reach(s: str) -> int:
    """Edits allowed, by length: short words are all near to each other."""
    n = len(s.replace(" ", ""))
    return 0 if n < 3 else 1 if n < 5 else 2


def allowed_cost(s: str) -> float:
    n = len(s.replace(" ", ""))
    return 0.0 if n < 3 else 0.7 if n < 4 else 1.1 if n < 5 else 1.8 if n < 7 else 2.0


class Dictionary:
    """Symmetric-delete dictionary of the terms of one field."""

    def __init__(self, terms: Iterable[tuple]):
        """(spelling, code, rows[, listed]): of equally near terms a listed one comes first, then the one entered more often."""
        self.terms: dict[str, tuple[str, float, bool]] = {}
        for spelling, code, n, *listed in terms:
            p, is_listed = plain(spelling), not listed or listed[0]
            if p and (p not in self.terms or (self.terms[p][2], self.terms[p][1]) < (is_listed, n)):
                self.terms[p] = (code, n, is_listed)
        self.by_delete: dict[str, list[str]] = {}
        self.by_sound: dict[str, list[str]] = {}
        self.by_consonants: dict[str, set[str]] = {}
        self.by_beginning: dict[str, set[str]] = {}
        for t in self.terms:
            for d in deletes(t, reach(t)):
                self.by_delete.setdefault(d, []).append(t)
            for d in deletes(sound(t), min(reach(sound(t)), 1)):
                self.by_sound.setdefault(d, []).append(t)
            if (c := consonants(t)) != t and len(c.replace(" ", "")) > 1:
                self.by_consonants.setdefault(c, set()).add(t)
                for i in range(3, len(c) + 1):
                    self.by_beginning.setdefault(c[:i], set()).add(t)
        self.most = max((len(t) for t in self.terms), default=0)
        self.most_sound = max((len(sound(t)) for t in self.terms), default=0)
        self.longest = max((len(t.split()) for t in self.terms), default=0)
        self.closest = lru_cache(100_000)(self._closest)

    def _closest(self, entry: str) -> tuple[float, str, bool] | None:
        """(cost, code, by sound only) of the best term for a whole entry in plain form; None if none is near enough."""
        if entry in self.terms:
            return 0.0, self.terms[entry][0], False
        # longer than every term by more than the edits allowed: no deletion of it is one of a term
        near: dict[str, None] = {}
        if len(entry) <= self.most + reach(entry):
            for d in deletes(entry, reach(entry)):
                near |= dict.fromkeys(self.by_delete.get(d, ()))
        heard = sound(entry)
        if len(heard) <= self.most_sound + 1:
            for d in deletes(heard, min(reach(heard), 1)):
                near |= dict.fromkeys(self.by_sound.get(d, ()))
        found = []
        for t in near:
            written, spoken = distance(entry, t), distance(heard, sound(t)) + 0.1
            cost = min(written, spoken)
            if cost <= min(allowed_cost(entry), allowed_cost(t)):
                found.append((cost, not self.terms[t][2], -self.terms[t][1], self.terms[t][0], spoken, t))
        # an abbreviation keeps the consonants and has no vowel
        if consonants(entry) == entry and len(entry) > 1:
            found += [(0.9, not self.terms[t][2], -self.terms[t][1], self.terms[t][0], 9.0, t) for t in self.by_consonants.get(entry, ())]
            found += [(1.2, not self.terms[t][2], -self.terms[t][1], self.terms[t][0], 9.0, t) for t in self.by_beginning.get(entry, ())]
        if not found:
            return None
        cost, _, _, code, spoken, t = min(found)
        return cost, code, spoken <= LEARN_COST and romanises(entry, t)

    def lookup(self, entry: str | None) -> tuple[float, str, bool] | None:
        """The term an entry names: as a whole, or, where it has additions, by the best span of its words."""
        words = plain(entry).split()
        if not words or not self.terms:
            return None
        bare = [re.sub(r"^al(?=\w{3})", "", w) for w in words]
        hits = [h for h in (self._lookup(words), self._lookup(bare) if bare != words else None) if h]
        return min(hits, default=None)

    def _lookup(self, words: list[str]) -> tuple[float, str, bool] | None:
        whole = self.closest(" ".join(words))
        if whole and not whole[0]:
            return whole
        # a span must hold all words that say something; so there are few, however long the entry
        telling = [i for i, w in enumerate(words) if not (w in FILLER or w.isdigit())]
        lo, hi = (telling[0], telling[-1]) if telling else (0, len(words) - 1)
        for n in range(min(len(words) - 1, self.longest + 1), hi - lo, -1):
            starts = range(max(0, hi - n + 1), min(lo, len(words) - n) + 1)
            hits = [h for i in starts if (h := self.closest(" ".join(words[i : i + n])))]
            if hits:
                # with additions an entry may be near a learned spelling, and nearer a term without them
                return min(hits + [whole] if whole else hits)
        if whole:
            return whole
        # a filler word may be mistyped too: then a span without spelling mistakes is enough
        return self.certain(words)

    def certain(self, words: list[str]) -> tuple[float, str, bool] | None:
        for n in range(min(len(words), self.longest), 0, -1):
            for i in range(len(words) - n + 1):
                span = " ".join(words[i : i + n])
                if len(span) > 3 and span in self.terms:
                    left = sum(w not in FILLER for w in words[:i] + words[i + n :])
                    return 0.05 + 1.5 * left, self.terms[span][0], False
        return None


# --- titles ---------------------------------------------------------------------------------------------------------

_DAY = re.compile(r"^\d{1,2}(st|nd|rd|th)?$")
_TAIL = {"pt", "part", "adhan", "adhaan", "athan", "azan"}


def _is_separator(words: list[str], i: int, used: set[int]) -> bool:
    """A sign between parts of a title (before the date, before an addition), not an entry of its own."""
    alone = len(words[i]) > 1 and len(set(words[i])) == 1  # "--", "???"
    return not alone and (words[i] != "-" or i + 1 in used or i + 1 < len(words) and plain(words[i + 1]) in FILLER)


def title_phrase(title: str | None) -> tuple[list[str], int | None]:
    """The words of a title outside date, honorific with name, calls and noise; and where a "from" stood among them."""
    t = re.sub(r"_", " ", title or "")
    words = t.split()
    keys = [plain(w) for w in words]
    used = set()
    # the date: a day and a month, and the year after them if there is one
    for i in range(len(words) - 1):
        if _DAY.match(keys[i].replace(" ", "")) and keys[i + 1] in C.MONTHS:
            used |= {i, i + 1}
            if i + 2 < len(words) and re.fullmatch(r"\d{2}|\d{4}", keys[i + 2]):
                used.add(i + 2)
            break
    end = len(words)
    for i, k in enumerate(keys):
        if k in C.HONORIFICS and i not in used:
            end = i
            break
    if end and keys[end - 1 : end] == ["by"]:
        end -= 1
        if end and keys[end - 1 : end] == ["led"]:
            end -= 1
    left, joint = [], None
    for i in range(end):
        if i in used:
            continue
        k = keys[i]
        if k == "from":
            joint = len(left)
        elif k in _TAIL or not k and _is_separator(words, i, used):
            continue
        else:
            left.append(words[i])
    return left, joint


def parts_of(left: list[str], joint: int | None, longest: int) -> set[str]:
    """Keys of the parts that :func:`split_phrase` may read of a title's phrase; none longer than ``longest``."""
    keys = set()
    for c in [joint] if joint is not None else range(len(left) + 1):
        for words in (left[:c], left[c:]):
            if words and len(k := key_of(" ".join(words))) <= longest:
                keys.add(k)
    return keys


def split_phrase(left: list[str], joint: int | None, venues: Dictionary, sessions: Dictionary, free: dict[str, set[str]]):
    """(venue entry, its code), (session entry, its code) of a title's phrase; None for a field it says nothing about.

    Tried: every cut into a venue part and a session part, in this order, or the
    other way round where the title says "<session> from <venue>".
    """

    def read(part: list[str], field: Dictionary, known: set[str]):
        text = " ".join(part)
        if text and key_of(text) in known:
            return 0.1, (text, UNMATCHED)
        if not plain(text) or all(w in FILLER for w in plain(text).split()):
            return 0.3, None
        hit = field.lookup(text)
        # longer parts that are spelled out are better evidence than short ones left over
        return (hit[0] + 0.2, (text, hit[1])) if hit else (4.0, (text, UNMATCHED))

    options = []
    cuts = [joint] if joint is not None else range(len(left) + 1)
    for c in cuts:
        a, b = left[:c], left[c:]
        for venue, session, extra in ((a, b, 0.0), (b, a, 0.0 if joint is not None else 0.5)):
            x, v = read(venue, venues, free["mosque"])
            y, s = read(session, sessions, free["prayer"])
            options.append((x + y + extra, len(venue), v, s))
    cost, _, v, s = min(options, key=lambda o: (o[0], o[1]))
    return v, s


def _terms(canon: DataFrame) -> list[tuple[str, str, str, float]]:
    """(field, spelling, code, rows) of the reference list, which must be small: every task holds it.  Listed goes before learned, at any size."""
    spelled = canon.select(
        "field", "code", F.explode(F.array_distinct(F.concat(F.array("code", "label"), F.coalesce("known_aliases", F.array().cast("array<string>"))))).alias("s")
    ).filter("s is not null and code is not null")
    rows = spelled.limit(MAX_TERMS + 1).collect()
    if len(rows) > MAX_TERMS:
        raise ValueError(f"more than {MAX_TERMS} terms; every task would hold them")
    return [(r.field, r.s, r.code, 0, True) for r in rows]


def _with_frequencies(terms: list[tuple], values: DataFrame) -> list[tuple]:
    """Listed terms with the number of rows that are entered in just their spelling: at most one row per term is read."""
    spelt = values.select("field", F.lower(F.trim("value")).alias("v"), "n").filter(F.col("v").isin(sorted({s.strip().lower() for _, s, *_ in terms})))
    rows = {(r.field, r.v): r.n for r in spelt.groupBy("field", "v").agg(F.sum("n").alias("n")).collect()}
    return [(f, s, c, rows.get((f, s.strip().lower()), 0), listed) for f, s, c, _, listed in terms]


FIELDS = ("mosque", "prayer")


def map_values(entries: DataFrame, canon: DataFrame) -> DataFrame:
    """(row_id, title, mosque, prayer) -> row_id, field, code: what each entry means, or ``unmatched``.

    The entry is the column, or, where it is null, what the title says; a row
    whose title says nothing about the field either has no row here, and neither
    has an entry that is literally a code of the field.  An entry of blanks or
    signs only is unmatched.  Extra columns are ignored; repeated rows stay.
    """
    spark = entries.sparkSession
    terms = _terms(canon)
    codes = {f: {c for g, _, c, *_ in terms if g == f} for f in FIELDS}
    values = entries.select(F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("value")) for f in FIELDS])).alias("x"))
    values = values.select("x.field", "x.value").filter("value is not null").groupBy("field", "value").agg(F.count("*").alias("n"))
    terms = _with_frequencies(terms, values)

    def matched(shared, learned: DataFrame | None = None):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            dicts = {f: Dictionary(t[1:] for t in shared.value if t[0] == f) for f in FIELDS}
            for b in batches:
                hits = [dicts[f].lookup(v) for f, v in zip(b["field"], b["value"])]
                b["code"] = [h[1] if h else UNMATCHED for h in hits]
                b["cost"] = [h[0] if h else 9.0 for h in hits]
                b["by_sound"] = [bool(h and h[2]) for h in hits]
                b["key"] = [key_of(v) for v in b["value"]]
                yield b

        return values.mapInPandas(run, "field string, value string, n long, code string, cost double, by_sound boolean, key string")

    # the listed terms first, then also what was learned from all rows: aliases, and values that name no term
    first = matched(spark.sparkContext.broadcast(terms))
    kinds = first.groupBy("field", "key", "code").agg(F.sum("n").alias("n"), F.max("by_sound").alias("by_sound"), F.min("cost").alias("cost"))
    heard = kinds.filter((F.col("code") != UNMATCHED) & F.col("by_sound") & (F.col("cost") > 0))
    learned = [(r.field, r.key, r.code, r.n, False) for r in heard.select("field", "key", "code", "n").limit(MAX_LEARNED + 1).collect()]
    if len(learned) > MAX_LEARNED:
        raise ValueError(f"more than {MAX_LEARNED} learned spellings; every task would hold them")
    learned.sort(key=lambda x: (-x[3], x[:3]))
    shared = spark.sparkContext.broadcast(terms + learned)
    final = cut(matched(shared).select("field", "value", "code", "key", "n"))

    unknown = final.filter((F.col("code") == UNMATCHED) & (F.col("key") != "")).select("field", "key").distinct()

    base = entries.select("row_id", "title", *FIELDS)
    literal = lambda f: F.col("value").isin(sorted(codes[f]))
    out = None
    for f in FIELDS:
        d = base.select("row_id", F.col(f).alias("value")).filter("value is not null").filter(~literal(f))
        d = d.join(final.filter(F.col("field") == f).select("value", "code"), "value")
        d = d.select("row_id", F.lit(f).alias("field"), "code")
        out = d if out is None else out.unionByName(d)

    # titles are read once per distinct title, for the rows that lack an entry
    missing = base.filter("title is not null and (mosque is null or prayer is null)")
    titles = missing.select("title").distinct()
    titles = titles.repartition(width(titles))

    # values that name no term go to the titles that hold them: there may be any number of them
    longest = unknown.agg(F.max(F.length("key"))).first()[0] or 0

    def part(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            b["key"] = [sorted(parts_of(*title_phrase(t), longest)) for t in b["title"]]
            yield b.explode("key").dropna(subset=["key"])

    held = titles.mapInPandas(part, "title string, key string").join(unknown, "key")
    known = held.groupBy("title").agg(*[F.collect_set(F.when(F.col("field") == f, F.col("key"))).alias(f"{f}_known") for f in FIELDS])
    titles = titles.join(known, "title", "left").repartition(width(titles))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        dicts = {f: Dictionary(t[1:] for t in shared.value if t[0] == f) for f in FIELDS}
        for b in batches:
            free = [{f: set() if k is None else set(k) for f, k in zip(FIELDS, ks)} for ks in zip(*[b[f"{f}_known"] for f in FIELDS])]
            got = [split_phrase(*title_phrase(t), dicts["mosque"], dicts["prayer"], k) for t, k in zip(b["title"], free)]
            for i, f in enumerate(FIELDS):
                b[f"{f}_said"] = [g[i][0] if g[i] else None for g in got]
                b[f"{f}_code"] = [g[i][1] if g[i] else None for g in got]
            yield b[["title", *[f"{f}_{x}" for f in FIELDS for x in ("said", "code")]]]

    said = titles.mapInPandas(read, "title string, " + ", ".join(f"{f}_said string, {f}_code string" for f in FIELDS))
    from_title = missing.join(said, "title")
    each = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).alias("own"), F.col(f"{f}_said").alias("value"), F.col(f"{f}_code").alias("code")) for f in FIELDS])
    t = from_title.select("row_id", F.explode(each).alias("x")).select("row_id", "x.*").filter("own is null and code is not null")
    for f in FIELDS:
        t = t.filter((F.col("field") != f) | ~literal(f))
    return out.unionByName(t.select("row_id", "field", "code"))
