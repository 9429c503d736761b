"""The aligner: noisy timed texts of a recording -> timed verses of the corpus.

The claim for one text depends on the verse matched before it, and what is left
of a text after a match depends on that match, so this is a fold over each
recording, run on Arrow batches.  Candidates and their scores depend on the text
only; a worker computes them once per distinct text and keeps them.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline import constants as C
from strandline.functions.text import py_skeleton
from strandline.session import ship, width

TIMELINE = (
    "take_id long, out_no int, t0 double, t1 double, surah int, ayah int, conf double, is_partial boolean, error string"
)


@dataclass(frozen=True)
class AlignOptions:
    """Fixed values of the aligner; ``max_verses`` bounds the corpus every worker holds."""

    min_confidence: float = 0.62
    candidate_limit: int = 60
    continuity_bonus: float = 0.12
    complete_coverage: float = 0.7
    max_splits: int = 6
    max_verses: int = 200_000


def round3(x: float) -> float:
    return math.floor(x * 1000 + 0.5) / 1000


class Index:
    """Inverted index over the corpus in one worker."""

    def __init__(self, verses: list[tuple[int, int, list[str]]], options: AlignOptions):
        self.verses, self.o = verses, options
        self.masks: list[dict[str, int]] = []
        post: dict[str, list[int]] = {}
        for pos, (_, _, ws) in enumerate(verses):
            mask: dict[str, int] = {}
            for i, w in enumerate(ws):
                mask[w] = mask.get(w, 0) | 1 << i
            self.masks.append(mask)
            for w in mask:
                post.setdefault(w, []).append(pos)
        n = len(verses)
        self.idf = {w: math.log(n / len(p)) for w, p in post.items()}
        self.post = {w: p for w, p in post.items() if len(p) <= n / 5}
        self.known = lru_cache(200_000)(self._known)

    def distances(self, query: tuple[str, ...], pos: int) -> list[int]:
        """Word edit distance of the verse to each prefix of the query, from one bit-parallel pass."""
        mask, m = self.masks[pos], len(self.verses[pos][2])
        full, high = (1 << m) - 1, 1 << (m - 1)
        pv, mv, d = full, 0, m
        out = [d]
        for w in query:
            eq = mask.get(w, 0)
            xv = eq | mv
            xh = (((eq & pv) + pv) ^ pv) | eq
            ph, mh = mv | ~(xh | pv) & full, pv & xh
            d += 1 if ph & high else -1 if mh & high else 0
            ph, mh = (ph << 1 | 1) & full, mh << 1 & full
            pv, mv = mh | ~(xv | ph) & full, ph & xv
            out.append(d)
        return out

    def score(self, query: tuple[str, ...], pos: int) -> tuple[float, float]:
        """Composite score and coverage."""
        length = len(self.verses[pos][2])
        if not length or not query:
            return 0.0, 0.0
        prefix = query[: min(len(query), length + 1)]
        d = self.distances(prefix, pos)[-1]
        mask = self.masks[pos]
        hit = sum(w in mask for w in prefix)
        sim = 1 - d / max(len(prefix), length)
        return 0.55 * sim + 0.25 * (hit / length) + 0.2 * (hit / len(prefix)), hit / length

    def _known(self, query: tuple[str, ...]) -> list[tuple[int, float, float]]:
        """Ranked candidates of a text with their scores: (pos, score, coverage)."""
        sums: dict[int, float] = {}
        for w in sorted(dict.fromkeys(query), key=lambda w: -self.idf.get(w, 0.0)):
            for pos in self.post.get(w, ()):
                sums[pos] = sums.get(pos, 0.0) + self.idf[w]
        ranked = sorted(sums, key=lambda p: -sums[p])[: self.o.candidate_limit]
        return [(p, *self.score(query, p)) for p in ranked]

    def best(self, query: tuple[str, ...], previous: int | None) -> tuple[int, float, float] | None:
        """The claim: (pos, score up to 1, coverage).

        Candidates are tried in rank order, then the neighbours of the previous
        match.  A later candidate wins if it exceeds the *capped* score of the
        best so far.
        """
        found = self.known(query)
        if previous is not None:
            seen = {p for p, _, _ in found}
            near = range(previous, min(previous + 4, len(self.verses)))
            found = [*found, *((p, *self.score(query, p)) for p in near if p not in seen)]
        best = None
        bonus = self.o.continuity_bonus
        for pos, s, coverage in found:
            if previous is not None:
                s += {1: bonus, 0: bonus * 0.5, 2: bonus * 0.4}.get(pos - previous, 0.0)
            if best is None or s > best[1]:
                best = (pos, min(s, 1.0), coverage)
        return best

    def extent(self, query: tuple[str, ...], pos: int) -> int:
        """How many leading words the matched verse takes."""
        n, length = len(query), len(self.verses[pos][2])
        low, high = max(1, length // 2), min(n, math.ceil(length * 1.5) + 1)
        best, top = min(n, length), -1.0
        d = self.distances(query[:high], pos) if high >= low else []
        for k in range(low, high + 1):
            sim = 1 - d[k] / max(k, length)
            if sim >= top:
                best, top = k, sim
        return n if n - best <= 2 else best


def align_one(rows: list[tuple[float, float, str]], index: Index) -> list[list]:
    """Fold one recording: (t0, t1, skeleton) in order -> [t0, t1, pos, conf, partial] after reconciling and merging."""
    o = index.o
    opener = py_skeleton(C.BOILERPLATE)
    out: list[list] = []
    taken: list[tuple[str, ...]] = []
    previous = None
    for t0, t1, norm in rows:
        if norm == opener:
            out.append([t0, t1, None, 0.0, False])
            taken.append(())
            continue
        query = tuple(norm.split())
        splits = 0
        while query and splits <= o.max_splits:
            match = index.best(query, previous)
            if match is None or match[1] < o.min_confidence:
                out.append([t0, t1, None, round3(match[1]) if match else 0.0, False])
                taken.append(())
                break
            pos, conf, coverage = match
            used = index.extent(query, pos)
            share = used / len(query)
            end = min(t1 if splits == 0 and share >= 0.999 else t0 + (t1 - t0) * share, t1)
            out.append([round3(t0), round3(end), pos, round3(conf), coverage < o.complete_coverage])
            taken.append(query[:used])
            previous, query, t0 = pos, query[used:], end
            splits += 1
            if t1 - t0 < 0.2:
                break
    for i in range(len(out) - 2, -1, -1):
        here, after = out[i][2], out[i + 1][2]
        if here is None or after is None or here in (after - 1, after) or after < 1 or not taken[i]:
            continue
        again, _ = index.score(taken[i], after - 1)
        if again + 0.02 >= out[i][3] and again >= o.min_confidence:
            out[i][2:4] = [after - 1, round3(again)]
    merged: list[list] = []
    for row in out:
        last = merged[-1] if merged else None
        if last and last[2] is not None and last[2] == row[2] and row[0] - last[1] < 1.0:
            last[1], last[3], last[4] = row[1], round3(max(last[3], row[3])), last[4] and row[4]
        else:
            merged.append(row)
    return merged


def whole_groups(batches: Iterator[pd.DataFrame], key: str) -> Iterator[tuple[object, pd.DataFrame]]:
    """Groups of equal ``key`` of sorted batches, each whole, also across batches."""
    open_: list[pd.DataFrame] = []
    for b in batches:
        if b.empty:
            continue
        cuts = (b[key] != b[key].shift()).to_numpy().nonzero()[0].tolist() + [len(b)]
        for lo, hi in zip(cuts, cuts[1:]):
            part = b.iloc[lo:hi]
            if open_ and open_[0][key].iloc[0] != part[key].iloc[0]:
                yield open_[0][key].iloc[0], pd.concat(open_) if len(open_) > 1 else open_[0]
                open_ = []
            open_.append(part)
    if open_:
        yield open_[0][key].iloc[0], pd.concat(open_) if len(open_) > 1 else open_[0]


def align(segments: DataFrame, corpus: DataFrame, options: AlignOptions = AlignOptions()) -> DataFrame:
    """Timed segments (take_id, seg_no, t0, t1, arabic) -> timeline rows of each take, in order of t0, then seg_no.

    A text that matches nothing well enough keeps its row, with null surah and
    ayah.  Rows with a null take, time or a blank text are dropped; takes without
    rows are absent (join them back for their status).  A take whose fold fails
    yields one row with ``error`` set, and disturbs no other.
    """
    spark = segments.sparkSession
    ship(spark)
    verses = corpus.select("pos", "surah", "ayah", "words").orderBy("pos").limit(options.max_verses + 1).collect()
    if len(verses) > options.max_verses:
        raise ValueError(f"the corpus has more than {options.max_verses} verses; every worker would hold it")
    # bounded by max_verses, whatever the size of the segments
    shared = spark.sparkContext.broadcast([(r.surah, r.ayah, list(r.words)) for r in verses])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index = Index(shared.value, options)
        rows: list[tuple] = []
        for take, g in whole_groups(batches, "take_id"):
            try:
                texts = [py_skeleton(x) for x in g["arabic"]]
                for k, (t0, t1, pos, conf, partial) in enumerate(align_one(list(zip(g["t0"], g["t1"], texts)), index)):
                    surah, ayah = (None, None) if pos is None else index.verses[pos][:2]
                    rows.append((take, k, t0, t1, surah, ayah, conf, bool(partial), None))
            except Exception as e:  # noqa: BLE001 - one bad recording must not stop the run
                rows.append((take, -1, None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:500]))
            if len(rows) >= 10_000:
                yield _frame(rows)
                rows = []
        if rows:
            yield _frame(rows)

    d = segments.select("take_id", "seg_no", F.col("t0").cast("double"), F.col("t1").cast("double"), "arabic")
    d = d.filter("take_id is not null and t0 is not null and t1 is not null and arabic is not null and trim(arabic) <> ''")
    d = d.repartition(width(d), "take_id").sortWithinPartitions("take_id", "t0", "seg_no", "t1", "arabic")
    return d.select("take_id", "t0", "t1", "arabic").mapInPandas(run, TIMELINE)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    names = [c.split()[0] for c in TIMELINE.split(", ")]
    f = pd.DataFrame.from_records(rows, columns=names)
    return f.astype({"surah": "Int32", "ayah": "Int32", "is_partial": "boolean", "t0": "Float64", "t1": "Float64", "conf": "Float64"})
