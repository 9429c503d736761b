"""Subject areas of documents: complement naive Bayes, refined by EM, with calibrated independent posteriors.

The unit of the model is the sentence; its classes are the subjects, ``none``
(small talk) and ``passing`` (a sentence that names a subject's words without
being about it).  Labelled documents say which subjects their sentences can
have.  A complement model (what the other classes say) is made from them, and
refined by expectation-maximization over all documents: labelled ones within
their labels, the others freely at a lower weight.  A subject that a single
sentence of a document looks like, against its labels or among many others,
teaches ``passing``.
Last, for each subject, a logistic model, fitted on the labelled documents and held
near a common one, turns how much of a document is about the subject into a
posterior, independent of the other subjects.

All statistics are taken over whole texts of all documents; only the labelled
documents used are bounded (``Options.max_labelled``).  Features are hashed, so
that the model's size doesn't depend on the corpus: 2^17 x 12 numbers.
"""

from __future__ import annotations

import html
import re
import warnings
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandline.session import cut

NONE = "none"
#: A subject is met once in a document if its sentences sum up to less than ONCE; a longer document has LONGER sentences.
ONCE, LONGER = 1.5, 4
#: Numbers per document and subject the posterior depends on.
N_FEATURES = 6


@dataclass(frozen=True)
class Options:
    """Parameters; ``max_labelled`` labelled documents, chosen by a hash of their id, fit the model.

    EM goes on until less than ``tolerance`` of all counts move between classes; ``max_rounds`` only guards
    against counts that swing for ever, with a warning.
    """

    bits: int = 17
    max_labelled: int = 20_000
    max_rounds: int = 30
    tolerance: float = 0.02
    calibration_ridge: float = 10.0
    unlabelled_weight: float = 0.5
    alpha: float = 0.1
    threshold: float = 0.5
    max_subjects: int = 200
    seed: int = 7


_MOJIBAKE = re.compile("[Â-ß][\u0080-¿]")
_TAG = re.compile(r"<[^>]{0,200}>")
_END = re.compile(r"(?<=[.!?;؟])[)\]\"»]*\s+|[\r\n]+|\s*<[^>]{0,200}>\s*")
_NUMBER = re.compile(r"\d+")
_WORD = re.compile(r"[^\W\d_]+(?:['’-][^\W\d_]+)*")


def sentences(text: str | None) -> list[str]:
    """Sentences of a whole text in lower case: markup out, entities and broken two-byte encoding repaired; no blanks."""
    t = html.unescape(text or "")
    if _MOJIBAKE.search(t):
        t = _MOJIBAKE.sub(lambda m: m[0].encode("latin-1").decode("utf-8"), t)
    return [s for s in (x.strip().lower() for x in _END.split(t)) if s]


class Reader:
    """Documents -> arrays of features, hashed words and pairs of words; words and sentences seen before are looked up."""

    def __init__(self, bits: int):
        self.mask = (1 << bits) - 1
        self.word = lru_cache(200_000)(lambda w: zlib.crc32(w.encode()))
        self.of = lru_cache(50_000)(self.features)

    def features(self, sentence: str) -> np.ndarray:
        w = np.array([self.word(x) for x in _WORD.findall(sentence)], np.int64)
        # the pair's hash is made from those of its words; it depends on their order
        pairs = (w[:-1] * 0x9E3779B1 + w[1:] * 0x85EBCA6B) >> 13
        return np.concatenate([w, pairs]) & self.mask

    def document(self, text: str | None) -> tuple[np.ndarray, list[int]]:
        """The features of all distinct sentences with words, and how many each sentence has."""
        found = [f for s in dict.fromkeys(sentences(text)) if len(f := self.of(_NUMBER.sub("", s)))]  # numbers are no features
        return (np.concatenate(found) if found else np.empty(0, np.int64)), [len(f) for f in found]


def featurise(documents: DataFrame, options: Options = Options()) -> DataFrame:
    """(doc_id, text) -> doc_id, ids, lens: the hashed features of each whole text, and how many each of its sentences has.

    Parting texts is most of the work, so it is done once, for training and
    assignment; the result is written to the shared folder.  Null ids are dropped.
    """
    bits = options.bits

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = Reader(bits)
        for b in batches:
            got = [reader.document(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": [g[0].astype(np.int32) for g in got], "lens": [np.array(g[1], np.int32) for g in got]})

    d = documents.select("doc_id", "text").filter("doc_id is not null")
    return cut(d.mapInPandas(run, "doc_id long, ids array<int>, lens array<int>"))


def _read(b: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, sentence number of each feature, document number of each sentence) of a batch of featurised documents."""
    per_doc = [len(x) for x in b["lens"]]
    if not sum(per_doc):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    lens = np.concatenate(list(b["lens"])).astype(np.int64)
    return np.concatenate(list(b["ids"])).astype(np.int64), np.repeat(np.arange(len(lens)), lens), np.repeat(np.arange(len(b)), per_doc)


def complement_weights(counts: np.ndarray, alpha: float) -> np.ndarray:
    """(features x classes) counts -> weights: minus the log share of a feature in all *other* classes."""
    other = counts.sum(1, keepdims=True) - counts + alpha
    return -np.log(other / other.sum(0, keepdims=True))


def sentence_scores(w: np.ndarray, ids: np.ndarray, sent: np.ndarray, n: int) -> np.ndarray:
    if not n:
        return np.zeros((0, w.shape[1]))
    starts = np.searchsorted(sent, np.arange(n))
    return np.add.reduceat(w[ids], starts, axis=0)


def posteriors(scores: np.ndarray, allowed: np.ndarray | None = None) -> np.ndarray:
    """Softmax over the allowed classes."""
    s = scores if allowed is None else np.where(allowed, scores, -np.inf)
    e = np.exp(s - s.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


def expect(w: np.ndarray | None, read: tuple, labels: list, k: int, o: Options) -> tuple[np.ndarray, np.ndarray]:
    """E-step of a batch: class weights of each sentence, and its weight in the model.

    ``labels`` has per document None (unlabelled) or a boolean array of its
    subjects; a labelled document without subjects is small talk.
    Classes 0..k-1 are the subjects, k is none, k + 1 passing.
    """
    ids, sent, doc = read
    n = len(doc)
    labelled = np.array([lab is not None for lab in labels], bool)[doc] if n else np.zeros(0, bool)
    own = np.zeros((n, k + 2), bool)
    rows = np.array([np.zeros(k, bool) if lab is None else lab for lab in labels]).reshape(len(labels), k)
    own[:, :k] = rows[doc]
    if w is None:
        p = np.zeros((n, k + 2))
        size = own[:, :k].sum(1)
        p[:, :k] = own[:, :k] / np.maximum(size, 1)[:, None]
        p[labelled & (size == 0), k] = 1.0
        return p, labelled.astype(float)
    s = sentence_scores(w, ids, sent, n)
    free = posteriors(s)
    # in a labelled document: its own subjects, small talk, or passing
    own[:, k:] = True
    p = np.where(labelled[:, None], posteriors(s, own | ~labelled[:, None]), free)
    # A subject that only one sentence of a longer document looks like is named in passing there, unless the labels say
    # otherwise.  (Several sentences of a subject that the labels lack rather mean a wrong label.)
    top = free[:, :k].argmax(1)
    sure = free[np.arange(n), top] > 0.5
    sums = np.zeros((len(labels), k))
    np.add.at(sums, doc, free[:, :k])
    once = sums[doc, top] < ONCE
    longer = np.bincount(doc, minlength=len(labels))[doc] >= LONGER
    has = own[np.arange(n), top] & labelled
    passing = sure & once & ~has & (longer | labelled)
    p[passing] = 0
    p[passing, k + 1] = 1.0
    return p, np.where(labelled, 1.0, o.unlabelled_weight)


def document_features(p: np.ndarray, doc: np.ndarray, n_docs: int, k: int) -> np.ndarray:
    """(documents x subjects x N_FEATURES): how much of a document is about a subject."""
    sums = np.zeros((n_docs, k + 2))
    np.add.at(sums, doc, p)
    top = np.zeros((n_docs, k))
    np.maximum.at(top, doc, p[:, :k])
    total = np.bincount(doc, minlength=n_docs).astype(float)
    about = sums[:, :k].sum(1, keepdims=True)
    out = np.zeros((n_docs, k, N_FEATURES))
    out[..., 0] = 1
    out[..., 1] = np.log1p(sums[:, :k])
    out[..., 2] = top
    out[..., 3] = sums[:, :k] / np.maximum(about, 1e-9)
    out[..., 4] = sums[:, :k] / np.maximum(total, 1)[:, None]
    out[..., 5] = np.log1p(total)[:, None]
    return out


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50, near: np.ndarray | None = None) -> np.ndarray:
    """Newton's method with a ridge towards ``near`` (0 by default); ``y`` may be a share between 0 and 1."""
    near = np.zeros(x.shape[1]) if near is None else near
    b = near.copy()
    for _ in range(steps):
        q = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (q - y) + ridge * (b - near)
        h = (x * (q * (1 - q))[:, None]).T @ x + ridge * np.eye(len(b))
        step = np.linalg.solve(h, g)
        b -= step
        if np.abs(step).max() < 1e-8:
            break
    return b


class Model:
    """Subjects, sentence weights and the calibration; small enough for every task."""

    def __init__(self, subjects: list[str], weights: np.ndarray, calibration: np.ndarray, options: Options):
        self.subjects, self.weights, self.calibration, self.options = subjects, weights, calibration, options

    def predict(self, b: pd.DataFrame) -> np.ndarray:
        """Posterior per featurised document and subject."""
        k = len(self.subjects)
        ids, sent, doc = _read(b)
        texts = range(len(b))
        p = posteriors(sentence_scores(self.weights, ids, sent, len(doc))) if len(doc) else np.zeros((0, k + 2))
        x = document_features(p, doc, len(texts), k)
        q = 1 / (1 + np.exp(-np.clip(np.einsum("dsf,sf->ds", x, self.calibration), -30, 30)))
        q[np.bincount(doc, minlength=len(texts)) == 0] = 0.0
        return q


_CHUNK = 1000


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        for i in range(0, len(b), _CHUNK):
            yield b.iloc[i : i + _CHUNK]


def _label_rows(labels: DataFrame, o: Options) -> DataFrame:
    """doc_id, given (subjects, those most of its labellers chose), n; a bounded number of documents, by hash of the id."""
    d = labels.filter("doc_id is not null and subject is not null").select("doc_id", "subject", F.coalesce("labeller", F.lit("")).alias("labeller")).distinct()
    d = d.groupBy("doc_id").agg(F.collect_set("subject").alias("given"))
    h = F.xxhash64("doc_id", F.lit(o.seed))
    return d.orderBy(h, "doc_id").limit(o.max_labelled)


def train(features: DataFrame, labels: DataFrame, subjects: DataFrame, options: Options = Options()) -> Model:
    """Fit the model to featurised documents.  Those without text teach nothing; labels of unknown subjects and unknown documents are ignored."""
    o = options
    spark = features.sparkSession
    names = [r.subject for r in subjects.select("subject").filter("subject is not null").distinct().orderBy("subject").limit(o.max_subjects + 1).collect()]
    if len(names) > o.max_subjects:
        raise ValueError(f"more than {o.max_subjects} subjects")
    k, size = len(names), 1 << o.bits
    at = {s: i for i, s in enumerate(names)}
    # at most max_labelled ids with their subjects: they go to the texts, the texts stay where they are read
    known = F.broadcast(_label_rows(labels, o))
    docs = features.filter("size(lens) > 0")
    taught = cut(docs.join(known, "doc_id"))
    everything = docs.join(known, "doc_id", "left")

    def flags(given) -> np.ndarray | None:
        if given is None:
            return None
        lab = np.zeros(k, bool)
        for s in given:
            if s in at:
                lab[at[s]] = True
        return lab

    columns = ", ".join(f"c{i} double" for i in range(k + 2))

    def count(df: DataFrame, w: np.ndarray | None) -> np.ndarray:
        shared = spark.sparkContext.broadcast(None if w is None else w.astype(np.float32))

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros((size, k + 2))
            for b in _chunks(batches):
                read = _read(b)
                ids, sent, doc = read
                if not len(doc):
                    continue
                p, weight = expect(shared.value, read, [flags(g) for g in b["given"]], k, o)
                # a sentence rarely has more than one class; what the others have together goes to those that are left
                p = np.where(p > 1e-4, p, 0)
                p = p / np.maximum(p.sum(1, keepdims=True), 1e-300) * weight[:, None]
                at_s, at_c = p.nonzero()
                starts = np.searchsorted(sent, np.arange(len(doc) + 1))
                length = (starts[1:] - starts[:-1])[at_s]
                cells = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length) + np.repeat(starts[at_s], length)
                flat = ids[cells] * (k + 2) + np.repeat(at_c, length)
                np.add.at(total.reshape(-1), flat, np.repeat(p[at_s, at_c], length))
            used = total.any(1).nonzero()[0]
            f = pd.DataFrame(total[used], columns=[f"c{i}" for i in range(k + 2)])
            f.insert(0, "feature", used)
            yield f

        sums = df.select("ids", "lens", "given").mapInPandas(run, f"feature long, {columns}")
        sums = sums.groupBy("feature").agg(*[F.sum(f"c{i}").alias(f"c{i}") for i in range(k + 2)])
        got = sums.toPandas()  # at most 2^bits rows
        shared.destroy()
        out = np.zeros((size, k + 2))
        out[got["feature"].to_numpy(np.int64)] = got[[f"c{i}" for i in range(k + 2)]].to_numpy()
        return out

    w = complement_weights(count(taught, None), o.alpha)
    w[:, k + 1] = 0.0  # nothing is known of passing sentences yet: no evidence for them
    for df in (taught, everything):
        before, moved = None, 1.0
        for _ in range(o.max_rounds):
            now = count(df, w)
            w = complement_weights(now, o.alpha)
            moved = 1.0 if before is None else np.abs(now - before).sum() / max(2 * now.sum(), 1e-300)
            before = now
            if moved < o.tolerance:
                break
        else:
            warnings.warn(f"EM: {moved:.3f} of the counts still move after {o.max_rounds} rounds", stacklevel=2)

    # calibration on the labelled documents, one row of numbers per document and subject
    shared = spark.sparkContext.broadcast(w)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in _chunks(batches):
            ids, sent, doc = _read(b)
            p = posteriors(sentence_scores(shared.value, ids, sent, len(doc))) if len(doc) else np.zeros((0, k + 2))
            x = document_features(p, doc, len(b), k).reshape(-1, N_FEATURES)
            f = pd.DataFrame(x, columns=[f"x{i}" for i in range(N_FEATURES)])
            f["subject"] = np.tile(np.arange(k), len(b))
            f["y"] = np.concatenate([flags(g) for g in b["given"]]).astype(float)
            yield f

    m = taught.select("ids", "lens", "given").mapInPandas(measure, ", ".join(f"x{i} double" for i in range(N_FEATURES)) + ", subject int, y double").toPandas()
    x, y, which = m[[f"x{i}" for i in range(N_FEATURES)]].to_numpy(), m["y"].to_numpy(), m["subject"].to_numpy()
    common = fit_logistic(x, y) if len(y) else np.zeros(N_FEATURES) - 30.0
    # each subject its own model, held near the common one: a subject with few labelled documents stays with it
    calibration = np.array([fit_logistic(x[which == i], y[which == i], o.calibration_ridge, near=common) if (which == i).any() else common for i in range(k)]).reshape(k, N_FEATURES)
    return Model(names, w.astype(np.float32), calibration, o)


def assign(features: DataFrame, model: Model) -> DataFrame:
    """doc_id, subject, posterior of every subject a document treats; documents that treat none have no row.

    Null, empty and wordless texts treat none.  The documents come featurised.
    """
    shared = features.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in _chunks(batches):
            q = m.predict(b)
            d, s = (q >= m.options.threshold).nonzero()
            if len(d):
                yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy()[d], "subject": [m.subjects[i] for i in s], "posterior": q[d, s]})

    return features.select("doc_id", "ids", "lens").mapInPandas(run, "doc_id long, subject string, posterior double")


def composition(assigned: DataFrame, documents: DataFrame) -> DataFrame:
    """Documents and characters per subject, and their shares of the whole corpus; for reweighting it."""
    n = documents.agg(F.count("*").alias("all_docs"), F.sum(F.length("text")).alias("all_chars")).withColumn("one", F.lit(1))
    d = assigned.join(documents.select("doc_id", F.length("text").alias("chars")), "doc_id")
    d = d.groupBy("subject").agg(F.count("*").alias("docs"), F.sum("chars").alias("chars")).withColumn("one", F.lit(1))
    return d.join(n, "one").select("subject", "docs", "chars", (F.col("docs") / F.col("all_docs")).alias("doc_share"), (F.col("chars") / F.col("all_chars")).alias("char_share"))
