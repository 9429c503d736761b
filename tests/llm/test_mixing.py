import math
import random

import numpy as np
import pytest

from strandline.llm import mixing


def test_inversion():
    """The counts have the Poisson distribution."""
    u = (np.arange(20000) + 0.5) / 20000
    n = mixing.uses_of(u, 1.3, 30)
    for k in range(5):
        assert (n == k).mean() == pytest.approx(math.exp(-1.3) * 1.3**k / math.factorial(k), abs=2e-4)
    assert mixing.uses_of(u, 1.3, 2).max() == 2


def test_steps():
    u = np.array([0.3, 0.9, 1e-9, 1 - 1e-9])
    x = mixing.steps_of(u, 3)
    assert (np.diff(x, axis=1) > 0).all()
    for k in range(3):
        assert mixing.at_most(k, np.exp(x[:, k])) == pytest.approx(u, abs=1e-6)


def test_top_up():
    assert mixing.top_up([(0.1, 1, 50), (0.2, 2, 500), (0.3, 3, 30), (0.4, 1, 50)], 85) == [1, 3]
    assert mixing.top_up([(0.1, 1, 50)], 30) == [1] and mixing.top_up([(0.1, 1, 50)], 20) == [] and mixing.top_up([], 5) == []


@pytest.fixture(scope="module")
def docs(spark):
    r = random.Random(4)
    rows = [(i, r.choice(["a"] * 20 + ["b"] * 5 + ["c"] + ["other"]), "word " * r.randrange(1, 60)) for i in range(4000)]
    rows += [(9001, None, "x"), (9002, "a", None), (9003, "a", ""), (None, "a", "x")]
    return spark.createDataFrame(rows, "doc_id long, source string, text string")


def targets(spark, *rows):
    return spark.createDataFrame(list(rows), "source string, target_share double, max_uses int")


def test_shares(spark, docs):
    uses, report = mixing.mix(docs, targets(spark, ("a", 0.6, 1), ("b", 0.3, 2), ("c", 0.1, 4)))
    rep = {r.source: r for r in report.collect()}
    assert all(r.feasible and r.met and abs(r.share - r.target_share) < 0.01 * r.target_share for r in rep.values())
    # the total is that of all documents
    assert sum(r.wanted_tokens for r in rep.values()) == pytest.approx(sum(r.tokens_available for r in rep.values()))
    got = uses.collect()
    assert len({(r.doc_id, r.use_no) for r in got}) == len(got)
    most = {"a": 1, "b": 2, "c": 4}
    assert all(r.use_no <= most[r.source] for r in got)
    assert sum(r.tokens for r in got if r.source == "b") == rep["b"].tokens
    assert [r.place for r in got] == sorted(r.place for r in got)
    again, _ = mixing.mix(docs.repartition(7), targets(spark, ("a", 0.6, 1), ("b", 0.3, 2), ("c", 0.1, 4)))
    assert [tuple(r) for r in again.collect()] == [tuple(r) for r in got]


def test_refined_histograms_and_a_feasible_mix(spark, docs, monkeypatch):
    want = targets(spark, ("a", 0.6, 1), ("b", 0.3, 2), ("c", 0.1, 4))
    _, report = mixing.mix(docs, want, total_tokens=20_000)
    first = sorted(tuple(r) for r in report.collect())
    assert all(r.met and abs(r.share - r.target_share) < 0.01 * r.target_share for r in report.collect())
    monkeypatch.setattr(mixing, "CLOSE", 20)
    monkeypatch.setattr(mixing, "BINS", 8)
    _, report = mixing.mix(docs, want, total_tokens=20_000)
    assert all(r.met for r in report.collect()) and len(first) == 3


def test_targets_that_cannot_be_met(spark, docs):
    _, report = mixing.mix(docs, targets(spark, ("a", 0.5, 1), ("c", 0.3, 2), ("missing", 0.2, 3)), total_tokens=100_000)
    rep = {r.source: r for r in report.collect()}
    assert rep["a"].met and not rep["c"].met and not rep["missing"].met
    assert rep["c"].tokens == 2 * rep["c"].tokens_available and rep["missing"].tokens == 0
    uses, report = mixing.mix(docs.filter("false"), targets(spark, ("a", 1.0, 1)))
    assert uses.count() == 0 and [r.met for r in report.collect()] == [False]
