import random

import numpy as np

from strandline.llm import subjects as S

TERMS = {"law": ["court", "statute", "witness", "lease"], "audio": ["microphone", "gain", "reverb", "limiter"], "travel": ["visa", "luggage", "shuttle", "fare"]}
TALK = ["thanks for the help", "no subtitles yet", "see the pinned post", "uploaded a little late"]


def corpus(seed, n):
    r = random.Random(seed)
    docs, truth, labels = [], {}, []
    for i in range(n):
        subs = r.sample(sorted(TERMS), r.choice([0, 1, 1, 1, 2]))
        out = []
        for s in subs:
            for _ in range(r.randrange(2, 5)):
                a, b = r.sample(TERMS[s], 2)
                out.append(r.choice([f"The {a} and the {b} were discussed again.", f"Most of this part is about the {a}, with the {b}.", f"Somebody asked why the {a} needs a {b}."]))
        out += [f"{x.capitalize()}." for x in r.sample(TALK, r.randrange(1, 4))]
        other = [s for s in TERMS if s not in subs]
        if other and r.random() < 0.3:
            out.append(f"We leave the {r.choice(TERMS[r.choice(other)])} for another day.")
        r.shuffle(out)
        docs.append((i, " ".join(out)))
        truth[i] = set(subs)
        if i % 3 == 0:
            wrong = r.random() < 0.04
            labels += [(i, s, "l1") for s in ([r.choice(sorted(TERMS))] if wrong else subs or ["none"])]
    return docs, truth, labels


def test_held_out(spark):
    docs, truth, labels = corpus(1, 900)
    d = spark.createDataFrame([*docs, (10_001, None), (10_002, ""), (10_003, "123 !!"), (None, "court")], "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (77_777, "law", "x"), (None, "law", "x"), (3, "unknown", "x")], "doc_id long, subject string, labeller string")
    sub = spark.createDataFrame([(s,) for s in TERMS], "subject string")
    f = S.featurise(d)
    m = S.train(f, lab, sub)
    got = {}
    for r in S.assign(f, m).collect():
        got.setdefault(r.doc_id, set()).add(r.subject)
    held = [i for i in truth if i % 3]
    assert np.mean([got.get(i, set()) == truth[i] for i in held]) > 0.95
    assert not {10_001, 10_002, 10_003} & set(got)
    shares = {r.subject: r.docs for r in S.composition(S.assign(f, m), d).collect()}
    assert shares["law"] == sum("law" in x for x in got.values())
    assert S.assign(f.filter("false"), m).count() == 0


def test_no_labels(spark):
    d = spark.createDataFrame([(1, "court")], "doc_id long, text string")
    lab = spark.createDataFrame([], "doc_id long, subject string, labeller string")
    f = S.featurise(d)
    m = S.train(f, lab, spark.createDataFrame([("law",)], "subject string"))
    assert S.assign(f, m).count() == 0


def test_sentences():
    assert S.sentences("<p>One &amp; two.</p> THREE? traitÃ©\nx") == ["one & two.", "three?", "traité", "x"]
    assert S.sentences(None) == [] and S.sentences("") == []


def test_logistic():
    r = np.random.default_rng(0)
    x = np.column_stack([np.ones(4000), r.normal(size=4000)])
    y = (r.random(4000) < 1 / (1 + np.exp(-(0.5 + 2 * x[:, 1])))).astype(float)
    assert np.allclose(S.fit_logistic(x, y), [0.5, 2], atol=0.25)
