"""The field against enumeration; its scores against held-out labels."""

import itertools
import math

import numpy as np

from tidewatch.llm import toxicity_crf as crf
from tidewatch.llm.queries import QUERIES

from .helpers import no_documents, odd_documents, odd_rows, remainder, table

SF = "/root/testdata/sf0.1"


def field(seed=1):
    rng = np.random.default_rng(seed)
    return crf.Field(np.zeros(4), 0.0, float(rng.normal()), rng.normal(size=(2, 2)),
                     np.zeros(crf.SUMMARY))


def enumerated(f, emissions):
    """Marginals by summing over all state sequences."""
    total, toxic = 0.0, np.zeros(len(emissions))
    for states in itertools.product((0, 1), repeat=len(emissions)):
        w = states[0] * f.start + sum(e * s for e, s in zip(emissions, states))
        w += sum(f.move[a, b] for a, b in zip(states, states[1:]))
        total += math.exp(w)
        toxic += math.exp(w) * np.array(states)
    return toxic / total


def test_marginals_are_enumerated(monkeypatch):
    rng = np.random.default_rng(3)
    documents = [rng.normal(size=n) * 2 for n in (1, 5, 9, 2, 1, 7)]
    first = np.concatenate([[True] + [False] * (len(d) - 1) for d in documents])
    f = field()
    want = np.concatenate([enumerated(f, d) for d in documents])
    for lane in (2, 4, 256):
        monkeypatch.setattr(crf, "LANE", lane)
        assert np.allclose(f.marginals(np.concatenate(documents), first), want)


def test_long_chain_is_plain_recursion():
    rng = np.random.default_rng(5)
    f, e = field(2), rng.normal(size=5000) * 3
    first = np.zeros(5000, bool)
    first[[0, 700, 701, 4000]] = True
    t = np.exp(f.move)
    alpha, beta = np.zeros((5000, 2)), np.ones((5000, 2))
    for i in range(5000):
        v = np.array([1, math.exp(f.start)]) if first[i] else alpha[i - 1] @ t
        alpha[i] = v * [1, math.exp(e[i])]
        alpha[i] /= alpha[i].sum()
    for i in range(4998, -1, -1):
        beta[i] = 1 if first[i + 1] else t @ (beta[i + 1] * [1, math.exp(e[i + 1])])
        beta[i] /= beta[i].sum()
    p = alpha * beta
    assert np.allclose(f.marginals(e, first), p[:, 1] / p.sum(1))


def test_held_out_documents(spark):
    label = {r.doc_id: r.toxic for r in table(spark, "labels", SF).collect()}
    got = QUERIES["op1_toxicity"](spark, SF).collect()
    assert len(got) == table(spark, "documents", SF).count()
    assert all(r.held_out == (remainder(r.doc_id, 4) == 2) and 0 <= r.score <= 1
               and r.predicted == (r.score >= 0.3) for r in got)
    held = [(r.predicted, label[r.doc_id]) for r in got if r.held_out and r.doc_id in label]
    hit = sum(p and t for p, t in held)
    print(len(held), hit, sum(t for _, t in held), sum(p for p, _ in held))
    assert hit / sum(t for _, t in held) > 0.9
    assert sum(p and not t for p, t in held) / sum(not t for _, t in held) < 0.02


def test_odd_rows(spark):
    docs, labels = table(spark, "documents", SF), table(spark, "labels", SF)
    fitted = crf.fit(docs, labels)
    got = crf.tag(odd_documents(spark), fitted).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((r[0] for r in odd_rows()), key=repr)
    assert all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id in (0, 1, 2)} == {0.0}
    assert crf.tag(no_documents(spark), fitted).collect() == []
    text = "You are an idiot moron, é and more words " + "fine " * 3000 + "scum"
    row = crf.tag(spark.createDataFrame([(1, text)], "doc_id bigint, text string"), fitted).first()
    assert [text[s.start:s.end] for s in row.spans] == ["idiot moron", "scum"]


def test_nothing_to_learn_from(spark):
    nothing = table(spark, "labels").limit(0)
    got = crf.tag(odd_documents(spark), crf.fit(odd_documents(spark), nothing)).collect()
    assert len(got) == len(odd_rows()) and not any(r.predicted for r in got)
