"""Interactions of terms that say nothing alone, and the screen's counts."""

from __future__ import annotations

import numpy as np
import pytest

from tallyfold.llm import factorization

NOISE = [f"{a}{b}" for a in "bcdfghjklm" for b in ("ana", "oro", "ulu", "ene", "ipi", "asa")]


def rows_of(n, seed, verdict):
    draw = np.random.default_rng(seed)
    texts, labels = [], []
    for _ in range(n):
        words = list(draw.choice(NOISE, 8))
        group, insult = (draw.random(2) < 0.5).tolist()
        texts.append(" ".join(draw.permutation(words + ["vexum"] * group + ["quorn"] * insult)))
        labels.append(int(verdict(group, insult, draw.random())))
    return texts, labels


@pytest.mark.parametrize(
    "verdict",
    [lambda a, b, u: a == b, lambda a, b, u: a and b, lambda a, b, u: u < (0.9 if a and b else 0.1 if a or b else 0.5)],
    ids=["both or none", "both", "neutral alone, noisy"],
)
def test_pairs_of_neutral_terms_are_learned(spark, verdict):
    texts, labels = rows_of(6000, 1, verdict)
    rows = spark.createDataFrame([(i, t, y) for i, (t, y) in enumerate(zip(texts, labels, strict=True))], "doc_id long, text string, label int")
    model = factorization.learn(rows)
    assert len(model[0]) >= 2
    fresh, truth = rows_of(600, 2, verdict)
    out = factorization.score(spark.createDataFrame(list(enumerate(fresh)), "doc_id long, text string"), model).collect()
    score = np.array([r["score"] for r in sorted(out, key=lambda r: r["doc_id"])])
    wrong = np.mean((score >= 0.5) != np.array(truth))
    best = np.mean([min(np.mean(np.array([verdict(a, b, u) for u in np.linspace(0, 1, 101)])), 1 - np.mean(np.array([verdict(a, b, u) for u in np.linspace(0, 1, 101)]))) for a in (False, True) for b in (False, True)])
    assert wrong <= best + 0.06


def test_screen_counts_all_labelled_rows(spark):
    """A term of 40 rows among 8000 is known although the fit sees 400 rows."""
    draw = np.random.default_rng(3)
    rows = [(i, " ".join(draw.choice(NOISE, 6)) + (" zlurr" if i % 200 == 0 else ""), int(i % 200 == 0 or i % 2)) for i in range(8000)]
    seen = {}
    fit = factorization.fit

    def spy(features, labels, seed=1, tally=None):
        seen["tally"], seen["n"] = tally, len(labels)
        return fit(features, labels, seed, tally)

    factorization.fit = spy
    try:
        factorization.learn(spark.createDataFrame(rows, "doc_id long, text string, label int"), sample=400)
    finally:
        factorization.fit = fit
    slots, present, positive, n, hits = seen["tally"]
    assert n == 8000 and hits == sum(r[2] for r in rows) and 200 < seen["n"] < 600
    assert sorted(present.tolist())[0] == 40 and positive[present == 40].tolist() == [40]


def test_labels_of_another_table_with_odd_rows(spark):
    """Null and repeated keys, null and empty texts, null labels, clashing names, empty tables."""
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (4, "one two"), (None, "one two"), (5, "12 ###"), (6, "é" * 50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS slots", "2 AS label", "3 AS row_key", "4 AS of")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (4, 1), (4, 0), (None, 1), (99, 1)], "doc_id long, label int")
    for d, marks in ((docs, labels), (docs.limit(0), labels), (docs, labels.limit(0))):
        out = factorization.score(docs, factorization.learn(d, labels=marks)).collect()
        assert len(out) == len(rows) and all(0 < r["score"] < 1 for r in out)


def test_steps_give_the_terms_back():
    import pyarrow as pa

    texts = pa.array(["zeta alpha beta " * 3, None, "", "q w e r t y u i o p " + " ".join(NOISE)])
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    (hashed,) = factorization._hashed(iter([batch]))
    for got, want in zip(factorization._unhashed(hashed.column("slots")), factorization.terms(batch), strict=True):
        assert got.tolist() == want.tolist()
