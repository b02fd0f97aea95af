"""Boosting, exact likelihood, exact neighbours and exact order statistics against plain Python."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallyfold.operators import boosting, ranking, series, synth
from tallyfold.session import cut_lineage


def _rows(spark, n=4000, seed=0):
    """y depends on a, and on whether b is missing: only a search over both sides of a split sees that."""
    draw = np.random.default_rng(seed)
    a, b = draw.normal(size=n), draw.normal(size=n)
    gone = draw.random(n) < 0.3
    p = 1 / (1 + np.exp(-(1.5 * a + np.where(gone, 2.0, -1.0))))
    y = (draw.random(n) < p).astype(int)
    held = draw.random(n) < 0.3
    rows = [(i, float(a[i]), None if gone[i] else float(b[i]), int(y[i]), bool(held[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, y int, held boolean")


def _plain(x, y, rounds, rate, depth, ridge):
    """The same greedy trees over all distinct thresholds, missing on both sides; margins of the rows."""
    margin = np.zeros(len(y))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)

        def grow(rows, d, g=g, h=h):
            total_g, total_h = g[rows].sum(), h[rows].sum()
            best = None
            for f in range(x.shape[1]) if d < depth else ():
                v = x[rows, f]
                for missing_left in (False, True):
                    if missing_left and not np.isnan(v).any():
                        continue
                    for t in np.unique(v[~np.isnan(v)])[:-1]:
                        left = (v <= t) | (np.isnan(v) & missing_left)
                        gl, hl = g[rows][left].sum(), h[rows][left].sum()
                        if hl < 1 or total_h - hl < 1:
                            continue
                        gain = gl**2 / (hl + ridge) + (total_g - gl) ** 2 / (total_h - hl + ridge) - total_g**2 / (total_h + ridge)
                        if gain > 1e-9 and (best is None or gain > best[0] + 1e-9):
                            best = (gain, left)
            if best is None:
                return [(rows, -rate * total_g / (total_h + ridge))]
            return grow(rows[best[1]], d + 1) + grow(rows[~best[1]], d + 1)

        for rows, value in grow(np.arange(len(y)), 0):
            margin[rows] += value
    return margin


def test_boosting_equals_plain_trees(spark):
    """With a bin for each value the histograms lose nothing."""
    df = _rows(spark, 300).withColumn("a", F.round("a", 1)).withColumn("b", F.round("b", 1))
    model = boosting.second_order(df, ["a", "b"], "y", "id", trees=4, depth=2, bins=400)
    rows = df.withColumn("m", model.margin()).orderBy("id").collect()
    x = np.array([[r["a"], math.nan if r["b"] is None else r["b"]] for r in rows])
    want = _plain(x, np.array([r["y"] for r in rows]), 4, 0.1, 2, 1.0)
    assert np.allclose([r["m"] for r in rows], want, atol=1e-5)


def test_boosting_uses_what_is_missing_and_does_not_depend_on_partitions(spark):
    df = _rows(spark)
    settings = {"trees": 30, "validation": "held", "patience": 5, "subsample": 0.5, "metric": "loss"}
    one = boosting.second_order(df.repartition(1), ["a", "b"], "y", "id", **settings)
    many = boosting.second_order(df.repartition(7), ["a", "b"], "y", "id", **settings)
    assert one.trees == many.trees and one.trail == many.trail
    assert one.importance["b"] > 0.2
    kept = next(t for t in one.trail if t["kept"])
    assert kept["valid_wrong"] < 0.24 and len(one.trees.roots) == kept["round"]
    assert all(t["train_loss"] <= one.trail[0]["train_loss"] for t in one.trail)


def test_boosting_stops_on_stagnant_error(spark):
    """The best round is kept, and no more than `patience` rounds follow it."""
    model = boosting.second_order(_rows(spark, 1500), ["a", "b"], "y", "id", trees=60, depth=5, leaf=5, bins=50, validation="held", metric="wrong", patience=5)
    kept = next(t for t in model.trail if t["kept"])
    assert kept["valid_wrong"] == min(t["valid_wrong"] for t in model.trail)
    assert len(model.trail) - 1 == min(60, kept["round"] + 5)


def test_boosting_of_odd_tables(spark):
    schema = "id long, a double, b double, y int, held boolean"
    empty = boosting.second_order(spark.createDataFrame([], schema), ["a", "b"], "y", "id", trees=3)
    assert empty.trees.roots == ()
    rows = [(1, None, math.nan, 1, False), (2, None, None, 0, False), (3, None, None, 1, None), (4, 1.0, 2.0, None, False)]
    df = spark.createDataFrame(rows, schema)
    out = df.withColumn("p", boosting.second_order(df, ["a", "b"], "y", "id", trees=3, validation="held").probability()).collect()
    assert len({round(r["p"], 12) for r in out}) == 1 and 0.5 < out[0]["p"] < 1


def _likelihood(runs, phi, mean):
    n = sum(len(r) for r in runs)
    s = sum((1 - phi**2) * (r[0] - mean) ** 2 + sum((b - mean - phi * (a - mean)) ** 2 for a, b in zip(r, r[1:], strict=False)) for r in runs)
    return n * math.log(s) - len(runs) * math.log(1 - phi**2)


def test_ar1_likelihood_is_a_maximum(spark):
    """Against a fine grid over phi and the mean, for a series with gaps and one with a large drift."""
    draw = np.random.default_rng(2)
    rows = []
    for name, phi, drift, gaps in (("a", 0.6, 0.01, {20, 21, 50}), ("b", -0.4, 3.0, set())):
        d, y = 0.0, 0.0
        for t in range(80):
            d = phi * d + draw.normal(0, 0.1)
            y += d + drift
            if t not in gaps:
                rows.append((name, t, math.exp(y) if name == "a" else math.exp(min(y, 600))))
    rows += [("c", t, 2.0**t) for t in range(6)] + [("d", 1, 5.0), ("e", 1, -1.0), ("e", 2, None)]
    df = spark.createDataFrame(rows, "s string, t int, v double")
    got = {r["s"]: r for r in series.ar1_likelihood(df, "s", "t", "v").collect()}
    for name in "ab":
        at = {t: math.log(v) for s, t, v in rows if s == name}
        runs, last = [], None
        for t in sorted(at):
            if t - 1 in at:
                runs = [*runs[:-1], [*runs[-1], at[t] - at[t - 1]]] if last == t - 1 else [*runs, [at[t] - at[t - 1]]]
                last = t
        r = got[name]
        here = _likelihood(runs, r["phi"], r["mean"])
        assert abs(r["slope"]) < 1e-6 and r["n"] == sum(map(len, runs))
        for step in (1e-3, 0.05):
            for i, j in ((1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (-1, 1)):
                assert here <= _likelihood(runs, r["phi"] + i * step, r["mean"] + j * step * 0.1) + 1e-9
    assert got["c"]["phi"] is None and got["d"]["phi"] is None and "e" not in got


def _brute_neighbours(ids, x, k):
    d = np.round(np.sqrt(((x[:, None, :] - x[None]) ** 2).sum(2)), 9)
    return {i: [j for _, j in sorted((d[a, b], ids[b]) for b in range(len(ids)) if ids[b] != i)[:k]] for a, i in enumerate(ids)}


@pytest.mark.parametrize("heaps", [0, 40])
def test_neighbours_are_exact_at_2000_rows(spark, monkeypatch, heaps):
    """Blocks of 100 rows, groups of 300; spread evenly or gathered, with repeated vectors."""
    monkeypatch.setattr(synth, "BLOCK", 100)
    monkeypatch.setattr(synth, "ASKING", 300)
    draw = np.random.default_rng(heaps)
    x = draw.normal(size=(2000, 6)) if not heaps else draw.normal(size=(heaps, 6))[draw.integers(0, heaps, 2000)] * 20 + draw.normal(size=(2000, 6))
    x[100:120] = x[99]
    ids = [7 * i for i in range(2000)]
    odd = [(90001, None), (90002, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (90003, [math.nan] * 6)]
    df = spark.createDataFrame([*zip(ids, x.tolist(), strict=True), *odd], "id long, v array<double>")
    got = {r["id"]: [n["id"] for n in r["_n"]] for r in synth.nearest_neighbours(df, "id", "v", 5).collect()}
    assert got == _brute_neighbours(ids, x, 5)


def test_smote_gives_the_rows_asked_for(spark):
    draw = np.random.default_rng(5)
    rows = [(i, draw.normal(size=3).tolist(), int(i < 30)) for i in range(60)]
    df = spark.createDataFrame(rows, "id long, v array<double>, label int")
    made = synth.smote(df, "id", "v", "label", 1, num_rows=100).collect()
    assert len(made) == 100 and {r["id"] for r in made} == set(range(30))
    assert max(r["copy"] for r in made) == 4 and all(r["neighbour"] < 30 for r in made)
    few = synth.smote(df, "id", "v", "label", 1, num_rows=7, neighbours=50).collect()
    assert len(few) == 7
    assert synth.smote(df.filter("id = 0"), "id", "v", "label", 1, per_row=3).count() == 0
    assert synth.smote(df.filter("id < 0"), "id", "v", "label", 1, num_rows=3).count() == 0


def test_order_statistics_of_many_columns(spark, monkeypatch):
    """Coarse sketches, a hot value, missing values, an empty column: the ranks are exact all the same."""
    monkeypatch.setattr(ranking, "SKETCH", 20)
    draw = np.random.default_rng(1)
    rows = [(float(v), 5.0 if i % 3 else float(i), None if i % 2 else i, None) for i, v in enumerate(draw.lognormal(0, 5, 3000))]
    df = spark.createDataFrame(rows, "a double, b double, c int, d double")
    ranks = [1, 2, 750, 1499, 1500]
    got = ranking.order_statistics_of(df, {c: ranks for c in "abcd"})
    for i, c in enumerate("abc"):
        values = sorted(float(r[i]) for r in rows if r[i] is not None)
        assert got[c] == {r: values[r - 1] for r in ranks}
    assert got["d"] == {}


def test_mixtures_equal_the_estimator_in_one_pass_a_round(spark, monkeypatch):
    """Spark's estimator gives the starts only; all numbers of components climb together to where it would end."""
    draw = np.random.default_rng(4)
    values = np.concatenate([draw.normal(0, 1, 300), draw.normal(9, 2, 200), [0.0] * 20]).round(3).tolist()
    df = spark.createDataFrame([(v,) for v in [*values, None, None]], "v double")
    rows = VectorAssembler(inputCols=["v"], outputCol="features", handleInvalid="skip").transform(df).select("features")
    want, low = None, math.inf
    for k in range(2, 5):
        model = GaussianMixture(k=k, seed=1, maxIter=50).fit(cut_lineage(rows))
        bic = -2 * model.summary.logLikelihood + (3 * k - 1) * math.log(len(values))
        if bic < low:
            want, low = model, bic
    asked = []
    monkeypatch.setattr(synth, "GaussianMixture", lambda **p: asked.append(p["maxIter"]) or GaussianMixture(**p))
    got = synth.mixture_table(df, "v", max_clusters=4)
    assert asked == [0, 0, 0]
    assert [i for i, *_ in got] == list(range(len(want.weights)))
    for (_, w, mean, std), weight, g in zip(got, want.weights, want.gaussians, strict=True):
        assert np.allclose([w, mean, std], [weight, g.mean[0], math.sqrt(g.cov.toArray()[0][0])], rtol=1e-6)


def test_histograms_have_a_cell_for_each_bin_whatever_the_rows():
    """Whole sums by open node, input and bin; a leaf that is not open and a row that does not train count nowhere."""
    draw = np.random.default_rng(5)
    n = 3000
    bins = draw.integers(0, 4, (2, n)).astype(np.uint8)
    y, role = draw.integers(0, 2, n).astype(float), draw.integers(0, 2, n).astype(np.int8)
    tree = {"feature": [0, 0, 0], "bin": [1, 0, 0], "missing_left": [True, False, False], "left": [1, -1, -1], "right": [2, -1, -1], "value": [0.0, 0.5, -0.5], "open": [2]}
    block = boosting._Block(bins, y, role, np.zeros(n, dtype=np.int64), np.zeros(n))
    _, sums = boosting._cells(block, [], tree, np.array([3, 3]), 4, 1 << 32, 0)
    assert sums.shape == (1, 2, 3, 4)
    inside = (role == 0) & np.isin(bins[0], [2])
    for f in range(2):
        for b in range(4):
            at = inside & (bins[f] == b)
            assert sums[0, f, :, b].tolist() == [int(((0.5 - y[at]) * boosting.UNIT).sum()), int(at.sum()) * boosting.UNIT // 4, int(at.sum())]
    losses, _ = boosting._cells(block, [tree], None, np.array([3, 3]), 4, 1 << 32, 0)
    assert losses[:, 2].tolist() == [int((role == 0).sum()), int((role == 1).sum())]


def test_score_code_walks_rows_together(spark):
    """No fold over trees inside a row; null, NaN and infinite inputs, a leaf above others, an empty table."""
    trees = boosting.FlatTrees(
        ("a", "b"), (0, 3), (0, 0, 0, 1, 0, 0, 0, 0), (1.0, 0.0, 0.0, 2.0, 0.0, 0.5, 0.0, 0.0),
        (True, False, False, False, False, True, False, False), (1, -1, -1, 4, -1, 6, -1, -1), (2, -1, -1, 5, -1, 7, -1, -1),
        (0.0, 1.0, 10.0, 0.0, 100.0, 0.0, 1000.0, 10000.0), 2,
    )
    rows = [(1.0, 2, 101.0), (1.5, 3, 10010.0), (None, None, 1001.0), (math.nan, 2, 101.0), (math.inf, None, 10010.0), (-math.inf, 9, 1001.0)]
    df = spark.createDataFrame(rows, "a double, b int, want double")
    out = df.withColumn("m", trees.margin(0.25))
    assert all(r["m"] == r["want"] + 0.25 for r in out.collect())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "lambdafunction" not in plan
    assert out.limit(0).count() == 0 and trees.first(0).roots == ()
