"""Fits on cells against Spark's own estimators on rows, and the elimination over them."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import forest, models, regression, selection
from tallyfold.plans.catalogue import REGISTRY

INPUTS = ["a", "b", "c"]


def _values(n=3000, seed=0):
    draw = np.random.default_rng(seed)
    a, b, c = draw.normal(size=n), draw.integers(0, 5, n).astype(float), np.where(draw.random(n) < 0.4, 0.5, draw.random(n))
    return a, b, c, np.rint(3 * (a > 0.3) + b * (c > 0.4) + draw.normal(size=n) * 4)


def _rows(spark, n=3000, seed=0):
    rows = [(i, int(i % 4), *map(float, r)) for i, r in enumerate(zip(*_values(n, seed), strict=True))]
    return spark.createDataFrame(rows, "id bigint, fold int, a double, b double, c double, y double")


def _lists(inputs=INPUTS):
    return {k: list(inputs) for k in range(4)}


def _held(model, cells):
    p, n = F.col("predicted"), F.col("rows")
    error = F.sum(F.col("squares") - 2 * p * n * F.col("y") + n * p * p) / F.sum(n)
    return {r["model"]: r["mse"] for r in models.prediction(model, cells.filter("fold = model")).groupBy("model").agg(error.alias("mse")).collect()}


@pytest.mark.parametrize("kind,ours,theirs", [("tree", {"maxDepth": 5}, {"maxDepth": 5}), ("boosting", {"maxIter": 6, "maxDepth": 3}, {"maxIter": 6, "maxDepth": 3})])
def test_fits_on_cells_equal_the_estimators_on_rows(spark, kind, ours, theirs):
    df = _rows(spark)
    cells = models.fold_cells(df, INPUTS, "y", "fold", range(4)).cache()
    model = models.tree_regression(cells, INPUTS, "y", kind, lists=_lists(), **ours)
    losses = _held(model, cells)
    for k in (0, 3):
        plain = models.tree_regression(df.filter(f"fold != {k}"), INPUTS, "y", kind, **theirs)
        assert np.allclose([model.importances[k][c] for c in INPUTS], plain.stages[-1].featureImportances.toArray(), atol=1e-9)
        want = models.prediction(plain, df.filter(f"fold = {k}")).selectExpr("avg((y - predicted) * (y - predicted))").first()[0]
        assert losses[k] == pytest.approx(want, abs=1e-9)


def test_forest_grows_each_tree_from_all_rows_of_its_sample(spark):
    df, (a, b, c, y) = _rows(spark, 1500), _values(1500)
    edges = models.fold_edges(df, INPUTS, "y", "fold", _lists())
    fits = []
    for parts in (1, 5):
        seen = models.fold_samples(df.repartition(parts), INPUTS, "y", "fold", edges, "id", trees=3)
        fits.append(models.tree_regression(seen, INPUTS, "y", "forest", lists=_lists(), maxDepth=30))
    cells = models.fold_cells(df, INPUTS, "y", "fold", range(4), edges=edges)
    assert all(fits[0].importances[k] == pytest.approx(fits[1].importances[k]) for k in range(4))
    assert _held(fits[0], cells) == pytest.approx(_held(fits[1], cells))
    draw = np.array([r[0] for r in df.orderBy("id").select(F.xxhash64("id")).collect()])
    outside = np.arange(1500) % 4 != 2
    shares = []
    for tree in range(3):
        w = forest.drawn(draw, tree, models.SEED)[outside].astype(float)
        bins = np.stack([np.searchsorted(edges[2][n], v[outside], "left") for n, v in zip(INPUTS, (a, b, c), strict=True)]).astype(np.uint8)
        _, falls = regression.grown(bins[:, w > 0], w[w > 0], y[outside][w > 0], 30, 1)
        shares.append(falls / falls.sum())
    assert [fits[0].importances[2][n] for n in INPUTS] == pytest.approx(list(np.mean(shares, axis=0)), abs=1e-4)


def test_thresholds_of_larger_tables_are_those_of_all_rows(spark, monkeypatch):
    """Before, tables of more than 100 000 rows were sampled for them."""
    n = 6000
    a, b, c, y = _values(n, 3)
    heavy = np.where(np.arange(n) % 3 == 0, 7.0, np.where(np.arange(n) % 7 == 0, 7.5, np.round(a, 2)))
    gaps = np.where(np.arange(n) % 5 == 0, np.nan, c)
    names = ["a", "b", "c", "heavy", "gaps"]
    rows = [(int(i % 4), 0, float(y[i]), *(float(v[i]) for v in (a, b, c, heavy)), None if i % 10 == 0 else float(gaps[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "fold int, draw bigint, _y double, " + ", ".join(f"{x} double" for x in names))
    df = df.orderBy(F.col("gaps").isNull(), "gaps").coalesce(3).union(df.filter("gaps IS NULL").limit(0))
    lists = {0: names, 1: names, 2: ["a", "heavy"], 3: ["b", "c"], 9: names}
    want = regression.fold_edges(df, names, lists)
    for ranges in (4, 50, 2000):
        monkeypatch.setattr(regression, "RANGES", ranges)
        found = regression.fold_edges(df, names, lists, few=0)
        assert {k: {x: list(v) for x, v in e.items()} for k, e in found.items()} == {k: {x: list(v) for x, v in e.items()} for k, e in want.items()}
    assert list(want[2]["a"]) == list(models.split_candidates(a[np.arange(n) % 4 != 2], 32))


def test_inputs_that_are_not_listed_may_be_missing(spark):
    rows = [(i % 2, None if i % 3 == 0 else float(i % 5), float("nan") if i % 4 == 0 else float(i % 7), float(i % 5)) for i in range(420)]
    df = spark.createDataFrame(rows, "fold int, a double, b double, y double")
    lists = {0: ["a"], 1: ["a", "b"]}
    edges = models.fold_edges(df, ["a", "b"], "y", "fold", lists)
    cells = models.fold_cells(df, ["a", "b"], "y", "fold", [0, 1], edges=edges)
    assert {r["model"]: r["n"] for r in cells.groupBy("model").agg(F.sum("rows").alias("n")).collect()} == {0: 280, 1: 210}
    model = models.tree_regression(cells, ["a", "b"], "y", "tree", lists=lists, maxDepth=9)
    assert _held(model, cells) == pytest.approx({0: 0.0, 1: 0.0}) and model.importances[0] == {"a": 1.0}
    with pytest.raises(ValueError, match="no rows"):
        models.tree_regression(cells.limit(0), ["a", "b"], "y", "tree", lists=lists)


def test_each_fold_eliminates_on_its_own():
    """Before, all folds dropped the same input, by the sum of their importances, and no fit saw all rows."""
    asked, drops = [], {0: ["b", "c", "a"], 1: ["a", "b", "c"], 2: ["c", "b", "a"]}

    def fits(lists):
        asked.append({k: tuple(v) for k, v in lists.items()})
        size = len(lists[0])
        return {k: ({1: 5.0}.get(k) if size == 2 else float(size), {c: drops[k].index(c) for c in v}) for k, v in lists.items()}

    trail = selection.recursive_elimination(["a", "b", "c"], [1, 2], fits)
    assert asked == [{k: ("a", "b", "c") for k in range(3)}, {0: ("a", "c"), 1: ("b", "c"), 2: ("a", "b")}, {0: ("a",), 1: ("c",), 2: ("a",)}]
    assert [(e["inputs"], e["loss"], e["drops"], e["best"]) for e in trail] == [
        (["a", "b", "c"], 3.0, "b", False), (["a", "c"], 5.0, "c", False), (["a"], 1.0, "a", True)
    ]


def test_select_rfe_runs_every_estimator(spark):
    """Before, the elimination ran by the tree only."""
    rows = REGISTRY["select_rfe"].run(spark, "/root/testdata/sf0.001").collect()
    assert [(r["estimator"], r["n"]) for r in rows] == [(e, n) for e in ("tree", "boosting", "forest") for n in (3, 2, 1)]
    assert all(math.isfinite(r["loss"]) and r["drops"] in r["inputs"].split(",") for r in rows)
    assert {e: sum(r["best"] for r in rows if r["estimator"] == e) for e in ("tree", "boosting", "forest")} == {"tree": 1, "boosting": 1, "forest": 1}
