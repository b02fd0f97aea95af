"""Random forest: the upper levels and the tasks' subtrees give one model, whatever the partitions."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.operators import forest, models


def _rows(spark, n=3000):
    rng = np.random.default_rng(4)
    a, b, c = rng.random(n), rng.integers(0, 4, n), rng.random(n)
    y = ((a > 0.5) ^ (b > 1)) ^ (rng.random(n) < 0.1)
    rows = [(i, float(a[i]), int(b[i]), None if i % 50 == 0 else float("nan") if i % 50 == 1 else float(c[i]), int(y[i])) for i in range(n)]
    return spark.createDataFrame(rows, "id bigint, a double, b int, c double, y int")


def _scores(model, df):
    return {r["id"]: r["p"] for r in models.probability(model, df).collect()}


def test_histograms_and_tasks_grow_the_same_trees(spark):
    """Before, draws depended on partitions and each level was summed over all tasks."""
    df = _rows(spark)
    whole = _scores(forest.fit(df, ["a", "b", "c"], "y", 5, 12, 5, key="id"), df)
    upper = forest.fit(df.repartition(3), ["a", "b", "c"], "y", 5, 12, 5, key="id", small=200)
    assert max(len(t.left) for t in upper.tops) > 7
    parts = _scores(upper, df.repartition(5))
    assert whole.keys() == parts.keys() == {i for i in range(3000) if i % 50 > 1}
    assert max(abs(whole[i] - parts[i]) for i in whole) < 1e-12
    right = {r["id"]: r["y"] for r in df.collect()}
    assert np.mean([(p >= 0.5) == right[i] for i, p in whole.items()]) > 0.85


def test_leaves_hold_enough_rows_and_sample_counts_are_poisson(spark):
    draw = np.random.default_rng(1).integers(-(2**62), 2**62, 100_000)
    counts = np.bincount(forest.drawn(draw, 3, 12345), minlength=4) / len(draw)
    assert abs(counts[:4] - np.array([0.3679, 0.3679, 0.1839, 0.0613])).max() < 0.01
    df = _rows(spark, 500)
    model = forest.fit(df, ["a", "b"], "y", 3, 20, 40, key="id")
    for r in model.subtrees.collect():
        left, share = np.frombuffer(r["left"], dtype=np.int32), np.frombuffer(r["share"], dtype=np.float64)
        assert len(left) == len(share) == r["n_nodes"] <= 2 * 700 // 40
        inner = np.flatnonzero(left != forest.LEAF)
        assert (left[inner] > inner).all() and (left[inner] + 1 < len(left)).all()


def test_one_class_and_no_rows(spark):
    df = spark.createDataFrame([(i, 1.0, 0) for i in range(20)], "id bigint, a double, y int")
    assert set(_scores(models.forest(df, ["a"], "y", trees=2, key="id"), df).values()) == {0.0}
    with pytest.raises(ValueError, match="training rows"):
        models.forest(df.filter("y = 1"), ["a"], "y")


def test_equal_rows_are_one_entry_with_their_counts(spark):
    """What the trees read is bounded by the bins; before, every level and the scoring read all rows."""
    rng = np.random.default_rng(8)
    a, y, draw = rng.integers(0, 5, 6000), rng.integers(0, 2, 6000), rng.integers(-(2**62), 2**62, 6000)
    df = spark.createDataFrame([(int(d), int(t), float(v)) for d, t, v in zip(draw, y, a, strict=True)], "draw bigint, y int, x0 double").repartition(4)
    blocks = forest._entries(forest._with_codes(df, [F.col("x0")], [np.arange(4) + 0.5]), 6000, 1, 3, 7)
    assert blocks.agg(F.sum("entries")).first()[0] == 10
    for batch in blocks.toArrow().to_batches():
        for bins, classes, counts in forest._blocks(batch, 1, 3):
            for tree in range(3):
                want = [forest.drawn(draw[(a == b) & (y == t)], tree, 7).sum() for b, t in zip(bins[0], classes, strict=True)]
                assert counts[tree].tolist() == want
    model = forest.fit(df, ["x0"], "y", 2, 5, 5, key="draw")
    scores = model.probability(df.repartition(3))
    assert scores.count() == 6000 and scores.groupBy("x0").agg(F.count_distinct("p").alias("n")).filter("n > 1").count() == 0


def test_many_inputs_share_several_longs(spark):
    rng = np.random.default_rng(9)
    x, names = rng.integers(0, 6, (2000, 9)), [f"_c{i}" for i in range(9)]
    rows = [(i, *map(int, r), int(r[8] > 2)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ", ".join(["id bigint", *(f"{c} int" for c in names), "y int"]))
    whole, parts = (_scores(forest.fit(df, names, "y", 9, 6, 5, key="id", small=k), df) for k in (1 << 20, 150))
    assert max(abs(whole[i] - parts[i]) for i in whole) < 1e-12
    assert np.mean([(whole[i] >= 0.5) == (x[i, 8] > 2) for i in whole]) > 0.9
    codes = [np.array([int.from_bytes(bytes([1, 2, 3, 4, 5, 6, 255]), "big")]), np.array([8 << 8 | 9])]
    assert forest._bins(codes, 9)[:, 0].tolist() == [1, 2, 3, 4, 5, 6, 255, 8, 9]


def test_trees_on_cells_equal_trees_on_rows(spark):
    """The rows a fit reads do not grow with the table; before, every fit read all rows."""
    rng = np.random.default_rng(2)
    n = 4000
    a, b = rng.random(n), rng.integers(0, 5, n)
    y = np.where(a > 0.4, 3.0, 0.0) + b + rng.normal(size=n)
    rows = [(int(i % 3), None if i % 40 == 0 else float(a[i]), int(b[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "fold int, a double, b int, y double")
    cells = models.fold_cells(df, ["a", "b"], "y", "fold", range(3)).cache()
    assert cells.count() <= 3 * 3 * 32 * 5
    for k in range(2):
        plain = models.tree_regression(df.filter(f"fold != {k}"), ["a", "b"], "y", "tree", maxDepth=3)
        fitted = models.tree_regression(cells.filter(f"model = {k} AND fold != {k}"), ["a", "b"], "y", "tree", weight="rows", maxDepth=3, maxBins=64)
        assert np.allclose(plain.stages[-1].featureImportances.toArray(), fitted.stages[-1].featureImportances.toArray())
        e = models.prediction(plain, df.filter(f"fold = {k}")).selectExpr("avg((y - predicted) * (y - predicted))").first()[0]
        held = models.prediction(fitted, cells.filter(f"model = {k} AND fold = {k}"))
        f = held.selectExpr("sum(squares - 2 * predicted * rows * y + rows * predicted * predicted) / sum(rows)").first()[0]
        assert abs(e - f) < 1e-9
    with pytest.raises(Exception, match="MUST NOT be Null"):
        models.fold_cells(df.withColumn("y", F.when(F.col("b") > 0, F.col("y"))), ["a", "b"], "y", "fold", range(3)).collect()


def test_split_candidates_cut_values_evenly():
    assert list(models.split_candidates(np.array([1.0, 1.0, 2.0, 4.0]), 32)) == [1.5, 3.0]
    cuts = models.split_candidates(np.arange(1000.0), 10)
    assert len(cuts) == 9 and abs(np.diff(cuts) - 100).max() <= 1
