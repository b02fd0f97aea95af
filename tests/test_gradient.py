"""Boosting by histograms against Spark's own estimator, which it equals where nothing is drawn."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tallyfold.operators import gradient, models, scoring

INPUTS = ["a", "b", "c"]


def _rows(spark, n=3000, seed=0):
    draw = np.random.default_rng(seed)
    a, b, c = draw.normal(size=n), np.round(draw.normal(size=n), 1), draw.integers(0, 4, n)
    y = (draw.random(n) < 1 / (1 + np.exp(-(a - 2 * b * (c == 1) + 0.5 * c)))).astype(int)
    return spark.createDataFrame([(i, *map(float, r), int(t)) for i, (*r, t) in enumerate(zip(a, b, c, y, strict=True))], "id long, a double, b double, c double, y int")


def test_fit_equals_the_estimator(spark, monkeypatch):
    df = _rows(spark)
    monkeypatch.setattr(gradient, "BLOCK", 700)
    ours = models.boosted_trees(df.repartition(3), INPUTS, "y", trees=7, subsample=1.0, depth=4, bins=20, key="id")
    est = GBTClassifier(featuresCol="x", labelCol="y", maxIter=7, stepSize=0.1, subsamplingRate=1.0, maxDepth=4, minInstancesPerNode=5, maxBins=20, seed=1)
    theirs = Pipeline(stages=[VectorAssembler(inputCols=INPUTS, outputCol="x"), est]).fit(df)
    want = dict(zip(INPUTS, theirs.stages[-1].featureImportances.toArray(), strict=True))
    assert ours.importance == pytest.approx(want, abs=1e-5)
    p = [[r["p"] for r in models.probability(m, df).orderBy("id").collect()] for m in (ours, theirs)]
    assert np.allclose(*p, atol=1e-5)
    table = {r["variable"]: r["importance"] for r in models.importance_table(df, ours, INPUTS).collect()}
    assert table == ours.importance


def test_fit_does_not_depend_on_partitions_and_draws_each_round_anew(spark):
    df = _rows(spark, 2000)
    fits = [models.boosted_trees(df.repartition(k), INPUTS, "y", trees=6, depth=3, key="id") for k in (1, 5)]
    assert fits[0].grown == fits[1].grown and fits[0].importance == fits[1].importance
    draw = np.arange(1000, dtype=np.uint32) * np.uint32(4294967)
    rounds = [gradient.sampled(draw, k) < 1 << 31 for k in range(4)]
    assert all(400 < r.sum() < 600 for r in rounds) and len({r.tobytes() for r in rounds}) == 4
    both = models.probability(fits[0], df).withColumn("q", scoring.boosted_probability(scoring.flat_trees(fits[0], df, INPUTS)))
    assert both.filter("abs(p - q) < 1e-12").count() == 2000


def test_a_level_is_one_pass_over_the_drawn_rows(spark, monkeypatch):
    """The estimator reads all rows on every level; here only a tree's first pass does."""
    seen, histograms = [], gradient._histograms

    def counted(work, steps, opened, inputs):
        seen.append(work.map(lambda w: w[0].shape[1]).sum())
        return histograms(work, steps, opened, inputs)

    monkeypatch.setattr(gradient, "_histograms", counted)
    models.boosted_trees(_rows(spark, 1000), INPUTS, "y", trees=2, depth=2, subsample=0.25, key="id")
    assert len(seen) == 4 and all(150 < k < 350 for k in seen)


def test_odd_tables(spark):
    schema = "id long, a double, b double, c double, y int"
    rows = [(None, 1.0, 2.0, 0.0, 1), (None, 1.0, 2.0, 0.0, 0), (1, None, 1.0, 1.0, 1), (2, float("nan"), 1.0, 1.0, 0)] * 6
    df = spark.createDataFrame(rows, schema)
    model = models.boosted_trees(df, INPUTS, "y", trees=3, key="id")
    assert models.probability(model, df).count() == 12 and model.importance == dict.fromkeys(INPUTS, 0.0)
    one = models.boosted_trees(df.filter("y = 1"), INPUTS, "y", trees=3)
    assert models.probability(one, df).agg(F.min("p")).first()[0] > 0.5
    with pytest.raises(ValueError, match="no rows"):
        models.boosted_trees(df.limit(0), INPUTS, "y")
    for bad in (None, 2):
        with pytest.raises(Exception, match="0 or 1"):
            models.boosted_trees(df.union(spark.createDataFrame([(9, 1.0, 1.0, 1.0, bad)], schema)), INPUTS, "y")
