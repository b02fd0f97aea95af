"""Scoring tables with coefficients, stored trees and vectorised functions."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold.functions.scalar import linear_predictor, logistic
from tallyfold.operators.boosting import LEAF, FlatTrees
from tallyfold.operators.gradient import GradientBoosted
from tallyfold.session import scratch_path


def score_logit(
    df: DataFrame, coefs: Mapping[str, float], intercept: float, target: str, cut: float = 0.5
) -> DataFrame:
    """Adds P_<target>1, P_<target>0 and I_<target>. A missing input gives NULL scores (a sum
    with NULL is NULL) and a blank class. Each step is a column, so it is computed once."""
    p1 = f"P_{target}1"
    scored = df.withColumn("_xbeta", linear_predictor(coefs, intercept)).withColumn(p1, logistic("_xbeta"))
    return scored.drop("_xbeta").withColumns({f"P_{target}0": 1 - F.col(p1), f"I_{target}": classify(p1, cut)})


def classify(p: str | Column, cut: float | Column, op: str = ">=") -> Column:
    p = F.col(p) if isinstance(p, str) else p
    said = p >= cut if op == ">=" else p > cut
    return F.when(p.isNull(), "").when(said, "1").otherwise("0")


def odds_points(
    log_odds: Column, target_score: float = 600, target_odds: float = 30, points_to_double: float = 20
) -> Column:
    """Scorecard points: offset + factor * log odds."""
    factor = points_to_double / math.log(2)
    offset = target_score - factor * math.log(target_odds)
    return F.lit(offset) + F.lit(factor) * log_odds


def ensemble_mean(probabilities: Sequence[Column]) -> Column:
    total = probabilities[0]
    for p in probabilities[1:]:
        total = total + p
    return total / float(len(probabilities))


def score_batches(
    df: DataFrame, inputs: Sequence[str], outputs: StructType | str, score: Callable[..., pd.DataFrame]
) -> DataFrame:
    """Score with a vectorised Python function of the input series, in argument order.

    The function gets Arrow batches, never the whole table; its outputs join the row as columns.
    """

    @F.pandas_udf(outputs)
    def run(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for columns in batches:
            yield score(*columns)

    return df.withColumn("_out", run(*[F.col(c) for c in inputs])).select(*df.columns, "_out.*")


def _tree_rows(model: PipelineModel, df: DataFrame) -> tuple[list, list[float]]:
    """Nodes and weights of the last stage, through Spark's documented save format."""
    trees = model.stages[-1]
    path = scratch_path(df.sparkSession, "trees")
    trees.write().overwrite().save(path)
    rows = df.sparkSession.read.parquet(f"{path}/data").collect()
    return rows, [float(w) for w in trees.treeWeights]


def flat_trees(model: PipelineModel | GradientBoosted, df: DataFrame, inputs: Sequence[str]) -> FlatTrees:
    """A boosted classifier of any number of trees as flat node arrays; see FlatTrees.

    The driver holds the nodes only (trees x 2^depth), never data. Inputs are numbers; the
    trees' weights are in the leaves.
    """
    if isinstance(model, GradientBoosted):
        return model.flat()
    rows, weights = _tree_rows(model, df)
    trees: dict[int, dict[int, object]] = {}
    for r in rows:
        trees.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]
    parts: dict[str, list] = {c: [] for c in ("roots", "feature", "threshold", "missing_left", "left", "right", "value")}
    deepest = 0
    for t in sorted(trees):
        base = len(parts["left"])
        parts["roots"].append(base)
        place = {i: base + k for k, i in enumerate(sorted(trees[t]))}
        depth = {0: 0}
        for i in sorted(trees[t]):
            node = trees[t][i]
            leaf, split = node["leftChild"] < 0, node["split"]
            if not leaf:
                if split["numCategories"] >= 0:
                    raise ValueError("splits on categories have no threshold")
                for child in (node["leftChild"], node["rightChild"]):
                    depth[child] = depth[i] + 1
            parts["feature"].append(0 if leaf else split["featureIndex"])
            parts["threshold"].append(0.0 if leaf else float(split["leftCategoriesOrThreshold"][0]))
            parts["missing_left"].append(False)
            parts["left"].append(LEAF if leaf else place[node["leftChild"]])
            parts["right"].append(LEAF if leaf else place[node["rightChild"]])
            parts["value"].append(weights[t] * float(node["prediction"]) if leaf else 0.0)
        deepest = max(deepest, *depth.values())
    return FlatTrees(tuple(inputs), **{c: tuple(v) for c, v in parts.items()}, depth=deepest)


def boosted_probability(trees: FlatTrees) -> Column:
    """P(event) of a boosted classifier of the library, whose margin is half the log odds."""
    return 1.0 / (1.0 + F.exp(-2.0 * trees.margin()))


def contract(df: DataFrame, inputs: Mapping[str, str]) -> DataFrame:
    """A model's inputs against a table: each variable, wanted type, found type, verdict."""
    found = dict(df.dtypes)
    spark = df.sparkSession
    rows = [(c, t, found.get(c)) for c, t in inputs.items()]
    table = spark.createDataFrame(rows, "variable string, wanted string, found string")
    verdict = (
        F.when(F.col("found").isNull(), "missing").when(F.col("found") != F.col("wanted"), "type").otherwise("ok")
    )
    return table.withColumn("verdict", verdict)
