"""Portfolio search by random trials."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalar import hash_uniform


def return_moments(returns: DataFrame, asset: str, time: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(asset, mean) and the full symmetric (i, j, cov). Assets meet on the date, so the
    self-join holds dates x assets^2 rows; assets are a short list by nature."""
    means = returns.groupBy(asset).agg(F.avg(value).alias("mean"))
    left = returns.select(F.col(time).alias("_t"), F.col(asset).alias("i"), F.col(value).alias("_x"))
    right = returns.select(F.col(time).alias("_t"), F.col(asset).alias("j"), F.col(value).alias("_y"))
    upper = left.join(right, "_t").filter("i <= j").groupBy("i", "j").agg(F.covar_samp("_x", "_y").alias("cov"))
    mirrored = upper.filter("i < j").select(F.col("j").alias("i"), F.col("i").alias("j"), "cov")
    return means, upper.unionByName(mirrored)


def trial_weights(means: DataFrame, asset: str, trials: int, seed: int, least: float = 0.1) -> DataFrame:
    """(trial, asset, weight): assets picked with probability 1/2, weights >= `least`, sum 1.

    Trials whose minimum weights exceed the whole are infeasible and left out.
    """
    assets = means.select(asset, F.explode(F.sequence(F.lit(1), F.lit(trials))).alias("trial"))
    cell = F.concat_ws("#", F.col("trial"), F.col(asset))
    picked = assets.withColumn("_u", hash_uniform(cell, seed)).filter("_u < 0.5")
    drawn = picked.withColumn("_w", hash_uniform(cell, seed + 1))
    sums = drawn.groupBy("trial").agg(F.sum("_w").alias("_s"), F.count("*").alias("_k"))
    weight = F.lit(least) + (1 - least * F.col("_k")) * F.col("_w") / F.col("_s")
    return drawn.join(sums, "trial").filter(F.col("_k") * least <= 1).select("trial", asset, weight.alias("weight"))


def trial_results(weights: DataFrame, means: DataFrame, cov: DataFrame, asset: str) -> DataFrame:
    """(trial, expected_return, risk)."""
    earned = weights.join(means, asset).groupBy("trial").agg(F.sum(F.col("weight") * F.col("mean")).alias("expected_return"))
    a = weights.select("trial", F.col(asset).alias("i"), F.col("weight").alias("wi"))
    b = weights.select(F.col("trial").alias("_t"), F.col(asset).alias("j"), F.col("weight").alias("wj"))
    pairs = a.join(cov, "i").join(b, (F.col("trial") == F.col("_t")) & (cov["j"] == b["j"]))
    risk = pairs.groupBy("trial").agg(F.sum(F.col("wi") * F.col("wj") * F.col("cov")).alias("risk"))
    return earned.join(risk, "trial")


def best_portfolio(
    returns: DataFrame, asset: str, time: str, value: str, trials: int, seed: int, risk_limit: float, least: float = 0.1
) -> DataFrame:
    """(asset, investment) of the feasible trial with the highest expected return."""
    means, cov = return_moments(returns, asset, time, value)
    weights = trial_weights(means, asset, trials, seed, least)
    feasible = trial_results(weights, means, cov, asset).filter(F.col("risk") <= risk_limit)
    order = F.struct(F.round("expected_return", 12), -F.col("trial"))
    best = feasible.agg(F.max_by("trial", order).alias("trial"))
    return weights.join(best, "trial").select("trial", asset, F.col("weight").alias("investment"))
