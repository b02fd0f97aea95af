"""Partial dependence and Shapley values of a score given as a column expression.

A model enters as `score(inputs: dict[name, Column]) -> Column`, so changing an input is
substituting a column: nothing is joined to the rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.sampling import simple_random_sample

Score = Callable[[dict[str, Column]], Column]


def partial_dependence(df: DataFrame, score: Score, inputs: Sequence[str], bins: int = 20) -> DataFrame:
    """Mean prediction and standard error at `bins` even steps from min to max of each input.

    Every row makes its variables x bins predictions, which the map side folds into as many
    groups; the shuffle carries only those.
    """
    ranges = df.agg(
        F.struct(
            *[
                F.struct(F.min(c).cast("double").alias("lo"), F.max(c).cast("double").alias("hi")).alias(c)
                for c in inputs
            ]
        ).alias("r")
    ).scalar()
    which, step = F.expr(f"cast(_point div {bins} as int)"), F.col("_point") % bins
    share = step / F.lit(float(bins - 1))
    grid = {c: F.col(f"_r.{c}.lo") + (F.col(f"_r.{c}.hi") - F.col(f"_r.{c}.lo")) * share for c in inputs}
    spread = df.select(
        *inputs, ranges.alias("_r"), F.explode(F.sequence(F.lit(0), F.lit(bins * len(inputs) - 1))).alias("_point")
    )
    moved = {c: F.when(which == i, grid[c]).otherwise(F.col(c)) for i, c in enumerate(inputs)}
    at = F.coalesce(*[F.when(which == i, grid[c]) for i, c in enumerate(inputs)])
    points = spread.select("_point", at.alias("_at"), score(moved).alias("_p"))
    names = F.array(*[F.lit(c) for c in inputs])
    return (
        points.groupBy("_point")
        .agg(
            F.max("_at").alias("bin_value"),
            F.avg("_p").alias("mean_prediction"),
            (F.stddev_samp("_p") / F.sqrt(F.count("*"))).alias("standard_error"),
        )
        .select(
            F.element_at(names, which + 1).alias("variable"),
            (step + 1).alias("bin_num"),
            "bin_value",
            "mean_prediction",
            "standard_error",
        )
    )


def background(df: DataFrame, key: str, inputs: Sequence[str], n: int, seed: int) -> Column:
    """n sampled rows as one array, in key order (a scalar subquery; n is small by design)."""
    if n > 1000:
        raise ValueError("a background sample has at most 1000 rows")
    sample = simple_random_sample(df.select(key, *inputs), key, n, seed)
    rows = F.array_sort(F.collect_list(F.struct(key, *[F.col(c).cast("double").alias(c) for c in inputs])))
    return sample.agg(rows.alias("b")).scalar()


def coalition_value(score: Score, inputs: Sequence[str], known: frozenset) -> Column:
    """Mean score with the inputs in `known` from the row and the others from background _b."""
    return F.avg(score({c: F.col(c) if c in known else F.col(f"_b.{c}") for c in inputs}))


def shapley_plan(inputs: Sequence[str], permutations: Sequence[Sequence[str]] | None = None):
    """{input: [(weight, with, without)]}: exact over all coalitions, or over permutations."""
    plan: dict[str, list[tuple[float, frozenset, frozenset]]] = {c: [] for c in inputs}
    if permutations is None:
        n = len(inputs)
        for c in inputs:
            rest = [x for x in inputs if x != c]
            for size in range(n):
                weight = math.factorial(size) * math.factorial(n - size - 1) / math.factorial(n)
                for s in combinations(rest, size):
                    plan[c].append((weight, frozenset(s) | {c}, frozenset(s)))
    else:
        for order in permutations:
            for i, c in enumerate(order):
                plan[c].append((1.0 / len(permutations), frozenset(order[: i + 1]), frozenset(order[:i])))
    return plan


def seeded_permutations(inputs: Sequence[str], n: int, seed: int) -> list[list[str]]:
    def rank(i: int, c: str) -> str:
        return hashlib.md5(f"{seed}|{i}|{c}".encode()).hexdigest()

    return [sorted(inputs, key=lambda c, i=i: rank(i, c)) for i in range(n)]


def shapley(
    df: DataFrame,
    key: str,
    score: Score,
    inputs: Sequence[str],
    background_rows: int,
    seed: int,
    permutations: int | None = None,
    sample: DataFrame | None = None,
) -> DataFrame:
    """One row per explained row: key, intercept (background mean) and a column per input.

    Without `permutations` all 2^n coalitions are used (at most 4 inputs). Explains all rows
    unless `sample` names the rows to explain.
    """
    if permutations is None and len(inputs) > 4:
        raise ValueError("exact Shapley values take at most 4 inputs; give a number of permutations")
    orders = None if permutations is None else seeded_permutations(inputs, permutations, seed)
    plan = shapley_plan(inputs, orders)
    needed = sorted({s for terms in plan.values() for _, a, b in terms for s in (a, b)}, key=lambda s: (len(s), sorted(s)))
    at = {s: i for i, s in enumerate(needed)}
    bg = background(df, key, inputs, background_rows, seed)
    # Each row meets the few background rows inside its task; the map side folds them back to
    # one row per key before the shuffle, and each coalition is evaluated once, in codegen.
    rows = (df if sample is None else sample).select(key, *inputs, F.explode(bg).alias("_b"))
    valued = rows.groupBy(key).agg(*[coalition_value(score, inputs, s).alias(f"_v{i}") for s, i in at.items()])
    effects = []
    for c, terms in plan.items():
        total = F.lit(0.0)
        for weight, with_, without in terms:
            total = total + F.lit(weight) * (F.col(f"_v{at[with_]}") - F.col(f"_v{at[without]}"))
        effects.append(total.alias(c))
    return valued.select(key, F.col(f"_v{at[frozenset()]}").alias("intercept"), *effects)


def shapley_long(wide: DataFrame, key: str, inputs: Sequence[str]) -> DataFrame:
    return wide.unpivot([key], list(inputs), "variable", "shapley_value")
