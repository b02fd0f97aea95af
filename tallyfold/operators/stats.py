"""Counts, moments, correlations, distributions."""

from __future__ import annotations

import math
from collections.abc import Sequence
from itertools import combinations_with_replacement

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from tallyfold.functions.scalar import equal_width_bin
from tallyfold.operators.ranking import running_totals
from tallyfold.operators.relational import wide_to_long
from tallyfold.session import cut_lineage


def one_way(df: DataFrame, column: str) -> DataFrame:
    """Frequency table of a class variable: count, percent and both cumulated.

    The windows see one row per level, not per record.
    """
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("count"))
    whole = Window.partitionBy(F.lit(0))
    upto = whole.orderBy(column).rowsBetween(Window.unboundedPreceding, 0)
    total, cumulative = F.sum("count").over(whole), F.sum("count").over(upto)
    return counts.select(
        column,
        "count",
        (F.col("count") * 100.0 / total).alias("percent"),
        cumulative.alias("cum_count"),
        (cumulative * 100.0 / total).alias("cum_percent"),
    )


def crosstab_by(df: DataFrame, by: str, rows: str, cols: str) -> DataFrame:
    return df.groupBy(by, rows, cols).agg(F.count("*").alias("count"))


def simple_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: n, mean, std, sum, min, max. One pass, one partial row per task."""
    parts = []
    for c in columns:
        x = F.col(c).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.count(x).alias("n"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.sum(x).alias("sum"),
                F.min(x).alias("min"),
                F.max(x).alias("max"),
            )
        )
    return df.agg(F.array(*parts).alias("_s")).select(F.inline("_s"))


def beta_share(x: float, a: float, b: float) -> float:
    """Regularised incomplete beta function by its continued fraction (modified Lentz)."""
    if x <= 0.0 or x >= 1.0:
        return float(x >= 1.0)
    if x > (a + 1.0) / (a + b + 2.0):
        return 1.0 - beta_share(1.0 - x, b, a)
    tiny = 1e-300
    front = math.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)) / a
    c, d = 1.0, 1.0 / ((1.0 - (a + b) * x / (a + 1.0)) or tiny)
    value, m = d, 1
    while True:
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        for term in (even, odd):
            d = 1.0 / ((1.0 + term * d) or tiny)
            c = (1.0 + term / c) or tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15 or m > 10_000:
            return front * value
        m += 1


@F.pandas_udf(DoubleType())
def t_tail(t: pd.Series, free: pd.Series) -> pd.Series:
    """P(|T| > t) of Student's t; for result rows, a few per pair of columns."""
    tails = [
        None if math.isnan(x) or math.isnan(v) else beta_share(v / (v + x * x), v / 2.0, 0.5)
        for x, v in zip(t.astype(float), free.astype(float), strict=True)
    ]
    return pd.Series(tails, dtype="float64")


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Long Pearson matrix with two-sided p-values of Student's t, in one pass over the rows."""
    pairs = list(combinations_with_replacement(columns, 2))
    parts = []
    for a, b in pairs:
        x, y = F.col(a).cast("double"), F.col(b).cast("double")
        both = x.isNotNull() & y.isNotNull()
        r = F.corr(x, y) if a != b else F.when(F.count_if(both) > 0, 1.0)
        parts.append(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), r.alias("r"), F.count_if(both).alias("n")))
    upper = df.agg(F.array(*parts).alias("_s")).select(F.inline("_s"))
    mirrored = upper.select(
        F.explode(
            F.when(F.col("a") == F.col("b"), F.array(F.struct("a", "b"))).otherwise(
                F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
            )
        ).alias("_p"),
        "r",
        "n",
    )
    known = (F.abs("r") < 1) & (F.col("n") > 2)
    free = F.when(known, F.col("n") - 2).cast("double")
    tail = t_tail(F.abs("r") * F.sqrt(free / (1 - F.col("r") * F.col("r"))), free)
    return mirrored.select(
        F.col("_p.a").alias("variable"), F.col("_p.b").alias("with_variable"), "r", "n", tail.alias("p_value")
    )


def mean_abs(df: DataFrame, name: str, value: str) -> DataFrame:
    return (
        df.groupBy(name).agg(F.avg(F.abs(value)).alias("mean_abs")).orderBy(F.desc("mean_abs"), name)
    )


def _range(df: DataFrame, column: str) -> Column:
    """{lo, hi} as a scalar subquery: one partial row per task."""
    x = F.col(column).cast("double")
    return df.agg(F.struct(F.min(x).alias("lo"), F.max(x).alias("hi")).alias("r")).scalar()


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins from minimum to maximum; bins without rows are absent."""
    x = F.col(column).cast("double")
    binned = df.filter(x.isNotNull()).withColumn("_r", _range(df, column))
    return (
        binned.withColumn("bin", equal_width_bin(x, F.col("_r.lo"), F.col("_r.hi"), bins))
        .groupBy("bin")
        .agg(F.count("*").alias("count"), F.min(x).alias("low"), F.max(x).alias("high"))
    )


def histogram_2d(df: DataFrame, x: str, group: str, bins: int) -> DataFrame:
    value = F.col(x).cast("double")
    binned = df.filter(value.isNotNull()).withColumn("_r", _range(df, x))
    return (
        binned.withColumn("bin", equal_width_bin(value, F.col("_r.lo"), F.col("_r.hi"), bins))
        .groupBy(group, "bin")
        .agg(F.count("*").alias("count"))
    )


def kernel_density(
    df: DataFrame, column: str, bandwidth: float, points: int = 50, bins: int = 200, by: Sequence[str] = ()
) -> DataFrame:
    """Gaussian density on an even grid, computed from a fine histogram.

    The rows are reduced to at most `bins` mid-points per group; only those meet the grid.
    """
    x = F.col(column).cast("double")
    ranged = df.filter(x.isNotNull()).withColumn("_r", _range(df, column))
    lo, hi = F.col("_lo"), F.col("_hi")
    cells = (
        ranged.select(
            *by,
            equal_width_bin(x, F.col("_r.lo"), F.col("_r.hi"), bins).alias("_bin"),
            F.col("_r.lo").alias("_lo"),
            F.col("_r.hi").alias("_hi"),
        )
        .groupBy(*by, "_bin", "_lo", "_hi")
        .agg(F.count("*").alias("_n"))
    )
    mid = lo + (F.col("_bin") + 0.5) * (hi - lo) / F.lit(float(bins))
    at = lo + F.col("point") * (hi - lo) / F.lit(float(points - 1))
    z = (F.col("x") - F.col("_mid")) / F.lit(bandwidth)
    kernel = F.exp(-0.5 * z * z) / F.lit(bandwidth * 2.5066282746310002)
    spread = cells.withColumn("_mid", mid).withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    return (
        spread.withColumn("x", at)
        .groupBy(*by, "point", "x")
        .agg((F.sum(kernel * F.col("_n")) / F.sum("_n")).alias("density"))
    )


def edf_tests(df: DataFrame, value: str, group: str, a, b) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov D, Kuiper V and Cramer-von Mises W2 of classes a and b.

    Rows collapse to one per distinct value before the running sums. The two columns are
    written once, for the sizes, the cut and the curves.
    """
    x = F.col(value).cast("double")
    used = cut_lineage(df.filter(F.col(group).isin(a, b) & x.isNotNull()).select(value, group))
    per_value = used.groupBy(x.alias("_x")).agg(
        F.count_if(F.col(group) == a).alias("_na"), F.count_if(F.col(group) == b).alias("_nb")
    )
    sizes = used.agg(
        F.struct(F.count_if(F.col(group) == a).alias("a"), F.count_if(F.col(group) == b).alias("b")).alias("n")
    ).scalar()
    curves = running_totals(per_value, "_x", {"_ca": "_na", "_cb": "_nb"}).withColumn("_n", sizes)
    na, nb = F.col("_n.a").cast("double"), F.col("_n.b").cast("double")
    curves = curves.withColumn("_d", F.try_divide(F.col("_ca"), na) - F.try_divide(F.col("_cb"), nb))
    weight = F.try_divide(na * nb, (na + nb) * (na + nb))
    return curves.agg(
        F.max(F.abs("_d")).alias("ks_d"),
        (F.greatest(F.max("_d"), F.lit(0.0)) + F.greatest(F.max(-F.col("_d")), F.lit(0.0))).alias("kuiper_v"),
        F.sum(F.col("_d") * F.col("_d") * (F.col("_na") + F.col("_nb")) * weight).alias("cramer_von_mises"),
        F.max("_n.a").alias("n_a"),
        F.max("_n.b").alias("n_b"),
    )


def profile(df: DataFrame, columns: Sequence[str], exact_distinct: bool = False) -> DataFrame:
    """One row per column: type, rows, missing, distinct, min, max and moments.

    Distinct counts are sketches by default. The exact count goes through distinct
    (column, value) pairs, which are combined before the shuffle.
    """
    types = dict(df.dtypes)
    numeric = {c: types[c] in ("double", "float", "int", "bigint", "smallint") for c in columns}
    parts = []
    for c in columns:
        x = F.col(c).cast("double") if numeric[c] else F.lit(None).cast("double")
        parts.append(
            F.struct(
                F.lit(c).alias("variable"),
                F.lit(types[c]).alias("type"),
                F.count("*").alias("rows"),
                F.count_if(F.col(c).isNull()).alias("missing"),
                F.approx_count_distinct(F.col(c)).alias("approx_distinct"),
                F.min(F.col(c)).cast("string").alias("min"),
                F.max(F.col(c)).cast("string").alias("max"),
                F.avg(x).alias("mean"),
                F.stddev_samp(x).alias("std"),
                F.skewness(x).alias("skewness"),
                F.kurtosis(x).alias("kurtosis"),
            )
        )
    out = df.agg(F.array(*parts).alias("_s")).select(F.inline("_s"))
    if not exact_distinct:
        return out
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("v")) for c in columns]
    distinct = (
        df.select(F.inline(F.array(*pairs)))
        .filter("v IS NOT NULL")
        .distinct()
        .groupBy("variable")
        .agg(F.count("*").alias("distinct"))
    )
    return out.join(distinct, "variable", "left")


def weighted_claims(df: DataFrame, exposure: str, observed: str, predicted: str, by: Sequence[str] = ()) -> DataFrame:
    """Exposure-weighted observed and predicted totals and their difference."""
    w = F.col(exposure)
    totals = df.groupBy(*by).agg(
        F.sum(w * F.col(observed)).alias("observed"), F.sum(w * F.col(predicted)).alias("predicted")
    )
    diff = F.col("predicted") - F.col("observed")
    return totals.withColumns(
        {"difference": diff, "relative": diff / F.nullif(F.col("observed"), F.lit(0.0))}
    )


def card_profile(df: DataFrame, interval: Sequence[str], classes: Sequence[str], by: str) -> DataFrame:
    """Model-card statistics by class of `by`: moments of interval inputs, level shares of
    class inputs; long and narrow, both read in one pass each."""
    long_interval = wide_to_long(df, [by], interval)
    moments = long_interval.groupBy(by, "variable").agg(
        F.count("value").alias("n"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    pairs = [F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("level")) for c in classes]
    counts = df.select(by, F.inline(F.array(*pairs))).groupBy(by, "variable", "level").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy(by, "variable"))
    return moments.unionByName(counts.withColumn("share", share), allowMissingColumns=True)

