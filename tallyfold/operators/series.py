"""Time series: one group per series, ordered by time. Inputs are aggregated to the grid
(hour, day, month) first, so a series is as long as its calendar, not as its raw rows."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.scalar import let


def slot_number(df: DataFrame, time: str, unit: str) -> Column:
    """Consecutive numbers of the hours, days or months of a calendar; integers are numbers already."""
    at = F.col(time)
    if dict(df.dtypes)[time] in ("smallint", "int", "bigint"):
        return at.cast("bigint")
    return {
        "hour": F.floor(F.unix_timestamp(at.cast("timestamp")) / 3600),
        "day": F.unix_date(at.cast("date")).cast("bigint"),
        "month": (F.year(at) * 12 + F.month(at)).cast("bigint"),
    }[unit]


def lagged(df: DataFrame, value: str, series: str, time: str, lag: int, unit: str) -> Column:
    """The value `lag` slots of the calendar earlier, NULL where that slot has no row."""
    w = Window.partitionBy(series).orderBy(slot_number(df, time, unit)).rangeBetween(-lag, -lag)
    return F.max(value).over(w)


def difference(
    df: DataFrame, series: str, time: str, value: str, lags: Sequence[int], out: str, unit: str = "day"
) -> DataFrame:
    """Successive differences at the given lags, e.g. [1, 12], by calendar and not by row: a
    gridded series need not be regularised, its empty slots give NULL."""
    df = df.withColumn(out, F.col(value))
    for lag in lags:
        df = df.withColumn(out, F.col(out) - lagged(df, out, series, time, lag, unit))
    return df


def to_grid(df: DataFrame, series: str, time: str, value: str, unit: str, how: str = "sum") -> DataFrame:
    """Aggregate to the interval grid."""
    slot = F.date_trunc(unit, time).alias("slot")
    return df.groupBy(series, slot).agg(getattr(F, how)(value).alias("value"), F.count("*").alias("n"))


def regularize(grid: DataFrame, series: str, unit: str) -> DataFrame:
    """All slots from each series' first to its last; empty slots have NULL value and n = 0."""
    step = F.expr(f"INTERVAL 1 {unit}")
    ends = grid.groupBy(series).agg(F.min("slot").alias("lo"), F.max("slot").alias("hi"))
    slots = ends.select(series, F.explode(F.sequence("lo", "hi", step)).alias("slot"))
    return slots.join(grid, [series, "slot"], "left").select(
        series, "slot", "value", F.coalesce("n", F.lit(0)).alias("n")
    )


def ar1_fit(grid: DataFrame, series: str, time: str, value: str, unit: str = "day") -> DataFrame:
    """ARIMA(1,1,0) on the log by conditional least squares, all series in one job.

    One row per series: phi, constant, innovation variance, the last log level and difference.
    Slots that are empty or not positive leave a gap, over which no difference is taken.
    """
    logged = grid.filter(F.col(value) > 0).withColumn("_y", F.ln(value))
    d = difference(logged, series, time, "_y", [1], "_d", unit)
    d = d.withColumn("_l", lagged(d, "_d", series, time, 1, unit))
    return d.groupBy(series).agg(
        F.regr_slope("_d", "_l").alias("phi"),
        F.regr_intercept("_d", "_l").alias("constant"),
        F.try_divide(F.regr_syy("_d", "_l") * (1 - F.regr_r2("_d", "_l")), F.regr_count("_d", "_l") - 2).alias("sigma2"),
        F.regr_count("_d", "_l").alias("n"),
        F.max(time).alias("last_time"),
        F.max_by("_y", time).alias("last_log"),
        F.max_by("_d", F.when(F.col("_d").isNotNull(), F.col(time))).alias("last_diff"),
    )


#: Halvings of (-1, 1) in the search for the maximum of a likelihood.
HALVINGS = 52


def ar1_likelihood(grid: DataFrame, series: str, time: str, value: str, unit: str = "day") -> DataFrame:
    """ARIMA(1,1,0) with a mean, on the log, by exact maximum likelihood, all series in one aggregation.

    The first difference of a stretch without gaps has the stationary distribution, each
    further one follows the difference before it. Nine sums a series give the likelihood at
    any phi with the best mean and variance for it, and the zero of its slope between -1 and
    1 is found by halving. One row per series as in ar1_fit, with the mean and `slope`, the
    derivative of -2 log likelihood at phi. sigma2 is the sum of squares over n - 2. A series
    without two neighbouring differences, or whose differences are all equal, has NULL estimates.
    """
    logged = grid.filter(F.col(value) > 0).withColumn("_y", F.ln(value))
    d = difference(logged, series, time, "_y", [1], "_d", unit)
    d = d.withColumn("_l", lagged(d, "_d", series, time, 1, unit))
    first = F.when(F.col("_l").isNull(), F.col("_d"))
    # Squares of what is left of a mean, which is taken out first: large means cost no digits.
    here, before = F.when(F.col("_l").isNotNull(), F.col("_d") - F.col("_c")), F.when(F.col("_d").isNotNull(), F.col("_l") - F.col("_c"))
    centre = d.groupBy(F.col(series).alias("_s")).agg(F.avg("_d").alias("_c"))
    d = d.join(centre, F.col(series).eqNullSafe(F.col("_s"))).withColumn("_f", first - F.col("_c")).withColumns({"_h": here, "_b": before})
    zero = F.lit(0.0)
    sums = d.groupBy(series).agg(
        F.first("_c").alias("centre"),
        F.count("_f").cast("double").alias("runs"), F.count("_h").cast("double").alias("pairs"),
        *[F.coalesce(F.sum(x), zero).alias(n) for n, x in {
            "f1": F.col("_f"), "f2": F.col("_f") * F.col("_f"), "h1": F.col("_h"), "b1": F.col("_b"),
            "h2": F.col("_h") * F.col("_h"), "b2": F.col("_b") * F.col("_b"), "hb": F.col("_h") * F.col("_b"),
        }.items()],
        F.max(time).alias("last_time"), F.max_by("_y", time).alias("last_log"),
        F.max_by("_d", F.when(F.col("_d").isNotNull(), F.col(time))).alias("last_diff"),
    )
    c = {n: F.col(n) for n in ("runs", "pairs", "f1", "f2", "h1", "b1", "h2", "b2", "hb")}

    def mean(phi: Column) -> Column:
        return ((1 + phi) * c["f1"] + c["h1"] - phi * c["b1"]) / ((1 + phi) * c["runs"] + (1 - phi) * c["pairs"])

    def squares(phi: Column, m: Column) -> Column:
        start = c["f2"] - 2 * m * c["f1"] + m * m * c["runs"]
        k = (1 - phi) * m
        rest = c["h2"] + phi * phi * c["b2"] + k * k * c["pairs"] - 2 * phi * c["hb"] - 2 * k * c["h1"] + 2 * phi * k * c["b1"]
        return (1 - phi * phi) * start + rest

    def slope(phi: Column) -> Column:
        def at(m: Column) -> Column:
            start = c["f2"] - 2 * m * c["f1"] + m * m * c["runs"]
            cross = c["hb"] - m * (c["h1"] + c["b1"]) + m * m * c["pairs"] - phi * (c["b2"] - 2 * m * c["b1"] + m * m * c["pairs"])
            change = -2 * phi * start - 2 * cross
            return (c["runs"] + c["pairs"]) * F.try_divide(change, squares(phi, m)) + 2 * c["runs"] * phi / (1 - phi * phi)

        return let(mean(phi), at)

    def halve(acc: Column, _: Column) -> Column:
        middle = (acc["lo"] + acc["hi"]) / 2
        return F.when(slope(middle) < 0, F.struct(middle.alias("lo"), acc["hi"].alias("hi"))).otherwise(F.struct(acc["lo"].alias("lo"), middle.alias("hi")))

    start = F.struct(F.lit(-1.0).alias("lo"), F.lit(1.0).alias("hi"))
    root = F.aggregate(F.sequence(F.lit(1), F.lit(HALVINGS)), start, halve, lambda acc: (acc["lo"] + acc["hi"]) / 2)
    varies = (c["pairs"] > 1) & (c["h2"] + c["f2"] > 1e-20)
    found = sums.withColumn("phi", F.when(varies, root))
    found = found.withColumn("_m", mean(F.col("phi")))
    return found.select(
        series, "phi", (F.col("_m") + F.col("centre")).alias("mean"), ((F.col("_m") + F.col("centre")) * (1 - F.col("phi"))).alias("constant"),
        F.try_divide(squares(F.col("phi"), F.col("_m")), c["runs"] + c["pairs"] - 2).alias("sigma2"),
        (c["runs"] + c["pairs"]).cast("bigint").alias("n"), slope(F.col("phi")).alias("slope"), "last_time", "last_log", "last_diff",
    )


def ar1_forecast(fit: DataFrame, series: str, lead: int) -> DataFrame:
    """Closed-form forecasts 1..lead. The sum of h AR(1) differences around their mean m is
    h*m + (d - m) * phi * (1 - phi^h) / (1 - phi)."""
    phi, h = F.col("phi"), F.col("step")
    mean = F.col("constant") / (1 - phi)
    steps = fit.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(lead))))
    moved = h * mean + (F.col("last_diff") - mean) * phi * (1 - F.pow(phi, h)) / (1 - phi)
    return steps.select(series, "step", F.exp(F.col("last_log") + moved).alias("forecast"))


def _innovations(w: np.ndarray, theta: np.ndarray, seasonal: np.ndarray, s: int) -> np.ndarray:
    """e_t = w_t + theta e_(t-1) + seasonal e_(t-s) - theta seasonal e_(t-s-1), zero before the
    start; one column per candidate (theta, seasonal), one pass over time for all of them."""
    e = np.zeros((len(w) + s + 1, len(theta)))
    for t, value in enumerate(w, start=s + 1):
        e[t] = value + theta * e[t - 1] + seasonal * e[t - s] - theta * seasonal * e[t - s - 1]
    return e[s + 1 :]


def airline_one(values: np.ndarray, s: int, lead: int) -> tuple[float, float, float, np.ndarray]:
    """(theta, seasonal theta, innovation variance, log forecasts) of one short series, by
    conditional sum of squares on a grid that is refined around its best point."""
    y = np.log(values)
    w = np.diff(y)
    w = w[s:] - w[:-s]
    centre, half = (0.0, 0.0), 0.95
    for _ in range(6):
        grid = np.linspace(-half, half, 9)
        a, b = np.meshgrid(np.clip(centre[0] + grid, -0.98, 0.98), np.clip(centre[1] + grid, -0.98, 0.98))
        a, b = a.ravel(), b.ravel()
        squares = np.sum(_innovations(w, a, b, s) ** 2, axis=0)
        best = min(zip(squares.tolist(), a.tolist(), b.tolist(), strict=True))
        centre, half = (best[1], best[2]), half / 3
    theta, seasonal = centre
    e = _innovations(w, np.array([theta]), np.array([seasonal]), s)[:, 0].tolist()
    history, future = list(y), []
    padded = [0.0] * (s + 1) + e
    for _ in range(lead):
        step = -theta * padded[-1] - seasonal * padded[-s] + theta * seasonal * padded[-s - 1]
        level = history[-1] + history[-s] - history[-s - 1] + step
        history.append(level)
        padded.append(0.0)
        future.append(level)
    return theta, seasonal, best[0] / max(len(w) - 2, 1), np.array(future)


def airline(grid: DataFrame, series: str, time: str, value: str, season: int, lead: int) -> DataFrame:
    """Log, differences (1, season), MA(1)(season), no constant; forecasts per series.

    A regularised series is one pandas frame of calendar length; Spark spreads the series. A
    series that is too short, has empty slots or values that are not positive gives one row
    with step 0 and NULL elsewhere.
    """

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        ordered = pdf.sort_values(time)
        values = ordered[value].to_numpy(dtype=float)
        if len(values) < 2 * season + 2 or not (values > 0).all():
            return pd.DataFrame({series: pdf[series].iloc[:1], "step": 0, "theta": None, "seasonal_theta": None, "sigma2": None, "forecast": None})
        theta, seasonal, sigma2, logs = airline_one(values, season, lead)
        return pd.DataFrame(
            {
                series: pdf[series].iloc[0],
                "step": range(1, lead + 1),
                "theta": theta,
                "seasonal_theta": seasonal,
                "sigma2": sigma2,
                "forecast": np.exp(logs),
            }
        )

    kind = dict(grid.dtypes)[series]
    schema = f"{series} {kind}, step int, theta double, seasonal_theta double, sigma2 double, forecast double"
    return grid.select(series, time, value).groupBy(series).applyInPandas(fit, schema)


def panel_pairs(
    wide: DataFrame, time: str, categories: Sequence[str], first: str = "sa_", second: str = "nsa_"
) -> DataFrame:
    """A wide panel with two versions of each category -> (time, category, first, second).

    The two versions sit in the same wide row, so no self-join is needed.
    """
    pairs = [
        F.struct(
            F.lit(c).alias("category"),
            F.col(f"{first}{c}").cast("double").alias("adjusted"),
            F.col(f"{second}{c}").cast("double").alias("unadjusted"),
        )
        for c in categories
    ]
    long = wide.select(time, F.inline(F.array(*pairs)))
    return long.filter("adjusted IS NOT NULL OR unadjusted IS NOT NULL")
