"""Scalar column expressions. All stay inside Catalyst; none needs Python workers."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Erf approximation 7.1.26 of Abramowitz and Stegun (error <= 1.5e-7).
ERF_P = 0.3275911
ERF_A = (0.254829592, -0.284496736, 1.421413741, -1.453152027, 1.061405429)


def col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def erf(x: ColumnOrName) -> Column:
    x = col(x)
    t = 1.0 / (1.0 + ERF_P * F.abs(x))
    poly = reduce(lambda acc, a: (acc + F.lit(a)) * t, reversed(ERF_A), F.lit(0.0))
    return F.signum(x) * (1.0 - poly * F.exp(-x * x))


def normal_cdf(x: ColumnOrName) -> Column:
    return 0.5 * (1.0 + erf(col(x) / F.lit(math.sqrt(2.0))))


def logistic(x: ColumnOrName) -> Column:
    """1/(1+exp(-x)) with x held in [-500, 500] so exp never overflows; NULL stays NULL."""
    x = col(x)
    held = F.greatest(F.least(x, F.lit(500.0)), F.lit(-500.0))
    return F.when(x.isNotNull(), 1.0 / (1.0 + F.exp(-held)))


def any_missing(cols: Sequence[ColumnOrName]) -> Column:
    return reduce(or_, [col(c).isNull() for c in cols])


def lt_or_missing(x: ColumnOrName, bound) -> Column:
    """`x < bound` where a missing x counts as smaller than every number."""
    x = col(x)
    return x.isNull() | (x < bound)


def compare_key(x: ColumnOrName, modifiers: str = "ILN") -> Column:
    """Text as the edit distance sees it. I: ignore case, L: leading blanks, N: quotes."""
    x = col(x)
    if "N" in modifiers:
        x = F.regexp_replace(x, "['\"]", "")
    if "L" in modifiers:
        x = F.ltrim(x)
    return F.lower(x) if "I" in modifiers else x


def edit_distance(a: ColumnOrName, b: ColumnOrName, modifiers: str = "ILN") -> Column:
    return F.levenshtein(compare_key(a, modifiers), compare_key(b, modifiers))


def hash_int(key: ColumnOrName, seed: int | str) -> Column:
    """32 uniform bits from md5(key|seed); the same integer in any engine with md5."""
    text = F.concat(col(key).cast("string"), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_uniform(key: ColumnOrName, seed: int | str) -> Column:
    return hash_int(key, seed) / F.lit(4294967296.0)


def linear_predictor(coefs: Mapping[str, float], intercept: float = 0.0) -> Column:
    return reduce(add, [F.lit(float(b)) * col(c) for c, b in coefs.items()], F.lit(float(intercept)))


def money(x: ColumnOrName) -> Column:
    """1234567.891 -> $1,234,567.89"""
    return F.concat(F.lit("$"), F.format_number(col(x), 2))


def percent(x: ColumnOrName, digits: int = 2) -> Column:
    """0.1234 -> 12.34%"""
    return F.concat(F.format_number(col(x) * 100.0, digits), F.lit("%"))


def black_scholes(notional, vol, strike, spot, years, rate) -> Column:
    """Value of `notional` call options; NULL outside the domain of the formula."""
    notional, vol, strike, spot, years, rate = map(col, (notional, vol, strike, spot, years, rate))
    spread = vol * F.sqrt(years)
    d1 = (F.ln(spot / strike) + (rate + vol * vol / 2.0) * years) / spread
    price = normal_cdf(d1) * spot - normal_cdf(d1 - spread) * strike * F.exp(-rate * years)
    return F.when((vol > 0) & (strike > 0) & (spot > 0) & (years > 0), notional * price)


def bin_of(x: ColumnOrName, edges: Sequence[float]) -> Column:
    """0-based bin: the number of edges strictly below x. NULL stays NULL."""
    x = col(x)
    above = [F.when(x > F.lit(float(e)), 1).otherwise(0) for e in edges]
    return F.when(x.isNotNull(), reduce(add, above, F.lit(0)))


def equal_width_bin(x: ColumnOrName, low: ColumnOrName, high: ColumnOrName, n: int) -> Column:
    """0-based equal-width bin over [low, high]; the maximum falls in the last bin."""
    x, low, high = col(x), col(low), col(high)
    width = (high - low) / F.lit(float(n))
    raw = F.floor((x - low) / F.nullif(width, F.lit(0.0)))
    return F.least(F.coalesce(raw, F.lit(0)), F.lit(n - 1)).cast("bigint")


def let(value: Column, body) -> Column:
    """body(value) with the value computed once, also inside higher-order functions."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def running_sum(values: Column, block: int = 16) -> Column:
    """Exclusive running totals of an int array, without a shuffle.

    Two levels keep the work low on long arrays: sums of blocks, their running totals, and
    running totals inside a block.
    """

    def total(part: Column) -> Column:
        return F.aggregate(part, F.lit(0), lambda acc, v: acc + v)

    def run(arr: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.greatest(F.floor((F.size(arr) - 1) / block).cast("int"), F.lit(0)))
        sums = F.transform(blocks, lambda b: total(F.slice(arr, b * block + 1, F.lit(block))))

        def block_totals(s: Column) -> Column:
            def inside(b: Column) -> Column:
                items = F.slice(arr, b * block + 1, F.lit(block))
                before = total(F.slice(s, F.lit(1), b))
                return let(before, lambda t: let(items, lambda x: F.transform(x, lambda v, j: t + total(F.slice(x, F.lit(1), j)))))

            return F.flatten(F.transform(blocks, inside))

        return let(sums, block_totals)

    return let(values, run)
