"""Feature preparation. A fitted value is either a scalar subquery (one small row, planned
lazily) or a short list of numbers fetched once and compiled into the projection, so every
transform is a map over the rows: nothing is joined and nothing is shuffled."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.scalar import bin_of
from tallyfold.operators.ranking import order_statistics_of
from tallyfold.session import cut_lineage

ACCURACY = 100_000


def _moments(df: DataFrame, columns: Sequence[str], std) -> Column:
    used = df.dropna(subset=list(columns))
    parts = [F.struct(F.avg(c).alias("mean"), std(c).alias("std")).alias(c) for c in columns]
    return used.agg(F.struct(*parts).alias("m")).scalar()


def standardize(
    df: DataFrame, columns: Sequence[str], keep_prefix: str | None = None
) -> DataFrame:
    """z-scores with the n-1 standard deviation. Rows missing any listed column do not
    enter the moments. With `keep_prefix`, the original columns stay under that prefix."""
    m = _moments(df, columns, F.stddev_samp)
    kept = {f"{keep_prefix}{c}": F.col(c) for c in columns} if keep_prefix else {}
    scaled = {
        c: (F.col(c) - m[c]["mean"]) / F.nullif(m[c]["std"], F.lit(0.0)) for c in columns
    }
    return df.withColumns({**kept, **scaled})


def standardize_within(
    df: DataFrame, columns: Sequence[str], by: str, keep_prefix: str | None = None
) -> DataFrame:
    """z-scores as `standardize`, with the moments of each group of `by` for itself.

    The moments are one row per group, aggregated on the map side and joined back.
    """
    used = df.dropna(subset=list(columns))
    parts = [F.struct(F.avg(c).alias("mean"), F.stddev_samp(c).alias("std")).alias(c) for c in columns]
    moments = used.groupBy(F.col(by).alias("_by")).agg(F.struct(*parts).alias("_m"))
    joined = df.join(moments, F.col(by).eqNullSafe(F.col("_by")), "left")
    kept = {f"{keep_prefix}{c}": F.col(c) for c in columns} if keep_prefix else {}
    m = F.col("_m")
    scaled = {c: (F.col(c) - m[c]["mean"]) / F.nullif(m[c]["std"], F.lit(0.0)) for c in columns}
    return joined.withColumns({**kept, **scaled}).drop("_by", "_m")


def log_scale(df: DataFrame, columns: Sequence[str], suffix: str = "") -> DataFrame:
    """Natural log, then z-score with the population standard deviation."""
    logs = {f"{c}{suffix}": F.ln(F.when(F.col(c) > 0, F.col(c))) for c in columns}
    logged = df.withColumns(logs)
    m = _moments(logged, list(logs), F.stddev_pop)
    return logged.withColumns(
        {c: (F.col(c) - m[c]["mean"]) / F.nullif(m[c]["std"], F.lit(0.0)) for c in logs}
    )


def dummies(df: DataFrame, column: str, codes: Mapping) -> DataFrame:
    """0/1 columns for known codes {code: new column}; an unknown or missing code gives zeros."""
    return df.withColumns(
        {name: F.coalesce((F.col(column) == code).cast("int"), F.lit(0)) for code, name in codes.items()}
    )


def observed_levels(df: DataFrame, columns: Sequence[str], at_most: int = 1000) -> dict[str, list]:
    """Sorted levels of class columns, in one job. Columns with more levels are refused."""
    pairs = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
    found = df.select(F.inline(F.array(*pairs))).filter("v IS NOT NULL").distinct()
    rows = found.limit(at_most * len(columns) + 1).collect()
    out = {c: sorted(r["v"] for r in rows if r["c"] == c) for c in columns}
    for c, values in out.items():
        if len(values) > at_most:
            raise ValueError(f"{c} has more than {at_most} levels: not a class variable")
    return out


def one_hot(df: DataFrame, columns: Sequence[str], levels: Mapping[str, Sequence] | None = None) -> DataFrame:
    """One 0/1 column per observed level, named column_level; unknown levels give zeros."""
    levels = levels or observed_levels(df, columns)
    new = {}
    for c in columns:
        for v in levels[c]:
            new[f"{c}_{v}"] = F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("int"), F.lit(0))
    return df.withColumns(new)


def quantile_edges(
    df: DataFrame, columns: Sequence[str], bins: int, interpolate: bool = True, accuracy: int = ACCURACY,
    exact: bool = True, stored: bool = False,
) -> dict[str, list[float]]:
    """Inner bin edges per column, duplicates dropped.

    Order statistics are exact at any size, in the same few passes
    for all columns over rows written once (stored=True: rows that come straight from files).
    Without `exact` they come from mergeable sketches with rank error n/accuracy. With `interpolate`, edges lie between
    the two neighbouring order statistics; without, an edge is the value at rank ceil(q*n).
    """
    probs = [i / bins for i in range(1, bins)]
    if not interpolate and not exact:
        row = df.agg(*[F.percentile_approx(c, probs, accuracy).alias(c) for c in columns]).first()
        return {c: sorted({float(v) for v in row[c] or []}) for c in columns}
    if exact and not stored:
        df = cut_lineage(df.select(*columns))
    counts = df.agg(*[F.count(c).alias(c) for c in columns]).first()
    ranks = {c: _edge_ranks(counts[c], probs, interpolate) for c in columns if counts[c]}
    values: dict[str, dict[int, float]] = {}
    if exact:
        values = order_statistics_of(df, {c: [r for lo, hi, _ in at for r in (lo, hi)] for c, at in ranks.items()}, stored=True)
    elif ranks:
        listed = {c: sorted({r for lo, hi, _ in at for r in (lo, hi)}) for c, at in ranks.items()}
        picks = [
            F.percentile_approx(c, [(r - 0.5) / counts[c] for r in rs], accuracy).alias(c) for c, rs in listed.items()
        ]
        row = df.agg(*picks).first()
        values = {c: dict(zip(rs, (float(v) for v in row[c]), strict=True)) for c, rs in listed.items()}
    edges: dict[str, list[float]] = {c: [] for c in columns}
    for c, at in ranks.items():
        v = values[c]
        edges[c] = sorted({v[lo] + w * (v[hi] - v[lo]) for lo, hi, w in at})
    return edges


def _edge_ranks(n: int, probs: Sequence[float], interpolate: bool) -> list[tuple[int, int, float]]:
    """(lower rank, upper rank, weight of the upper), 1-based, for each probability."""
    if not interpolate:
        ranks = [max(1, math.ceil(q * n)) for q in probs]
        return [(r, r, 0.0) for r in ranks]
    at = [q * (n - 1) for q in probs]
    return [(int(k) + 1, min(int(k) + 2, n), k - int(k)) for k in at]


def apply_bins(df: DataFrame, edges: Mapping[str, Sequence[float]], suffix: str = "_bin") -> DataFrame:
    return df.withColumns({f"{c}{suffix}": bin_of(c, e) for c, e in edges.items()})


def impute(df: DataFrame, how: Mapping[str, str]) -> DataFrame:
    """Fill missing values with the mean, median (the lower middle value) or most frequent value (smallest on a tie)."""
    fills = {}
    means = [c for c, m in how.items() if m == "mean"]
    if means:
        s = df.agg(F.struct(*[F.avg(c).alias(c) for c in means]).alias("s")).scalar()
        fills = {c: F.coalesce(F.col(c), s[c]) for c in means}
    medians = [c for c, m in how.items() if m == "median"]
    if medians:
        sizes = df.agg(*[F.count(c).alias(c) for c in medians]).first()
        middle = order_statistics_of(df, {c: [(sizes[c] + 1) // 2] for c in medians if sizes[c]})
        kinds = dict(df.dtypes)
        fills |= {c: F.coalesce(F.col(c), F.lit(v[(sizes[c] + 1) // 2]).cast(kinds[c])) for c, v in middle.items()}
    for c, m in how.items():
        if m == "most_frequent":
            counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("_n"))
            top = counts.orderBy(F.desc("_n"), c).limit(1).select(c).scalar()
            fills[c] = F.coalesce(F.col(c), top)
    return df.withColumns(fills)


def poly2(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """All squares and pairwise products, named a_x_b, beside the columns themselves."""
    new = {}
    for i, a in enumerate(columns):
        for b in columns[i:]:
            new[f"{a}_x_{b}"] = F.col(a) * F.col(b)
    return df.withColumns(new)


def column_spec(df: DataFrame, keep: Sequence[str], spec: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Apply named steps to column groups and keep only their outputs, in the order given.

    Steps: pass, one_hot, quantile_bin (5 bins), log_scale, standardize, poly2.
    """
    out = df
    wanted: list[str] = list(keep)
    for step, columns in spec:
        before = list(out.columns)
        if step == "pass":
            wanted += columns
        elif step == "one_hot":
            out = one_hot(out, columns, observed_levels(df, columns))
            wanted += [c for c in out.columns if c not in before]
        elif step == "quantile_bin":
            out = apply_bins(out, quantile_edges(df, columns, 5))
            wanted += [f"{c}_bin" for c in columns]
        elif step == "log_scale":
            out = log_scale(out, columns, "_log")
            wanted += [f"{c}_log" for c in columns]
        elif step == "standardize":
            m = _moments(df, columns, F.stddev_samp)
            out = out.withColumns({f"{c}_std": F.try_divide(F.col(c) - m[c]["mean"], m[c]["std"]) for c in columns})
            wanted += [f"{c}_std" for c in columns]
        elif step == "poly2":
            out = poly2(out, columns)
            wanted += [c for c in out.columns if c not in before]
        else:
            raise ValueError(f"unknown step {step}")
    return out.select(*wanted)


def woe_edges(
    df: DataFrame, columns: Sequence[str], min_bins: int = 3, max_bins: int = 7, stored: bool = False
) -> dict[str, list[float]]:
    """Quantile edges for weight of evidence; a column must give at least min_bins bins."""
    edges = quantile_edges(df, columns, max_bins, interpolate=False, stored=stored)
    return {c: e for c, e in edges.items() if len(e) + 1 >= min_bins}


def woe_table(df: DataFrame, edges: Mapping[str, Sequence[float]], target: str, event) -> DataFrame:
    """(variable, bin, events, nonevents, woe, iv) with woe = ln(non-event share / event share),
    counts smoothed by 0.5. At most seven bins per variable: a small table."""
    pairs = [
        F.struct(F.lit(c).alias("variable"), F.coalesce(bin_of(c, e), F.lit(-1)).alias("bin"))
        for c, e in edges.items()
    ]
    is_event = F.col(target) == event
    counts = (
        df.filter(F.col(target).isNotNull())
        .select(is_event.alias("_e"), F.inline(F.array(*pairs)))
        .groupBy("variable", "bin")
        .agg(F.count_if("_e").alias("events"), F.count_if(~F.col("_e")).alias("nonevents"))
    )
    w = Window.partitionBy("variable")
    good = F.try_divide(F.col("nonevents") + 0.5, F.sum("nonevents").over(w))
    bad = F.try_divide(F.col("events") + 0.5, F.sum("events").over(w))
    woe = F.ln(good / bad)
    return counts.withColumns({"woe": woe, "iv": (good - bad) * woe})


def woe_transform(
    df: DataFrame, columns: Sequence[str], target: str, event, prefix: str = "woe_"
) -> DataFrame:
    """Replace each input by its bin's weight of evidence, under a prefix; other columns stay.

    The small table comes back as one map (a scalar subquery) and is looked up per row.
    """
    narrow = cut_lineage(df.select(*columns, target))
    edges = woe_edges(narrow, columns, stored=True)
    entries = woe_table(narrow, edges, target, event).agg(
        F.map_from_entries(
            F.collect_list(F.struct(F.concat_ws("|", "variable", "bin").alias("k"), F.col("woe")))
        ).alias("w")
    )
    woe = entries.scalar()
    new = {}
    for c, e in edges.items():
        bin_ = F.coalesce(bin_of(c, e), F.lit(-1))
        new[f"{prefix}{c}"] = F.try_element_at(woe, F.concat_ws("|", F.lit(c), bin_))
    return df.withColumns(new)


def decode(df: DataFrame, column: str, label_text: str, out: str) -> DataFrame:
    """Integer codes to the names a data dictionary lists, as in 'Single:0, Married:1'."""
    return df.withColumn(out, F.try_element_at(code_map(F.lit(label_text)), F.col(column).cast("int")))


def code_map(label: Column) -> Column:
    """{code: name} from a dictionary label. A pair may be followed by a comma or colon."""
    pattern = F.lit(r"([A-Za-z][A-Za-z_/() -]*):\s*(\d+)")
    names = F.transform(F.regexp_extract_all(label, pattern, F.lit(1)), F.trim)
    codes = F.transform(F.regexp_extract_all(label, pattern, F.lit(2)), lambda c: c.cast("int"))
    return F.map_from_arrays(codes, names)
