"""Exact global ranks and running sums without a one-task sort.

Rows are cut into buckets that respect the sort order. Bucket sizes (a bounded number of
rows) give each bucket its offset; inside a bucket a plain window does the rest. Buckets
come from concrete numbers (hash bits, or quantiles fetched once), never from a sampled
range partitioning, so a recomputed task always sees the same cut. A value that fills
whole buckets on its own is split further by the tie-break key.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyfold.functions.scalar import col, hash_int
from tallyfold.session import cut_lineage

BUCKET, SUB = "_bucket", "_sub"
#: Accuracy of the sketches that only place split points.
SKETCH = 10_000


def bucket_count(spark: SparkSession) -> int:
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(32, min(4096, 4 * partitions))


def _window(by: Sequence[str]):
    return Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))


def _attach(df: DataFrame, small: DataFrame, by: Sequence[str], cut: Sequence[str]) -> DataFrame:
    """Join bucket facts back; groups and buckets match NULL-safely so that no row is lost."""
    renamed = small.withColumnsRenamed({c: f"_r_{c}" for c in [*by, *cut]})
    on = [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in [*cut, *by]]
    return df.join(renamed, on).drop(*[f"_r_{c}" for c in [*by, *cut]])


def _rank(
    df: DataFrame, by: Sequence[str], cut: Sequence[str], order: list[Column], rank: str, total: str
) -> DataFrame:
    sizes = df.groupBy(*by, *cut).agg(F.count("*").alias("_n"))
    w = _window(by)
    # Rows without a value lie in the NULL bucket and come last.
    before = F.sum("_n").over(w.orderBy(*[F.col(c).asc_nulls_last() for c in cut]).rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select(
        *by,
        *cut,
        F.coalesce(before, F.lit(0)).alias("_before"),
        F.sum("_n").over(w).alias(total),
    )
    local = df.withColumn("_local", F.row_number().over(Window.partitionBy(*by, *cut).orderBy(*order)))
    ranked = _attach(local, offsets, by, cut)
    return ranked.withColumn(rank, F.col("_before") + F.col("_local")).drop(*cut, "_local", "_before")


def rank_by_hash(
    df: DataFrame,
    key: str | Column,
    seed: int | str,
    by: Sequence[str] = (),
    rank: str = "rank",
    total: str = "total",
) -> DataFrame:
    """1-based rank of each row in a seeded random order of its unique key, per group."""
    n = bucket_count(df.sparkSession)
    prepared = df.withColumn("_key", col(key).cast("string")).withColumn("_hash", hash_int("_key", seed))
    prepared = prepared.withColumn(BUCKET, F.shiftright(F.col("_hash") * n, 32))
    order = [F.col("_hash"), F.col("_key")]
    return _rank(prepared, by, [BUCKET], order, rank, total).drop("_hash", "_key")


def quantile_splits(values: Sequence[float]) -> tuple[list[float], list[int]]:
    """Bucketizer splits for ascending quantiles, and the ids of one-value buckets.

    A value seen twice among the quantiles holds at least one bucket's share of the rows:
    it gets a bucket of its own, [v, next float above v).
    """
    splits, hot = [-math.inf], []
    for i, v in enumerate(values):
        if i and v == values[i - 1]:
            if splits[-1] == v:
                hot.append(len(splits) - 1)
                splits.append(math.nextafter(v, math.inf))
        elif v > splits[-1]:
            splits.append(v)
    return [*splits, math.inf], hot


def _cut(df: DataFrame, column: str, splits: list[float], out: str) -> DataFrame:
    if len(splits) < 3:
        return df.withColumn(out, F.lit(0.0))
    return Bucketizer(splits=splits, inputCol=column, outputCol=out, handleInvalid="keep").transform(df)


def _quantiles(df: DataFrame, columns: Sequence[str], n: int) -> list[list[float]]:
    probs = [i / n for i in range(1, n)]
    row = df.agg(
        *[F.percentile_approx(c, probs, max(10000, 10 * n)).alias(f"q{i}") for i, c in enumerate(columns)]
    ).first()
    return [list(row[i] or []) for i in range(len(columns))]


def rank_by_value(
    df: DataFrame,
    column: str | Column,
    tie_break: str,
    by: Sequence[str] = (),
    descending: bool = True,
    rank: str = "rank",
    total: str = "total",
    stored: bool = False,
) -> DataFrame:
    """1-based rank by a non-null number, ties in order of a unique numeric key, per group.

    The rows are read three times (quantiles, bucket sizes, ranks), so they are written once
    and the input is not computed again; pass narrow rows, and stored=True for rows that come
    straight from files. The quantiles of the column and the key are fetched as a short list.
    """
    if not stored:
        df = cut_lineage(df)
    value = col(column).cast("double")
    prepared = df.withColumn("_value", -value if descending else value)
    prepared = prepared.withColumn("_tie", F.col(tie_break).cast("double"))
    n = bucket_count(df.sparkSession)
    value_q, tie_q = _quantiles(prepared, ["_value", "_tie"], n)
    splits, hot = quantile_splits(value_q)
    prepared = _cut(prepared, "_value", splits, BUCKET)
    if hot:
        tie_splits, _ = quantile_splits(tie_q)
        prepared = _cut(prepared, "_tie", tie_splits, SUB)
        is_hot = F.col(BUCKET).isin([float(h) for h in hot])
        prepared = prepared.withColumn(SUB, F.when(is_hot, F.col(SUB)).otherwise(F.lit(0.0)))
    else:
        prepared = prepared.withColumn(SUB, F.lit(0.0))
    order = [F.col("_value"), F.col(tie_break)]
    return _rank(prepared, by, [BUCKET, SUB], order, rank, total).drop("_value", "_tie")


def running_totals(
    df: DataFrame,
    order: str,
    sums: dict[str, str],
    by: Sequence[str] = (),
    cell: Column | None = None,
) -> DataFrame:
    """Inclusive running sums over rows that are unique per (by, order).

    `sums` maps new column -> summed column. `cell` is any non-decreasing function of the
    order column; without it the cut comes from quantiles, fetched by one small job.
    """
    if cell is None:
        n = bucket_count(df.sparkSession)
        splits, _ = quantile_splits(_quantiles(df, [order], n)[0])
        with_double = df.withColumn("_value", F.col(order).cast("double"))
        cutdf = _cut(with_double, "_value", splits, BUCKET).drop("_value")
    else:
        cutdf = df.withColumn(BUCKET, cell)
    totals = cutdf.groupBy(*by, BUCKET).agg(*[F.sum(c).alias(f"_t_{new}") for new, c in sums.items()])
    before = _window(by).orderBy(BUCKET).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, BUCKET, *[F.coalesce(F.sum(f"_t_{new}").over(before), F.lit(0)).alias(f"_o_{new}") for new in sums]
    )
    inside = Window.partitionBy(*by, BUCKET).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = cutdf.withColumns({f"_l_{new}": F.sum(c).over(inside) for new, c in sums.items()})
    joined = _attach(local, offsets, by, [BUCKET])
    out = joined.withColumns({new: F.col(f"_l_{new}") + F.col(f"_o_{new}") for new in sums})
    return out.drop(BUCKET, *[f"_l_{new}" for new in sums], *[f"_o_{new}" for new in sums])


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int]) -> dict[int, float]:
    """Exact values at 1-based ranks, at any table size."""
    return order_statistics_of(df, {column: ranks})[column]


def order_statistics_of(
    df: DataFrame, wanted: Mapping[str, Sequence[int]], stored: bool = False
) -> dict[str, dict[int, float]]:
    """Exact values at 1-based ranks of several columns, missing values left out.

    Sketches give split points close around the wanted ranks; exact counts of the cells
    between them say which cell holds each rank, and only the few values in those cells are
    counted one by one. The sketches decide how few, not what comes out. All columns share
    three passes over narrow rows that are written once; pass stored=True for rows that come
    straight from files.
    """
    columns = {c: sorted({int(r) for r in ranks}) for c, ranks in wanted.items()}
    if not columns:
        return {}
    names = {c: f"_v{i}" for i, c in enumerate(columns)}
    rows = df.select(*[F.col(c).cast("double").alias(v) for c, v in names.items()])
    if not stored:
        rows = cut_lineage(rows)
    sizes = rows.agg(*[F.count(v).alias(v) for v in names.values()]).first()
    asked = {c: v for c, v in names.items() if sizes[v] and columns[c]}
    if not asked:
        return {c: {} for c in wanted}
    near = 2.0 / SKETCH
    probs = {c: sorted({min(max(r / sizes[v] + side, 0.0), 1.0) for r in columns[c] for side in (-near, near)}) for c, v in asked.items()}
    points = rows.agg(*[F.percentile_approx(v, probs[c], SKETCH).alias(v) for c, v in asked.items()]).first()
    cut = rows
    for v in asked.values():
        cut = _cut(cut, v, [-math.inf, *sorted({float(x) for x in points[v]}), math.inf], f"{v}_cell")
    pairs = [F.struct(F.lit(v).alias("of"), F.col(f"{v}_cell").alias("cell"), F.col(v).alias("value")) for v in asked.values()]
    cells = cut.select(F.inline(F.array(*pairs))).filter("value IS NOT NULL")
    held: dict[str, list[tuple[float, int]]] = {v: [] for v in asked.values()}
    for r in cells.groupBy("of", "cell").count().collect():
        held[r["of"]].append((r["cell"], r["count"]))
    local: list[tuple[str, float, list[int], int]] = []
    for c, v in asked.items():
        before = 0
        for cell, n in sorted(held[v]):
            inside = [r - before for r in columns[c] if before < r <= before + n]
            if inside:
                local.append((v, cell, inside, before))
            before += n
    small = df.sparkSession.createDataFrame(local, "of string, cell double, ranks array<bigint>, before bigint")
    values = cells.join(F.broadcast(small), ["of", "cell"]).groupBy("of", "cell", "value").agg(F.count("*").alias("n"), F.first("ranks").alias("ranks"), F.first("before").alias("before"))
    upto = F.sum("n").over(Window.partitionBy("of", "cell").orderBy("value"))
    found = values.withColumn("upto", upto).select("of", "value", "before", F.explode(F.filter("ranks", lambda r: (r > F.col("upto") - F.col("n")) & (r <= F.col("upto")))).alias("rank"))
    out: dict[str, dict[int, float]] = {c: {} for c in wanted}
    back = {v: c for c, v in names.items()}
    for r in found.collect():
        out[back[r["of"]]][r["before"] + r["rank"]] = r["value"]
    return out
