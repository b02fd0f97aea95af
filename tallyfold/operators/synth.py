"""Synthetic rows: between neighbours, from mixtures, from marginals."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.ml.clustering import GaussianMixture
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.scalar import bin_of, hash_int, hash_uniform
from tallyfold.operators.prep import quantile_edges
from tallyfold.operators.ranking import order_statistics_of, rank_by_hash, rank_by_value
from tallyfold.session import cut_lineage


def smote_ordered(
    df: DataFrame, key: str, order: str, columns: Sequence[str], seed: int
) -> DataFrame:
    """One synthetic row per row, on the way to its exact nearest neighbour along `order`.

    In one dimension the nearest row is the one before or after, so a rank and an equi-join on
    rank +- 1 find it: at most two candidates per row, no pairs within the class.
    """
    ranked = cut_lineage(rank_by_value(df.select(key, *dict.fromkeys([order, *columns])), order, key, descending=False))
    other = ranked.select(
        F.col("rank").alias("_rank"),
        F.col(order).alias("_order"),
        F.struct(*[F.col(c).cast("double").alias(c) for c in columns]).alias("_other"),
    )
    links = ranked.withColumn("_rank", F.explode(F.array(F.col("rank") - 1, F.col("rank") + 1)))
    gap = F.abs(F.col(order) - F.col("_order"))
    nearest = links.join(other, "_rank").groupBy(key).agg(
        F.min_by("_other", F.struct(gap, F.col("_rank"))).alias("_other"),
        *[F.first(c).alias(c) for c in dict.fromkeys([order, *columns])],
    )
    u = hash_uniform(key, seed)
    return nearest.select(key, *[(F.col(c) + u * (F.col(f"_other.{c}") - F.col(c))).alias(c) for c in columns])


PIVOTS = 16
#: Rows of one block at least, and the largest number of blocks, whose summary all tasks hold (1 MB).
BLOCK, BLOCKS = 1024, 4096
#: Rows that ask one block in one group.
ASKING = 4096


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances by products; good for choosing, not for comparing near ties."""
    return np.maximum((x * x).sum(axis=1)[:, None] + (y * y).sum(axis=1)[None, :] - 2.0 * x @ y.T, 0.0)


def _nearest(x: np.ndarray, own: np.ndarray, y: np.ndarray, ids: np.ndarray, k: int) -> list[tuple[int, float, object, int]]:
    """(row of x, distance, id, row of y) of the k nearest rows of y with another id; equal distances go by id."""
    out = []
    for at in range(0, len(x), 256):
        part = x[at : at + 256]
        d = _distances(part, y)
        d[own[at : at + 256, None] == ids[None, :]] = np.inf
        slack = 1e-9 * ((part * part).sum(axis=1) + (y * y).sum(axis=1).max())
        upto = np.partition(d, min(k, len(y)) - 1, axis=1)[:, min(k, len(y)) - 1] + slack
        for i in range(len(part)):
            near = np.flatnonzero((d[i] <= upto[i]) & np.isfinite(d[i]))
            exact = np.round(np.sqrt(((part[i] - y[near]) ** 2).sum(axis=1)), 9)
            best = sorted(zip(exact.tolist(), ids[near].tolist(), near.tolist(), strict=True))[:k]
            out += [(at + i, dist, other, j) for dist, other, j in best]
    return out


def nearest_neighbours(df: DataFrame, key: str, vector: str, k: int) -> DataFrame:
    """(key, _v, _n) with _n the k nearest other rows as (d, id, v), exact at any number of rows.

    Every row knows its distances to PIVOTS fixed rows. Rows in order of (nearest pivot,
    distance to it) are cut into blocks; a block keeps the least and the largest distance of
    its rows to each pivot. The k-th distance inside the own block bounds a row's search: only
    blocks whose distances to every pivot come within that bound of the row's are asked
    (triangle inequality). Where vectors gather, few blocks are; where all are about equally
    far from each other, all are, in groups of at most ASKING rows each.

    The key is unique. Vectors that are null, have a null or NaN component, or another length
    than the first pivot's have no neighbours and are left out; a row alone has none.
    """
    spark = df.sparkSession
    sound = F.col(vector).isNotNull() & F.coalesce(F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double"))), F.lit(False))
    rows = df.filter(sound).select(F.col(key).alias("id"), F.transform(vector, lambda c: c.cast("double")).alias("v"))
    first = rows.orderBy(hash_int("id", 0), "id").limit(PIVOTS).collect()
    if not first:
        none = df.filter(F.lit(False)).select(key, F.transform(vector, lambda c: c.cast("double")).alias("_v"))
        kind = dict(df.dtypes)[key]
        return none.withColumn("_n", F.array().cast(f"array<struct<d:double,id:{kind},v:array<double>>>"))
    size = len(first[0]["v"])
    pivots = np.array([r["v"] for r in first if len(r["v"]) == size], dtype=float).reshape(-1, size)
    kind = dict(rows.dtypes)["id"]

    def placed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            x = np.stack(pdf["v"].to_numpy()) if len(pdf) else np.empty((0, size))
            d = np.sqrt(_distances(x, pivots))
            nearest = d.argmin(axis=1) if len(pdf) else np.empty(0, dtype=int)
            near = d[np.arange(len(pdf)), nearest]
            yield pd.DataFrame({"id": pdf["id"], "v": pdf["v"], "p": list(d), "place": nearest + near / (1.0 + near)})

    of_size = rows.filter(F.size("v") == size)
    stored = cut_lineage(of_size.mapInPandas(placed, f"id {kind}, v array<double>, p array<double>, place double"))
    ranked = rank_by_value(stored.select("id", "place").withColumn("_t", hash_int("id", 1)), "place", "_t", descending=False)
    block = F.floor((F.col("rank") - 1) / F.greatest(F.lit(BLOCK), F.ceil(F.col("total") / BLOCKS))).cast("int")
    blocks = cut_lineage(stored.drop("place").join(ranked.select(F.col("id").alias("_id"), block.alias("block")), F.col("id") == F.col("_id")).drop("_id"))

    # The k-th distance inside the own block: what farther blocks have to beat.
    def inside(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = np.stack(pdf["v"].to_numpy()), pdf["id"].to_numpy()
        reach = np.full(len(pdf), np.inf)
        count = np.zeros(len(pdf), dtype=int)
        last = np.zeros(len(pdf))
        for i, d, _, _ in _nearest(x, ids, x, ids, k):
            count[i] += 1
            last[i] = d
        reach[count == k] = last[count == k]
        return pd.DataFrame({"id": ids, "v": pdf["v"], "p": pdf["p"], "reach": reach})

    asking = cut_lineage(blocks.groupBy("block").applyInPandas(inside, f"id {kind}, v array<double>, p array<double>, reach double"))
    ends = blocks.groupBy("block").agg(*[f(F.get("p", i)).alias(f"{n}{i}") for i in range(len(pivots)) for n, f in (("lo", F.min), ("hi", F.max))])
    summary = ends.collect()
    numbers = np.array([r["block"] for r in summary], dtype=int)
    low, high = (np.array([[r[f"{n}{i}"] for i in range(len(pivots))] for r in summary]).reshape(len(summary), -1) for n in ("lo", "hi"))

    def asked(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), 256):
                part = pdf.iloc[at : at + 256]
                p = np.stack(part["p"].to_numpy())
                gap = np.maximum(np.maximum(p[:, None, :] - high[None], low[None] - p[:, None, :]), 0.0).max(axis=2)
                # Distances by products round; a little more is asked than the bound says.
                row, which = np.nonzero(gap <= part["reach"].to_numpy()[:, None] * (1 + 1e-6) + 1e-4 * (1 + p.max(axis=1))[:, None])
                yield pd.DataFrame({"id": part["id"].to_numpy()[row], "v": part["v"].to_numpy()[row], "block": numbers[which]})

    ask = asking.mapInPandas(asked, f"id {kind}, v array<double>, block int")
    ask = cut_lineage(ask.withColumn("part", hash_int("id", 2)))
    parts = F.greatest(F.ceil(F.count(F.lit(1)) / ASKING), F.lit(1)).cast("int")
    n_parts = cut_lineage(ask.groupBy(F.col("block").alias("of")).agg(parts.alias("parts")))
    left = ask.join(n_parts, F.col("block") == F.col("of")).select("id", "v", "block", (F.col("part") % F.col("parts")).cast("int").alias("part"))
    right = blocks.join(n_parts, F.col("block") == F.col("of")).select("id", "v", "block", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))

    def answer(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        found = _nearest(np.stack(a["v"].to_numpy()), a["id"].to_numpy(), np.stack(b["v"].to_numpy()), b["id"].to_numpy(), k) if len(a) and len(b) else []
        i, d, other, j = zip(*found, strict=True) if found else ((), (), (), ())
        return pd.DataFrame({"id": a["id"].to_numpy()[list(i)], "v": a["v"].to_numpy()[list(i)], "d": np.array(d, dtype=float), "near": list(other), "nv": b["v"].to_numpy()[list(j)]})

    schema = f"id {kind}, v array<double>, d double, near {kind}, nv array<double>"
    found = left.groupBy("block", "part").cogroup(right.groupBy("block", "part")).applyInPandas(answer, schema)
    # At most k of each block.
    best = F.slice(F.array_sort(F.collect_list(F.struct("d", F.col("near").alias("id"), F.col("nv").alias("v")))), 1, k)
    return found.groupBy("id").agg(F.first("v").alias("_v"), best.alias("_n")).withColumnRenamed("id", key)


def smote(
    df: DataFrame, key: str, vector: str, class_column: str, class_to_augment, per_row: int | None = None, num_rows: int | None = None,
    neighbours: int = 5, seed: int = 10,
) -> DataFrame:
    """Synthetic vectors of a class, each between a row and one of its nearest neighbours.

    Every row gives `per_row` vectors; or there are `num_rows` in all, the rows first in a
    seeded order giving one more where they do not share evenly. Neighbours are exact, see
    nearest_neighbours(). A class of one row gives none.
    """
    if (per_row is None) == (num_rows is None):
        raise ValueError("give per_row or num_rows")
    found = nearest_neighbours(df.filter(F.col(class_column) == class_to_augment), key, vector, neighbours)
    if per_row is not None:
        counted = found.withColumn("_copies", F.lit(per_row))
    else:
        found = cut_lineage(found)
        ranked = rank_by_hash(found.select(F.col(key).alias("_key2")), "_key2", seed + 2)
        more = F.when(F.col("rank") <= F.lit(num_rows) % F.col("total"), 1).otherwise(0)
        shares = ranked.select("_key2", (F.floor(F.lit(num_rows) / F.col("total")) + more).cast("int").alias("_copies"))
        counted = found.join(shares, F.col(key) == F.col("_key2")).drop("_key2").filter("_copies > 0")
    copies = counted.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_copies"))))
    draw = F.concat_ws("#", F.col(key), F.col("copy"))
    pick = F.element_at("_n", (F.floor(hash_uniform(draw, seed) * F.size("_n")) + 1).cast("int"))
    u = hash_uniform(draw, seed + 1)
    moved = F.zip_with("_v", pick["v"], lambda a, b: a + u * (b - a))
    return copies.select(key, "copy", pick["id"].alias("neighbour"), moved.alias("vector"))


#: Rows of a block of numbers, and partitions up to which the driver alone adds up their sums.
NUMBERS, FEW = 1 << 14, 32
#: Spark's spread of a density, and the tolerance and rounds of its estimator.
EPSILON, TOLERANCE, ROUNDS = 2.0**-52, 0.01, 50


@dataclass
class _Mixture:
    """Weights, means and variances of the components, and how far the fit has come."""

    weight: np.ndarray
    mean: np.ndarray
    var: np.ndarray
    value: float = -float(np.finfo(float).max)
    before: float = 0.0

    def settled(self) -> bool:
        return not abs(self.value - self.before) > TOLERANCE

    def sums(self, x: np.ndarray) -> tuple[float, np.ndarray]:
        """Log likelihood of some rows; each component's sums of shares, of share * x and of share * x * x."""
        sound = self.var > EPSILON * self.var
        safe = np.where(sound, self.var, 1.0)
        p = x[None, :] - self.mean[:, None]
        p *= np.where(sound, np.sqrt(1.0 / safe), 0.0)[:, None]
        p *= p
        p *= -0.5
        p += (-0.5 * (math.log(2.0 * math.pi) + np.log(safe)))[:, None]
        np.exp(p, out=p)
        p *= self.weight[:, None]
        p += EPSILON
        total = p.sum(axis=0)
        p /= total
        return float(np.log(total).sum()), np.stack([p.sum(axis=1), p @ x, p @ (x * x)])

    def moved(self, value: float, sums: np.ndarray) -> _Mixture:
        share, first, second = sums
        mean = first / share
        return _Mixture(share / share.sum(), mean, (second - share * mean * mean) / share, value, self.value)


def _numbers(rows: DataFrame, column: str) -> RDD:
    """The column's values as arrays, at most NUMBERS in one."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column(0).to_numpy(zero_copy_only=False)
            for at in range(0, len(x), NUMBERS):
                yield pa.RecordBatch.from_arrays([pa.array([x[at : at + NUMBERS].tobytes()], type=pa.binary())], names=["x"])

    return rows.select(column).mapInArrow(packed, "x binary").rdd.map(lambda r: np.frombuffer(r[0], dtype=np.float64))


def _climbed(blocks: RDD, models: dict[int, _Mixture]) -> dict[int, _Mixture]:
    """Expectation-maximisation of all models at once: a round is one pass, which the settled ones sit out."""
    models = dict(models)
    for _ in range(ROUNDS):
        going = {k: m for k, m in models.items() if not m.settled()}
        if not going:
            break

        def one(items: Iterator[np.ndarray], going: dict = going) -> Iterator[dict]:
            out: dict = {}
            for x in items:
                found = {k: m.sums(x) for k, m in going.items()}
                out = merge(out, found)
            yield out

        def merge(a: dict, b: dict) -> dict:
            return {k: (a[k][0] + b[k][0], a[k][1] + b[k][1]) for k in a} if a and b else a or b

        depth = 1 if blocks.getNumPartitions() <= FEW else 2
        found = blocks.mapPartitions(one).treeAggregate({}, merge, merge, depth)
        models |= {k: m.moved(*found[k]) for k, m in going.items()}
    return models


def mixture_table(df: DataFrame, column: str, max_clusters: int = 10, seed: int = 1) -> list[tuple]:
    """(component, weight, mean, std) of a one-column Gaussian mixture; the number of
    components has the lowest BIC among 1..max_clusters.

    Spark's estimator draws the starts; its rounds are made here, for all numbers of components
    in one pass over arrays, with its formulas, tolerance and limit of rounds.
    """
    rows = VectorAssembler(inputCols=[column], outputCol="features", handleInvalid="skip").transform(df.select(column))
    stored = cut_lineage(rows.select("features", F.col(column).cast("double").alias("_x")))
    x = F.col(column).cast("double")
    one = df.agg(F.count(x).alias("n"), F.avg(x).alias("mean"), F.var_pop(x).alias("var")).first()
    n, std = one["n"], math.sqrt(one["var"])
    single = -0.5 * n * (math.log(2 * math.pi * one["var"]) + 1.0)
    best = (-2.0 * single + 2 * math.log(n), None)
    models = {}
    for k in range(2, max_clusters + 1):
        start = GaussianMixture(k=k, seed=seed, maxIter=0).fit(stored.select("features"))
        var = [float(g.cov.toArray()[0][0]) for g in start.gaussians]
        models[k] = _Mixture(np.array(start.weights, dtype=float), np.array([float(g.mean[0]) for g in start.gaussians]), np.array(var))
    if models:
        blocks = _numbers(stored, "_x").persist(StorageLevel.MEMORY_AND_DISK)
        models = _climbed(blocks, models)
        blocks.unpersist()
    for k, model in models.items():
        bic = -2.0 * model.value + (3 * k - 1) * math.log(n)
        if bic < best[0]:
            best = (bic, model)
    model = best[1]
    if model is None:
        return [(0, 1.0, one["mean"], std)]
    parts = zip(model.weight.tolist(), model.mean.tolist(), model.var.tolist(), strict=True)
    return [(i, w, mean, math.sqrt(var)) for i, (w, mean, var) in enumerate(parts)]


def level_shares(df: DataFrame, columns: Sequence[str], at_most: int = 1000) -> dict[str, list[tuple[str, float]]]:
    """Levels of class columns with their cumulative shares, in one job. Columns with more
    levels are refused, so the answer is short."""
    pairs = [F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in columns]
    counts = df.select(F.inline(F.array(*pairs))).filter("v IS NOT NULL").groupBy("c", "v").agg(F.count("*").alias("n"))
    rows = counts.limit(at_most * len(columns) + 1).collect()
    out = {}
    for c in columns:
        mine = sorted((r["v"], r["n"]) for r in rows if r["c"] == c)
        if len(mine) > at_most:
            raise ValueError(f"{c} has more than {at_most} levels: not a class variable")
        total, so_far, shares = sum(n for _, n in mine), 0, []
        for v, n in mine:
            so_far += n
            shares.append((v, so_far / total))
        out[c] = shares
    return out


def _draw_level(u: Column, shares: Sequence[tuple[str, float]]) -> Column:
    """The first level whose cumulative share exceeds u."""
    passed = F.size(F.filter(F.array(*[F.lit(upto) for _, upto in shares]), lambda upto: upto <= u))
    return F.element_at(F.array(*[F.lit(level) for level, _ in shares]), passed + 1)


def synthesize(
    df: DataFrame, nominal: Sequence[str], interval: Sequence[str], rows: int, seed: int, grid: int = 100
) -> DataFrame:
    """A table of `rows` independent draws that keeps each column's distribution.

    Nominal columns follow the original level frequencies; interval columns are drawn from the
    inverse distribution function through `grid` exact quantiles. A column keeps its share of
    missing values. All draws are hashes of the row id.
    """
    out = df.sparkSession.range(rows).withColumnRenamed("id", "row_id")
    new: dict[str, Column] = {}
    filled = df.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in [*nominal, *interval]]).first().asDict()
    for c, shares in level_shares(df, nominal).items():
        if not shares:
            new[c] = F.lit(None).cast("string")
            continue
        new[c] = _draw_level(hash_uniform("row_id", f"{seed}{c}"), shares)
    ranks = {c: [max(1, -(-i * filled[c] // grid)) for i in range(grid + 1)] for c in interval}
    values = order_statistics_of(df, {c: r for c, r in ranks.items() if filled[c]}) if interval else {}
    for c in interval:
        if not filled[c]:
            new[c] = F.lit(None).cast("double")
            continue
        at = hash_uniform("row_id", f"{seed}{c}") * grid
        step = F.floor(at).cast("int")
        table = F.array(*[F.lit(float(values[c][r])) for r in ranks[c]])
        low, high = F.element_at(table, step + 1), F.element_at(table, step + 2)
        new[c] = low + (at - step) * (high - low)
    for c, value in new.items():
        if 0 < filled[c] < filled["_rows"]:
            gone = hash_uniform("row_id", f"{seed}{c}|missing") >= filled[c] / filled["_rows"]
            new[c] = F.when(~gone, value)
    return out.withColumns(new)


def compare_distributions(original: DataFrame, synthetic: DataFrame, columns: Sequence[str], bins: int = 20) -> DataFrame:
    """(variable, bin, original share, synthetic share) on the original's quantile bins."""
    edges = quantile_edges(original, columns, bins, interpolate=False)
    pairs = [F.struct(F.lit(c).alias("variable"), bin_of(c, e).alias("bin")) for c, e in edges.items()]
    both = original.select(*columns, F.lit(1).alias("_o")).unionByName(synthetic.select(*columns, F.lit(0).alias("_o")))
    counts = both.select("_o", F.inline(F.array(*pairs))).groupBy("variable", "bin").agg(
        F.sum("_o").alias("n_original"), F.sum(1 - F.col("_o")).alias("n_synthetic")
    )
    w = Window.partitionBy("variable")
    return counts.select(
        "variable",
        "bin",
        (F.col("n_original") / F.sum("n_original").over(w)).alias("original"),
        (F.col("n_synthetic") / F.sum("n_synthetic").over(w)).alias("synthetic"),
    )
