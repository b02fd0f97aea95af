"""Seeded samples, splits and folds. All randomness is md5 of the row key, so a result
depends on keys and seed only: not on partitions, retries or the engine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalar import hash_int, hash_uniform
from tallyfold.operators.ranking import rank_by_hash

# Partition codes and shares.
VALIDATE, TRAIN, TEST = 0, 1, 2
TRAIN_VALIDATE_TEST = ((TRAIN, 0.6), (VALIDATE, 0.3), (TEST, 0.1))


def simple_random_sample(df: DataFrame, key: str, n: int, seed: int | str) -> DataFrame:
    """n rows, all equally likely. Top-n per partition, then merged: no full sort."""
    return df.orderBy(hash_int(key, seed), F.col(key)).limit(n)


def split_by_hash(
    df: DataFrame, key: str, seed: int | str, shares: Sequence[tuple[int, float]] = TRAIN_VALIDATE_TEST,
    out: str = "analytic_partition",
) -> DataFrame:
    """Partition codes by hash thresholds: no shuffle, shares exact on average only."""
    u, upto, code = hash_uniform(key, seed), Decimal(0), None
    for value, share in shares[:-1]:
        upto += Decimal(str(share))
        test = u < float(upto)
        code = F.when(test, value) if code is None else code.when(test, value)
    return df.withColumn(out, F.lit(shares[-1][0]) if code is None else code.otherwise(shares[-1][0]))


def _rounded(total: Column, share: Decimal) -> Column:
    return F.round(total * F.lit(float(share)), 0)


def split_exact(
    df: DataFrame, key: str, seed: int | str, shares: Sequence[tuple[int, float]] = TRAIN_VALIDATE_TEST,
    out: str = "analytic_partition", last_takes_rest: bool = True,
) -> DataFrame:
    """Partition codes with counts round(share * N), in a seeded random order.

    With last_takes_rest=False, rows beyond the last rounded bound get NULL.
    """
    ranked = rank_by_hash(df, key, seed, rank="_rank", total="_total")
    bound, code = F.lit(0.0), None
    for i, (value, share) in enumerate(shares):
        if last_takes_rest and i == len(shares) - 1:
            continue
        bound = bound + _rounded(F.col("_total"), Decimal(str(share)))
        test = F.col("_rank") <= bound
        code = F.when(test, value) if code is None else code.when(test, value)
    if last_takes_rest:
        code = F.lit(shares[-1][0]) if code is None else code.otherwise(shares[-1][0])
    return ranked.withColumn(out, code).drop("_rank", "_total")


def split_counts(n: int, shares: Sequence[float]) -> list[int]:
    """Rounded partition sizes, last one the rest."""
    sizes = [int((Decimal(n) * Decimal(str(s))).quantize(Decimal(1), ROUND_HALF_UP)) for s in shares[:-1]]
    return [*sizes, n - sum(sizes)]


def kfold(df: DataFrame, key: str, k: int, seed: int | str, out: str = "fold") -> DataFrame:
    """Folds 1..k of equal size (to one row)."""
    ranked = rank_by_hash(df, key, seed, rank="_rank", total="_total")
    return ranked.withColumn(out, F.ceil(F.col("_rank") * k / F.col("_total"))).drop("_rank", "_total")


def oversample(
    df: DataFrame, key: str, target: str, event, seed: int | str, event_share: float = 0.9,
    event_prop: float = 0.5, out: str = "freq",
) -> DataFrame:
    """Keep `event_share` of the events and thin the others until events are `event_prop`
    of the sample; `freq` = class rows per sampled row."""
    is_event = F.col(target) == event
    counts = df.agg(
        F.struct(F.count_if(is_event).alias("n1"), F.count_if(~is_event).alias("n0")).alias("n")
    ).scalar()
    kept = F.round(counts["n1"] * event_share, 0)
    others = F.least(F.round(kept * ((1.0 - event_prop) / event_prop), 0), counts["n0"])
    ranked = rank_by_hash(
        df.filter(F.col(target).isNotNull()).withColumn("_event", is_event), key, seed, ["_event"], "_rank", "_total"
    )
    size = F.when(F.col("_event"), kept).otherwise(others)
    sampled = ranked.filter(F.col("_rank") <= size)
    return sampled.withColumn(out, F.col("_total") / size).drop("_event", "_rank", "_total")


def balanced_bootstrap(
    df: DataFrame, key: str, strata: str, reps: int, seed: int | str, out: str = "replicate"
) -> DataFrame:
    """`reps` replicates of stratum size in which every row is used exactly `reps` times."""
    copies = df.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.lit(reps))))
    copies = copies.withColumn("_copy_key", F.concat_ws("#", F.col(key), F.col("_copy")))
    ranked = rank_by_hash(copies, "_copy_key", seed, [strata], "_rank", "_total")
    replicate = F.ceil(F.col("_rank") * reps / F.col("_total"))
    return ranked.withColumn(out, replicate).drop("_copy", "_copy_key", "_rank", "_total")


def stratified_n(df: DataFrame, key: str, strata: str, sizes: Mapping, seed: int | str) -> DataFrame:
    """A fixed number of rows per stratum; strata not listed give none."""
    wanted = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    listed = df.filter(F.col(strata).isin(list(sizes)))
    ranked = rank_by_hash(listed, key, seed, [strata], "_rank", "_total")
    return ranked.filter(F.col("_rank") <= wanted[F.col(strata)]).drop("_rank", "_total")
