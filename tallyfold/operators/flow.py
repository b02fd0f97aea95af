"""The preparation chain: standardise, encode, partition."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import prep
from tallyfold.operators.ranking import rank_by_hash
from tallyfold.operators.sampling import TEST, TRAIN, VALIDATE


def prepare(
    df: DataFrame,
    key: str,
    scale: Sequence[str],
    dummies: Mapping[str, Mapping],
    seed: int,
    period: str,
) -> DataFrame:
    """All periods at once: z-scores inside each period with originals under orig_, known
    codes as dummies, and an exact 60/30/10 partition inside every period."""
    out = prep.standardize_within(df, scale, period, keep_prefix="orig_")
    for column, codes in dummies.items():
        out = prep.dummies(out, column, codes)
    ranked = rank_by_hash(out, key, seed, [period], "_rank", "_total")
    train = F.round(F.col("_total") * 0.6, 0)
    upto = train + F.round(F.col("_total") * 0.3, 0)
    part = F.when(F.col("_rank") <= train, TRAIN).when(F.col("_rank") <= upto, VALIDATE).otherwise(TEST)
    return ranked.withColumn("analytic_partition", part).drop("_rank", "_total")
