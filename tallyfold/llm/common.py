"""What the operators of this package share on the Spark side."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits of a membership filter: 4 MB at any number of members.
FILTER_BITS = 25

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def crc_mod(key: str | Column, n: int) -> Column:
    """crc32 of the value as text, modulo n; null counts as the empty text."""
    value = F.col(key) if isinstance(key, str) else key
    return F.pmod(F.crc32(F.coalesce(value.cast("string"), F.lit("")).cast("binary")), F.lit(n))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def bit_filter(df: DataFrame, column: str) -> np.ndarray:
    """A bit for the high FILTER_BITS bits of each value of a column of evenly spread 64-bit hashes.

    A filter that many members fill lets more pass; it never stops a member. At most
    2**(FILTER_BITS - 6) words reach the driver.
    """
    cell = F.shiftrightunsigned(column, 64 - FILTER_BITS)
    words = (
        df.select(F.shiftright(cell, 6).alias("word"), cell.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    bits = np.zeros(1 << (FILTER_BITS - 6), dtype=np.uint64)
    bits[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bits


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes (unsigned 64-bit) may be members."""
    cell = hashes >> np.uint64(64 - FILTER_BITS)
    return (bits[(cell >> np.uint64(6)).astype(np.int64)] >> (cell & np.uint64(63))) & np.uint64(1) == 1
