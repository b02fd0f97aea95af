"""Mixing sources to target weights: hash-random order, prefix sums, and a cut at each source's budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.session import cut_lineage

#: Sources in order of their names weigh so much, repeating.
WEIGHTS = (1, 2, 3)
#: No source gives more than so many times its size.
MAX_EPOCHS = 3
#: Documents in one range of a source's order; a source has as many ranges as it needs.
RANGE = 1 << 11
WORD = r"[^\x20\x09-\x0D]+"

_KEY_BITS = 60


def n_words(text: Column) -> Column:
    """Number of words; null has none. Words become one letter each and the blanks go, so memory stays below the text."""
    left = F.translate(F.regexp_replace(text, WORD, "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(left).cast("bigint"), F.lit(0).cast("bigint"))


def random_key(key: Column, seed: int) -> Column:
    """60 bits of the md5 of the key and the seed; null counts as the empty text."""
    text = F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(f"|{seed}"))
    return F.conv(F.substring(F.md5(text), 1, _KEY_BITS // 4), 16, 10).cast("bigint")


def _positions(sources: DataFrame, name: str) -> DataFrame:
    """Adds `position`, the 0-based rank by code point, null last: ranges of names are ranked and shifted.

    The window over ranges sees one row for each partition.
    """
    order = F.col(name).asc_nulls_last()
    ranged = cut_lineage(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(F.col("part").alias("of"), before.alias("before"))
    local = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return ranged.withColumn("local", local).join(shifts, F.col("part") == F.col("of")).withColumn("position", F.col("before") + F.col("local")).drop("part", "of", "before", "local")


def targets(sources: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Adds weight and target to rows of (source, source_size, ...), one a source.

    The sum of all sizes is shared by weight. A target stops at max_epochs times its source's
    size, and what is over is shared among the others, until none is above. Each step is one
    sum over the sources, compared in whole numbers.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("position") % len(weights) + 1).cast("int"))
    weighed = cut_lineage(_positions(sources, "source").withColumn("weight", weight.cast("bigint")).drop("position"))
    cap = F.lit(max_epochs) * F.col("source_size")
    total, divisor = weighed.agg(F.sum("source_size"), F.sum("weight")).first()
    total, divisor = total or 0, divisor or 0
    left = total
    while divisor:
        wide = "decimal(38,0)"
        full = cap.cast(wide) * F.lit(divisor).cast("decimal(19,0)") <= F.col("weight").cast(wide) * F.lit(left).cast("decimal(19,0)")
        capped, open_weight = weighed.agg(F.sum(F.when(full, cap)), F.sum(F.when(~full, F.col("weight")))).first()
        now = total - (capped or 0), open_weight or 0
        if now == (left, divisor):
            break
        left, divisor = now
    share = F.lit(left).cast("double") * F.col("weight").cast("double") / F.lit(float(divisor or 1))
    return weighed.withColumn("target", F.least(cap.cast("double"), share) if divisor else cap.cast("double"))


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, seed: int = 0,
) -> DataFrame:
    """(key, source, size, source_size, target, taken): how many words the mix takes of each row.

    size is the number of words. Within its source, a row has a place by a random key (md5 of
    key and seed, so reruns agree). A source's budget is its target to the nearest word: whole
    epochs of all its rows, then rows in order of the random key up to the exact budget; the
    row at the cut gives its first words only, those behind it give none in that epoch. taken
    counts every epoch and is at most max_epochs times size.

    The order is cut into ranges of the key with about RANGE rows each, however large the
    source: sums run inside a range, and the sums of the ranges before are added.

    Null or empty text: size 0, taken 0. A null source is a source, last in order. Null keys
    share one random key; repeated rows are rows of their own, and rows of equal random key go
    by size. A source without words, or a table without words: target 0. No rows in, no rows
    out. Other columns are not read.
    """
    rows = docs.select(
        F.col(key).alias("row_key"), F.col(source).cast("string").alias("source"), n_words(F.col(text)).alias("size"), random_key(F.col(key), seed).alias("draw")
    )
    rows = cut_lineage(rows)
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_rows"))
    aims = targets(sources, weights, max_epochs)
    budget = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * max_epochs)
    aims = aims.withColumn("budget", budget).select(
        F.col("source").alias("of"), "source_size", "target", F.ceil(F.col("n_rows") / RANGE).alias("n_ranges"),
        F.coalesce(F.expr("budget div nullif(source_size, 0)"), F.lit(0)).alias("epochs"),
        F.coalesce(F.expr("budget % nullif(source_size, 0)"), F.lit(0)).alias("rest"),
    )
    spot = F.floor(F.col("draw") / F.lit(float(1 << _KEY_BITS)) * F.col("n_ranges"))
    placed = rows.join(aims, F.col("source").eqNullSafe(F.col("of"))).withColumn("range", F.least(spot, F.col("n_ranges") - 1)).drop("of", "n_ranges")
    sums = placed.groupBy(F.col("source").alias("of"), F.col("range").alias("at")).agg(F.sum("size").alias("size_of"))
    ahead = F.sum("size_of").over(Window.partitionBy("of").orderBy("at").rowsBetween(Window.unboundedPreceding, -1))
    shifts = sums.select("of", "at", F.coalesce(ahead, F.lit(0)).alias("ahead"))
    inside = Window.partitionBy("source", "range").orderBy("draw", "row_key", "size").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = placed.withColumn("upto", F.sum("size").over(inside)).join(shifts, F.col("source").eqNullSafe(F.col("of")) & (F.col("range") == F.col("at")))
    begins = F.col("ahead") + F.col("upto") - F.col("size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - begins))
    taken = (F.col("epochs") * F.col("size") + last).cast("bigint")
    return ranked.select(F.col("row_key").alias(key), "source", "size", "source_size", "target", taken.alias("taken"))
