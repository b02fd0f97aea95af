"""Near duplicates by b-bit MinHash: bands propose, packed bits estimate, full sets confirm."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import kernel
from tallyfold.llm.common import bit_filter, passes
from tallyfold.llm.components import components
from tallyfold.session import cut_lineage

WIDTH = 5
ROWS = 4
BANDS = 40
BITS = 2
PERCENT = 75
#: Members of a bucket group that one task compares; larger groups are cut into slices of about this size.
SLICE = 256
#: Standard deviations below the threshold at which the estimate may drop a pair (chance below 1e-6).
MARGIN = 5.0

_MINIMA = ROWS * BANDS
_PER_LONG = 64 // BITS
_LONGS = _MINIMA // _PER_LONG
_rng = np.random.default_rng(20)
_FACTORS = _rng.integers(1, 1 << 63, _MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _rng.integers(1, 1 << 63, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHIFTS = np.arange(_PER_LONG, dtype=np.uint64) * np.uint64(BITS)

SIGNATURE = "row_key bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, bits array<bigint>"


def shingle_sets(batch: pa.RecordBatch, text: str, width: int) -> Iterator[np.ndarray]:
    """For each row the sorted distinct hashes of its word shingles (see near_duplicates)."""
    data, bounds = kernel.utf8(batch.column(text))
    data = kernel.LOWER[data]
    starts, ends, rows = kernel.spans(data, bounds, kernel.WORD)
    words = kernel.span_hashes(data, starts, ends)
    shingles, first = kernel.windows(words, rows, width)
    word_at = np.searchsorted(rows, np.arange(batch.num_rows + 1))
    at = np.searchsorted(first, word_at)
    for r in range(batch.num_rows):
        n = word_at[r + 1] - word_at[r]
        if n == 0:
            yield np.empty(0, dtype=np.uint64)
        elif n < width:
            whole, _ = kernel.windows(words[word_at[r] : word_at[r + 1]], np.zeros(n, dtype=np.int64), int(n))
            yield whole + np.uint64(n)
        else:
            yield np.unique(shingles[at[r] : at[r + 1]])


def _minima(shingles: np.ndarray) -> np.ndarray:
    out = np.full(_MINIMA, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 512):
        np.minimum(out, (shingles[at : at + 512, None] * _FACTORS).min(axis=0), out=out)
    return out


def _signature_rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [("row_key", pa.int64())]
        + [(n, pa.int64()) for n in ("n_shingles", "set_a", "set_b")]
        + [("bands", pa.list_(pa.int64())), ("bits", pa.list_(pa.int64()))]
    )
    band_no = np.arange(BANDS, dtype=np.uint64)
    for batch in kernel.slices(batches, "text"):
        n = batch.num_rows
        sizes, sums = np.zeros(n, dtype=np.int64), np.zeros((n, 2), dtype=np.uint64)
        minima = np.zeros((n, _MINIMA), dtype=np.uint64)
        for r, s in enumerate(shingle_sets(batch, "text", width)):
            sizes[r] = len(s)
            if len(s):
                sums[r] = kernel.mix(s + np.uint64(7)).sum(dtype=np.uint64), (s * (s >> np.uint64(32) | np.uint64(1))).sum(dtype=np.uint64)
                minima[r] = _minima(s)
        with np.errstate(over="ignore"):
            bands = kernel.mix((minima.reshape(n, BANDS, ROWS) * _BAND_FACTORS).sum(axis=2, dtype=np.uint64) + band_no)
        low = kernel.mix(minima) & np.uint64((1 << BITS) - 1)
        bits = (low.reshape(n, _LONGS, _PER_LONG) << _SHIFTS).sum(axis=2, dtype=np.uint64)
        lists = [
            pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1, dtype=np.int32) * a.shape[1]), pa.array(np.ascontiguousarray(a).reshape(-1).view(np.int64))
            )
            for a in (bands, bits)
        ]
        plain = [pa.array(sizes), pa.array(sums[:, 0].copy().view(np.int64)), pa.array(sums[:, 1].copy().view(np.int64))]
        yield pa.RecordBatch.from_arrays([batch.column("row_key").cast(pa.int64()), *plain, *lists], schema=schema)


def _set_rows(batches: Iterator[pa.RecordBatch], width: int, shared) -> Iterator[pa.RecordBatch]:
    """The shingle sets of the rows whose key passes the filter, each (key, set) once in a task."""
    bits, given = shared.value, set()
    for batch in kernel.slices(batches, "text"):
        wanted = passes(bits, batch.column("key_hash").to_numpy().view(np.uint64))
        batch = batch.filter(pa.array(wanted))
        keys, sets = [], []
        for key, s in zip(batch.column("row_key").to_pylist(), shingle_sets(batch, "text", width), strict=True):
            mark = (key, len(s), int(s.sum(dtype=np.uint64)))
            if mark not in given:
                given.add(mark)
                keys.append(key)
                sets.append(s)
        offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
        values = np.concatenate([*sets, np.empty(0, dtype=np.uint64)])
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, type=pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))],
            names=["row_key", "shingles"],
        )


def _similar(a: str, b: str, percent: int):
    """The collision-corrected estimate of two packed signatures is not surely below the threshold."""
    same = F.lit(0)
    mask = int.from_bytes(b"\x55" * 8, "big")
    for j in range(_LONGS):
        x = F.col(a)[j].bitwiseXOR(F.col(b)[j])
        same = same + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(mask)))
    chance = 0.5**BITS
    expected = chance + (1 - chance) * percent / 100
    spread = (expected * (1 - expected) * _MINIMA) ** 0.5
    return same <= F.lit(_MINIMA - (expected * _MINIMA - MARGIN * spread))


def _compared(pairs: DataFrame, texts: DataFrame, width: int, percent: int, *more: Column) -> DataFrame:
    """Pairs (a, b) with both shingle sets as sa and sb, and whether they are linked.

    Only the sets of members of pairs are made and shuffled; texts stay where they are read.
    """
    ids = pairs.select(F.col("a").alias("k")).union(pairs.select(F.col("b").alias("k"))).select(F.xxhash64("k").alias("h"))
    shared = texts.sparkSession.sparkContext.broadcast(bit_filter(ids, "h"))
    hashed = texts.filter("row_key IS NOT NULL").withColumn("key_hash", F.xxhash64("row_key"))
    sets = cut_lineage(hashed.mapInArrow(lambda it: _set_rows(it, width, shared), "row_key bigint, shingles array<bigint>"))
    right = pairs.join(sets.select(F.col("row_key").alias("b"), F.col("shingles").alias("sb")), "b")
    both = right.join(sets.select(F.col("row_key").alias("a"), F.col("shingles").alias("sa")), "a")
    common = F.size(F.array_intersect("sa", "sb"))
    linked = F.lit(100) * common >= F.lit(percent) * (F.size("sa") + F.size("sb") - common)
    return both.select("a", "b", linked.alias("linked"), *more)


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(key, n_shingles, component_id, kept) for each row of docs.

    A row's set holds the distinct `width`-word shingles of its whole text, A-Z lowered;
    fewer words are one shingle; no word, an empty text or null is the empty set, which is
    linked with nothing. Rows with 100 * intersection >= percent * union are linked, and
    component_id is the least key reachable.

    Candidates agree in all ROWS minima of one of BANDS bands: a pair at the threshold is
    missed with a chance of (1 - 0.75**4)**40 = 2.5e-7. Equal sets are one class from the
    start. Each band bucket has a hub, its class with the most company over all bands. The
    packed low bits, corrected for chance collisions, drop pairs MARGIN deviations below the
    threshold; the full sets decide the rest.

    First every member of a bucket is compared with the hub, so a large group of copies
    costs one comparison for each member. For the pairs that the full sets were read for,
    the difference to the hub is kept (what a set has more and what it lacks). After the
    links with hubs are joined to components, only members of different components remain:
    near ones are compared by their differences inside the join, which gives links and no
    other pairs; those far from the hub are compared by packed bits and then by full sets.

    The key must be an integer. Rows with a null key stay, with null component_id and
    kept = true. Repeated keys are one node: they join the classes of all their texts.
    Other columns of docs are not read. No rows in, no rows out.
    """
    texts = docs.select(F.col(key).cast("bigint").alias("row_key"), F.col(text).alias("text"))
    signed = cut_lineage(texts.mapInArrow(lambda it: _signature_rows(it, width), SIGNATURE))
    keyed = signed.filter("row_key IS NOT NULL AND n_shingles > 0")
    classes = cut_lineage(keyed.groupBy("set_a", "set_b", "n_shingles").agg(F.min("row_key").alias("rep")))

    # One row for each class; a key with two texts can stand for two classes.
    one = classes.withColumn("row_key", F.col("rep"))
    nodes = cut_lineage(
        keyed.join(one, ["set_a", "set_b", "n_shingles", "row_key"]).dropDuplicates(["set_a", "set_b", "n_shingles"]).select("rep", "n_shingles", "bands", "bits")
    )
    several = nodes.groupBy("rep").count().filter("count > 1").select("rep")
    banded = nodes.select("rep", "n_shingles", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("rep").alias("low"), F.max("rep").alias("top"), F.count(F.lit(1)).alias("n")).filter("low < top")
    members = cut_lineage(banded.select("band", "rep").join(buckets.select("band", "n"), "band"))
    company = members.groupBy("rep").agg(F.sum("n").alias("company"))
    hubs = members.join(company, "rep").groupBy("band").agg(F.max_by("rep", F.struct("company", -F.col("rep"))).alias("hub"))
    bits = nodes.select("rep", "n_shingles", "bits")
    hub_bits = bits.select(F.col("rep").alias("hub"), F.col("bits").alias("hub_bits"))
    groups = cut_lineage(
        members.join(hubs, "band").filter("rep <> hub").select("hub", "rep").distinct().join(bits, "rep").join(hub_bits, "hub").select(
            F.col("hub"), "rep", "n_shingles", "bits", _similar("bits", "hub_bits", percent).alias("near")
        )
    )
    stars = groups.filter("near").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    near = cut_lineage(
        _compared(
            stars, texts, width, percent,
            F.array_except("sb", "sa").alias("more"), F.array_except("sa", "sb").alias("less"), F.size("sb").alias("size"), F.size("sa").alias("hub_size"),
        )
    )
    links = near.filter("linked").select("a", "b")
    label = cut_lineage(components(links, "a", "b")).withColumnRenamed("component", "label")

    # Only groups with members outside the hub's component are looked at again.
    labelled = groups.join(label.withColumnRenamed("node", "rep"), "rep", "left").withColumn("label", F.coalesce("label", "rep"))
    labelled = labelled.join(label.select(F.col("node").alias("hub"), F.col("label").alias("hub_label")), "hub", "left")
    labelled = cut_lineage(labelled.withColumn("outside", F.col("label") != F.coalesce("hub_label", "hub")).drop("hub_label"))
    open_hubs = labelled.groupBy("hub").agg(F.count_if("outside").alias("out"), F.ceil(F.count(F.lit(1)) / SLICE).alias("slices"))
    left = labelled.join(open_hubs.filter("out > 0").drop("out"), "hub")

    def side(df: DataFrame, mark: str, *columns: str) -> DataFrame:
        """The x side of a group goes to each of its slices, a row of the y side to one."""
        slices = F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)
        slice_ = F.explode(slices) if mark == "x" else F.pmod(F.xxhash64("rep"), F.col("slices"))
        return df.select("hub", slice_.alias("slice"), *(F.col(c).alias(f"{c}_{mark}") for c in ("rep", "label", "outside", "bits", *columns)))

    def different(x: str, y: str):
        """Members of different components whose bits allow a link; a pair of the same kind comes once."""
        return (F.col(f"label_{x}") != F.col(f"label_{y}")) & _similar(f"bits_{x}", f"bits_{y}", percent)

    once = ~F.col("outside_y") | (F.col("rep_x") < F.col("rep_y"))
    deltas = near.select(F.col("a").alias("hub"), F.col("b").alias("rep"), "more", "less", "size", "hub_size")
    close = left.filter("near").drop("n_shingles").join(deltas, ["hub", "rep"])
    added = ("more", "less", "size")
    # Symmetric difference of two sets by way of the hub: what both changed alike cancels out.
    alike = F.size(F.array_intersect("more_x", "more_y")) + F.size(F.array_intersect("less_x", "less_y"))
    apart = F.size("more_x") + F.size("less_x") + F.size("more_y") + F.size("less_y") - 2 * alike
    union = (F.col("size_x") + F.col("size_y") + apart) / 2
    linked = F.lit(100) * (union - apart) >= F.lit(percent) * union
    by_hub = (
        side(close.filter("outside"), "x", *added).join(side(close, "y", *added), ["hub", "slice"])
        .filter(different("x", "y") & once & linked)
        .select(F.col("rep_x").alias("a"), F.col("rep_y").alias("b"))
    )
    # A pair of which one is far from the hub has one member outside, or both are in different components anyway.
    far = side(left.filter("NOT near"), "x").join(side(left, "y", "near"), ["hub", "slice"])
    by_bits = (
        far.filter(different("x", "y") & (F.col("near_y") | (F.col("rep_x") < F.col("rep_y"))))
        .select(F.least("rep_x", "rep_y").alias("a"), F.greatest("rep_x", "rep_y").alias("b"))
        .distinct()
    )
    more = _compared(cut_lineage(by_bits), texts, width, percent).filter("linked").select("a", "b").union(by_hub)

    # Different texts under one key hang together by that key.
    repeated = keyed.groupBy("row_key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("row_key")
    by_key = (
        keyed.join(repeated, "row_key", "left_semi")
        .join(classes, ["set_a", "set_b", "n_shingles"])
        .select(F.col("row_key").alias("a"), F.col("rep").alias("b"))
        .distinct()
    )
    final = components(links.union(more).union(by_key), "a", "b")
    named = classes.join(final.withColumnRenamed("node", "rep"), "rep", "left").select(
        "set_a", "set_b", "n_shingles", F.coalesce("component", "rep").alias("component_id")
    )
    out = signed.select("row_key", "n_shingles", "set_a", "set_b").join(named, ["set_a", "set_b", "n_shingles"], "left")
    own = F.when(F.col("row_key").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "row_key"))
    return out.select(
        F.col("row_key").alias(key),
        "n_shingles",
        own.alias("component_id"),
        F.coalesce(own == F.col("row_key"), F.lit(True)).alias("kept"),
    )
