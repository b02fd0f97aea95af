"""Benchmark decontamination by greedy string tiling over shared token seeds."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.llm import kernel
from tallyfold.llm.common import bit_filter, passes
from tallyfold.session import cut_lineage

#: Tokens of a seed, and so the least length of a tile.
WIDTH = 5
#: Share of a test item's tokens that tiles must cover.
COVERAGE = 0.5

#: Signs that separate words although their bytes are not ASCII.
_SIGNS = " ‘’‚“”„«»–—…¿¡·"


def _plain(text: str):
    return F.translate(F.lower(F.col(text)), _SIGNS, " " * len(_SIGNS))


def _seeds(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Rolling hashes of `width` tokens: seed, row, position of its first token; and the tokens of each row."""
    data, bounds = kernel.utf8(batch.column("text"))
    starts, ends, rows = kernel.spans(data, bounds, kernel.ALNUM)
    seeds, first = kernel.windows(kernel.span_hashes(data, starts, ends), rows, width)
    begins = np.searchsorted(rows, np.arange(batch.num_rows + 1))
    return seeds, rows[first], first - begins[rows[first]], np.diff(begins)


def _grouped(seeds: np.ndarray, rows: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, pa.ListArray]:
    """One entry for each distinct seed of a row: row, seed, and its positions in ascending order."""
    order = np.lexsort((at, seeds, rows))
    seeds, rows, at = seeds[order], rows[order], at[order]
    new = np.ones(len(seeds), dtype=bool)
    new[1:] = (seeds[1:] != seeds[:-1]) | (rows[1:] != rows[:-1])
    first = np.flatnonzero(new)
    places = pa.ListArray.from_arrays(pa.array(np.append(first, len(seeds)), type=pa.int32()), pa.array(at.astype(np.int64)))
    return rows[first], seeds[first].view(np.int64), places


def _item_rows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in kernel.slices(batches, "text"):
        seeds, rows, at, sizes = _seeds(batch, width)
        rows, seeds, places = _grouped(seeds, rows, at)
        take = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("item_id").take(take), batch.column("item_key").take(take), pa.array(sizes[rows].astype(np.int64)), pa.array(seeds), places],
            names=["item_id", "item_key", "item_tokens", "seed", "item_at"],
        )


def _hits(batches: Iterator[pa.RecordBatch], shared, width: int) -> Iterator[pa.RecordBatch]:
    bits = shared.value
    for batch in kernel.slices(batches, "text"):
        seeds, rows, at, _ = _seeds(batch, width)
        found = passes(bits, seeds)
        rows, seeds, places = _grouped(seeds[found], rows[found], at[found])
        take = pa.array(rows)
        yield pa.RecordBatch.from_arrays(
            [batch.column("row_key").take(take), batch.column("text_key").take(take), pa.array(seeds), places],
            names=["row_key", "text_key", "seed", "doc_at"],
        )


def tile(doc_at: np.ndarray, item_at: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling from the shared seeds of two texts: (doc start, item start, tokens) of each tile.

    Seeds that follow each other on a diagonal are one common passage. The longest free
    passage becomes a tile again and again (ties: first in the document, then in the item);
    a passage that a tile has cut goes on as its free parts of at least `width` tokens.
    """
    diagonal = doc_at - item_at
    order = np.lexsort((doc_at, diagonal))
    d, i, g = doc_at[order], item_at[order], diagonal[order]
    breaks = np.flatnonzero((np.diff(g) != 0) | (np.diff(d) != 1)) + 1
    heap = []
    for a, b in zip(np.concatenate([[0], breaks]), np.concatenate([breaks, [len(d)]]), strict=True):
        if b > a:
            heap.append((-(int(b - a) + width - 1), int(d[a]), int(i[a])))
    heapq.heapify(heap)
    doc_marked: set[int] = set()
    item_marked: set[int] = set()
    tiles = []
    while heap:
        length, da, ia = heapq.heappop(heap)
        length = -length
        free = [da + k not in doc_marked and ia + k not in item_marked for k in range(length)]
        if all(free):
            tiles.append((da, ia, length))
            doc_marked.update(range(da, da + length))
            item_marked.update(range(ia, ia + length))
            continue
        at = 0
        while at < length:
            upto = at
            while upto < length and free[upto]:
                upto += 1
            if upto - at >= width:
                heapq.heappush(heap, (-(upto - at), da + at, ia + at))
            at = upto + 1
    return tiles


def tile_seeds(doc_at: np.ndarray, doc_seed: np.ndarray, item_at: np.ndarray, item_seed: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """The tiles of tile(), from each side's own positions and seed numbers: memory is linear in both texts.

    Running Karp-Rabin: windows of 2, 4, 8, ... seeds are numbered by pairs of shorter ones, so
    two lookups name a window of any length. A binary search finds the longest length with a
    window free on both sides; its windows become tiles in the document's order, each at its
    first free place in the item; then the next shorter length is searched among the free seeds.
    """
    d, i = np.argsort(doc_at), np.argsort(item_at)
    at, split = np.concatenate([doc_at[d], item_at[i]]), len(doc_at)
    n = len(at)
    if split == 0 or split == n:
        return []
    index, sides = np.arange(n), ((0, split), (split, n))
    follows = np.zeros(n, dtype=bool)
    follows[:-1] = np.diff(at) == 1
    follows[split - 1] = False
    free = np.ones(n, dtype=bool)
    names = [np.concatenate([doc_seed[d], item_seed[i]]).astype(np.int64)]

    def lengths() -> np.ndarray:
        """Free seeds in a row from each position on."""
        stop = ~follows
        stop[:-1] |= ~free[1:]
        ends = np.flatnonzero(stop)
        return np.where(free, ends[np.searchsorted(ends, index)] - index + 1, 0)

    def windows(length: int) -> np.ndarray:
        """A number for the window of `length` seeds at each position; only meant where so many follow each other."""
        level = length.bit_length() - 1
        while len(names) <= level:
            half = 1 << (len(names) - 1)
            both = names[-1] * (n + 1) + names[-1][np.minimum(index + half, n - 1)]
            names.append(np.unique(both, return_inverse=True)[1].astype(np.int64))
        return names[level] * (n + 1) + names[level][np.minimum(index + length - (1 << level), n - 1)]

    def common(length: int, run: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window numbers, document positions, item positions) of the free windows that both sides hold."""
        named = windows(length)
        docs, items = np.flatnonzero(run[:split] >= length), split + np.flatnonzero(run[split:] >= length)
        docs = docs[np.isin(named[docs], named[items])]
        return named, docs, items

    def mark(side: tuple[int, int], start: int, tokens: int) -> None:
        """No seed that touches these tokens is free any more."""
        low, high = np.searchsorted(at[side[0] : side[1]], [start - width + 1, start + tokens])
        free[side[0] + low : side[0] + high] = False

    tiles: list[tuple[int, int, int]] = []
    limit = n
    while True:
        run = lengths()
        low, high = 0, int(min(limit, run[:split].max(), run[split:].max()))
        guess = high
        while low < high:
            if len(common(guess, run)[1]):
                low = guess
            else:
                high = guess - 1
            guess = (low + high + 1) // 2
        if low == 0:
            return tiles
        named, docs, items = common(low, run)
        places: dict[int, list[int]] = {}
        for y in items[np.isin(named[items], named[docs])][::-1].tolist():
            places.setdefault(int(named[y]), []).append(y)
        tokens, until = low + width - 1, -1
        for x, start, name in zip(docs.tolist(), at[docs].tolist(), named[docs].tolist(), strict=True):
            if not places:
                break
            if start < until or name not in places:
                continue
            left = places[name]
            while left and not free[left[-1] : left[-1] + low].all():
                left.pop()
            if left:
                begin = int(at[left.pop()])
                tiles.append((start, begin, tokens))
                mark(sides[0], start, tokens)
                mark(sides[1], begin, tokens)
                until = start + tokens
            if not left:
                del places[name]
        limit = low - 1


def _tiles_of(entries: pa.StructArray, width: int) -> list[tuple[int, int, int]]:
    """The tiles of one document and item from their shared seeds' positions."""
    doc, item = entries.field("doc_at"), entries.field("item_at")
    n_doc, n_item = (np.asarray(x.value_lengths(), dtype=np.int64) for x in (doc, item))
    doc_at, item_at = (np.asarray(x.flatten(), dtype=np.int64) for x in (doc, item))
    seed = np.arange(len(entries))
    if (np.minimum(n_doc, n_item) == 1).all():
        # Each seed is single on one side: there are no more pairs of positions than positions.
        pairs = n_doc * n_item
        which = np.repeat(seed, pairs)
        k = np.arange(len(which)) - np.repeat(np.cumsum(pairs) - pairs, pairs)
        return tile(
            doc_at[(np.cumsum(n_doc) - n_doc)[which] + np.minimum(k, n_doc[which] - 1)],
            item_at[(np.cumsum(n_item) - n_item)[which] + np.minimum(k, n_item[which] - 1)],
            width,
        )
    return tile_seeds(doc_at, np.repeat(seed, n_doc), item_at, np.repeat(seed, n_item), width)


def _tiled(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        shared = batch.column("shared")
        covered, where = [], []
        for r in range(batch.num_rows):
            tiles = _tiles_of(shared[r].values, width)
            covered.append(sum(t[2] for t in tiles))
            where.append([{"doc_start": a, "item_start": b, "tokens": n} for a, b, n in sorted(tiles)])
        kind = pa.list_(pa.struct([("doc_start", pa.int64()), ("item_start", pa.int64()), ("tokens", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("row_key", "item_id", "item_tokens")), pa.array(covered, type=pa.int64()), pa.array(where, type=kind)],
            names=["row_key", "item_id", "item_tokens", "covered_tokens", "tiles"],
        )


def overlaps(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", width: int = WIDTH
) -> DataFrame:
    """(key, item, item_tokens, covered_tokens, coverage, tiles) for each document and test item with a common seed.

    Tokens are lower-case runs of letters and digits. A seed is `width` consecutive tokens.
    Document seeds pass a fixed-size bit filter of the benchmark's seeds and are then joined
    with them, so only seeds of test items are shuffled, and tiles are laid for each pair. A
    seed travels once for a text with all its positions, and a pair of texts holds each side's
    positions, not their products, so a text that repeats itself costs no more than its length.

    Null or empty texts and items with fewer than `width` tokens match nothing. Repeated
    rows give one result; documents that share a key but not the text are taken apart, and
    the best coverage of an item is reported for the key. Texts that share an item's id are
    taken apart in the same way. Rows with a null key match too,
    under the null key. Empty tables give no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col(item).alias("item_id"), F.xxhash64(item_text).alias("item_key"), _plain(item_text).alias("text")).distinct()
    item_type = dict(items.dtypes)["item_id"]
    seeds = cut_lineage(
        items.mapInArrow(
            lambda it: _item_rows(it, width), f"item_id {item_type}, item_key bigint, item_tokens bigint, seed bigint, item_at array<bigint>"
        )
    )

    shared = spark.sparkContext.broadcast(bit_filter(seeds, "seed"))

    source = docs.select(F.col(key).alias("row_key"), F.xxhash64(text).alias("text_key"), _plain(text).alias("text"))
    key_type = dict(source.dtypes)["row_key"]
    hits = source.mapInArrow(lambda it: _hits(it, shared, width), f"row_key {key_type}, text_key bigint, seed bigint, doc_at array<bigint>")
    pairs = (
        hits.join(seeds, "seed")
        .groupBy("row_key", "text_key", "item_id", "item_key", "item_tokens")
        .agg(F.collect_set(F.struct("doc_at", "item_at")).alias("shared"))
    )
    tiles = "array<struct<doc_start:bigint,item_start:bigint,tokens:bigint>>"
    tiled = pairs.select("row_key", "item_id", "item_tokens", "shared").mapInArrow(
        lambda it: _tiled(it, width), f"row_key {key_type}, item_id {item_type}, item_tokens bigint, covered_tokens bigint, tiles {tiles}"
    )
    best = tiled.groupBy("row_key", "item_id").agg(
        F.max(F.struct((F.col("covered_tokens") / F.col("item_tokens")).alias("coverage"), "covered_tokens", "item_tokens", "tiles")).alias("best")
    )
    return best.select(
        F.col("row_key").alias(key), F.col("item_id").alias(item), "best.item_tokens", "best.covered_tokens", "best.coverage", "best.tiles"
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, **names) -> DataFrame:
    """The overlaps that cover at least this share of a test item; see overlaps()."""
    return overlaps(docs, benchmark, **names).filter(F.col("coverage") >= coverage)
