"""Random forest for a 0/1 target: upper levels by histograms over all rows, the subtrees below them in tasks.

A tree sees a row as its bins and class only. So rows are binned, dealt by ranges of their bins, and the bootstrap counts of
rows that are equal in bins and class are added up, tree by tree: what is written once, as blocks of arrays, are such entries
and their counts. While a node holds more than SMALL entries of its tree's sample, a level is one pass: every task sums its
entries by (tree, node, input, bin, class), the sums are added by node and the driver sees one split a node. The entries of
smaller nodes are dealt by (tree, node), and each group grows its subtree level by level over arrays. So the deep levels,
which have nearly as many nodes as entries, need no histogram of every node from every task. Scoring deals the distinct bins
of the rows in the same way to stored subtrees and joins the scores to the rows; no tree passes through the driver whole.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.prep import quantile_edges
from tallyfold.session import cut_lineage

LEAF = -1
#: Entries of a sample up to which a node's subtree is grown by one task.
SMALL = 1 << 20
#: Entries of a block; positions in it fit 16 bits.
BLOCK = 1 << 16
#: Inputs whose bins share a long.
PACKED = 7
#: Rows that walk down a tree together.
TOGETHER = 1 << 14
#: Blocks that may meet in one group when scoring.
MET = 256
#: Cells of a histogram held at a time.
CELLS = 1 << 22
#: Most partitions that groups are dealt to.
DEALT = 4000
#: Shares of 2^32 at which a Poisson(1) count steps up.
_STEPS = (np.cumsum([math.exp(-1) / math.factorial(k) for k in range(12)]) * (1 << 32)).astype(np.uint32)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _word(n: int) -> np.uint64:
    return np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64))


def drawn(draw: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree's bootstrap sample: Poisson(1) from the row's own bits."""
    bits = (_mixed(draw.view(np.uint64) + _word(seed * 1_000_003 + tree + 1)) >> np.uint64(32)).astype(np.uint32)
    return sum((bits >= step).view(np.uint8) for step in _STEPS)


def _tried(path: np.ndarray, tree: int, seed: int, inputs: int) -> np.ndarray:
    """Which inputs each node may split on: ceil(sqrt(inputs)) of them, by hash of the tree and the node's place in it."""
    base = _mixed(path.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03) + _word(seed * 1_000_003 + tree + 1))
    ranks = np.stack([_mixed(base + _word(f + 1)) for f in range(inputs)], axis=1).argsort(axis=1, kind="stable").argsort(axis=1)
    return ranks < math.ceil(math.sqrt(inputs))


def _best(cells: np.ndarray, tried: np.ndarray, leaf: int) -> tuple[np.ndarray, ...]:
    """(split or not, input, bin, rows of class 0 and 1 on the left) of each node by gini gain; cells are nodes x inputs x 2 x bins."""
    below = np.cumsum(cells, axis=3)[:, :, :, :-1]
    n0, n1 = below[:, :, 0], below[:, :, 1]
    all0, all1 = (cells[:, :1, c].sum(axis=2, keepdims=True) for c in (0, 1))
    left, right = n0 + n1, all0 + all1 - n0 - n1
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = (n0 * n0 + n1 * n1) / left + ((all0 - n0) ** 2 + (all1 - n1) ** 2) / right - (all0 * all0 + all1 * all1) / (all0 + all1)
    ok = (left >= max(leaf, 1)) & (right >= max(leaf, 1)) & tried[:, :, None]
    gain = np.where(ok, gain, -np.inf).reshape(len(cells), -1)
    at, rows = gain.argmax(axis=1), np.arange(len(cells))
    f, k = np.divmod(at, below.shape[3])
    return gain[rows, at] > 1e-9, f, k, n0[rows, f, k], n1[rows, f, k]


def _counted(slot: np.ndarray, bins: np.ndarray, y: np.ndarray, w: np.ndarray, nodes: int, width: int) -> np.ndarray:
    cells, at = np.empty((nodes, len(bins), 2, width)), (slot * 2 + y) * width
    for f in range(len(bins)):
        cells[:, f] = np.bincount(at + bins[f], weights=w, minlength=nodes * 2 * width).reshape(nodes, 2, width)
    return cells


def _walked(feature: np.ndarray, cut: np.ndarray, left: np.ndarray, bins: np.ndarray) -> np.ndarray:
    """The last node of each row; a right child follows its left one."""
    out, leaf = np.empty(bins.shape[1], dtype=np.int64), left == LEAF
    # The next node, input and bin in one number; a leaf is its own next node, as no bin is above 255.
    step = np.where(leaf, np.arange(len(left)) << 16 | 255, left.astype(np.int64) << 16 | feature.astype(np.int64) << 8 | cut)
    for start in range(0, len(out), TOGETHER):
        some = np.ascontiguousarray(bins[:, start : start + TOGETHER])
        n, flat = some.shape[1], some.ravel()
        at, going = np.zeros(n, dtype=np.int64), np.arange(n)
        while len(going):
            here = at[going]
            for _ in range(2):
                node = step[here]
                here = (node >> 16) + (flat[(node >> 8 & 255) * n + going] > (node & 255))
            at[going] = here
            going = going[~leaf[here]]
        out[start : start + n] = at
    return out


@dataclass(frozen=True)
class _Grown:
    """A tree in order of levels: input, bin, left child or LEAF, rows of class 0 and 1; depth of each node's place."""

    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    n0: np.ndarray
    n1: np.ndarray

    def share(self) -> np.ndarray:
        return self.n1 / np.maximum(self.n0 + self.n1, 1)


def _pruned(left: list[int] | np.ndarray, predicted: np.ndarray, closed: np.ndarray) -> np.ndarray:
    """left without the splits whose two leaves predict the same class; nodes that are not closed are no leaves."""
    left = np.array(left)
    internal = np.flatnonzero(left != LEAF)
    while len(internal):
        a, b = left[internal], left[internal] + 1
        same = (left[a] == LEAF) & (left[b] == LEAF) & closed[a] & closed[b] & (predicted[a] == predicted[b])
        if not same.any():
            break
        left[internal[same]] = LEAF
        internal = internal[~same]
    return left


def _subtree(bins: np.ndarray, y: np.ndarray, w: np.ndarray, tree: int, path: int, depth: int, width: int, leaf: int, seed: int) -> _Grown:
    """Grown to `depth` levels below a node whose rows are given, then pruned."""
    weight, y = w.astype(np.float64), y.astype(np.int64)
    parts = {c: [] for c in ("feature", "cut", "left", "n0", "n1")}
    n1 = np.array([weight @ y])
    n0, paths, total = weight.sum() - n1, np.array([path], dtype=np.uint64), 1

    def to_split() -> np.ndarray:
        return np.flatnonzero((n0 > 0) & (n1 > 0) & (n0 + n1 >= 2 * leaf))

    # Only the rows of nodes that may be split are kept: at is a node's place among these.
    opened, at = to_split(), np.zeros(bins.shape[1], dtype=np.int64)
    for level in range(depth + 1):
        m = len(n0)
        feature, cut, left = np.zeros(m, dtype=np.int8), np.zeros(m, dtype=np.uint8), np.full(m, LEAF, dtype=np.int32)
        left0, left1 = np.zeros(m), np.zeros(m)
        if level == depth:
            opened = opened[:0]
        step = max(1, CELLS // (len(bins) * 2 * width))
        for start in range(0, len(opened), step):
            some = opened[start : start + step]
            if len(some) == len(opened):
                cells = _counted(at, bins, y, weight, len(some), width)
            else:
                mine = np.flatnonzero((at >= start) & (at < start + step))
                cells = _counted(at[mine] - start, bins.take(mine, axis=1), y[mine], weight[mine], len(some), width)
            ok, f, k, a, b = _best(cells, _tried(paths[some], tree, seed, len(bins)), leaf)
            some = some[ok]
            feature[some], cut[some], left0[some], left1[some] = f[ok], k[ok], a[ok], b[ok]
            left[some] = 0
        split = np.flatnonzero(left == 0)
        left[split] = total + 2 * np.arange(len(split))
        for c, v in (("feature", feature), ("cut", cut), ("left", left), ("n0", n0), ("n1", n1)):
            parts[c].append(v)
        if not len(split):
            break
        children = np.full((m, 2), -1, dtype=np.int64)
        children[split] = np.arange(2 * len(split)).reshape(-1, 2)
        n0, n1, paths = (
            np.stack([a, b], axis=1).ravel()
            for a, b in ((left0[split], n0[split] - left0[split]), (left1[split], n1[split] - left1[split]), (2 * paths[split], 2 * paths[split] + np.uint64(1)))
        )
        total, before, opened = total + 2 * len(split), opened, to_split()
        places = np.full(2 * len(split) + 1, -1, dtype=np.int64)
        places[opened] = np.arange(len(opened))
        right = bins.ravel()[feature[before].astype(np.int64)[at] * bins.shape[1] + np.arange(bins.shape[1])] > cut[before][at]
        at = places[children[before]].ravel()[2 * at + right]
        kept = np.flatnonzero(at >= 0)
        if len(kept) < len(at):
            bins, y, weight, at = bins.take(kept, axis=1), y[kept], weight[kept], at[kept]
    g = _Grown(*(np.concatenate(parts[c]) for c in ("feature", "cut", "left", "n0", "n1")))
    left = _pruned(g.left, g.n1 > g.n0, np.ones(len(g.left), dtype=bool))
    alive = np.zeros(len(left), dtype=bool)
    alive[0], found = True, np.array([0])
    while len(found):
        found = left[found[left[found] != LEAF]]
        found = np.concatenate([found, found + 1])
        alive[found] = True
    places = np.cumsum(alive) - 1
    left = np.where(left == LEAF, LEAF, places[left])[alive].astype(np.int32)
    return _Grown(g.feature[alive], g.cut[alive], left, g.n0[alive], g.n1[alive])


class _Top:
    """The upper levels of one tree, grown by the driver; its leaves are closed or hand their rows to a subtree."""

    def __init__(self) -> None:
        self.feature, self.cut, self.left, self.n0, self.n1 = [0], [0], [LEAF], [0.0], [0.0]
        self.path, self.level, self.closed, self.large = [1], [0], [False], [True]

    def split(self, node: int, f: int, k: int, counts: Sequence[float], large: tuple[bool, bool]) -> None:
        self.feature[node], self.cut[node], self.left[node] = f, k, len(self.left)
        for side in (0, 1):
            n0, n1 = counts[2 * side : 2 * side + 2]
            for values, v in (
                (self.feature, 0), (self.cut, 0), (self.left, LEAF), (self.n0, n0), (self.n1, n1), (self.path, 2 * self.path[node] + side),
                (self.level, self.level[node] + 1), (self.closed, False), (self.large, large[side]),
            ):
                values.append(v)

    def last(self, bins: np.ndarray) -> np.ndarray:
        return _walked(np.array(self.feature), np.array(self.cut), np.array(self.left), bins)

    def opened(self, large: bool) -> np.ndarray:
        """Leaves that are still to be grown: by histograms (large) or by a task."""
        return (np.array(self.left) == LEAF) & ~np.array(self.closed) & (np.array(self.large) == large)


def _names(inputs: int) -> list[str]:
    return [f"_bins_{i}" for i in range(-(-inputs // PACKED))]


def _with_codes(rows: DataFrame, values: Sequence, edges: list[np.ndarray]) -> DataFrame:
    """The bins of PACKED inputs in each column of _names, a byte each."""

    def coded(some: list[np.ndarray]):
        @F.pandas_udf("bigint")
        def code(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                columns = (columns,) if isinstance(columns, pd.Series) else columns
                out = np.zeros(len(columns[0]), dtype=np.int64)
                for e, v in zip(some, columns, strict=True):
                    out = out << 8 | np.searchsorted(e, v.to_numpy(dtype=float, na_value=np.nan), "left")
                yield pd.Series(out)

        # Not to be computed again by filters that are made from it.
        return code.asNondeterministic()

    parts = range(0, len(edges), PACKED)
    return rows.withColumns({c: coded(edges[i : i + PACKED])(*values[i : i + PACKED]) for c, i in zip(_names(len(edges)), parts, strict=True)})


def _bins(codes: Sequence[np.ndarray], inputs: int) -> np.ndarray:
    out = np.empty((inputs, len(codes[0])), dtype=np.uint8)
    for f in range(inputs):
        first = f // PACKED * PACKED
        out[f] = codes[f // PACKED] >> 8 * (min(PACKED, inputs - first) - 1 - (f - first)) & 255
    return out


def _slabs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[list[np.ndarray]]:
    """The columns of some `rows` rows at a time."""
    held = []

    def joined() -> list[np.ndarray]:
        table = pa.Table.from_batches(held)
        return [table.column(i).to_numpy() for i in range(table.num_columns)]

    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield joined()
            held = []
    if sum(b.num_rows for b in held):
        yield joined()


def _entries(rows: DataFrame, n_rows: int, inputs: int, trees: int, seed: int) -> DataFrame:
    """Blocks of entries, written once: entries, bins as inputs x entries, class, and as trees x entries how often the rows
    of an entry are in a tree's sample. Rows are dealt by ranges, so equal ones meet, however many they are."""
    names = _names(inputs)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for y, draw, *codes in _slabs(batches, 2 * BLOCK):
            order = np.lexsort((y, *codes[::-1]))
            y, draw, codes = y[order], draw[order], [c[order] for c in codes]
            new = np.ones(len(y), dtype=bool)
            new[1:] = y[1:] != y[:-1]
            for c in codes:
                new[1:] |= c[1:] != c[:-1]
            starts = np.flatnonzero(new)
            for i in range(0, len(starts), BLOCK):
                some = starts[i : i + BLOCK]
                end = starts[i + BLOCK] if i + BLOCK < len(starts) else len(y)
                mine, counts = draw[some[0] : end], np.empty((trees, len(some)), dtype=np.uint32)
                for tree in range(trees):
                    counts[tree] = np.add.reduceat(drawn(mine, tree, seed), some - some[0], dtype=np.uint32)
                kind = np.min_scalar_type(counts.max())
                arrays = (_bins([c[some] for c in codes], inputs), y[some].astype(np.uint8), counts.astype(kind))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(some)], pa.int32()), *(pa.array([a.tobytes()], type=pa.binary()) for a in arrays)], names=["entries", "bins", "y", "counts"]
                )

    dealt = rows.select("y", "draw", *names).repartitionByRange(min(DEALT, max(1, -(-n_rows // BLOCK))), *names, "y", "draw")
    return cut_lineage(dealt.mapInArrow(pack, "entries int, bins binary, y binary, counts binary"))


def _blocks(batch: pa.RecordBatch, inputs: int, trees: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for i in range(batch.num_rows):
        n, bins, y, counts = (batch.column(c)[i].as_py() for c in ("entries", "bins", "y", "counts"))
        kind = np.dtype(f"u{len(counts) // (trees * n)}")
        yield np.frombuffer(bins, dtype=np.uint8).reshape(inputs, n), np.frombuffer(y, dtype=np.uint8), np.frombuffer(counts, dtype=kind).reshape(trees, n)


def _usable(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    for c in inputs:
        df = df.filter(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    return df


def _doubles(inputs: Sequence[str]) -> list:
    return [F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(inputs)]


def _edges(rows: DataFrame, names: Sequence[str], bins: int) -> list[np.ndarray]:
    """Exact quantiles; all values where a column has no more than `bins`."""
    found = quantile_edges(rows, names, bins, interpolate=False, stored=True)
    for c in names:
        if len(found[c]) < bins - 1:
            values = sorted(r[0] for r in rows.select(c).distinct().limit(bins + 1).collect())
            if len(values) <= bins:
                found[c] = values[:-1]
    return [np.array(found[c], dtype=float) for c in names]


@dataclass(frozen=True)
class Forest:
    inputs: tuple[str, ...]
    edges: list[np.ndarray]
    tops: list[_Top]
    #: (tree, node, n_nodes, n0, n1, feature, cut, left, share): a row a subtree, its nodes as arrays.
    subtrees: DataFrame

    def probability(self, df: DataFrame, out: str = "p") -> DataFrame:
        """The columns of a table beside P(event), the mean over trees of the leaf's share of events. Rows without an
        input, or with NaN, are left out. The table is read twice; store it before if its plan is long."""
        inputs, tops, trees = len(self.inputs), self.tops, len(self.tops)
        names = _names(inputs)
        coded = _with_codes(_usable(df, self.inputs), [F.col(c).cast("double") for c in self.inputs], self.edges)

        def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            first = TaskContext.get().partitionId() << 32
            for number, codes in enumerate(_slabs(batches, BLOCK)):
                for i in range(0, len(codes[0]), BLOCK):
                    arrays = [pa.array([c[i : i + BLOCK].tobytes()], type=pa.binary()) for c in codes]
                    yield pa.RecordBatch.from_arrays([pa.array([first + (number << 16) + i // BLOCK]), *arrays], names=["block", *names])

        blocks = cut_lineage(coded.select(*names).distinct().mapInArrow(pack, ", ".join(["block bigint", *(f"{c} binary" for c in names)])))
        salts = max(1, -(-blocks.count() // MET))

        def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    block = batch.column("block")[i].as_py()
                    bins = _bins([np.frombuffer(batch.column(c)[i].as_py(), dtype=np.int64) for c in names], inputs)
                    for tree, top in enumerate(tops):
                        for node, sel in _groups(top, bins):
                            yield pa.RecordBatch.from_pydict(
                                {
                                    "tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()), "salt": pa.array([hash(block) % salts], pa.int32()),
                                    "block": [block], "pos": [sel.astype(np.uint16).tobytes()], "bins": [np.ascontiguousarray(bins[:, sel]).tobytes()],
                                }
                            )

        def scored(key: tuple, rows: pd.DataFrame, subtree: pd.DataFrame) -> pd.DataFrame:
            kinds = (("feature", np.int8), ("cut", np.uint8), ("left", np.int32), ("share", np.float64))
            feature, cut, left, share = (np.frombuffer(subtree[c].iloc[0], dtype=kind) for c, kind in kinds)
            values = []
            for b in rows["bins"]:
                values.append(share[_walked(feature, cut, left, np.frombuffer(b, dtype=np.uint8).reshape(inputs, -1))].tobytes())
            return pd.DataFrame({"block": rows["block"], "tree": key[0], "pos": rows["pos"], "p": values})

        def total(key: tuple, block: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
            codes = [np.frombuffer(block[c].iloc[0], dtype=np.int64) for c in names]
            bins = _bins(codes, inputs)
            by_tree: dict[int, list] = {}
            for tree, pos, p in zip(parts["tree"], parts["pos"], parts["p"], strict=True):
                by_tree.setdefault(tree, []).append((np.frombuffer(pos, dtype=np.uint16), np.frombuffer(p, dtype=np.float64)))
            sums = np.zeros(bins.shape[1])
            for tree, top in enumerate(tops):
                closed = np.array(top.closed) & (np.array(top.left) == LEAF)
                if closed.any():
                    n0, n1 = np.array(top.n0), np.array(top.n1)
                    sums += np.where(closed, n1 / np.maximum(n0 + n1, 1), 0.0)[top.last(bins)]
                for pos, p in by_tree.get(tree, ()):
                    sums[pos] += p
            return pd.DataFrame({**dict(zip(names, codes, strict=True)), "_share": sums / trees})

        keys = ["tree", "node", "salt"]
        dealt = min(DEALT, max(salts * sum(int(t.opened(False).sum()) for t in tops), 1))
        rows = blocks.mapInArrow(spread, "tree int, node int, salt int, block bigint, pos binary, bins binary").repartition(dealt, *keys)
        held = self.subtrees.withColumn("salt", F.explode(F.array(*[F.lit(i) for i in range(salts)]))).repartition(dealt, *keys)
        # Groups of rows always have their subtree; subtrees without rows give none.
        by_rows = rows.groupBy(*keys).cogroup(held.groupBy(*keys))
        parts = by_rows.applyInPandas(scored, "block bigint, tree int, pos binary, p binary")
        summed = blocks.groupBy("block").cogroup(parts.groupBy("block")).applyInPandas(total, ", ".join([*(f"{c} bigint" for c in names), "_share double"]))
        return coded.join(summed, names).select(*[df[c] for c in df.columns if c != out], F.col("_share").alias(out))


def _groups(top: _Top, bins: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(node, rows) for the nodes that hand their rows to a subtree."""
    at, handed = top.last(bins), top.opened(False)
    if len(handed) == 1:
        if handed[0] and len(at):
            yield 0, np.arange(len(at))
        return
    order = np.argsort(at, kind="stable")
    nodes, starts = np.unique(at[order], return_index=True)
    for node, sel in zip(nodes, np.split(order, starts[1:]), strict=True):
        if handed[node]:
            yield int(node), sel


def fit(
    df: DataFrame, inputs: Sequence[str], target: str, trees: int, depth: int, leaf: int, key: str | None = None, bins: int = 32,
    seed: int = 12345, small: int = SMALL,
) -> Forest:
    """Bootstrap samples by Poisson(1) counts, ceil(sqrt(inputs)) inputs tried a node, gini gain, at least `leaf` rows of the
    sample a leaf, splits between leaves of one class pruned.

    The draws hash `key` (without it the inputs), so they do not depend on partitions; rows that share a key share their draws.
    Rows without an input or target do not train.
    """
    names = [f"x{i}" for i in range(len(inputs))]
    draw = F.xxhash64(*([key] if key else inputs))
    used = _usable(df, inputs).filter(F.col(target).isNotNull())
    narrow = cut_lineage(used.select(draw.alias("draw"), F.col(target).cast("int").alias("y"), *_doubles(inputs)))
    n_rows = narrow.count()
    if not n_rows:
        raise ValueError("a forest needs training rows")
    if bins > 256:
        raise ValueError("at most 256 bins")
    edges = _edges(narrow, names, bins)
    width, n_inputs = max(len(e) for e in edges) + 1, len(names)
    if width == 1:
        width = 2
    blocks = _entries(_with_codes(narrow, [F.col(c) for c in names], edges), n_rows, n_inputs, trees, seed)
    n_entries = blocks.agg(F.sum("entries")).first()[0]
    tops = [_Top() for _ in range(trees)]
    for top in tops:
        top.large[0] = n_entries > small
    for level in range(depth):
        if not any(t.opened(True).any() for t in tops):
            break
        for r in _level(blocks, tops, n_inputs, width, leaf, seed).collect():
            top, node = tops[r["tree"]], r["node"]
            top.n0[node], top.n1[node] = r["n0"], r["n1"]
            if r["split"]:
                counts = (r["left0"], r["left1"], r["n0"] - r["left0"], r["n1"] - r["left1"])
                top.split(node, r["feature"], r["cut"], counts, (r["entries_left"] > small, r["entries"] - r["entries_left"] > small))
            else:
                top.closed[node] = True
    for top in tops:
        for node in np.flatnonzero(top.opened(True)):
            top.closed[node] = True
    subtrees = cut_lineage(_subtrees(blocks, tops, n_inputs, width, depth, leaf, seed))
    # A subtree of one node is a leaf of the upper levels, which may be pruned in turn.
    for r in subtrees.filter("n_nodes = 1").select("tree", "node", "n0", "n1").collect():
        top, node = tops[r["tree"]], r["node"]
        top.closed[node], top.n0[node], top.n1[node] = True, r["n0"], r["n1"]
    for top in tops:
        left = _pruned(top.left, np.array(top.n1) > np.array(top.n0), np.array(top.closed) | (np.array(top.left) != LEAF))
        top.closed = [c or (now == LEAF and was != LEAF) for c, now, was in zip(top.closed, left, top.left, strict=True)]
        top.left = [int(v) for v in left]
    return Forest(tuple(inputs), edges, tops, subtrees)


def _level(blocks: DataFrame, tops: list[_Top], inputs: int, width: int, leaf: int, seed: int) -> DataFrame:
    """The best split of each large node, from the sums of all blocks."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = [np.flatnonzero(t.opened(True)) for t in tops]
        sums = [np.zeros((len(o), inputs, 3, width)) for o in opened]
        for batch in batches:
            for bins, y, counts in _blocks(batch, inputs, len(tops)):
                y = y.astype(np.int64)
                for tree, top in enumerate(tops):
                    if not len(opened[tree]):
                        continue
                    slots = np.full(len(top.left), -1, dtype=np.int64)
                    slots[opened[tree]] = np.arange(len(opened[tree]))
                    slot = slots[top.last(bins)]
                    mine = (slot >= 0) & (counts[tree] > 0)
                    slot, here = slot[mine], bins[:, mine]
                    sums[tree][:, :, :2] += _counted(slot, here, y[mine], counts[tree][mine], len(opened[tree]), width)
                    for f in range(inputs):
                        sums[tree][:, f, 2] += np.bincount(slot * width + here[f], minlength=len(opened[tree]) * width).reshape(-1, width)
        for tree, nodes in enumerate(opened):
            if len(nodes):
                yield pa.RecordBatch.from_pydict(
                    {"tree": pa.array([tree] * len(nodes), pa.int32()), "node": pa.array(nodes, pa.int32()), "cells": [c.tobytes() for c in sums[tree]]}
                )

    paths = [t.path for t in tops]

    def best(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        cells = sum(np.frombuffer(c, dtype=np.float64) for c in rows["cells"]).reshape(1, inputs, 3, width)
        cells, met = cells[:, :, :2], cells[0, :, 2]
        tree, node = int(key[0]), int(key[1])
        ok, f, k, a, b = _best(cells, _tried(np.array([paths[tree][node]], dtype=np.uint64), tree, seed, inputs), leaf)
        n0, n1 = (float(cells[0, 0, c].sum()) for c in (0, 1))
        names = ["tree", "node", "split", "feature", "cut", "left0", "left1", "n0", "n1", "entries_left", "entries"]
        row = (tree, node, bool(ok[0]), int(f[0]), int(k[0]), float(a[0]), float(b[0]), n0, n1, float(met[f[0], : k[0] + 1].sum()), float(met[0].sum()))
        return pd.DataFrame([row], columns=names)

    sums = blocks.mapInArrow(count, "tree int, node int, cells binary")
    return sums.groupBy("tree", "node").applyInPandas(
        best, "tree int, node int, split boolean, feature int, cut int, left0 double, left1 double, n0 double, n1 double, entries_left double, entries double"
    )


def _subtrees(blocks: DataFrame, tops: list[_Top], inputs: int, width: int, depth: int, leaf: int, seed: int) -> DataFrame:
    """The entries of each small node, dealt to a task that grows its subtree."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for every, y, counts in _blocks(batch, inputs, len(tops)):
                for tree, top in enumerate(tops):
                    inside = np.flatnonzero(counts[tree])
                    bins = every[:, inside]
                    for node, sel in _groups(top, bins):
                        yield pa.RecordBatch.from_pydict(
                            {
                                "tree": pa.array([tree], pa.int32()), "node": pa.array([node], pa.int32()), "bins": [np.ascontiguousarray(bins[:, sel]).tobytes()],
                                "y": [y[inside[sel]].tobytes()], "counts": [counts[tree][inside[sel]].tobytes()],
                            }
                        )

    places = [(t.path, t.level) for t in tops]

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        tree, node = int(key[0]), int(key[1])
        bins = np.concatenate([np.frombuffer(b, dtype=np.uint8).reshape(inputs, -1) for b in rows["bins"]], axis=1)
        y = np.concatenate([np.frombuffer(b, dtype=np.uint8) for b in rows["y"]])
        counts = np.concatenate([np.frombuffer(b, dtype=f"u{len(b) // len(c)}") for b, c in zip(rows["counts"], rows["y"], strict=True)])
        path, level = places[tree][0][node], places[tree][1][node]
        g = _subtree(bins, y, counts, tree, path, depth - level, width, leaf, seed)
        return pd.DataFrame(
            {
                "tree": [tree], "node": [node], "n_nodes": [len(g.left)], "n0": [g.n0[0]], "n1": [g.n1[0]], "feature": [g.feature.tobytes()],
                "cut": [g.cut.tobytes()], "left": [g.left.tobytes()], "share": [g.share().tobytes()],
            }
        )

    groups = sum(int(t.opened(False).sum()) for t in tops)
    rows = blocks.mapInArrow(spread, "tree int, node int, bins binary, y binary, counts binary").repartition(min(DEALT, max(groups, 1)), "tree", "node")
    return rows.groupBy("tree", "node").applyInPandas(
        grow, "tree int, node int, n_nodes int, n0 double, n1 double, feature binary, cut binary, left binary, share binary"
    )
