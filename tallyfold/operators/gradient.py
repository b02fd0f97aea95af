"""Gradient boosting for a 0/1 target as Spark's GBTClassifier defines it, by histograms over blocks of binned rows.

The first tree is fitted to labels of -1 and 1, each further one to the residuals 4y / (1 + exp(2yF)) of a drawn share
of the rows; a split has the largest fall of the squared error, a leaf is a mean. A tree takes one pass over all rows,
which keeps its drawn rows as bins and residuals, and one over those for each further level; the driver sees at most
2^depth x inputs x bins cells. The blocks are an RDD, as in boosting.py. Residuals are summed as whole numbers (2^-20
steps), so a fit does not depend on partitions, order or retries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalar import hash_int
from tallyfold.operators.boosting import FEW, LEAF, MERGED, MOVED_EVERY, FlatTrees, _flat, sampled
from tallyfold.session import cut_lineage

UNIT = 1 << 20
#: What a row adds to a sum of residuals, so that one sum of doubles holds rows and residuals: BLOCK * COUNT < 2^53.
COUNT = 1 << 38
#: Rows of a block, at most.
BLOCK = 1 << 14
#: Rows that thresholds are chosen from; Spark's estimators look at 10 000.
LOOKED_AT = 100_000


def split_candidates(values: np.ndarray, bins: int) -> np.ndarray:
    """Thresholds between `bins` bins of equal counts, as Spark's trees choose them from the rows they look at."""
    found, counts = np.unique(values, return_counts=True)
    if len(found) <= bins:
        return (found[:-1] + found[1:]) / 2
    stride = len(values) / bins
    out, target, below = [], stride, counts[0]
    for i in range(1, len(found)):
        upto = below + counts[i]
        if abs(below - target) < abs(upto - target):
            out.append((found[i - 1] + found[i]) / 2)
            target += stride
        below = upto
    return np.array(out)


@dataclass
class GradientBoosted:
    """Trees over bin numbers; their values hold the rate."""

    inputs: tuple[str, ...]
    edges: list[np.ndarray]
    grown: list[dict]
    depth: int
    #: Each input's share of the fall of the squared error.
    importance: dict[str, float]

    def flat(self) -> FlatTrees:
        """The trees with thresholds in place of bins."""
        return _flat(self.grown, self.inputs, self.edges, self.depth)

    def probability(self, df: DataFrame, out: str = "p") -> DataFrame:
        """The table's columns beside P(event), by bins; rows without an input are left out, as in the fit."""
        edges, trees = self.edges, [_Steps(t, self.edges) for t in self.grown]

        @F.pandas_udf("double")
        def scored(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            for columns in batches:
                margin = np.zeros(len(columns[0]))
                for start in range(0, len(margin), BLOCK):
                    bins = _binned([c.to_numpy(dtype=float, na_value=np.nan)[start : start + BLOCK] for c in columns], edges)
                    for t in trees:
                        margin[start : start + BLOCK] += t.value[t.last(bins)]
                yield pd.Series(1.0 / (1.0 + np.exp(-2.0 * margin)))

        whole = _whole(df, self.inputs)
        return whole.withColumn(out, scored(*[F.col(c).cast("double") for c in self.inputs])).select(*df.columns, out)


def _whole(df: DataFrame, inputs: Sequence[str]) -> DataFrame:
    for c in inputs:
        df = df.filter(F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double")))
    return df


def _binned(values: Sequence[np.ndarray], edges: list[np.ndarray]) -> np.ndarray:
    kind = np.uint8 if max(map(len, edges), default=0) < 1 << 8 else np.int32
    return np.stack([np.searchsorted(e, v, "left").astype(kind) for e, v in zip(edges, values, strict=True)])


class _Steps:
    """A tree as tables: a node's input, and the next node by node and bin; a leaf is its own next node."""

    def __init__(self, tree: dict, edges: list[np.ndarray]):
        self.width = max(map(len, edges)) + 1
        left, right, cut = (np.array(tree[c], dtype=np.int32)[:, None] for c in ("left", "right", "bin"))
        bins = np.arange(self.width, dtype=np.int32)[None, :]
        itself = np.arange(len(left), dtype=np.int32)[:, None]
        self.next = np.where(left == LEAF, itself, np.where(bins <= cut, left, right)).astype(np.int32).ravel()
        self.feature = np.array(tree["feature"], dtype=np.int32)
        self.value = np.array(tree["value"], dtype=float)
        self.levels = tree["levels"]

    def last(self, bins: np.ndarray) -> np.ndarray:
        """The last node of each row on its way down."""
        n = bins.shape[1]
        flat, rows, first = bins.ravel(), np.arange(n, dtype=np.int32), self.feature * np.int32(n)
        at = np.zeros(n, dtype=np.int32)
        for _ in range(self.levels):
            at = self.next[at * np.int32(self.width) + flat[first[at] + rows]]
        return at


@dataclass
class _Block:
    """Some rows: bins as inputs x rows, labels of -1 and 1, random bits, margin."""

    bins: np.ndarray
    y: np.ndarray
    draw: np.ndarray
    margin: np.ndarray

    def moved(self, trees: list[_Steps]) -> _Block:
        margin = self.margin.copy()
        for t in trees:
            margin += t.value[t.last(self.bins)]
        return replace(self, margin=margin)

    def drawn(self, trees: list[_Steps], cut: int, round_: int) -> tuple[np.ndarray, np.ndarray]:
        """Bins and residuals, in units, of the rows that this round draws."""
        used = np.flatnonzero(sampled(self.draw, round_) < cut) if cut < 1 << 32 else slice(None)
        block = _Block(np.ascontiguousarray(self.bins[:, used]), self.y[used], self.draw[used], self.margin[used]).moved(trees)
        y = block.y.astype(float)
        residual = 4.0 * y / (1.0 + np.exp(np.minimum(2.0 * y * block.margin, 700.0))) if round_ else y
        return block.bins, np.rint(residual * UNIT).astype(np.int32)


def _cells(bins: np.ndarray, residual: np.ndarray, steps: _Steps, opened: list[int]) -> np.ndarray:
    """Rows and sums of residuals by open node, input and bin."""
    at = steps.last(bins)
    slots = np.full(len(steps.feature), -1, dtype=np.int32)
    slots[opened] = np.arange(len(opened), dtype=np.int32)
    at = slots[at]
    if (at < 0).any():
        used = np.flatnonzero(at >= 0)
        at, bins, residual = at[used], bins[:, used], residual[used]
    weights, width = residual + float(COUNT), steps.width
    out = np.empty((len(opened), len(bins), 2, width), dtype=np.int64)
    first = at.astype(np.int64) * width
    for f, codes in enumerate(bins):
        both = np.bincount(first + codes, weights=weights, minlength=len(opened) * width).reshape(len(opened), width)
        n = np.rint(both / COUNT)
        out[:, f, 0], out[:, f, 1] = n, both - n * COUNT
    return out


def _histograms(work: RDD, steps: _Steps, opened: list[int], inputs: int) -> np.ndarray | None:
    def one(items: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[np.ndarray | None]:
        total = None
        for bins, residual in items:
            total = summed(total, _cells(bins, residual, steps, opened))
        yield total

    def summed(a: np.ndarray | None, b: np.ndarray | None) -> np.ndarray | None:
        return a + b if a is not None and b is not None else b if a is None else a

    parts = work.getNumPartitions()
    cells = len(opened) * inputs * 2 * steps.width
    return work.mapPartitions(one).treeAggregate(None, summed, summed, 1 if parts <= FEW and parts * cells <= MERGED else 2)


def _split(cells: np.ndarray, sizes: list[int], leaf: int) -> tuple[float, int, int, int, int] | None:
    """(fall of the squared error, input, bin, rows and residuals on the left) of a node's best split, or None; the first of equals."""
    best = None
    for f, size in enumerate(sizes):
        n, s = cells[f, 0, :size], cells[f, 1, :size]
        rows, total = int(n.sum()), int(s.sum())
        nl, sl = np.cumsum(n)[:-1], np.cumsum(s)[:-1]
        ok = (nl >= max(leaf, 1)) & (rows - nl >= max(leaf, 1))
        if not ok.any():
            continue
        a, b = nl[ok], sl[ok]
        gain = a * ((rows - a) / rows) * ((b / a - (total - b) / (rows - a)) / UNIT) ** 2
        k = int(gain.argmax())
        if gain[k] > 1e-9 and (best is None or gain[k] > best[0]):
            best = (float(gain[k]), f, int(np.flatnonzero(ok)[k]), int(a[k]), int(b[k]))
    return best


def _tree(work: RDD, edges: list[np.ndarray], depth: int, leaf: int, weight: float, gains: list[float]) -> dict:
    t: dict = {c: [] for c in ("feature", "bin", "missing_left", "left", "right", "value")}
    sizes = [len(e) + 1 for e in edges]

    def add(n: int, s: int) -> int:
        for c, v in (("feature", 0), ("bin", 0), ("missing_left", False), ("left", LEAF), ("right", LEAF), ("value", weight * s / UNIT / n if n else 0.0)):
            t[c].append(v)
        return len(t["left"]) - 1

    opened, t["levels"] = [add(0, 0)], 0
    for level in range(max(depth, 1)):
        cells = _histograms(work, _Steps(t, edges), opened, len(edges))
        if cells is None:
            break
        if level == 0:
            n, s = (int(v) for v in cells[0, 0].sum(axis=1))
            t["value"][0] = weight * s / UNIT / n if n else 0.0
        if depth == 0:
            break
        children = []
        for node, own in zip(opened, cells, strict=True):
            split = _split(own, sizes, leaf)
            if split is None:
                continue
            gain, f, t["bin"][node], n, s = split
            t["feature"][node] = f
            gains[f] += gain
            rows, total = (int(v) for v in own[0].sum(axis=1))
            t["left"][node], t["right"][node] = add(n, s), add(rows - n, total - s)
            children += [t["left"][node], t["right"][node]]
        if not children:
            break
        opened, t["levels"] = children, level + 1
    return t


def fit(
    df: DataFrame, inputs: Sequence[str], target: str, trees: int, rate: float, subsample: float, depth: int, leaf: int,
    bins: int, seed: int, key: str | None = None,
) -> GradientBoosted:
    """Boosted trees for a 0/1 target. Rows without an input are left out; another target is an error, as for Spark's estimator.

    Draws hash the key, the inputs and the target, without a key the row's place in the stored table.
    """
    inputs, y = list(inputs), F.col(target).cast("double")
    said = F.when(y.isin(0.0, 1.0), y).otherwise(F.raise_error("the target must be 0 or 1").cast("double"))
    place = F.concat_ws("|", *[F.col(c).cast("string") for c in (key, *inputs, target)]) if key else F.monotonically_increasing_id()
    names = [f"x{i}" for i in range(len(inputs))]
    columns = [F.col(c).cast("double").alias(x) for c, x in zip(inputs, names, strict=True)]
    narrow = cut_lineage(_whole(df, inputs).select(said.alias("y"), hash_int(place, seed).alias("draw"), *columns))
    n = narrow.count()
    if n == 0:
        raise ValueError("no rows to train on")
    looked = narrow if n <= LOOKED_AT else narrow.filter(F.col("draw") < int(LOOKED_AT / n * (1 << 32)))
    seen = looked.select(*names).toPandas()
    edges = [split_candidates(seen[c].to_numpy(), min(bins, n)) for c in names]

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, BLOCK):
                label, draw, *x = (c.to_numpy(zero_copy_only=False) for c in whole.slice(start, BLOCK).columns)
                arrays = (_binned(x, edges), (2 * label - 1).astype(np.int8), draw.astype(np.uint32))
                yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], type=pa.binary()) for a in arrays], names=["bins", "y", "draw"])

    def block(r) -> _Block:
        label, codes = np.frombuffer(r["y"], dtype=np.int8), np.frombuffer(r["bins"], dtype=np.uint8)
        if len(codes) != len(label) * len(edges):
            codes = codes.view(np.int32)
        return _Block(codes.reshape(len(edges), len(label)), label, np.frombuffer(r["draw"], dtype=np.uint32), np.zeros(len(label)))

    # A task a core, and no more than full blocks: a pass over little data is mostly the start of its tasks.
    parts, wanted = narrow.rdd.getNumPartitions(), max(1, min(-(-n // BLOCK), df.sparkSession.sparkContext.defaultParallelism))
    narrow = narrow.repartition(wanted) if parts < wanted else narrow.coalesce(wanted)
    base = narrow.mapInArrow(packed, "bins binary, y binary, draw binary").rdd.map(block).persist(StorageLevel.MEMORY_AND_DISK)
    cut = round(subsample * (1 << 32))
    grown: list[dict] = []
    gains, since, held = [0.0] * len(inputs), [], [base]
    for round_ in range(trees):
        work = base.map(lambda b, since=tuple(since), round_=round_: b.drawn(since, cut, round_)).persist(StorageLevel.MEMORY_AND_DISK)
        grown.append(_tree(work, edges, depth, leaf, rate if round_ else 1.0, gains))
        work.unpersist()
        since.append(_Steps(grown[-1], edges))
        if len(since) >= MOVED_EVERY:
            base, since = base.map(lambda b, since=tuple(since): b.moved(since)).persist(StorageLevel.MEMORY_AND_DISK), []
            held.append(base)
            # The last ones are computed from those before in the next pass; what is older is no longer read.
            for spent in held[:-2]:
                spent.unpersist()
            del held[:-2]
    for old in held:
        old.unpersist()
    total = sum(gains) or 1.0
    return GradientBoosted(tuple(inputs), edges, grown, depth, {c: g / total for c, g in zip(inputs, gains, strict=True)})
