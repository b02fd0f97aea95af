"""Tree regressors for cross-validation: many fits, one for each fold, on cells of binned inputs.

A split between bins depends on the rows and the mean of the target in each cell only. So a pass over the rows adds them up by
(fit, cell), whatever their number; for a forest also by tree, each row as often as the tree's bootstrap sample holds it. Each
fit, of a forest each tree, then grows in its own task from at most bins^inputs cells, as Spark's estimators grow theirs:
variance gain, one split between two bins, all inputs tried at each node. Thresholds are those of all rows that a fit trains on.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators.forest import CELLS, DEALT, LEAF, _slabs, _walked, drawn
from tallyfold.operators.gradient import split_candidates
from tallyfold.session import cut_lineage

#: Rows up to which the values are counted in one place.
FEW = 100_000
#: Ranges of about equal rows in which the others are counted first, and the relative error of their bounds.
RANGES = 8192
SKETCH = 50_000
#: Ranges that are looked into ahead of the one that is asked for.
AHEAD = 4
#: Rows that are added up at a time.
SLAB = 1 << 18

Lists = Mapping[int, Sequence[str]]
Edges = Mapping[int, Mapping[str, np.ndarray]]


def narrowed(df: DataFrame, inputs: Sequence[str], target: str, fold: str, key: str | None = None) -> DataFrame:
    """(fold, draw, _y, inputs as doubles): rows without a fold are in no fit."""
    draw = F.xxhash64(*([key] if key else inputs))
    columns = [F.col(fold).cast("int").alias("fold"), draw.alias("draw"), F.col(target).cast("double").alias("_y")]
    return df.select(*columns, *[F.col(c).cast("double").alias(c) for c in inputs]).filter("fold IS NOT NULL")


def _arrays(columns: Sequence[np.ndarray], inputs: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, dict[str, np.ndarray]]:
    fold, draw, y, *x = columns
    return fold, draw, y, dict(zip(inputs, x, strict=True))


def _whole(x: Mapping[str, np.ndarray], listed: Sequence[str]) -> np.ndarray:
    return ~np.any([np.isnan(x[c]) for c in listed], axis=0)


def fold_edges(rows: DataFrame, inputs: Sequence[str], lists: Lists, bins: int = 32, few: int = FEW) -> Edges:
    """The thresholds of each fit's listed inputs, from all rows outside its fold that have these inputs.

    They are split_candidates of the values. Of larger tables the driver sees the rows in each of RANGES ranges of values, and the
    values of the few ranges in which a threshold may be.
    """
    if rows.count() <= few:
        seen = rows.toPandas()
        x = {c: seen[c].to_numpy(dtype=float) for c in inputs}
        return {
            k: {c: split_candidates(x[c][used], bins) for c in listed}
            for k, listed in lists.items()
            for used in [_whole(x, listed) & (seen["fold"].to_numpy() != k)]
        }
    kinds = list(dict.fromkeys(tuple(v) for v in lists.values()))
    points = rows.agg(*[F.percentile_approx(F.when(~F.isnan(c), F.col(c)), [i / RANGES for i in range(RANGES + 1)], SKETCH).alias(c) for c in inputs]).first()
    bounds = {c: np.unique(np.array(points[c] or [], dtype=float)) for c in inputs}

    def ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _slabs(batches, SLAB):
            fold, _, _, x = _arrays(columns, inputs)
            out = []
            for i, listed in enumerate(kinds):
                used = _whole(x, listed)
                for c in listed:
                    part = pd.DataFrame({"fold": fold[used], "at": np.searchsorted(bounds[c], x[c][used], "left"), "v": x[c][used]})
                    part = part.groupby(["fold", "at"])["v"].agg(["size", "max"]).reset_index()
                    out.append(part.assign(kind=i, input=c))
            yield pa.RecordBatch.from_pandas(pd.concat(out), schema=_schema("at", "size", "max"), preserve_index=False)

    counted = rows.mapInArrow(ranges, "kind int, input string, fold int, at int, size bigint, max double")
    counted = counted.groupBy("kind", "input", "fold", "at").agg(F.sum("size").alias("size"), F.max("max").alias("max")).toPandas()
    held = {key: part for key, part in counted.groupby(["kind", "input"])}

    walks = {}
    for k, listed in lists.items():
        for c in listed:
            part = held.get((kinds.index(tuple(listed)), c))
            part = counted.iloc[:0] if part is None else part[part["fold"] != k]
            walks[k, c] = part.groupby("at").agg(size=("size", "sum"), max=("max", "max")).sort_index()
    detail: dict[tuple[int, str], dict[int, pd.DataFrame]] = {(i, c): {} for i, listed in enumerate(kinds) for c in listed}
    while True:
        edges: dict[int, dict[str, np.ndarray]] = {k: {} for k in lists}
        asked: dict[tuple[int, str], set[int]] = {}
        for (k, c), walk in walks.items():
            own = (kinds.index(tuple(lists[k])), c)

            def values(at: int, k: int = k, own: tuple[int, str] = own) -> tuple[np.ndarray, np.ndarray] | None:
                if at not in detail[own]:
                    return None
                part = detail[own][at]
                part = part[part["fold"] != k].groupby("value")["size"].sum().sort_index()
                return part.index.to_numpy(), part.to_numpy()

            edges[k][c], missing = _cut(walk.index.to_numpy(), walk["size"].to_numpy(), walk["max"].to_numpy(), values, bins)
            asked.setdefault(own, set()).update(m for m in missing if m not in detail[own])
        asked = {own: wanted for own, wanted in asked.items() if wanted}
        if not asked:
            return edges
        looked = {own: np.array(sorted(wanted)) for own, wanted in asked.items()}

        def inside(batches: Iterator[pa.RecordBatch], looked: dict = looked) -> Iterator[pa.RecordBatch]:
            for columns in _slabs(batches, SLAB):
                fold, _, _, x = _arrays(columns, inputs)
                out = []
                for (i, c), wanted in looked.items():
                    at = np.searchsorted(bounds[c], x[c], "left")
                    used = np.flatnonzero(_whole(x, kinds[i]) & np.isin(at, wanted))
                    part = pd.DataFrame({"fold": fold[used], "at": at[used], "value": x[c][used]})
                    out.append(part.groupby(["fold", "at", "value"]).size().rename("size").reset_index().assign(kind=i, input=c))
                yield pa.RecordBatch.from_pandas(pd.concat(out), schema=_schema("at", "value", "size"), preserve_index=False)

        found = rows.mapInArrow(inside, "kind int, input string, fold int, at int, value double, size bigint")
        found = found.groupBy("kind", "input", "fold", "at", "value").agg(F.sum("size").alias("size")).toPandas()
        for (i, c, at), part in found.groupby(["kind", "input", "at"]):
            detail[int(i), c][int(at)] = part
        for own, wanted in looked.items():
            for at in wanted:
                detail[own].setdefault(int(at), found.iloc[:0])


def _schema(*more: str) -> pa.Schema:
    kinds = {"at": pa.int32(), "size": pa.int64(), "max": pa.float64(), "value": pa.float64()}
    return pa.schema([("kind", pa.int32()), ("input", pa.string()), ("fold", pa.int32()), *((c, kinds[c]) for c in more)])


def _cut(
    at: np.ndarray, sizes: np.ndarray, tops: np.ndarray, values: Callable[[int], tuple[np.ndarray, np.ndarray] | None], bins: int
) -> tuple[np.ndarray, list[int]]:
    """split_candidates from ranges in order, with their rows and largest values, and from the values of some of them; or which others are asked for."""
    if len(at) <= bins:
        found = [values(int(a)) for a in at]
        missing = [int(a) for a, f in zip(at, found, strict=True) if f is None]
        if missing or not found:
            return np.array([]), missing
        distinct = np.concatenate([f[0] for f in found])
        if len(distinct) <= bins:
            return (distinct[:-1] + distinct[1:]) / 2, []
    upto = np.cumsum(sizes)
    n = int(upto[-1])
    out: list[float] = []
    stride, target, below, last, missing = n / bins, n / bins, 0, None, []
    # The ranges that hold the targets, and those after them, are asked for together.
    for i in np.unique(np.searchsorted(upto, stride * np.arange(1, bins), "right")):
        missing += [int(a) for a in at[i : i + 2] if values(int(a)) is None]
    if missing:
        return np.array([]), missing
    for i, a in enumerate(at):
        # A threshold is set before a value where the rows below it are nearer to the target than those up to it.
        if target >= upto[i]:
            below, last = int(upto[i]), tops[i]
            continue
        inner = values(int(a))
        if inner is None:
            return np.array([]), [int(b) for b in at[i : i + AHEAD]]
        v, counts = inner
        ends = below + np.cumsum(counts)
        begins, before = ends - counts, np.concatenate([[np.nan if last is None else last], v[:-1]])
        first = 1 if last is None else 0
        while first < len(v):
            nearer = np.flatnonzero(np.abs(begins[first:] - target) < np.abs(ends[first:] - target))
            if not len(nearer):
                break
            first += int(nearer[0])
            out.append(float((before[first] + v[first]) / 2))
            target, first = target + stride, first + 1
        below, last = int(ends[-1]), v[-1]
    return np.array(out), []


def _codes(x: Mapping[str, np.ndarray], edges: Mapping[str, np.ndarray], inputs: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """(rows with all listed inputs, their bins from 1 packed a byte an input, the first highest); 0 stands for an input that is not listed."""
    used = _whole(x, list(edges))
    code = np.zeros(int(used.sum()), dtype=np.int64)
    for c in inputs:
        code = code << 8
        if c in edges:
            code |= np.searchsorted(edges[c], x[c][used], "left") + 1
    return used, code


def _unpacked(code: np.ndarray, inputs: int) -> np.ndarray:
    return np.stack([code >> 8 * (inputs - 1 - i) & 255 for i in range(inputs)])


def _checked(inputs: Sequence[str], bins: int) -> None:
    if len(inputs) > 7 or bins > 255:
        raise ValueError("cells have at most 7 inputs of 255 bins")


def cells(rows: DataFrame, inputs: Sequence[str], target: str, edges: Edges, bins: int = 32) -> DataFrame:
    """(model, fold, bins of the inputs, rows, mean target, squares) of `narrowed` rows; a row without target is an error."""
    _checked(inputs, bins)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _slabs(batches, SLAB):
            fold, _, y, x = _arrays(columns, inputs)
            for k, own in edges.items():
                used, code = _codes(x, own, inputs)
                mine = y[used]
                if np.isnan(mine).any():
                    raise ValueError("Labels MUST NOT be Null or NaN")
                part = pd.DataFrame({"fold": fold[used], "code": code, "rows": np.ones(len(code)), "_y": mine, "squares": mine * mine})
                part = part.groupby(["fold", "code"]).sum().reset_index()
                codes = _unpacked(part["code"].to_numpy(), len(inputs)).astype(np.int32)
                arrays = [np.full(len(part), k, dtype=np.int32), part["fold"].to_numpy(dtype=np.int32), *codes, *(part[c].to_numpy() for c in ("rows", "_y", "squares"))]
                yield pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names=["model", "fold", *inputs, "rows", "_y", "squares"])

    schema = ", ".join(["model int, fold int", *(f"`{c}` int" for c in inputs), "rows double, _y double, squares double"])
    added = rows.mapInArrow(summed, schema).groupBy("model", "fold", *inputs)
    return added.agg(F.sum("rows").alias("rows"), (F.sum("_y") / F.sum("rows")).alias(target), F.sum("squares").alias("squares"))


def samples(rows: DataFrame, inputs: Sequence[str], target: str, edges: Edges, trees: int, seed: int, bins: int = 32) -> DataFrame:
    """The cells of the rows outside each fold as the trees' bootstrap samples hold them, as arrays: (model, tree, cells, rows, sums).

    A row is in a sample as often as a Poisson(1) draw from its own bits says, the same in each fit. A cell may come in several rows.
    """
    _checked(inputs, bins)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in _slabs(batches, SLAB):
            fold, draw, y, x = _arrays(columns, inputs)
            parts = {}
            for k, own in edges.items():
                used, code = _codes(x, own, inputs)
                if np.isnan(y[used]).any():
                    raise ValueError("Labels MUST NOT be Null or NaN")
                inside = fold[used] != k
                found, place = np.unique(code[inside], return_inverse=True)
                used[used] = inside
                # The place after the last is for the rows that this fit does not see.
                places = np.full(len(fold), len(found), dtype=np.int64)
                places[used] = place
                parts[k] = found, places
            known = np.where(np.isnan(y), 0.0, y)
            for tree in range(trees):
                w = drawn(draw, tree, seed).astype(float)
                out = []
                for k, (found, places) in parts.items():
                    n, s = (np.bincount(places, weights=v, minlength=len(found) + 1)[:-1] for v in (w, w * known))
                    met = n > 0
                    out.append((k, tree, found[met].tobytes(), n[met].tobytes(), s[met].tobytes()))
                types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names=["model", "tree", "cells", "rows", target])

    return rows.mapInArrow(summed, f"model int, tree int, cells binary, rows binary, `{target}` binary")


def _gains(found: np.ndarray, leaf: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(gain, input, bin, rows and sums on the left) of each node's best split; found is nodes x inputs x (rows, sums) x bins."""
    below = np.cumsum(found, axis=3)
    n, s = below[:, :, 0, :-1], below[:, :, 1, :-1]
    rows, total = below[:, :, 0, -1:], below[:, :, 1, -1:]
    ok = (n >= leaf) & (rows - n >= leaf) & (n > 0) & (rows - n > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where(ok, s * s / n + (total - s) ** 2 / (rows - n) - total * total / rows, -np.inf).reshape(len(found), -1)
    at, nodes = gain.argmax(axis=1), np.arange(len(found))
    f, b = np.divmod(at, n.shape[2])
    return gain[nodes, at], f, b, n[nodes, f, b], s[nodes, f, b]


def grown(bins: np.ndarray, rows: np.ndarray, mean: np.ndarray, depth: int, leaf: float) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """A regression tree on cells (bins as inputs x cells): its nodes as arrays, a right child after its left one, and each input's fall of the squared error."""
    width = int(bins.max(initial=0)) + 2
    centre = float(rows @ mean / rows.sum())
    s = rows * (mean - centre)
    least = 1e-12 * float(s @ (mean - centre))
    n0, s0 = np.array([rows.sum()]), np.array([s.sum()])
    parts: dict[str, list] = {c: [] for c in ("feature", "cut", "left", "value")}
    falls, total, at = np.zeros(len(bins)), 1, np.zeros(bins.shape[1], dtype=np.int64)
    step = max(1, CELLS // (len(bins) * 2 * width))
    for level in range(depth + 1):
        m = len(n0)
        feature, cut, left = np.zeros(m, dtype=np.int8), np.zeros(m, dtype=np.uint8), np.full(m, LEAF, dtype=np.int32)
        ln, ls = np.zeros(m), np.zeros(m)
        for start in range(0, m if level < depth and bins.shape[1] else 0, step):
            size = min(step, m - start)
            mine = slice(None) if size == m else np.flatnonzero((at >= start) & (at < start + size))
            first, weights = (at[mine] - start) * width, (rows[mine], s[mine])
            found = np.empty((size, len(bins), 2, width))
            for f, codes in enumerate(bins):
                for j, w in enumerate(weights):
                    found[:, f, j] = np.bincount(first + codes[mine], weights=w, minlength=size * width).reshape(size, width)
            gain, f, b, n, sums = _gains(found, leaf)
            ok = np.flatnonzero(gain > least)
            falls += np.bincount(f[ok], weights=gain[ok], minlength=len(bins))
            feature[start + ok], cut[start + ok], ln[start + ok], ls[start + ok], left[start + ok] = f[ok], b[ok], n[ok], sums[ok], 0
        split = np.flatnonzero(left == 0)
        left[split] = total + 2 * np.arange(len(split))
        for c, v in (("feature", feature), ("cut", cut), ("left", left), ("value", centre + s0 / np.maximum(n0, 1e-300))):
            parts[c].append(v)
        if not len(split):
            break
        kept = np.flatnonzero(left[at] != LEAF)
        bins, rows, s, at = bins.take(kept, axis=1), rows[kept], s[kept], at[kept]
        at = left[at] - total + (bins[feature[at], np.arange(len(at))] > cut[at])
        n0, s0 = (np.stack([a[split], b[split] - a[split]], axis=1).ravel() for a, b in ((ln, n0), (ls, s0)))
        total += 2 * len(split)
    return {c: np.concatenate(v) for c, v in parts.items()}, falls


def boosted(bins: np.ndarray, rows: np.ndarray, mean: np.ndarray, trees: int, rate: float, depth: int, leaf: float) -> Iterator[tuple[dict[str, np.ndarray], np.ndarray]]:
    """Trees on the steepest fall of the squared error, 2 (y - F), the first on y itself; the values hold the rate."""
    margin = np.zeros(len(rows))
    for k in range(trees):
        tree, falls = grown(bins, rows, 2.0 * (mean - margin) if k else mean, depth, leaf)
        tree["value"] = tree["value"] * (rate if k else 1.0)
        margin += tree["value"][_walked(tree["feature"], tree["cut"], tree["left"], bins)]
        yield tree, falls


_TREES = "model int, tree int, feature binary, cut binary, left binary, value binary, falls binary"
_KINDS = {"feature": np.int8, "cut": np.uint8, "left": np.int32, "value": np.float64}


@dataclass(frozen=True)
class CellTrees:
    """One fit for each model; prediction is the sum of the trees' values, of a forest their mean."""

    inputs: tuple[str, ...]
    lists: dict[int, tuple[str, ...]]
    trees: DataFrame
    mean: bool

    @property
    def importances(self) -> dict[int, dict[str, float]]:
        """Each input's share of the fall of the squared error; of a forest the mean of its trees' shares."""
        out = {k: np.zeros(len(listed)) for k, listed in self.lists.items()}
        for r in self.trees.select("model", "falls").orderBy("model", "tree").collect():
            falls = np.frombuffer(r["falls"], dtype=np.float64)
            out[r["model"]] += falls / (falls.sum() or 1.0) if self.mean else falls
        return {k: dict(zip(self.lists[k], (v / (v.sum() or 1.0)).tolist(), strict=True)) for k, v in out.items()}

    def prediction(self, df: DataFrame, out: str = "predicted") -> DataFrame:
        """The cells beside their prediction."""
        lists, mean = self.lists, self.mean

        def scored(key: tuple, rows: pd.DataFrame, trees: pd.DataFrame) -> pd.DataFrame:
            bins = _bins_of(rows, lists[int(key[0])])
            total = np.zeros(len(rows))
            for tree in trees.sort_values("tree").itertuples():
                feature, cut, left, value = (np.frombuffer(getattr(tree, c), dtype=kind) for c, kind in _KINDS.items())
                total += value[_walked(feature, cut, left, bins)]
            return rows.assign(**{out: total / max(len(trees), 1) if mean else total})

        n = len(lists)
        both = df.repartition(n, "model").groupBy("model").cogroup(self.trees.repartition(n, "model").groupBy("model"))
        return both.applyInPandas(scored, f"{', '.join(f'`{c}` {t}' for c, t in df.dtypes)}, `{out}` double")


def _bins_of(rows: pd.DataFrame, listed: Sequence[str]) -> np.ndarray:
    return (rows[list(listed)].to_numpy().T - 1).astype(np.uint8).reshape(len(listed), len(rows))


def _row(model: int, number: int, tree: Mapping[str, np.ndarray], falls: np.ndarray) -> dict:
    return {"model": model, "tree": number} | {c: tree[c].astype(kind).tobytes() for c, kind in _KINDS.items()} | {"falls": falls.tobytes()}


def fit(
    df: DataFrame, inputs: Sequence[str], lists: Lists, target: str, kind: str, maxDepth: int = 5, minInstancesPerNode: int = 1,
    maxIter: int = 20, stepSize: float = 0.1,
) -> CellTrees:
    """A tree or boosted trees a model from `cells` outside its fold, or a forest a model from its `samples`."""
    inputs, lists = tuple(inputs), {k: tuple(v) for k, v in lists.items()}

    def of_cells(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        model, listed = int(key[0]), lists[int(key[0])]
        part = part.assign(_s=part["rows"] * part[target]).groupby(list(inputs), sort=True)[["rows", "_s"]].sum().reset_index()
        bins, rows, mean = _bins_of(part, listed), part["rows"].to_numpy(), (part["_s"] / part["rows"]).to_numpy()
        found = [grown(bins, rows, mean, maxDepth, minInstancesPerNode)] if kind == "tree" else boosted(bins, rows, mean, maxIter, stepSize, maxDepth, minInstancesPerNode)
        return pd.DataFrame([_row(model, i, tree, falls) for i, (tree, falls) in enumerate(found)])

    def of_sample(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        model, listed = int(key[0]), lists[int(key[0])]
        code, rows, sums = (np.concatenate([np.frombuffer(b, dtype=t) for b in part[c]]) for c, t in (("cells", np.int64), ("rows", float), (target, float)))
        code, place = np.unique(code, return_inverse=True)
        if not len(code):
            return pd.DataFrame(columns=["model", "tree", *_KINDS, "falls"])
        rows, sums = (np.bincount(place, weights=w) for w in (rows, sums))
        bins = _unpacked(code, len(inputs))[[inputs.index(c) for c in listed]] - 1
        return pd.DataFrame([_row(model, int(key[1]), *grown(bins.astype(np.uint8), rows, sums / rows, maxDepth, minInstancesPerNode))])

    if kind == "forest":
        groups = df.repartition(min(DEALT, max(1, 16 * len(lists))), "model", "tree").groupBy("model", "tree")
        trees = cut_lineage(groups.applyInPandas(of_sample, _TREES))
    else:
        trees = cut_lineage(df.filter("fold <> model").repartition(len(lists), "model").groupBy("model").applyInPandas(of_cells, _TREES))
    if trees.select("model").distinct().count() < len(lists):
        raise ValueError("no rows to train on")
    return CellTrees(inputs, lists, trees, kind == "forest")
