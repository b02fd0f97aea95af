"""Second-order tree boosting on Spark: one histogram per tree level, missing values searched on both sides.

Rows are binned, written once and held as blocks of arrays. A level of a tree is one pass in
which every task sums gradients and Hessians by (node, input, bin); the sums are reduced in a
tree, and the driver sees at most 2^depth x inputs x (bins + 1) cells and picks the splits.
Bins are held by input in the smallest whole numbers, so a sum is one count over an array.
The blocks are an RDD because a fit is some hundred such passes: one takes 0.05 s of overhead,
as a query 0.3 to 0.5 s. Gradients are summed as whole numbers (2^-24 steps), so a fit does
not depend on partitions, order or retries.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalar import hash_int
from tallyfold.operators.prep import quantile_edges
from tallyfold.session import cut_lineage

UNIT = 1 << 24
#: Rounds after which the blocks' margins are moved on, so that a pass walks at most so many trees.
MOVED_EVERY = 4
LEAF = -1
#: Rows of a block.
BLOCK = 1 << 14
#: Partitions up to which histograms are merged by the driver alone.
FEW = 32
#: Cells of all partial histograms up to which the driver alone merges them.
MERGED = 1 << 22
#: Rows that are walked through a tree at a time when scoring.
WALKED = 1 << 12


@dataclass(frozen=True)
class FlatTrees:
    """Trees as parallel arrays over all nodes. A row without the input, or with one up to the threshold, goes left or
    right by `missing_left` and the comparison; a leaf has left = LEAF and its value. roots are the trees' first nodes."""

    inputs: tuple[str, ...]
    roots: tuple[int, ...]
    feature: tuple[int, ...]
    threshold: tuple[float, ...]
    missing_left: tuple[bool, ...]
    left: tuple[int, ...]
    right: tuple[int, ...]
    value: tuple[float, ...]
    depth: int

    def first(self, n: int) -> FlatTrees:
        return FlatTrees(self.inputs, self.roots[:n], self.feature, self.threshold, self.missing_left, self.left, self.right, self.value, self.depth)

    def margin(self, base: float = 0.0) -> Column:
        """The sum over trees of the leaf each row falls in, walked for many rows at a time, tree after tree.

        A leaf is its own child, so every row takes the same number of steps. Null and NaN are missing.
        """
        if not self.roots:
            return F.lit(float(base))
        trees, inputs = self, len(self.inputs)

        @F.pandas_udf("double")
        def total(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            feature, threshold, value = np.array(trees.feature, dtype=np.int32), np.array(trees.threshold, dtype=float), np.array(trees.value, dtype=float)
            missing_right = ~np.array(trees.missing_left, dtype=bool)
            children = np.array([(i, i) if l == LEAF else (l, r) for i, (l, r) in enumerate(zip(trees.left, trees.right, strict=True))], dtype=np.int32).ravel()
            for columns in batches:
                x = np.stack([c.to_numpy(dtype=float, na_value=np.nan) for c in columns])
                out = np.full(x.shape[1], float(base))
                for start in range(0, len(out), WALKED):
                    part = np.ascontiguousarray(x[:, start : start + WALKED])
                    n = part.shape[1]
                    flat, rows, gone = part.ravel(), np.arange(n, dtype=np.int32), np.isnan(part).any()
                    for root in trees.roots:
                        at = np.full(n, root, dtype=np.int32)
                        for _ in range(max(trees.depth, 1)):
                            v = flat[feature[at] * n + rows] if inputs > 1 else flat
                            right = v > threshold[at]
                            if gone:
                                right |= np.isnan(v) & missing_right[at]
                            at = children[2 * at + right]
                        out[start : start + n] += value[at]
                yield pd.Series(out)

        return total(*[F.col(c).cast("double") for c in self.inputs])

    def table(self, df: DataFrame) -> DataFrame:
        """Score code as rows: (tree, node, variable, threshold, missing_left, left, right, value)."""
        tree = np.searchsorted(self.roots, np.arange(len(self.left)), "right") - 1
        rows = [
            (int(t), i, None if l == LEAF else self.inputs[f], None if l == LEAF else h, None if l == LEAF else m, l, r, v)
            for i, (t, f, h, m, l, r, v) in enumerate(zip(tree, self.feature, self.threshold, self.missing_left, self.left, self.right, self.value, strict=True))
        ]
        return df.sparkSession.createDataFrame(rows, "tree int, node int, variable string, threshold double, missing_left boolean, left int, right int, value double")


@dataclass
class Boosted:
    trees: FlatTrees
    #: A row a round: its loss and wrong shares of training and validation rows, and whether it is the round kept.
    trail: list[dict]
    importance: dict[str, float] = field(default_factory=dict)

    def margin(self) -> Column:
        return self.trees.margin()

    def probability(self) -> Column:
        return 1.0 / (1.0 + F.exp(-self.margin()))


@dataclass(frozen=True)
class Settings:
    rate: float
    depth: int
    ridge: float
    min_hessian: float
    leaf: int


def _grow(cells: dict, node: int, edges: list[np.ndarray], s: Settings) -> tuple | None:
    """(gain, feature, bin, missing_left, left G, left H) of a node's best split, or None.

    cells[node] has for each input the arrays G, H, n over its bins, missing last.
    """
    best = None
    for f, (g, h, n) in enumerate(cells[node]):
        total_g, total_h, total_n = g.sum(), h.sum(), n.sum()
        gl, hl, nl = np.cumsum(g[:-1])[:-1], np.cumsum(h[:-1])[:-1], np.cumsum(n[:-1])[:-1]
        for missing_left in (False, True):
            if missing_left and n[-1] == 0:
                continue
            a, b, c = (gl + g[-1], hl + h[-1], nl + n[-1]) if missing_left else (gl, hl, nl)
            ga, ha, gb, hb = a / UNIT, b / UNIT, (total_g - a) / UNIT, (total_h - b) / UNIT
            ok = (ha >= s.min_hessian) & (hb >= s.min_hessian) & (c >= s.leaf) & (total_n - c >= s.leaf)
            gain = ga * ga / (ha + s.ridge) + gb * gb / (hb + s.ridge) - (total_g / UNIT) ** 2 / (total_h / UNIT + s.ridge)
            gain = np.where(ok, gain, -np.inf)
            if len(gain) and gain.max() > 1e-9 and (best is None or gain.max() > best[0] + 1e-12):
                k = int(gain.argmax())
                best = (float(gain[k]), f, k, missing_left, int(a[k]), int(b[k]))
    return best


@dataclass
class _Block:
    """Some rows: bins as inputs x rows, target, 1 for validation rows, random bits, margin."""

    bins: np.ndarray
    y: np.ndarray
    role: np.ndarray
    draw: np.ndarray
    margin: np.ndarray

    def moved(self, trees: list[dict], missing: np.ndarray) -> _Block:
        return replace(self, margin=_margins(trees, self.margin, self.bins, missing))


def _node(tree: dict, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
    """The last node of each row on its way down; a leaf is its own child."""
    n = bins.shape[1]
    flat, rows = bins.ravel(), np.arange(n)
    at = np.zeros(n, dtype=np.int64)
    leaf = np.array(tree["left"]) == LEAF
    itself = np.arange(len(leaf))
    children = np.stack([np.where(leaf, itself, tree["left"]), np.where(leaf, itself, tree["right"])], axis=1).ravel()
    f, k = np.array(tree["feature"]), np.array(tree["bin"])
    none, missing_right = missing[f], ~np.array(tree["missing_left"], dtype=bool)
    while not leaf[at].all():
        x = flat[f[at] * n + rows]
        at = children[2 * at + np.where(x == none[at], missing_right[at], x > k[at])]
    return at


def _margins(trees: list[dict], start: np.ndarray, bins: np.ndarray, missing: np.ndarray) -> np.ndarray:
    out = start.copy()
    for tree in trees:
        out += np.asarray(tree["value"])[_node(tree, bins, missing)]
    return out


#: Sums of the losses, wrong rows and rows of training and of validation rows, and of G, H and rows by (node, input, bin).
_Sums = tuple[np.ndarray, np.ndarray]


def _summed(a: _Sums | None, b: _Sums | None) -> _Sums | None:
    return (a[0] + b[0], a[1] + b[1]) if a is not None and b is not None else b if a is None else a


def _cells(block: _Block, done: list[dict], current: dict | None, missing: np.ndarray, width: int, cut: int, round_: int) -> _Sums:
    """Sums over the sampled training rows by open node, input and bin; without a current tree the losses of all rows too.

    All are whole numbers far below 2^53, which sums of doubles keep.
    """
    opened = [0] if current is None else current["open"]
    p = 1.0 / (1.0 + np.exp(-np.clip(_margins(done, block.margin, block.bins, missing), -500, 500)))
    used = block.role == 0
    if cut < 1 << 32:
        used &= sampled(block.draw, round_) < cut
    losses = np.zeros((2, 3), dtype=np.int64)
    if current is None:
        at = np.zeros(len(p), dtype=np.int64)
        loss = np.rint(-np.log(np.maximum(np.where(block.y == 1, p, 1 - p), 1e-15)) * UNIT)
        for part, values in enumerate((loss, (p >= 0.5) != (block.y == 1), None)):
            losses[:, part] = np.bincount(block.role, weights=values, minlength=2)
    else:
        slots = np.full(len(current["left"]), -1, dtype=np.int64)
        slots[opened] = np.arange(len(opened))
        at = slots[_node(current, block.bins, missing)]
        used &= at >= 0
    if not used.all():
        at, p, y, bins = at[used], p[used], block.y[used], block.bins[:, used]
    else:
        y, bins = block.y, block.bins
    g, h = np.rint((p - y) * UNIT), np.rint(p * (1 - p) * UNIT)
    sums = np.empty((len(opened), len(missing), 3, width), dtype=np.int64)
    at = at * width
    for f in range(len(missing)):
        cell = at + bins[f]
        for part, values in enumerate((g, h, None)):
            sums[:, f, part] = np.bincount(cell, weights=values, minlength=len(opened) * width).reshape(len(opened), width)
    return losses, sums


def _histograms(blocks: RDD, done: list[dict], current: dict | None, sizes: list[int], cut: int, round_: int) -> dict[int, list]:
    """{node: [(G, H, n) of each input]}; with a current tree its open leaves are the nodes, else node 0 and, below 0, the losses."""
    width, missing = max(sizes) + 1, np.array(sizes)
    opened = [0] if current is None else current["open"]

    def one(items: Iterator[_Block]) -> Iterator[_Sums | None]:
        total = None
        for block in items:
            total = _summed(total, _cells(block, done, current, missing, width, cut, round_))
        yield total

    # At most FEW partial histograms, and MERGED cells of them, reach the driver; more are merged by tasks first.
    parts = blocks.getNumPartitions()
    depth = 1 if parts <= FEW and parts * len(opened) * len(sizes) * 3 * width <= MERGED else 2
    found = blocks.mapPartitions(one).treeAggregate(None, _summed, _summed, depth)
    out: dict[int, list] = {}
    if found is None:
        return out
    losses, sums = found
    out |= {-1 - role: v.tolist() for role, v in enumerate(losses) if v[2]}
    for node, cells in zip(opened, sums, strict=True):
        if cells[0, 2].any():
            out[node] = [tuple(a[: k + 1] for a in cells[f]) for f, k in enumerate(sizes)]
    return out


def sampled(draw: np.ndarray, round_: int) -> np.ndarray:
    """32 bits for each row and round, from the row's own 32 random bits."""
    shift = np.uint64(round_ * 0x9E3779B97F4A7C15 % (1 << 64))
    h = (draw.astype(np.uint64) + shift) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (h >> np.uint64(32)).astype(np.int64)


def second_order(
    df: DataFrame, inputs: Sequence[str], target: str, key: str, trees: int = 100, rate: float = 0.1, depth: int = 3,
    ridge: float = 1.0, min_hessian: float = 1.0, leaf: int = 1, bins: int = 256, subsample: float = 1.0,
    validation: str | None = None, metric: str = "loss", patience: int | None = None, seed: int = 12345,
) -> Boosted:
    """Boosted trees for a 0/1 target by gradients G and Hessians H of the log loss.

    A split gains G_l^2/(H_l+ridge) + G_r^2/(H_r+ridge) - G^2/(H+ridge); every split is tried
    with the rows that miss its input on the left and on the right. A leaf is -rate * G/(H+ridge).
    Inputs are cut at `bins` exact quantiles, null and NaN count as missing. A round draws `subsample` of
    the training rows by hash of the key. Where `validation` is true, rows do not train; with
    `patience`, boosting stops when their `metric` ("loss" or "wrong") has not improved for so
    many rounds, and the best round's trees are kept. Rows without a target are left out. Without
    training rows there are no trees.
    """
    role = F.coalesce(F.col(validation).cast("int"), F.lit(0)) if validation else F.lit(0)
    used = df.filter(F.col(target).isNotNull())
    plain = [F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(inputs)]
    narrow = cut_lineage(used.select(F.col(target).cast("double").alias("y"), role.alias("role"), hash_int(key, seed).alias("draw"), *plain))
    names = [f"x{i}" for i in range(len(inputs))]
    found = quantile_edges(narrow.filter("role = 0"), names, bins, interpolate=False, stored=True)
    edges = [np.array(found[c]) for c in names]
    sizes = [len(e) + 1 for e in edges]

    kind = np.uint8 if max(sizes) < 1 << 8 else np.uint16 if max(sizes) < 1 << 16 else np.int32

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y, role, draw, *x = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            codes = np.empty((len(names), batch.num_rows), dtype=kind)
            for i, v in enumerate(x):
                codes[i] = np.where(np.isnan(v), sizes[i], np.searchsorted(edges[i], v, "left"))
            arrays = (codes, y.astype(np.float64), role.astype(np.int8), draw.astype(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array([a.tobytes()], type=pa.binary()) for a in arrays], names=["bins", "y", "role", "draw"])

    def block(r) -> _Block:
        y = np.frombuffer(r["y"], dtype=np.float64)
        codes = np.frombuffer(r["bins"], dtype=kind).reshape(len(names), len(y))
        return _Block(codes, y, np.frombuffer(r["role"], dtype=np.int8), np.frombuffer(r["draw"], dtype=np.int64), np.zeros(len(y)))

    # No more tasks than full blocks: on little data a pass is mostly the start of its tasks.
    n_rows = narrow.count()
    packed = narrow.coalesce(max(1, -(-n_rows // BLOCK))).mapInArrow(coded, "bins binary, y binary, role binary, draw binary")
    blocks = packed.filter("length(y) > 0").rdd.map(block).persist(StorageLevel.MEMORY_AND_DISK)
    s = Settings(rate, depth, ridge, min_hessian, leaf)
    cut = round(subsample * (1 << 32))
    grown: list[dict] = []
    since, trail, gains = 0, [], dict.fromkeys(range(len(inputs)), 0.0)
    missing, held = np.array(sizes), [blocks]

    def seen(cells: dict) -> None:
        shares = {f"{name}_{part}": v[i] / (UNIT if part == "loss" else 1) / v[2] for name, v in (("train", cells.get(-1)), ("valid", cells.get(-2))) if v and v[2] for i, part in enumerate(("loss", "wrong"))}
        trail.append({"round": len(grown), **shares})

    def done() -> bool:
        if patience is None or not trail or f"valid_{metric}" not in trail[-1]:
            return False
        best = min(range(len(trail)), key=lambda k: (trail[k][f"valid_{metric}"], k))
        return len(trail) - 1 - best >= patience

    while True:
        level = _histograms(blocks, grown[since:], None, sizes, cut, len(grown))
        seen(level)
        if len(grown) >= trees or done() or 0 not in level:
            break
        grown.append(_tree(blocks, grown[since:], level, edges, sizes, cut, len(grown), s, gains))
        if len(grown) - since >= MOVED_EVERY:
            latest, old = grown[since:], blocks
            blocks, since = old.map(lambda b, latest=latest: b.moved(latest, missing)).persist(StorageLevel.MEMORY_AND_DISK), len(grown)
            held.append(blocks)
            # The last ones are computed from those before in the next pass; what is older is no longer read.
            for spent in held[:-2]:
                spent.unpersist()
            del held[:-2]
    for old in held:
        old.unpersist()
    best = len(grown)
    if patience is not None and f"valid_{metric}" in trail[-1]:
        best = min(trail, key=lambda t: (t[f"valid_{metric}"], t["round"]))["round"]
    total = sum(gains.values()) or 1.0
    return Boosted(
        _flat(grown, tuple(inputs), edges, depth).first(best),
        [{**t, "kept": t["round"] == best} for t in trail],
        {c: gains[i] / total for i, c in enumerate(inputs)},
    )


def _tree(
    blocks: RDD, before: list[dict], level: dict, edges: list[np.ndarray], sizes: list[int], cut: int, round_: int, s: Settings, gains: dict
) -> dict:
    """One tree, level by level; a leaf's value comes from the sums of the split that made it."""
    t: dict = {c: [] for c in ("feature", "bin", "missing_left", "left", "right", "value")}

    def add(g: int, h: int) -> int:
        for c, v in (("feature", 0), ("bin", 0), ("missing_left", False), ("left", LEAF), ("right", LEAF), ("value", -s.rate * (g / UNIT) / (h / UNIT + s.ridge))):
            t[c].append(v)
        return len(t["left"]) - 1

    def total(node: int) -> tuple[int, int]:
        g, h, _ = level[node][0]
        return int(g.sum()), int(h.sum())

    t["open"] = [add(*total(0))]
    for d in range(s.depth):
        opened = []
        for node in t["open"]:
            split = _grow(level, node, edges, s)
            if split is None:
                continue
            gain, t["feature"][node], t["bin"][node], t["missing_left"][node], g, h = split
            gains[t["feature"][node]] += gain
            all_g, all_h = total(node)
            t["left"][node], t["right"][node] = add(g, h), add(all_g - g, all_h - h)
            opened += [t["left"][node], t["right"][node]]
        t["open"] = opened
        if not opened or d + 1 == s.depth:
            break
        level = _histograms(blocks, before, t, sizes, cut, round_)
    return t


def _flat(grown: list[dict], inputs: tuple[str, ...], edges: list[np.ndarray], depth: int) -> FlatTrees:
    parts: dict[str, list] = {c: [] for c in ("roots", "feature", "threshold", "missing_left", "left", "right", "value")}
    for t in grown:
        base = len(parts["left"])
        parts["roots"].append(base)
        for i, left in enumerate(t["left"]):
            f, leaf = t["feature"][i], left == LEAF
            parts["feature"].append(f)
            parts["threshold"].append(0.0 if leaf else float(edges[f][t["bin"][i]]))
            parts["missing_left"].append(bool(t["missing_left"][i]))
            parts["left"].append(LEAF if leaf else base + left)
            parts["right"].append(LEAF if leaf else base + t["right"][i])
            parts["value"].append(float(t["value"][i]))
    return FlatTrees(inputs, **{c: tuple(v) for c, v in parts.items()}, depth=depth)
