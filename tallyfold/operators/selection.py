"""Feature selection."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalar import bin_of
from tallyfold.operators.prep import quantile_edges
from tallyfold.session import cut_lineage


def symmetric_uncertainty(
    df: DataFrame, columns: Sequence[str], target: str, bins: int = 10
) -> DataFrame:
    """2*I(X;Y)/(H(X)+H(Y)) per binned input, highest first; all inputs in one pass.

    The contingency counts are at most bins x levels per variable, whatever the table size.
    """
    df = cut_lineage(df.select(target, *columns))
    edges = quantile_edges(df, columns, bins, interpolate=False, stored=True)
    pairs = [F.struct(F.lit(c).alias("variable"), bin_of(c, e).alias("bin")) for c, e in edges.items()]
    joint = (
        df.select(F.col(target).alias("y"), F.inline(F.array(*pairs)))
        .groupBy("variable", "bin", "y")
        .agg(F.count("*").alias("n"))
    )
    joint = cut_lineage(joint)

    def entropy(keys: list[str]) -> DataFrame:
        cells = joint.groupBy("variable", *keys).agg(F.sum("n").cast("double").alias("n"))
        # H = ln N - sum(n ln n)/N
        h = F.ln(F.sum("n")) - F.sum(F.col("n") * F.ln("n")) / F.sum("n")
        return cells.groupBy("variable").agg(h.alias("h_" + "".join(keys)))

    h = entropy(["bin"]).join(entropy(["y"]), "variable").join(entropy(["bin", "y"]), "variable")
    both = F.col("h_bin") + F.col("h_y")
    su = F.when(both > 0, 2 * (both - F.col("h_biny")) / both).otherwise(0.0)
    return h.select("variable", su.alias("su")).orderBy(F.desc("su"), "variable")


#: The model that is fitted on all rows, beside one a fold.
WHOLE = 0


def recursive_elimination(
    columns: Sequence[str],
    folds: Sequence[int],
    fits: Callable[[Mapping[int, Sequence[str]]], Mapping[int, tuple[float | None, Mapping[str, float]]]],
    min_features: int = 1,
) -> list[dict]:
    """Recursive elimination with cross-validation: drop the least important input until `min_features` remain.

    Each fold eliminates by the fits on the rows outside it alone, and its loss is that of these fits on its own rows; the best
    size has the least mean loss. WHOLE eliminates by the fits on all rows: its inputs at the best size are those selected.
    `fits` fits all of them for one size: for each model and its inputs the loss (None: no rows) and the importances.
    Returns one entry per size, the best marked.
    """
    left, trail = {k: list(columns) for k in (WHOLE, *folds)}, []
    while left[WHOLE]:
        found = fits(left)
        scores = [found[k][0] for k in folds if found[k][0] is not None]
        worst = {k: min(inputs, key=lambda c, k=k: (found[k][1][c], c)) for k, inputs in left.items()}
        loss = sum(scores) / len(scores) if scores else math.nan
        trail.append({"n": len(left[WHOLE]), "inputs": list(left[WHOLE]), "loss": loss, "drops": worst[WHOLE]})
        if len(left[WHOLE]) <= min_features:
            break
        left = {k: [c for c in inputs if c != worst[k]] for k, inputs in left.items()}
    best = min(trail, key=lambda e: (e["loss"], e["n"]))
    return [{**e, "best": e is best} for e in trail]


def stepwise(
    columns: Sequence[str], aic: Callable[[Sequence[str]], float], max_steps: int = 50
) -> list[dict]:
    """Forward selection with backward checks on AIC. `aic` fits on the given inputs."""
    chosen: list[str] = []
    current = aic(chosen)
    trail = [{"step": 0, "action": "start", "variable": "", "aic": current}]
    for step in range(1, max_steps + 1):
        moves = [("add", c, [*chosen, c]) for c in columns if c not in chosen]
        if len(chosen) > 1:
            moves += [("remove", c, [x for x in chosen if x != c]) for c in chosen]
        tried = [(aic(inputs), action, c, inputs) for action, c, inputs in moves]
        if not tried:
            break
        value, action, c, inputs = min(tried, key=lambda t: (t[0], t[2]))
        if value >= current - 1e-9:
            break
        chosen, current = inputs, value
        trail.append({"step": step, "action": action, "variable": c, "aic": value})
    return trail
