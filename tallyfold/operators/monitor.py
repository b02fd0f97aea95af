"""Performance and input drift by period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.functions.scalar import bin_of
from tallyfold.operators.assess import assess_groups
from tallyfold.operators.prep import quantile_edges
from tallyfold.session import cut_lineage


def period_kpis(df: DataFrame, key: str, y: str, p: str, period: str) -> DataFrame:
    """All performance measures of each period, in one job."""
    return assess_groups(df, key, y, p, [period])


def stability(
    df: DataFrame, columns: Sequence[str], period: str, base, bins: int = 10
) -> DataFrame:
    """Population stability index of each input, each period against the base period.

    Edges are quantiles of the base. Shares are smoothed by half a row, so an empty bin
    gives a finite index. The counts are at most periods x variables x (bins + 1).
    """
    df = cut_lineage(df.select(period, *columns))
    edges = quantile_edges(df.filter(F.col(period) == base), columns, bins, interpolate=False, stored=True)
    pairs = [
        F.struct(F.lit(c).alias("variable"), F.coalesce(bin_of(c, e), F.lit(-1)).alias("bin"))
        for c, e in edges.items()
    ]
    counts = (
        df.select(F.col(period).alias("period"), F.inline(F.array(*pairs)))
        .groupBy("variable", "period", "bin")
        .agg(F.count("*").alias("n"))
    )
    counts = cut_lineage(counts)
    periods = counts.select("variable", "period").distinct()
    cells = counts.select("variable", "bin").distinct()
    full = periods.join(cells, "variable").join(counts, ["variable", "period", "bin"], "left")
    n = F.coalesce("n", F.lit(0)) + 0.5
    shares = full.select(
        "variable", "period", "bin", (n / F.sum(n).over(Window.partitionBy("variable", "period"))).alias("share")
    )
    reference = shares.filter(F.col("period") == base).select("variable", "bin", F.col("share").alias("base_share"))
    both = shares.join(reference, ["variable", "bin"])
    term = (F.col("share") - F.col("base_share")) * F.ln(F.col("share") / F.col("base_share"))
    return both.groupBy("variable", "period").agg(F.sum(term).alias("psi"))
