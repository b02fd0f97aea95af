"""Connected components of an edge table, by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.session import cut_lineage


def _least(edges: DataFrame, own: str, other: str) -> DataFrame:
    """For each node the least of itself and its neighbours; partial minima keep hubs cheap."""
    return edges.groupBy(F.col(own).alias("n")).agg(F.min(other).alias("m")).select("n", F.least("n", "m").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = _least(both, "a", "b")
    return (
        both.filter("b > a")
        .join(least, F.col("a") == F.col("n"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges point from the larger (a) to the smaller (b)."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = _least(down, "a", "b")
    return (
        down.join(least, F.col("a") == F.col("n"))
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .filter("a <> b")
        .union(least.select(F.col("n").alias("a"), F.col("m").alias("b")).filter("a <> b"))
        .distinct()
    )


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge; component is the least node reachable.

    Ends when the star step changes nothing. No node gathers its neighbours: minima are
    aggregated and joined back. An edge from a node to itself gives that node alone;
    null ends are dropped; an empty table gives an empty result.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).dropna()
    nodes = cut_lineage(pairs.distinct())
    stars = nodes.filter("a <> b")

    def mark(df: DataFrame) -> tuple:
        row = df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        return tuple(row)

    before = None
    while True:
        stars = cut_lineage(_small_star(_large_star(stars)))
        now = mark(stars)
        if now == before:
            break
        before = now
    ends = nodes.select(F.col("a").alias("node")).union(nodes.select(F.col("b").alias("node"))).distinct()
    return ends.join(stars.select(F.col("a").alias("node"), F.col("b").alias("root")), "node", "left").select(
        "node", F.coalesce("root", "node").alias("component")
    )
