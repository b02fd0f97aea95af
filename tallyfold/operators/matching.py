"""Names that are nearly equal, records that are the same entity."""

from __future__ import annotations

from collections.abc import Sequence
from os.path import commonprefix

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyfold.functions.scalar import compare_key
from tallyfold.session import cut_lineage


def _shortened(texts: DataFrame, column: str, n: int, key: str, mask: bool = False) -> DataFrame:
    """(column, key): a row for each string left after deleting n characters, as 64-bit hash; all of them where there
    are fewer.

    With `mask` the places are hashed too, so the key stands for the string with n places left
    open. Without, of a run of equal characters only the first is deleted, as the others give
    the same string. Places are exploded from left to right.
    """
    out = texts.select(column, F.col(column).alias("_t"), F.lit(1).alias("_from"))
    kept: list[str] = []
    for i in range(n):
        size, at, later = F.length("_t"), F.col("_at"), n - i - 1
        many = F.sequence(F.col("_from"), size - later)
        places = F.when(size == 0, F.array(F.lit(0))).when(size - later >= F.col("_from"), many).otherwise(F.array(F.col("_from")))
        placed = out.select(column, "_t", "_from", *kept, F.explode(places).alias("_at"))
        if mask:
            kept.append(f"_p{i}")
        else:
            opens_run = F.substring("_t", at, F.lit(1)) != F.substring("_t", at - 1, F.lit(1))
            placed = placed.filter((at <= F.col("_from")) | opens_run)
        shorter = F.concat(F.substring("_t", F.lit(1), at - 1), F.substring("_t", at + 1, size))
        out = placed.select(
            column,
            F.when(at == 0, F.col("_t")).otherwise(shorter).alias("_t"),
            F.greatest(at, F.lit(1)).alias("_from"),
            *kept[: len(kept) - mask],
            *([at.alias(kept[-1])] if mask else []),
        )
    return out.select(column, F.xxhash64("_t", *kept).alias(key))


def _met(a: DataFrame, b: DataFrame, k: int) -> DataFrame:
    """(a, b, key) texts that may be within k edits of each other, all that are among them.

    Texts of one length differ by at most k substitutions, and then agree with k places left
    open; or by k - 1 deletions on both sides, at least one of which is no substitution. If one
    is longer by d, it loses k characters and the other k - d. So no pair meets on k deletions
    of both sides, which would bring together what is 2k edits apart. Kinds of variants are
    made only for texts that have a length to meet on the other side.
    """

    def lengths(df: DataFrame) -> set[int]:
        return {r[0] for r in df.select(F.length(df.columns[0])).distinct().collect()}

    def of(df: DataFrame, column: str, other: set[int], n: int, shift: Sequence[int], kind: int, mask: bool = False) -> DataFrame:
        own = lengths_of[column]
        fit = sorted(x for x in own if any(x + d in other for d in shift))
        picked = df if len(fit) == len(own) else df.filter(F.length(column).isin(fit))
        return _shortened(picked, column, n, "_v", mask).withColumn("_kind", F.lit(kind))

    lengths_of = {"a": lengths(a), "b": lengths(b)}
    out = {}
    for df, column, other, longer, shorter in ((a, "a", lengths_of["b"], 2, 3), (b, "b", lengths_of["a"], 3, 2)):
        parts = [of(df, column, other, k, [0], 0, mask=True)]
        if k > 1:
            parts.append(of(df, column, other, k - 1, [0], 1))
        for d in range(1, k + 1):
            parts.append(of(df, column, other, k - d, [d], shorter))
        if k:
            parts.append(of(df, column, other, k, range(-k, 0), longer))
        out[column] = parts[0]
        for part in parts[1:]:
            out[column] = out[column].unionByName(part)
    return out["a"].join(out["b"], ["_v", "_kind"])


def near_pairs(left: DataFrame, left_col: str, right: DataFrame, right_col: str, k: int) -> DataFrame:
    """Distinct (left, right) texts within edit distance k, with the distance.

    Texts are made distinct first: a name that fills a third of the rows is compared once. A
    text becomes some length**k / k! variants, which no size estimate foresees, so the distinct
    texts are spread over all shuffle partitions before and written once, as each kind of
    variants reads them.
    """
    parts = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    a = cut_lineage(left.select(F.col(left_col).alias("a")).filter("a IS NOT NULL").distinct().repartition(parts, "a"))
    b = cut_lineage(right.select(F.col(right_col).alias("b")).filter("b IS NOT NULL").distinct().repartition(parts, "b"))
    head, tail = _shared_ends(a.unionByName(b.withColumnRenamed("b", "a")), "a")

    def middle(df: DataFrame, c: str) -> DataFrame:
        return df.select(F.substring(c, F.lit(len(head) + 1), F.length(c) - len(head) - len(tail)).alias(c))

    met = _met(middle(a, "a"), middle(b, "b"), k)
    near = met.select("a", "b", F.levenshtein("a", "b", k).alias("distance")).filter("distance >= 0").distinct()
    whole = [F.concat(F.lit(head), F.col(c), F.lit(tail)).alias(c) for c in ("a", "b")]
    return near.select(*whole, "distance")


def _shared_ends(texts: DataFrame, column: str) -> tuple[str, str]:
    """What all texts begin and end with; it takes no part in any distance. The first and the last in order tell it."""
    back = F.reverse(column)
    row = texts.agg(F.min(column), F.max(column), F.min(back), F.max(back), F.min(F.length(column))).first()
    if row[0] is None:
        return "", ""
    head = commonprefix([row[0], row[1]])
    tail = commonprefix([row[2], row[3]])[: row[4] - len(head)]
    return head, tail[::-1]


def fuzzy_join(
    left: DataFrame, left_col: str, lookup: DataFrame, lookup_col: str, k: int, modifiers: str = "ILN"
) -> DataFrame:
    """Rows of `left` with each lookup name within edit distance k."""
    keyed = left.withColumn("_lk", compare_key(left_col, modifiers))
    names = lookup.select(lookup_col, compare_key(lookup_col, modifiers).alias("_rk")).distinct()
    pairs = near_pairs(keyed, "_lk", names, "_rk", k)
    matched = keyed.join(pairs, F.col("_lk") == F.col("a")).join(names, F.col("b") == F.col("_rk"))
    return matched.drop("_lk", "_rk", "a", "b")


def cluster_key(columns: Sequence[str]) -> Column:
    """Cluster id for one rule: records that agree on all columns. No shuffle at all.

    A record with a missing rule column matches nobody and gets NULL.
    """
    # The separator is escaped inside values, so different records never give one text.
    parts = [F.replace(F.replace(F.col(c).cast("string"), F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|")) for c in columns]
    missing = [p.isNull() for p in parts]
    id_ = F.md5(F.concat_ws("|", *parts))
    for m in missing:
        id_ = F.when(~m, id_)
    return id_


def resolve_entities(
    df: DataFrame, key: str, rules: Sequence[Sequence[str]], max_rounds: int = 50
) -> DataFrame:
    """(key, cluster_id): records connected by any chain of rule agreements.

    The cluster id is the smallest key in the cluster. Records meet in (rule, value) nodes,
    never pairwise: each round takes the minimum label per node (combined map-side, so a hot
    value costs one row per task), hands it back, and jumps to the label's own label.
    """
    memberships = df.select(
        F.col(key).alias("id"),
        F.explode(
            F.array(*[F.concat(F.lit(f"{i}|"), cluster_key(rule)) for i, rule in enumerate(rules)])
        ).alias("node"),
    ).filter("node IS NOT NULL")
    edges = cut_lineage(memberships)
    labels = df.select(F.col(key).alias("id"), F.col(key).alias("label"))
    for _ in range(max_rounds):
        by_node = edges.join(labels, "id").groupBy("node").agg(F.min("label").alias("label"))
        by_id = edges.join(by_node, "node").groupBy("id").agg(F.min("label").alias("near"))
        hooked = labels.join(by_id, "id", "left").select(
            "id", "label", F.least("label", "near").alias("best")
        )
        parent = hooked.select(F.col("id").alias("best"), F.col("best").alias("jump"))
        step = cut_lineage(
            hooked.join(parent, "best", "left").select("id", "label", F.least("best", "jump").alias("next"))
        )
        done = step.filter(F.col("label") != F.col("next")).isEmpty()
        labels = step.select("id", F.col("next").alias("label"))
        if done:
            return labels.select(F.col("id").alias(key), F.col("label").alias("cluster_id"))
    raise RuntimeError(f"clusters not settled after {max_rounds} rounds")
