"""Projection, filter, reshape and JSON steps."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def select_without(df: DataFrame, drop: Sequence[str]) -> DataFrame:
    gone = set(drop)
    return df.select(*[c for c in df.columns if c not in gone])


def with_labels(df: DataFrame, labels: Mapping[str, str]) -> DataFrame:
    """Attach column labels as field comments."""
    for name, text in labels.items():
        df = df.withMetadata(name, {**df.schema[name].metadata, "comment": text})
    return df


def column_labels(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata.get("comment", "") for f in df.schema.fields}


def clean_names(df: DataFrame) -> DataFrame:
    """Drop blanks, turn brackets into underscores."""
    return df.toDF(*[c.replace(" ", "").replace("(", "_").replace(")", "_") for c in df.columns])


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Rows for which the predicate is not true; an unknown predicate keeps the row."""
    return df.filter(~F.coalesce(predicate, F.lit(False)))


def query_step(df: DataFrame, spec: Mapping) -> DataFrame:
    """One visual query step.

    Keys: where, group_by, select {alias: column}, aggregates {alias: (function, column)},
    having, distinct, order_by [(column, ascending)], limit.
    """
    if spec.get("where"):
        df = df.filter(spec["where"])
    aggregates = [
        F.count("*").alias(alias) if column == "*" else getattr(F, fn)(column).alias(alias)
        for alias, (fn, column) in spec.get("aggregates", {}).items()
    ]
    if aggregates:
        df = df.groupBy(*spec.get("group_by", [])).agg(*aggregates)
    elif spec.get("select"):
        df = df.select(*[F.col(c).alias(alias) for alias, c in spec["select"].items()])
    if spec.get("having"):
        df = df.filter(spec["having"])
    if spec.get("distinct"):
        df = df.distinct()
    if spec.get("order_by"):
        df = df.orderBy(*[F.col(c).asc() if up else F.col(c).desc() for c, up in spec["order_by"]])
    return df.limit(spec["limit"]) if spec.get("limit") is not None else df


def append_force(base: DataFrame, *others: DataFrame) -> DataFrame:
    """Bag union by name; the base decides the columns, missing ones are NULL."""
    fitted = [o.select(*[c for c in o.columns if c in base.columns]) for o in others]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), fitted, base).select(*base.columns)


def stack_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


#: A pivot makes at most this many columns; with more levels the rows keep a map.
MAX_COLUMNS = 1000


def found_levels(df: DataFrame, column: str, most: int = MAX_COLUMNS) -> list:
    """The levels of a column in ascending order, nulls left out, from one pass over the data.

    At most `most` levels reach the driver; more are an error, as they are no list of columns.
    """
    rows = df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"{column} has more than {most} levels; long_to_map keeps any number of them")
    return [r[0] for r in rows]


def long_to_wide(df: DataFrame, key: str, name: str, value: str, names: Sequence | None = None) -> DataFrame:
    """Rows (key, name, value) to one row per key; names not given are found in the data by a first pass.

    A key whose names are all null keeps its row; a name without a value is NULL.
    """
    names = found_levels(df, name) if names is None else list(names)
    if not names:
        return df.select(key).distinct()
    return df.groupBy(key).pivot(name, names).agg(F.first(value, ignorenulls=True))


def long_to_map(df: DataFrame, key: str, name: str, value: str, to: str = "levels") -> DataFrame:
    """Rows (key, name, value) to one row per key with a map name -> value, names ascending.

    No list of names is needed, so a new level appears by itself. Of rows that repeat a name
    the greatest value stays; null names are left out, a key without names has an empty map.
    Rows are reduced to one for each (key, name) before a key's names meet.
    """
    single = df.groupBy(key, name).agg(F.max(value).alias("_value"))
    listed = F.collect_list(F.when(F.col(name).isNotNull(), F.struct(F.col(name).alias("key"), F.col("_value").alias("value"))))
    return single.groupBy(key).agg(F.map_from_entries(F.array_sort(listed)).alias(to))


def map_to_long(df: DataFrame, keep: Sequence[str], levels: str = "levels", name: str = "variable", value: str = "value") -> DataFrame:
    """One row for each entry of a map column."""
    return df.select(*keep, F.explode(levels).alias(name, value))


def wide_to_long(
    df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str = "variable", value: str = "value"
) -> DataFrame:
    doubles = df.select(*ids, *[F.col(v).cast("double").alias(v) for v in values])
    return doubles.unpivot(list(ids), list(values), name, value)


def levels(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def explode_records(df: DataFrame, column: str, schema: str, keep: Sequence[str] = ()) -> DataFrame:
    """A JSON list of records in a text column -> one row per record, fields as columns."""
    parsed = df.select(*keep, F.posexplode(F.from_json(column, schema)).alias("pos", "_rec"))
    return parsed.select(*keep, "pos", "_rec.*")


def name_value_to_columns(df: DataFrame, column: str, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """A JSON list of {name, value} in a text column -> one column per wanted name."""
    pairs = F.map_from_entries(F.from_json(column, "array<struct<name:string,value:string>>"))
    listed = df.select(*keep, pairs.alias("_pairs"))
    return listed.select(*keep, *[F.try_element_at("_pairs", F.lit(n)).alias(n) for n in names])


def columns_to_name_value(columns: Sequence[str]) -> Column:
    """The request payload: [{"name": ..., "value": ...}, ...] as JSON text."""
    pairs = [F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("value")) for c in columns]
    return F.to_json(F.array(*pairs))
