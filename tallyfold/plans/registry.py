"""Named queries, each with its result columns and, where SQL can say it, the same in SQL.

A column list such as "account_id:i p:f6 cls:s" fixes names, types and the digits
that are compared: i = bigint, fN = double rounded to N digits, s = string, d = date,
t = timestamp without zone, b = boolean. "*:f6" stands for all other columns, as the data have them;
its SQL lists those of the given tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SPARK = {"i": "bigint", "s": "string", "d": "date", "t": "timestamp_ntz", "b": "boolean"}
_DUCK = {"i": "BIGINT", "s": "VARCHAR", "d": "DATE", "t": "TIMESTAMP", "b": "BOOLEAN"}


@dataclass(frozen=True)
class Query:
    name: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def _columns(cols: str) -> list[tuple[str, str]]:
    return [tuple(c.rsplit(":", 1)) for c in cols.split()]


def _shape(df: DataFrame, cols: str) -> DataFrame:
    out = []
    listed = _columns(cols)
    others = [c for c in df.columns if c not in dict(listed)]
    for name, kind in [(n, k) for name, k in listed for n in (others if name == "*" else [name])]:
        if kind[0] == "f":
            value = F.round(F.col(name).cast("double"), int(kind[1:]))
        else:
            value = F.col(name).cast(_SPARK[kind])
        out.append(value.alias(name))
    return df.select(*out)


def _shape_sql(sql: str, cols: str) -> str:
    out = []
    for name, kind in _columns(cols):
        name = f'"{name}"'
        if kind[0] == "f":
            value = f"round(CAST({name} AS DOUBLE), {kind[1:]})"
            value = f"CASE WHEN {value} = 0 THEN CAST(0 AS DOUBLE) ELSE {value} END"
        else:
            value = f"CAST({name} AS {_DUCK[kind]})"
        out.append(f"{value} AS {name}")
    return f"SELECT {', '.join(out)} FROM ({sql}) AS shaped"


def query(name: str, cols: str, sql: str | None = None, sql_cols: str | None = None):
    """Register a function (spark, sf_dir) -> DataFrame under a build key; sql_cols where `cols` leaves columns open."""

    def wrap(fn):
        if name in REGISTRY:
            raise ValueError(f"{name} registered twice")
        REGISTRY[name] = Query(
            name,
            lambda spark, d: _shape(fn(spark, d), cols),
            None if sql is None else _shape_sql(sql, sql_cols or cols),
        )
        return fn

    return wrap
