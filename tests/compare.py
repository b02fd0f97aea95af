"""Runs a named query in Spark and its SQL in DuckDB and compares the rows as multisets."""

from __future__ import annotations


import duckdb

TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _key(row):
    return tuple((v is not None, str(type(v)), v if v is not None else 0) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted([tuple(r) for r in df.select(*names).collect()], key=_key)


def duck_rows(con, sql):
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    rows = [tuple(r[i] for i in order) for r in cur.fetchall()]
    return [names[i] for i in order], sorted(rows, key=_key)


def difference(df, con, sql) -> str | None:
    """None when equal, else what differs."""
    names, left = spark_rows(df)
    other, right = duck_rows(con, sql)
    if names != other:
        return f"columns {names} != {other}"
    if len(left) != len(right):
        return f"{len(left)} rows, oracle {len(right)}; e.g. {left[:2]} / {right[:2]}"
    wrong = [(a, b) for a, b in zip(left, right, strict=True) if a != b]
    return f"{len(wrong)} rows differ, e.g. {wrong[:2]}" if wrong else None


