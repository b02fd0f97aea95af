"""The modelling views all queries share, each with its SQL text for the oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tallyfold.functions.scalar import hash_uniform, linear_predictor, logistic


_SCHEMAS: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stored table. Its schema is inferred once per path, not once per query."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


# A fixed scorecard on the loans view, so that scores can be compared across engines.
INTERCEPT = -3.1
COEFS = {
    "n_lines": 0.45,
    "qty": 0.006,
    "avg_disc": 1.2,
    "amount": -4e-7,
    "net_worth": -1.5e-5,
}
FEATURES = list(COEFS)


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order that has lines: the table every model works on.

    The line items are aggregated before any join, so a hot order costs one partial
    aggregate per task; joins are left to AQE (size-checked broadcast, skew split).
    """
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(
            F.count("*").alias("n_lines"),
            F.sum("l_quantity").alias("qty"),
            F.avg("l_discount").alias("avg_disc"),
            F.count_if(F.col("l_returnflag") == "R").alias("n_returned"),
        )
    )
    orders = table(spark, sf_dir, "orders")
    customer = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    return (
        orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"))
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("o_orderkey").alias("account_id"),
            F.col("o_custkey").alias("customer_id"),
            F.col("o_totalprice").alias("amount"),
            F.col("c_acctbal").alias("net_worth"),
            "n_lines",
            "qty",
            "avg_disc",
            "n_returned",
            F.col("c_mktsegment").alias("segment"),
            F.col("o_orderpriority").alias("priority"),
            F.col("o_orderstatus").alias("status"),
            F.col("n_regionkey").alias("region"),
            (F.col("n_returned") >= 2).cast("int").alias("event"),
            F.col("o_orderdate").alias("opened"),
        )
    )


LOANS = """loans AS (
 SELECT o_orderkey AS account_id, o_custkey AS customer_id, o_totalprice AS amount,
        c_acctbal AS net_worth, n_lines, qty, avg_disc, n_returned,
        c_mktsegment AS segment, o_orderpriority AS priority, o_orderstatus AS status,
        n_regionkey AS region, CAST(n_returned >= 2 AS INT) AS event, o_orderdate AS opened
 FROM orders
 JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS qty,
              avg(l_discount) AS avg_disc, count(*) FILTER (l_returnflag = 'R') AS n_returned
       FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey
 JOIN customer ON o_custkey = c_custkey
 JOIN nation ON c_nationkey = n_nationkey)"""


def score_col():
    return logistic(linear_predictor(COEFS, INTERCEPT))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans with the scorecard probability `p` and a hash-based 60/30/10 `part`."""
    u = hash_uniform("account_id", 10)
    part = F.when(u < 0.6, 1).when(u < 0.9, 0).otherwise(2)
    return loans(spark, sf_dir).withColumns({"p": score_col(), "part": part})


XBETA_SQL = f"({INTERCEPT} + " + " + ".join(f"({b!r}) * {c}" for c, b in COEFS.items()) + ")"


def uniform_sql(key: str, seed) -> str:
    return (
        f"(CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || '|{seed}'), 1, 8) AS BIGINT)"
        " / CAST(4294967296 AS DOUBLE))"
    )


SCORED = f"""{LOANS}, scored AS (
 SELECT *, CAST(1 / (1 + exp(-{XBETA_SQL})) AS DOUBLE) AS p,
        CASE WHEN {uniform_sql('account_id', 10)} < 0.6 THEN 1
             WHEN {uniform_sql('account_id', 10)} < 0.9 THEN 0 ELSE 2 END AS part
 FROM loans)"""
