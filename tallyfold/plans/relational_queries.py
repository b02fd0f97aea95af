"""Queries on sources, projection, reshape and joins."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from tallyfold.functions.scalar import lt_or_missing
from tallyfold.operators import matching, relational as rel
from tallyfold.operators.sampling import simple_random_sample
from tallyfold.plans.registry import query
from tallyfold.plans.views import (
    COEFS,
    INTERCEPT,
    LOANS,
    SCORED,
    XBETA_SQL,
    loans,
    scored,
    table,
    uniform_sql,
)
from tallyfold.sources import io
from tallyfold.session import scratch_path


@query(
    "src_load",
    "o_orderstatus:s n:i total:f2",
    "SELECT o_orderstatus, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 1",
)
def src_load(spark, d):
    orders = io.load_once(spark, "orders", f"{d}/orders.parquet")
    return orders.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))


@query(
    "src_csv_roundtrip",
    "c_custkey:i c_name:s c_nationkey:i c_acctbal:f2 c_mktsegment:s",
    "SELECT * FROM customer",
)
def src_csv_roundtrip(spark, d):
    customer = table(spark, d, "customer")
    path = io.write_csv(customer, scratch_path(spark, "csv"))
    return io.read_csv(spark, path, customer.schema)


_STORED_SQL = """SELECT 'promoted' AS stored, o_orderstatus, count(*) AS n, sum(o_totalprice) AS total FROM orders GROUP BY 2
       UNION ALL SELECT 'copied', o_orderstatus, count(*), sum(o_totalprice) FROM orders
       WHERE o_totalprice >= 100000 GROUP BY 2
       UNION ALL SELECT 'replaced', o_orderstatus, count(*), 2 * sum(o_totalprice) FROM orders
       WHERE o_orderstatus <> 'P' GROUP BY 2"""


@query("src_stored_tables", "stored:s o_orderstatus:s n:i total:f1", _STORED_SQL)
def src_stored_tables(spark, d):
    """A view is promoted, copied in part, and then replaced by rows made from itself; the names are dropped at the end."""
    tag = uuid.uuid4().hex
    kept, part = f"kept_{tag}", f"part_{tag}"
    io.load_once(spark, "orders", f"{d}/orders.parquet").createOrReplaceTempView(f"session_{tag}")
    promoted = io.promote_table(spark, f"session_{tag}", kept)
    copied = io.copy_table(spark, kept, part, ["o_orderstatus", "o_totalprice"], "o_totalprice >= 100000")
    doubled = promoted.filter("o_orderstatus <> 'P'").withColumn("o_totalprice", 2 * F.col("o_totalprice"))
    replaced = io.replace_table(doubled, kept)
    sums = [
        t.groupBy(F.lit(name).alias("stored"), "o_orderstatus").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))
        for name, t in (("promoted", promoted), ("copied", copied), ("replaced", replaced))
    ]
    for name in (kept, part):
        io.drop_table(spark, name)
    spark.catalog.dropTempView(f"session_{tag}")
    return rel.stack_all(sums)


@query(
    "src_inline",
    "area:s customers:i",
    """SELECT CASE r_name WHEN 'AFRICA' THEN 'south' WHEN 'AMERICA' THEN 'west' WHEN 'ASIA' THEN 'east'
       ELSE 'other' END AS area, count(*) AS customers
       FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
       GROUP BY 1""",
)
def src_inline(spark, d):
    areas = spark.createDataFrame(
        [("AFRICA", "south"), ("AMERICA", "west"), ("ASIA", "east")], "r_name string, area string"
    )
    regions = table(spark, d, "region").join(areas, "r_name", "left")
    nations = table(spark, d, "nation").join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    per_nation = table(spark, d, "customer").groupBy("c_nationkey").agg(F.count("*").alias("n"))
    return (
        per_nation.join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy(F.coalesce("area", F.lit("other")).alias("area"))
        .agg(F.sum("n").alias("customers"))
    )


@query(
    "src_jdbc_like",
    "o_orderkey:i o_totalprice:f2",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice >= 300000 AND o_orderstatus = 'F'",
)
def src_jdbc_like(spark, d):
    """The warehouse pattern on a file source: SQL text with predicates the scan receives."""
    return spark.sql(
        "SELECT o_orderkey, o_totalprice FROM {orders} WHERE o_totalprice >= 300000 AND o_orderstatus = 'F'",
        orders=table(spark, d, "orders"),
    )


@query(
    "src_view_bridge",
    "c_mktsegment:s n:i balance:f2",
    """SELECT c_mktsegment, count(*) AS n, sum(c_acctbal) AS balance FROM customer
       WHERE c_acctbal > 0 GROUP BY 1""",
)
def src_view_bridge(spark, d):
    positive = table(spark, d, "customer").filter("c_acctbal > 0")
    return spark.sql(
        "SELECT c_mktsegment, count(*) AS n, sum(c_acctbal) AS balance FROM {positive} GROUP BY c_mktsegment",
        positive=positive,
    )


@query(
    "src_binary_files",
    "label:s bytes:i",
    """SELECT CASE WHEN length(html) >= 1000 THEN 'long' ELSE 'short' END AS label, sum(strlen(html) + 1) AS bytes
       FROM pages WHERE html IS NOT NULL GROUP BY 1""",
)
def src_binary_files(spark, d):
    """Pages written to one folder for each label and read back as binary files; the bytes of
    a label are the same however many files it was written to."""
    pages = table(spark, d, "pages").filter("html IS NOT NULL")
    label = F.when(F.length("html") >= 1000, "long").otherwise("short")
    path = scratch_path(spark, "labelled")
    pages.select(F.col("html").alias("value"), label.alias("label")).write.partitionBy("label").text(path)
    files = io.labelled_files(spark, path, "*.txt")
    return files.groupBy(F.regexp_replace("label", "^label=", "").alias("label")).agg(
        F.sum(F.length("content")).alias("bytes")
    )


_NARRATIVE_SQL = r"""trim(regexp_replace(replace(text, '"', ''), '\n+', ' ', 'g'))"""


@query(
    "src_text_reports",
    "narrative:s n:i",
    f"""SELECT narrative, count(*) AS n FROM (SELECT {_NARRATIVE_SQL} AS narrative FROM conversations)
        WHERE narrative <> '' GROUP BY 1""",
)
def src_text_reports(spark, d):
    path = io.write_narratives(table(spark, d, "conversations"), "text", scratch_path(spark, "reports"))
    return io.read_narratives(spark, path).groupBy("narrative").agg(F.count("*").alias("n"))


@query(
    "fn_base64",
    "doc_id:i encoded_md5:s encoded_length:i same:b",
    """SELECT doc_id, md5(to_base64(encode(text))) AS encoded_md5,
       length(to_base64(encode(text))) AS encoded_length, true AS same FROM documents""",
)
def fn_base64(spark, d):
    # Spark folds base64 text at 76 characters unless told otherwise.
    docs = table(spark, d, "documents").withColumn(
        "b64", F.regexp_replace(F.base64(F.encode("text", "UTF-8")), r"\s", "")
    )
    return docs.select(
        "doc_id",
        F.md5("b64").alias("encoded_md5"),
        F.length("b64").alias("encoded_length"),
        (F.decode(F.unbase64("b64"), "UTF-8") == F.col("text")).alias("same"),
    )


@query(
    "filter_cmp",
    "o_orderkey:i o_totalprice:f2",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 50000",
)
def filter_cmp(spark, d):
    return table(spark, d, "orders").filter("o_totalprice < 50000").select("o_orderkey", "o_totalprice")


@query(
    "filter_notnull",
    "doc_id:i quality:i",
    """SELECT d.doc_id, quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE quality IS NOT NULL""",
)
def filter_notnull(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.filter(F.col("quality").isNotNull())


@query(
    "filter_lt_or_missing",
    "doc_id:i",
    """SELECT d.doc_id FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE quality IS NULL OR quality < 1""",
)
def filter_lt_or_missing(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return joined.filter(lt_or_missing("quality", 1))


@query(
    "filter_partition",
    "segment:s n:i events:i",
    f"""WITH {SCORED} SELECT segment, count(*) AS n, sum(event) AS events FROM scored
        WHERE part = 1 GROUP BY 1""",
)
def filter_partition(spark, d):
    train = scored(spark, d).filter("part = 1")
    return train.groupBy("segment").agg(F.count("*").alias("n"), F.sum("event").alias("events"))


@query(
    "filter_date",
    "l_orderkey:i l_linenumber:i l_shipdate:d n:i",
    """SELECT l_orderkey, l_linenumber, CAST(l_shipdate AS DATE) AS l_shipdate, count(*) AS n
       FROM lineitem WHERE l_shipdate >= DATE '2001-06-01' GROUP BY 1, 2, 3""",
)
def filter_date(spark, d):
    return (
        table(spark, d, "lineitem")
        .filter(F.col("l_shipdate") >= F.lit("2001-06-01").cast("date"))
        .groupBy("l_orderkey", "l_linenumber", F.to_date("l_shipdate").alias("l_shipdate"))
        .agg(F.count("*").alias("n"))
    )


@query(
    "project_keep_drop",
    "p_partkey:i p_brand:s p_size:i",
    "SELECT p_partkey, p_brand, p_size FROM part WHERE p_brand IN ('Brand#1', 'Brand#2', 'Brand#3')",
)
def project_keep_drop(spark, d):
    part = rel.select_without(table(spark, d, "part"), ["p_name", "p_type", "p_retailprice"])
    return part.filter(F.col("p_brand").isin("Brand#1", "Brand#2", "Brand#3"))


@query(
    "project_labels",
    "column_name:s column_label:s filled:i",
    """SELECT 'amount' AS column_name, 'order value' AS column_label, count(amount) AS filled FROM
       (SELECT o_totalprice AS amount FROM orders) UNION ALL
       SELECT 'account_id', 'unique identifier', count(o_orderkey) FROM orders""",
)
def project_labels(spark, d):
    named = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("account_id"), F.col("o_totalprice").alias("amount")
    )
    labelled = rel.with_labels(named, {"account_id": "unique identifier", "amount": "order value"})
    labels = rel.column_labels(labelled)
    filled = labelled.agg(*[F.count(c).alias(c) for c in labelled.columns])
    long = filled.unpivot([], labelled.columns, "column_name", "filled")
    label = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    return long.withColumn("column_label", label[F.col("column_name")])


@query(
    "query_step",
    "o_orderpriority:s n:i total:f2",
    """SELECT o_orderpriority, count(*) AS n, sum(o_totalprice) AS total FROM orders
       WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING count(*) > 1 ORDER BY total DESC LIMIT 3""",
)
def query_step(spark, d):
    return rel.query_step(
        table(spark, d, "orders"),
        {
            "where": "o_orderstatus <> 'P'",
            "group_by": ["o_orderpriority"],
            "aggregates": {"n": ("count", "*"), "total": ("sum", "o_totalprice")},
            "having": "n > 1",
            "order_by": [("total", False)],
            "limit": 3,
        },
    )


@query(
    "project_computed",
    "o_orderkey:i variable:s thousands:f6",
    "SELECT o_orderkey, 'amount' AS variable, o_totalprice / 1000 AS thousands FROM orders",
)
def project_computed(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", F.lit("amount").alias("variable"), (F.col("o_totalprice") / 1000).alias("thousands")
    )


@query(
    "project_rename",
    "supplier_id:i supplier:s balance:f2",
    "SELECT s_suppkey AS supplier_id, s_name AS supplier, s_acctbal AS balance FROM supplier",
)
def project_rename(spark, d):
    names = {"s_suppkey": "supplier_id", "s_name": "supplier", "s_acctbal": "balance"}
    return table(spark, d, "supplier").withColumnsRenamed(names).drop("s_nationkey")


@query(
    "project_clean_names",
    "orderkey:i price_usd_:f2",
    "SELECT o_orderkey AS orderkey, o_totalprice AS price_usd_ FROM orders",
)
def project_clean_names(spark, d):
    raw = table(spark, d, "orders").select(
        F.col("o_orderkey").alias("order key"), F.col("o_totalprice").alias("price (usd)")
    )
    return rel.clean_names(raw)


@query(
    "project_cast",
    "p_partkey:i price:i size:s brand_no:i type_no:i",
    """SELECT p_partkey, CAST(trunc(p_retailprice) AS BIGINT) AS price, CAST(p_size AS VARCHAR) AS size,
       TRY_CAST(replace(p_brand, 'Brand#', '') AS BIGINT) AS brand_no, TRY_CAST(p_type AS BIGINT) AS type_no
       FROM part""",
)
def project_cast(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        F.col("p_retailprice").cast("bigint").alias("price"),
        F.col("p_size").cast("string").alias("size"),
        F.replace("p_brand", F.lit("Brand#"), F.lit("")).try_cast("bigint").alias("brand_no"),
        F.col("p_type").try_cast("bigint").alias("type_no"),
    )


@query(
    "delete_where",
    "doc_id:i toxic:i",
    """SELECT d.doc_id, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
       WHERE NOT coalesce(toxic <> 1, false)""",
)
def delete_where(spark, d):
    joined = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    return rel.delete_where(joined, F.col("toxic") != 1).select("doc_id", "toxic")


@query(
    "union_force",
    "name:s nation:i balance:f2",
    """SELECT c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer
       UNION ALL SELECT s_name, NULL, s_acctbal FROM supplier""",
)
def union_force(spark, d):
    customers = table(spark, d, "customer").selectExpr(
        "c_name AS name", "c_nationkey AS nation", "c_acctbal AS balance"
    )
    suppliers = table(spark, d, "supplier").selectExpr(
        "s_acctbal AS balance", "s_name AS name", "s_suppkey AS extra"
    )
    return rel.append_force(customers, suppliers)


@query(
    "union_many",
    "kind:s id:i",
    """SELECT 'customer' AS kind, c_custkey AS id FROM customer UNION ALL
       SELECT 'supplier', s_suppkey FROM supplier UNION ALL SELECT 'part', p_partkey FROM part""",
)
def union_many(spark, d):
    keys = {"customer": "c_custkey", "supplier": "s_suppkey", "part": "p_partkey"}
    return rel.stack_all(
        [table(spark, d, t).select(F.lit(t).alias("kind"), F.col(k).alias("id")) for t, k in keys.items()]
    )


_TYPES = ["click", "error", "purchase", "signup", "view"]


@query(
    "pivot_id",
    "user_id:i *:f2",
    "SELECT user_id, "
    + ", ".join(f"sum(value) FILTER (event_type = '{t}') AS {t}" for t in _TYPES)
    + " FROM events GROUP BY 1",
    sql_cols="user_id:i " + " ".join(f"{t}:f2" for t in _TYPES),
)
def pivot_id(spark, d):
    """A column for each event type that the table holds."""
    totals = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("v"))
    return rel.long_to_wide(totals, "user_id", "event_type", "v")


@query(
    "pivot_map",
    "user_id:i n_types:i event_type:s value:f2",
    """SELECT user_id, count(*) OVER (PARTITION BY user_id) AS n_types, event_type, sum(value) AS value
       FROM events WHERE event_type IS NOT NULL GROUP BY user_id, event_type""",
)
def pivot_map(spark, d):
    """All levels of a user in one row, as a map, and taken apart again."""
    totals = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.sum("value").alias("v"))
    wide = rel.long_to_map(totals, "user_id", "event_type", "v").withColumn("n_types", F.size("levels"))
    return rel.map_to_long(wide, ["user_id", "n_types"], name="event_type")


@query(
    "unpivot_cols",
    "p_partkey:i variable:s value:f2",
    """SELECT p_partkey, 'p_size' AS variable, CAST(p_size AS DOUBLE) AS value FROM part UNION ALL
       SELECT p_partkey, 'p_retailprice', p_retailprice FROM part""",
)
def unpivot_cols(spark, d):
    return rel.wide_to_long(table(spark, d, "part"), ["p_partkey"], ["p_size", "p_retailprice"])


@query("distinct_levels", "p_type:s", "SELECT DISTINCT p_type FROM part ORDER BY 1")
def distinct_levels(spark, d):
    return rel.levels(table(spark, d, "part"), "p_type")


@query(
    "json_flatten",
    "event_id:i pos:i k:i data:s",
    """SELECT event_id, pos, CASE pos WHEN 0 THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k,
       CASE pos WHEN 0 THEN event_type ELSE CAST(user_id AS VARCHAR) END AS data
       FROM events, (VALUES (0), (1)) AS t(pos)""",
)
def json_flatten(spark, d):
    """Each event carries a two-record JSON list; records become rows, fields columns."""
    listed = table(spark, d, "events").select(
        "event_id",
        F.format_string(
            '[{"metadata": %s, "data": "%s"}, {"data": "%d"}]', "props", "event_type", "user_id"
        ).alias("concepts"),
    )
    schema = "array<struct<metadata:struct<k:bigint>,data:string>>"
    rows = rel.explode_records(listed, "concepts", schema, ["event_id"])
    return rows.select("event_id", "pos", "metadata.k", "data")


@query(
    "json_name_value",
    "event_id:i event_type:s k:s missing:s",
    """SELECT event_id, event_type, json_extract_string(props, '$.k') AS k, CAST(NULL AS VARCHAR) AS missing
       FROM events""",
)
def json_name_value(spark, d):
    packed = (
        table(spark, d, "events")
        .withColumn("k", F.get_json_object("props", "$.k"))
        .select("event_id", rel.columns_to_name_value(["event_type", "k"]).alias("outputs"))
    )
    return rel.name_value_to_columns(packed, "outputs", ["event_type", "k", "missing"], ["event_id"])


@query(
    "json_pack",
    "c_custkey:i inputs:s",
    """SELECT c_custkey, '[{"name":"c_name","value":"' || c_name || '"},{"name":"c_nationkey","value":"' ||
       c_nationkey || '"},{"name":"c_mktsegment","value":"' || c_mktsegment || '"}]' AS inputs FROM customer""",
)
def json_pack(spark, d):
    payload = rel.columns_to_name_value(["c_name", "c_nationkey", "c_mktsegment"])
    return table(spark, d, "customer").select("c_custkey", payload.alias("inputs"))


@query(
    "score_keep_cols",
    "account_id:i event:i segment:s p_event1:f6 p_event0:f6",
    f"WITH {SCORED} SELECT account_id, event, segment, p AS p_event1, 1 - p AS p_event0 FROM scored",
)
def score_keep_cols(spark, d):
    """Scores beside actuals and group columns, without a join: scored in place."""
    return scored(spark, d).select(
        "account_id", "event", "segment", F.col("p").alias("p_event1"), (1 - F.col("p")).alias("p_event0")
    )


@query(
    "join_prep",
    "r_name:s segment:s n:i amount:f2",
    f"""WITH {LOANS} SELECT r_name, segment, count(*) AS n, sum(amount) AS amount
        FROM loans JOIN region ON region = r_regionkey GROUP BY 1, 2""",
)
def join_prep(spark, d):
    """Aggregate on the key first, then name the few groups."""
    grouped = loans(spark, d).groupBy("region", "segment").agg(
        F.count("*").alias("n"), F.sum("amount").alias("amount")
    )
    return grouped.join(table(spark, d, "region"), F.col("region") == F.col("r_regionkey"))


@query(
    "join_semi_sample",
    "l_orderkey:i l_linenumber:i l_quantity:f2",
    f"""SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN
        (SELECT o_orderkey FROM orders ORDER BY {uniform_sql('o_orderkey', 7)}, o_orderkey LIMIT 50)""",
)
def join_semi_sample(spark, d):
    sample = simple_random_sample(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 50, seed=7)
    # 50 keys by construction: small enough to broadcast at any table size.
    return table(spark, d, "lineitem").join(
        F.broadcast(sample), F.col("l_orderkey") == F.col("o_orderkey"), "left_semi"
    )


@query(
    "entity_match",
    "c_custkey:i cluster_id:s",
    "SELECT c_custkey, md5(concat_ws('|', c_nationkey, c_mktsegment)) AS cluster_id FROM customer",
)
def entity_match(spark, d):
    key = matching.cluster_key(["c_nationkey", "c_mktsegment"])
    return table(spark, d, "customer").select("c_custkey", key.alias("cluster_id"))


@query(
    "entity_match_multi",
    "c_custkey:i cluster_id:i",
    """WITH RECURSIVE r AS (
         SELECT c_custkey AS id, 'a' || c_nationkey || '|' || CAST(floor(c_acctbal / 20) AS BIGINT) AS node
         FROM customer UNION ALL
         SELECT c_custkey, 'b' || c_mktsegment || '|' || CAST(floor(c_acctbal / 2) AS BIGINT) FROM customer),
       star AS (SELECT id, min(id) OVER (PARTITION BY node) AS hub FROM r),
       edges AS (SELECT id AS a, hub AS b FROM star WHERE id <> hub
                 UNION SELECT hub, id FROM star WHERE id <> hub),
       reach(id, other) AS (
         SELECT c_custkey, c_custkey FROM customer
         UNION SELECT reach.id, edges.b FROM reach JOIN edges ON reach.other = edges.a)
       SELECT id AS c_custkey, min(other) AS cluster_id FROM reach GROUP BY 1""",
)
def entity_match_multi(spark, d):
    """Same nation and close balance, or same segment and closer balance; transitive."""
    customers = table(spark, d, "customer").withColumns(
        {"b20": F.floor(F.col("c_acctbal") / 20), "b2": F.floor(F.col("c_acctbal") / 2)}
    )
    rules = [["c_nationkey", "b20"], ["c_mktsegment", "b2"]]
    return matching.resolve_entities(customers, "c_custkey", rules)


@query(
    "fuzzy_join",
    "c_custkey:i s_name:s distance:i",
    """SELECT c_custkey, s_name, levenshtein(lower(replace(c_name, 'Customer', 'Party')),
         lower(replace(s_name, 'Supplier', 'Party'))) AS distance
       FROM customer, supplier WHERE levenshtein(lower(replace(c_name, 'Customer', 'Party')),
         lower(replace(s_name, 'Supplier', 'Party'))) <= 2""",
)
def fuzzy_join(spark, d):
    customers = table(spark, d, "customer").select(
        "c_custkey", F.replace("c_name", F.lit("Customer"), F.lit("Party")).alias("party")
    )
    suppliers = table(spark, d, "supplier").select(
        "s_name", F.replace("s_name", F.lit("Supplier"), F.lit("Party")).alias("known")
    )
    near = matching.fuzzy_join(customers, "party", suppliers, "known", k=2)
    return near.join(suppliers, "known").select("c_custkey", "s_name", "distance")
