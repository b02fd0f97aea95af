"""Queries on scalar functions and feature preparation."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions import scalar as fn
from tallyfold.operators import prep, selection
from tallyfold.operators.flow import prepare
from tallyfold.plans.registry import query
from tallyfold.plans.stats_queries import _ranked_sql, normal_cdf_sql
from tallyfold.plans.views import (
    COEFS,
    FEATURES,
    INTERCEPT,
    LOANS,
    XBETA_SQL,
    loans,
    table,
    uniform_sql,
)
from tallyfold.session import cut_lineage


@query(
    "fn_math",
    "o_orderkey:i log_price:f6 root:f6 rounded:f0 square:f4 growth:f6 distance:f4",
    """SELECT o_orderkey, ln(o_totalprice) AS log_price, sqrt(o_totalprice) AS root,
       round(o_totalprice / 1000) AS rounded, power(o_totalprice / 1000, 2) AS square,
       exp(o_totalprice / 1000000) AS growth, abs(o_totalprice - 250000) AS distance FROM orders""",
)
def fn_math(spark, d):
    x = F.col("o_totalprice")
    return table(spark, d, "orders").select(
        "o_orderkey",
        F.ln(x).alias("log_price"),
        F.sqrt(x).alias("root"),
        F.round(x / 1000, 0).alias("rounded"),
        F.pow(x / 1000, 2).alias("square"),
        F.exp(x / 1000000).alias("growth"),
        F.abs(x - 250000).alias("distance"),
    )


@query(
    "fn_normcdf",
    "c_custkey:i prob:f6",
    f"SELECT c_custkey, {normal_cdf_sql('((c_acctbal - 4500) / 3000)')} AS prob FROM customer",
)
def fn_normcdf(spark, d):
    z = (F.col("c_acctbal") - 4500) / 3000
    return table(spark, d, "customer").select("c_custkey", fn.normal_cdf(z).alias("prob"))


@query(
    "fn_logistic",
    "c_custkey:i prob:f6 extreme:f6",
    """SELECT c_custkey, 1 / (1 + exp(-(c_acctbal - 4500) / 3000)) AS prob,
       CASE WHEN c_acctbal > 4500 THEN 1 WHEN c_acctbal = 4500 THEN 0.5 ELSE 0 END AS extreme FROM customer""",
)
def fn_logistic(spark, d):
    z = (F.col("c_acctbal") - 4500) / 3000
    return table(spark, d, "customer").select(
        "c_custkey", fn.logistic(z).alias("prob"), fn.logistic(z * 1e9).alias("extreme")
    )


@query(
    "fn_anymissing",
    "doc_id:i missing:b",
    """SELECT d.doc_id, quality IS NULL OR toxic IS NULL OR n_chars IS NULL AS missing
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
)
def fn_anymissing(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    joined = docs.join(table(spark, d, "labels"), "doc_id", "left")
    return joined.select("doc_id", fn.any_missing(["quality", "toxic", "n_chars"]).alias("missing"))


@query(
    "fn_case",
    "o_orderkey:i band:s",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 100000 THEN 'small' WHEN o_totalprice < 300000 THEN 'medium'
       ELSE 'large' END AS band FROM orders""",
)
def fn_case(spark, d):
    x = F.col("o_totalprice")
    band = F.when(x < 100000, "small").when(x < 300000, "medium").otherwise("large")
    return table(spark, d, "orders").select("o_orderkey", band.alias("band"))


@query(
    "fn_complev",
    "p_partkey:i distance:i",
    """SELECT p_partkey, levenshtein(lower(ltrim(replace('  "' || upper(p_name) || '"', '"', ''))),
       lower(ltrim(replace(' ''Small'' ring', '''', '')))) AS distance FROM part""",
)
def fn_complev(spark, d):
    shouted = F.concat(F.lit('  "'), F.upper("p_name"), F.lit('"'))
    return table(spark, d, "part").select(
        "p_partkey", fn.edit_distance(shouted, F.lit(" 'Small' ring")).alias("distance")
    )


@query(
    "fn_string",
    "p_partkey:i code:s padded:s shouted:s",
    """SELECT p_partkey, 'variable_' || replace(p_brand, '#', '_') AS code, rpad(p_type, 12, '.') AS padded,
       upper(p_name) AS shouted FROM part""",
)
def fn_string(spark, d):
    return table(spark, d, "part").select(
        "p_partkey",
        F.concat(F.lit("variable_"), F.replace("p_brand", F.lit("#"), F.lit("_"))).alias("code"),
        F.rpad("p_type", 12, ".").alias("padded"),
        F.upper("p_name").alias("shouted"),
    )


@query(
    "fn_format",
    "s_suppkey:i balance:s share:s",
    """SELECT s_suppkey, '$' || format('{:,.2f}', s_acctbal) AS balance,
       format('{:,.2f}', s_acctbal / 10000 * 100) || '%' AS share FROM supplier""",
)
def fn_format(spark, d):
    return table(spark, d, "supplier").select(
        "s_suppkey",
        fn.money("s_acctbal").alias("balance"),
        fn.percent(F.col("s_acctbal") / 10000).alias("share"),
    )


@query(
    "fn_hash_uniform",
    "o_orderkey:i u:f9",
    f"SELECT o_orderkey, {uniform_sql('o_orderkey', 42)} AS u FROM orders",
)
def fn_hash_uniform(spark, d):
    return table(spark, d, "orders").select("o_orderkey", fn.hash_uniform("o_orderkey", 42).alias("u"))


@query(
    "fn_json",
    "event_id:i k:i rebuilt:s",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       '{"type":"' || event_type || '","k":' || json_extract_string(props, '$.k') || '}' AS rebuilt FROM events""",
)
def fn_json(spark, d):
    parsed = F.from_json("props", "k bigint")["k"]
    return table(spark, d, "events").select(
        "event_id",
        parsed.alias("k"),
        F.to_json(F.struct(F.col("event_type").alias("type"), parsed.alias("k"))).alias("rebuilt"),
    )


@query(
    "fn_linpred",
    "account_id:i xbeta:f10 odds:f9",
    f"WITH {LOANS} SELECT account_id, {XBETA_SQL} AS xbeta, exp({XBETA_SQL}) AS odds FROM loans",
)
def fn_linpred(spark, d):
    xbeta = fn.linear_predictor(COEFS, INTERCEPT)
    return loans(spark, d).select("account_id", xbeta.alias("xbeta"), F.exp(xbeta).alias("odds"))


@query(
    "fn_dates",
    "o_orderkey:i parsed:d month:d quarter:d next_quarter:d",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS parsed, date_trunc('month', o_orderdate) AS month,
       date_trunc('quarter', o_orderdate) AS quarter,
       date_trunc('month', o_orderdate) + INTERVAL 3 MONTH AS next_quarter FROM orders""",
)
def fn_dates(spark, d):
    day = F.to_date(F.date_format("o_orderdate", "M/d/yyyy"), "M/d/yyyy")
    return table(spark, d, "orders").select(
        "o_orderkey",
        day.alias("parsed"),
        F.trunc(day, "month").alias("month"),
        F.trunc(day, "quarter").alias("quarter"),
        F.add_months(F.trunc(day, "month"), 3).alias("next_quarter"),
    )


@query(
    "fn_first_nonnull",
    "source:s quality:i",
    """SELECT source, arg_min(quality, d.doc_id) FILTER (quality IS NOT NULL) AS quality
       FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY 1""",
)
def fn_first_nonnull(spark, d):
    """First value in key order; min_by keeps one candidate per task, unlike an ordered window."""
    docs = table(spark, d, "documents").select("doc_id", "source")
    joined = docs.join(table(spark, d, "labels"), "doc_id", "left")
    key = F.when(F.col("quality").isNotNull(), F.col("doc_id"))
    return joined.groupBy("source").agg(F.min_by("quality", key).alias("quality"))


_Z = ["amount", "net_worth", "qty"]
_MOMENTS = ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _Z)
_SCALED = ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in _Z)


@query(
    "prep_standardize",
    "account_id:i amount:f6 net_worth:f6 qty:f6",
    f"WITH {LOANS}, m AS (SELECT {_MOMENTS} FROM loans) SELECT account_id, {_SCALED} FROM loans, m",
)
def prep_standardize(spark, d):
    return prep.standardize(loans(spark, d).select("account_id", *_Z), _Z)


@query(
    "prep_standardize_orig",
    "account_id:i amount:f6 net_worth:f6 qty:f6 orig_amount:f2 orig_net_worth:f2 orig_qty:f2",
    f"""WITH {LOANS}, m AS (SELECT {_MOMENTS} FROM loans) SELECT account_id, {_SCALED},
        amount AS orig_amount, net_worth AS orig_net_worth, qty AS orig_qty FROM loans, m""",
)
def prep_standardize_orig(spark, d):
    return prep.standardize(loans(spark, d).select("account_id", *_Z), _Z, keep_prefix="orig_")


REGION_CODES = {0: "region_africa", 1: "region_america", 2: "region_asia", 3: "region_europe"}
_DUMMY_SQL = ", ".join(f"CAST(region = {c} AS INT) AS {n}" for c, n in REGION_CODES.items())


@query(
    "prep_dummies",
    "account_id:i " + " ".join(f"{n}:i" for n in REGION_CODES.values()),
    f"WITH {LOANS} SELECT account_id, {_DUMMY_SQL} FROM loans",
)
def prep_dummies(spark, d):
    return prep.dummies(loans(spark, d).select("account_id", "region"), "region", REGION_CODES)


_PTYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@query(
    "prep_onehot",
    "p_partkey:i " + " ".join(f"p_type_{t}:i" for t in _PTYPES),
    "SELECT p_partkey, "
    + ", ".join(f"CAST(p_type = '{t}' AS INT) AS p_type_{t}" for t in _PTYPES)
    + " FROM part",
)
def prep_onehot(spark, d):
    return prep.one_hot(table(spark, d, "part").select("p_partkey", "p_type"), ["p_type"])


def _bin_case_sql(c: str, edges: list[str]) -> str:
    return "(" + " + ".join(f"CAST({c} > {e} AS INT)" for e in edges) + ")"


_FIFTHS = [f"q[{i}]" for i in (1, 2, 3, 4)]


@query(
    "prep_quantile_bin",
    "account_id:i amount_bin:i qty_bin:i",
    f"""WITH {LOANS}, e AS (SELECT quantile_cont(CAST(amount AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS q,
          list_distinct(quantile_cont(CAST(qty AS DOUBLE), [0.2, 0.4, 0.6, 0.8])) AS r FROM loans)
        SELECT account_id, {_bin_case_sql('amount', _FIFTHS)} AS amount_bin,
          len(list_filter(r, lambda x: x < qty)) AS qty_bin FROM loans, e""",
)
def prep_quantile_bin(spark, d):
    rows = loans(spark, d).select("account_id", "amount", "qty")
    return prep.apply_bins(rows, prep.quantile_edges(rows, ["amount", "qty"], 5))


@query(
    "prep_log_scale",
    "account_id:i amount:f6",
    f"""WITH {LOANS}, l AS (SELECT account_id, ln(amount) AS x FROM loans)
        SELECT account_id, (x - (SELECT avg(x) FROM l)) / (SELECT stddev_pop(x) FROM l) AS amount FROM l""",
)
def prep_log_scale(spark, d):
    return prep.log_scale(loans(spark, d).select("account_id", "amount"), ["amount"])


@query(
    "prep_impute",
    "doc_id:i quality:i toxic:f6 n_chars:f6",
    """WITH j AS (SELECT d.doc_id, quality, CAST(toxic AS DOUBLE) AS toxic,
         CASE WHEN quality IS NOT NULL THEN n_chars END AS n_chars
         FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
       SELECT doc_id, coalesce(quality, (SELECT quality FROM j WHERE quality IS NOT NULL GROUP BY 1
           ORDER BY count(*) DESC, quality LIMIT 1)) AS quality,
         coalesce(toxic, (SELECT avg(toxic) FROM j)) AS toxic,
         coalesce(n_chars, (SELECT quantile_disc(n_chars, 0.5) FROM j)) AS n_chars FROM j""",
)
def prep_impute(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    joined = docs.join(table(spark, d, "labels"), "doc_id", "left")
    holes = joined.withColumn("n_chars", F.when(F.col("quality").isNotNull(), F.col("n_chars")))
    return prep.impute(holes, {"quality": "most_frequent", "toxic": "mean", "n_chars": "median"})


@query(
    "prep_poly2",
    "account_id:i n_lines:f6 avg_disc:f6 n_lines_x_n_lines:f6 n_lines_x_avg_disc:f6 avg_disc_x_avg_disc:f6",
    f"""WITH {LOANS} SELECT account_id, n_lines, avg_disc, n_lines * n_lines AS n_lines_x_n_lines,
        n_lines * avg_disc AS n_lines_x_avg_disc, avg_disc * avg_disc AS avg_disc_x_avg_disc FROM loans""",
)
def prep_poly2(spark, d):
    rows = loans(spark, d).select("account_id", "n_lines", "avg_disc")
    return prep.poly2(rows, ["n_lines", "avg_disc"])


_STATES = ["F", "O", "P"]


@query(
    "prep_column_spec",
    "account_id:i net_worth:f2 " + " ".join(f"status_{s}:i" for s in _STATES) + " amount_bin:i amount_log:f6 qty_std:f6",
    f"""WITH {LOANS}, e AS (SELECT quantile_cont(CAST(amount AS DOUBLE), [0.2, 0.4, 0.6, 0.8]) AS q,
          avg(ln(amount)) AS lm, stddev_pop(ln(amount)) AS ls, avg(qty) AS qm, stddev_samp(qty) AS qs FROM loans)
        SELECT account_id, net_worth, """
    + ", ".join(f"CAST(status = '{s}' AS INT) AS status_{s}" for s in _STATES)
    + f""", {_bin_case_sql('amount', _FIFTHS)} AS amount_bin,
        (ln(amount) - lm) / ls AS amount_log, (qty - qm) / qs AS qty_std FROM loans, e""",
)
def prep_column_spec(spark, d):
    return prep.column_spec(
        loans(spark, d),
        ["account_id"],
        [
            ("pass", ["net_worth"]),
            ("one_hot", ["status"]),
            ("quantile_bin", ["amount"]),
            ("log_scale", ["amount"]),
            ("standardize", ["qty"]),
        ],
    )


_WOE_IN = ["n_lines", "qty", "amount"]
_SEVENTHS = "[" + ", ".join(f"{i}/7.0::DOUBLE" for i in range(1, 7)) + "]"
WOE_CTE = f"""{LOANS}, e AS (SELECT {', '.join(
    f"list_distinct(quantile_disc({c}, {_SEVENTHS})) AS e_{c}" for c in _WOE_IN)} FROM loans),
 binned AS (SELECT loans.*, {', '.join(
    f"len(list_filter(e_{c}, lambda x: x < {c})) AS b_{c}" for c in _WOE_IN)} FROM loans, e),
 cells AS ({' UNION ALL '.join(
    f"SELECT '{c}' AS variable, b_{c} AS bin, sum(event) AS events, sum(1 - event) AS nonevents FROM binned GROUP BY 2"
    for c in _WOE_IN)}),
 shares AS (SELECT *, (nonevents + 0.5::DOUBLE) / sum(nonevents) OVER (PARTITION BY variable) AS good,
   (events + 0.5::DOUBLE) / sum(events) OVER (PARTITION BY variable) AS bad FROM cells),
 woe AS (SELECT *, ln(good / bad) AS woe, (good - bad) * ln(good / bad) AS iv FROM shares)"""


@query(
    "prep_woe",
    "account_id:i segment:s " + " ".join(f"woe_{c}:f6" for c in _WOE_IN),
    f"WITH {WOE_CTE} SELECT account_id, segment, "
    + ", ".join(f"w_{c}.woe AS woe_{c}" for c in _WOE_IN)
    + " FROM binned "
    + " ".join(f"JOIN woe w_{c} ON w_{c}.variable = '{c}' AND w_{c}.bin = b_{c}" for c in _WOE_IN),
)
def prep_woe(spark, d):
    rows = loans(spark, d).select("account_id", "segment", "event", *_WOE_IN)
    return prep.woe_transform(rows, _WOE_IN, "event", 1)


@query(
    "prep_iv",
    "variable:s bins:i iv:f6",
    f"WITH {WOE_CTE} SELECT variable, count(*) AS bins, sum(iv) AS iv FROM woe GROUP BY 1",
)
def prep_iv(spark, d):
    rows = cut_lineage(loans(spark, d).select("event", *_WOE_IN))
    cells = prep.woe_table(rows, prep.woe_edges(rows, _WOE_IN, stored=True), "event", 1)
    return cells.groupBy("variable").agg(F.count("*").alias("bins"), F.sum("iv").alias("iv"))


@query(
    "flow_prep",
    "period:i account_id:i amount:f6 orig_amount:f2 analytic_partition:i region_asia:i",
    f"""WITH {LOANS}, p AS (SELECT *, quarter(opened) AS period FROM loans),
        m AS (SELECT period, avg(amount) AS am, stddev_samp(amount) AS asd FROM p GROUP BY 1),
        s AS ({_ranked_sql('p', 'account_id', 10, 'period')})
        SELECT period, account_id, (amount - am) / asd AS amount, amount AS orig_amount,
          CASE WHEN rnk <= round(total * 0.6) THEN 1 WHEN rnk <= round(total * 0.6) + round(total * 0.3) THEN 0
          ELSE 2 END AS analytic_partition, CAST(region = 2 AS INT) AS region_asia FROM s JOIN m USING (period)""",
)
def flow_prep(spark, d):
    rows = loans(spark, d).withColumn("period", F.quarter("opened"))
    return prepare(
        rows, key="account_id", scale=["amount"], dummies={"region": REGION_CODES}, seed=10, period="period"
    ).select("period", "account_id", "amount", "orig_amount", "analytic_partition", "region_asia")


# Dictionary labels as the data owner writes them.
DICTIONARY = {
    "marital_status": "Single:0, Married:1, Divorced:2",
    "region": "California:0, New York:1, Florida:2, Texas:3, NE:4, South:5, MidWest:6: West:7",
}


@query(
    "prep_decode",
    "c_custkey:i region_char:s marital_char:s",
    """SELECT c_custkey, CASE c_nationkey % 9 WHEN 0 THEN 'California' WHEN 1 THEN 'New York' WHEN 2 THEN 'Florida'
       WHEN 3 THEN 'Texas' WHEN 4 THEN 'NE' WHEN 5 THEN 'South' WHEN 6 THEN 'MidWest' WHEN 7 THEN 'West' END
       AS region_char, CASE c_nationkey % 4 WHEN 0 THEN 'Single' WHEN 1 THEN 'Married' WHEN 2 THEN 'Divorced' END
       AS marital_char FROM customer""",
)
def prep_decode(spark, d):
    coded = table(spark, d, "customer").selectExpr("c_custkey", "c_nationkey % 9 AS r", "c_nationkey % 4 AS m")
    named = prep.decode(coded, "r", DICTIONARY["region"], "region_char")
    return prep.decode(named, "m", DICTIONARY["marital_status"], "marital_char")


_SU = ["n_lines", "qty", "amount", "net_worth"]
_TENTHS = "[" + ", ".join(f"{i}/10.0::DOUBLE" for i in range(1, 10)) + "]"


@query(
    "select_su",
    "variable:s su:f6",
    f"""WITH {LOANS}, e AS (SELECT {', '.join(f"list_distinct(quantile_disc({c}, {_TENTHS})) AS e_{c}" for c in _SU)}
          FROM loans),
        j AS ({' UNION ALL '.join(
          f"SELECT '{c}' AS variable, len(list_filter(e_{c}, lambda x: x < {c})) AS bin, event AS y, count(*) AS n "
          f"FROM loans, e GROUP BY 2, 3" for c in _SU)}),
        hx AS (SELECT variable, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS h FROM
          (SELECT variable, bin, sum(n) AS n FROM j GROUP BY 1, 2) GROUP BY 1),
        hy AS (SELECT variable, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS h FROM
          (SELECT variable, y, sum(n) AS n FROM j GROUP BY 1, 2) GROUP BY 1),
        hxy AS (SELECT variable, ln(sum(n)) - sum(n * ln(n)) / sum(n) AS h FROM j GROUP BY 1)
        SELECT variable, 2 * (hx.h + hy.h - hxy.h) / (hx.h + hy.h) AS su
        FROM hx JOIN hy USING (variable) JOIN hxy USING (variable)""",
)
def select_su(spark, d):
    return selection.symmetric_uncertainty(loans(spark, d).select("event", *_SU), _SU, "event")
