"""Queries on scoring and decisions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F

from tallyfold.functions import scalar as fn
from tallyfold.operators import rules, scoring
from tallyfold.plans.registry import query
from tallyfold.plans.stats_queries import normal_cdf_sql
from tallyfold.plans.views import COEFS, FEATURES, INTERCEPT, LOANS, SCORED, XBETA_SQL, loans, scored, table
from tallyfold.session import cut_lineage

_HOLED = f"""{LOANS}, h AS (SELECT * REPLACE (CASE WHEN status <> 'P' THEN net_worth END AS net_worth) FROM loans),
 s AS (SELECT account_id, 1 / (1 + exp(-{XBETA_SQL})) AS p FROM h)"""


@query(
    "score_logit_expr",
    "account_id:i P_event1:f6 P_event0:f6 I_event:s",
    f"""WITH {_HOLED} SELECT account_id, p AS "P_event1", 1 - p AS "P_event0",
        CASE WHEN p IS NULL THEN '' WHEN p >= 0.5 THEN '1' ELSE '0' END AS "I_event" FROM s""",
)
def score_logit_expr(spark, d):
    """Coefficients as score code, on rows of which some lack an input."""
    holed = loans(spark, d).withColumn("net_worth", F.when(F.col("status") != "P", F.col("net_worth")))
    return scoring.score_logit(holed.select("account_id", *FEATURES), COEFS, INTERCEPT, "event")


@query(
    "score_classify",
    "account_id:i by_half:s by_prior:s above_tenth:s p0:f6",
    f"""WITH {SCORED}, m AS (SELECT avg(event) AS prior FROM scored)
        SELECT account_id, CASE WHEN p >= 0.5 THEN '1' ELSE '0' END AS by_half,
        CASE WHEN p >= prior THEN '1' ELSE '0' END AS by_prior, CASE WHEN p > 0.1 THEN '1' ELSE '0' END AS above_tenth,
        1 - p AS p0 FROM scored, m""",
)
def score_classify(spark, d):
    rows = scored(spark, d)
    prior = rows.agg(F.avg("event").alias("prior")).scalar()
    return rows.select(
        "account_id",
        scoring.classify("p", 0.5).alias("by_half"),
        scoring.classify("p", prior).alias("by_prior"),
        scoring.classify("p", 0.1, ">").alias("above_tenth"),
        (1 - F.col("p")).alias("p0"),
    )


@query(
    "score_points",
    "account_id:i points:f6",
    f"""WITH {LOANS} SELECT account_id, 600 - (20 / ln(2)) * ln(30) + (20 / ln(2)) * (-{XBETA_SQL}) AS points
        FROM loans""",
)
def score_points(spark, d):
    good = -fn.linear_predictor(COEFS, INTERCEPT)
    return loans(spark, d).select("account_id", scoring.odds_points(good).alias("points"))


def _band_score(amount: pd.Series, n_lines: pd.Series) -> pd.DataFrame:
    p = 1.0 / (1.0 + 2.718281828459045 ** -(0.5 * n_lines - amount / 200000.0 - 1.0))
    return pd.DataFrame({"EM_EVENTPROBABILITY": p, "EM_CLASSIFICATION": (p >= 0.5).map({True: "1", False: "0"})})


@query(
    "score_pandas",
    "account_id:i EM_EVENTPROBABILITY:f6 EM_CLASSIFICATION:s",
    f"""WITH {LOANS}, s AS (SELECT account_id, 1 / (1 + exp(-(0.5 * n_lines - amount / 200000 - 1))) AS p FROM loans)
        SELECT account_id, p AS "EM_EVENTPROBABILITY", CASE WHEN p >= 0.5 THEN '1' ELSE '0' END
        AS "EM_CLASSIFICATION" FROM s""",
)
def score_pandas(spark, d):
    rows = loans(spark, d).select("account_id", "amount", "n_lines")
    outputs = "EM_EVENTPROBABILITY double, EM_CLASSIFICATION string"
    return scoring.score_batches(rows, ["amount", "n_lines"], outputs, _band_score)


def _bs_sql(notional, vol, strike, spot, t, r) -> str:
    d1 = f"((ln(({spot}) / ({strike})) + (({r}) + ({vol}) * ({vol}) / 2) * ({t})) / (({vol}) * sqrt({t})))"
    d2 = f"({d1} - ({vol}) * sqrt({t}))"
    price = f"({normal_cdf_sql(d1)} * ({spot}) - {normal_cdf_sql(d2)} * ({strike}) * exp(-({r}) * ({t})))"
    return f"CASE WHEN ({vol}) > 0 AND ({strike}) > 0 AND ({spot}) > 0 AND ({t}) > 0 THEN ({notional}) * {price} END"


_OPTION = {
    "notional": "qty",
    "vol": "0.1::DOUBLE + avg_disc * 4",
    "strike": "amount / 1000",
    "spot": "net_worth / 40",
    "t": "CAST(n_lines AS DOUBLE) / 4",
    "r": "0.03::DOUBLE",
}


@query(
    "score_black_scholes",
    "account_id:i option_value:f2",
    f"""WITH {LOANS}, o AS (SELECT account_id, {', '.join(f'{v} AS o_{k}' for k, v in _OPTION.items())} FROM loans)
        SELECT account_id, {_bs_sql(*[f'o_{k}' for k in _OPTION])} AS option_value FROM o""",
)
def score_black_scholes(spark, d):
    value = fn.black_scholes(
        F.col("qty"),
        0.1 + F.col("avg_disc") * 4,
        F.col("amount") / 1000,
        F.col("net_worth") / 40,
        F.col("n_lines") / 4.0,
        F.lit(0.03),
    )
    return loans(spark, d).select("account_id", value.alias("option_value"))


@query(
    "udf_sql",
    "account_id:i option_value:f2",
    f"""WITH {LOANS}, o AS (SELECT account_id, {', '.join(f'{v} AS o_{k}' for k, v in _OPTION.items())} FROM loans)
        SELECT account_id, {_bs_sql(*[f'o_{k}' for k in _OPTION])} AS option_value FROM o""",
)
def udf_sql(spark, d):
    """The option value as a named SQL function; Spark inlines its body into the plan."""
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION norm_cdf(x DOUBLE) RETURNS DOUBLE RETURN
        SELECT 0.5D * (1 + sign(x) * (1 - ((((1.061405429D * t - 1.453152027D) * t + 1.421413741D) * t
          - 0.284496736D) * t + 0.254829592D) * t * exp(-x * x / 2)))
        FROM (SELECT 1 / (1 + 0.3275911D * abs(x) / sqrt(2D)) AS t)"""
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION black_scholes(notional DOUBLE, vol DOUBLE, strike DOUBLE,
          spot DOUBLE, years DOUBLE, rate DOUBLE) RETURNS DOUBLE RETURN
        CASE WHEN vol > 0 AND strike > 0 AND spot > 0 AND years > 0 THEN notional * (
          norm_cdf((ln(spot / strike) + (rate + vol * vol / 2) * years) / (vol * sqrt(years))) * spot
          - norm_cdf((ln(spot / strike) + (rate + vol * vol / 2) * years) / (vol * sqrt(years)) - vol * sqrt(years))
            * strike * exp(-rate * years)) END"""
    )
    return spark.sql(
        """SELECT account_id, black_scholes(qty, 0.1D + avg_disc * 4, amount / 1000, net_worth / 40,
             n_lines / 4D, 0.03D) AS option_value FROM {loans}""",
        loans=loans(spark, d),
    )


@query(
    "score_ensemble_avg",
    "account_id:i p:f6",
    f"""WITH {SCORED} SELECT account_id, (p + 1 / (1 + exp(-(0.5 * n_lines - 2))) + 1 / (1 + exp(-(qty / 50 - 2)))) / 3
        AS p FROM scored""",
)
def score_ensemble_avg(spark, d):
    members = [
        F.col("p"),
        fn.logistic(0.5 * F.col("n_lines") - 2.0),
        fn.logistic(F.col("qty") / 50.0 - 2.0),
    ]
    return scored(spark, d).select("account_id", scoring.ensemble_mean(members).alias("p"))


@query(
    "score_contract",
    "variable:s wanted:s found:s verdict:s filled:i",
    f"""WITH {LOANS} SELECT 'amount' AS variable, 'double' AS wanted, 'double' AS found, 'ok' AS verdict,
          (SELECT count(amount) FROM loans) AS filled UNION ALL
        SELECT 'n_lines', 'double', 'bigint', 'type', (SELECT count(n_lines) FROM loans) UNION ALL
        SELECT 'credit_score', 'double', NULL, 'missing', 0""",
)
def score_contract(spark, d):
    """The inputs a model declares against a table, with the filled rows of each."""
    rows = loans(spark, d)
    wanted = {"amount": "double", "n_lines": "double", "credit_score": "double"}
    checked = scoring.contract(rows, wanted)
    have = [c for c in wanted if c in rows.columns]
    filled = rows.agg(*[F.count(c).alias(c) for c in have]).unpivot([], have, "variable", "filled")
    return checked.join(filled, "variable", "left").fillna({"filled": 0})


def _applications(spark, d):
    """Loan requests as the rule sets name their inputs."""
    return scored(spark, d).select(
        "account_id",
        "p",
        F.floor(850 - 550 * F.col("p")).alias("orig_credit_score"),
        (F.col("qty") / 3).alias("orig_debt_to_income"),
        F.col("amount").alias("orig_amount"),
        F.col("net_worth").alias("orig_net_worth"),
        F.when(F.col("status") == "F", "TRUE").when(F.col("status") == "O", "false").alias("id_current_fs_relationship"),
    )


APPLICATIONS = f"""{SCORED}, app AS (SELECT account_id, p, floor(850 - 550 * p) AS score, qty / 3 AS dti, amount,
   net_worth, coalesce(status = 'F', false) AS is_current FROM scored)"""
_SCREEN_REASON = """CASE WHEN score <= 620 THEN 'Your credit score is below the minimum threshold'
   WHEN dti > 100 THEN 'Your debt-to-income ratio exceeds our minimum requirements' END"""
_SIZE_REASON = """CASE WHEN amount >= 200000 THEN 'Your requested loan amount exceeds our maximum loan threshold'
   WHEN amount < 5000 THEN 'Your requested loan is below the minimum amount that we lend' END"""


@query(
    "rules_screening",
    "account_id:i DeclineFlag:i MonthlyIncome:f6 DeclineReason:s",
    f"""WITH {APPLICATIONS} SELECT account_id, CAST(score <= 620 OR dti > 100 AS INT) AS "DeclineFlag",
        net_worth / 26 AS "MonthlyIncome", {_SCREEN_REASON} AS "DeclineReason" FROM app""",
)
def rules_screening(spark, d):
    return rules.apply_rules(_applications(spark, d), rules.SCREENING)


@query(
    "rules_loan_size",
    "account_id:i DeclineFlag:i DeclineReason:s",
    f"""WITH {APPLICATIONS} SELECT account_id, CASE WHEN amount >= 200000 OR amount < 5000 THEN 1 END AS "DeclineFlag",
        {_SIZE_REASON} AS "DeclineReason" FROM app""",
)
def rules_loan_size(spark, d):
    return rules.apply_rules(_applications(spark, d), rules.LOAN_SIZE)


@query(
    "rules_from_table",
    "account_id:i DeclineFlag:i MonthlyIncome:f6 DeclineReason:s",
    f"""WITH {APPLICATIONS} SELECT account_id, net_worth / 26 AS "MonthlyIncome",
        CASE WHEN score <= 620 OR dti > 100 OR amount >= 200000 OR amount < 5000 THEN 1 ELSE 0 END AS "DeclineFlag",
        coalesce({_SCREEN_REASON}, {_SIZE_REASON}) AS "DeclineReason" FROM app""",
)
def rules_from_table(spark, d):
    """Two rule sets stored as rows of one table, compiled from it and run one after the other."""
    rows = rules.rule_rows(spark, "screening", rules.SCREENING).unionByName(rules.rule_rows(spark, "loan_size", rules.LOAN_SIZE))
    stored = cut_lineage(rows)
    screened = rules.apply_rules(_applications(spark, d), rules.stored_rules(stored, "screening"))
    return rules.apply_rules(screened, rules.stored_rules(stored, "loan_size"), F.col("DeclineFlag") == 0)


@query(
    "rules_credit_check",
    "account_id:i current_ok:i prospective_ok:i",
    f"""WITH {APPLICATIONS} SELECT account_id, CAST(score >= 720 AND dti <= 30 AS INT) AS current_ok,
        CAST(score >= 680 AND dti <= 40 AS INT) AS prospective_ok FROM app""",
)
def rules_credit_check(spark, d):
    now = rules.apply_rules(_applications(spark, d), rules.CURRENT_CUSTOMER)
    now = now.withColumnRenamed("ApproveFlag", "current_ok").drop("rules_fired")
    later = rules.apply_rules(now, rules.PROSPECTIVE_CUSTOMER)
    return later.withColumnRenamed("ApproveFlag", "prospective_ok")


@query(
    "rules_fired",
    "account_id:i rule:s",
    f"""WITH {APPLICATIONS}
        SELECT account_id, 'Basic credit conditions' AS rule FROM app WHERE score <= 620 UNION ALL
        SELECT account_id, 'Default_rule_5_else_1' FROM app WHERE score > 620 AND dti > 100""",
)
def rules_fired(spark, d):
    out = rules.apply_rules(_applications(spark, d), rules.SCREENING)
    return out.select("account_id", F.explode("rules_fired").alias("rule"))


FLOW_SQL = f"""screened AS (SELECT *, {_SCREEN_REASON} AS r1, {_SIZE_REASON} AS r2,
   CASE WHEN is_current THEN score >= 720 AND dti <= 30 ELSE score >= 680 AND dti <= 40 END AS passes FROM app),
 decided AS (SELECT *, CAST(r1 IS NOT NULL OR r2 IS NOT NULL AS INT) AS "DeclineFlag",
   coalesce(r1, r2) AS "DeclineReason",
   CASE WHEN r1 IS NULL AND r2 IS NULL THEN CAST(passes AS INT) END AS "ApproveFlag",
   CASE WHEN r1 IS NULL AND r2 IS NULL AND passes THEN 'approve' ELSE 'deny' END AS loan_decision FROM screened)"""


@query(
    "decision_flow",
    "account_id:i DeclineFlag:i DeclineReason:s ApproveFlag:i loan_decision:s review_decision:s",
    f"""WITH {APPLICATIONS}, {FLOW_SQL} SELECT *, CASE WHEN p >= 0.75 THEN 'auto_escalate' WHEN p >= 0.25 THEN 'review'
        ELSE 'do_not_review' END AS review_decision FROM decided""",
)
def decision_flow(spark, d):
    out = rules.decide_loan(_applications(spark, d), "id_current_fs_relationship")
    return out.withColumn("review_decision", rules.review_band(F.col("p"), 0.75, 0.25))


@query(
    "score_batch_decision",
    "loan_decision:s DeclineReason:s n:i mean_p:f8",
    f"""WITH {APPLICATIONS}, {FLOW_SQL} SELECT loan_decision, "DeclineReason", count(*) AS n, avg(p) AS mean_p
        FROM decided GROUP BY 1, 2""",
)
def score_batch_decision(spark, d):
    """Score and decide a whole table, then count the outcomes."""
    out = rules.decide_loan(_applications(spark, d), "id_current_fs_relationship")
    return out.groupBy("loan_decision", "DeclineReason").agg(F.count("*").alias("n"), F.avg("p").alias("mean_p"))


_DICTIONARY = [
    {"name": "c_custkey", "dataType": "decimal", "direction": "inOut", "length": "8"},
    {"name": "c_name", "dataType": "integer", "direction": "input", "length": ""},
    {"name": "c_mktsegment", "dataType": "string", "direction": "input", "length": "8"},
    {"name": "c_phone", "dataType": "string", "direction": "input", "length": "20"},
    {"name": "_WARN_", "dataType": "string", "direction": "output", "length": ""},
]


@query(
    "rules_validate_schema",
    "variable:s type:s present:b bad_values:i too_long:i",
    """SELECT 'c_custkey' AS variable, 'decimal' AS type, true AS present,
         count(*) FILTER (TRY_CAST(c_custkey AS DOUBLE) IS NULL) AS bad_values, 0 AS too_long FROM customer UNION ALL
       SELECT 'c_name', 'integer', true, count(*) FILTER (TRY_CAST(c_name AS INT) IS NULL), 0 FROM customer UNION ALL
       SELECT 'c_mktsegment', 'string', true, 0, count(*) FILTER (length(c_mktsegment) > 8) FROM customer UNION ALL
       SELECT 'c_phone', 'string', false, 0, 0""",
)
def rules_validate_schema(spark, d):
    return rules.validate_table(table(spark, d, "customer"), _DICTIONARY)


@query(
    "reconcile_amounts",
    "o_orderkey:i subtotal:f8 tax:f8 math_consistent:b unlabeled_delta:b items_ok:b",
    """WITH i AS (SELECT l_orderkey, sum(l_extendedprice * (1 - l_discount)) AS subtotal,
         sum(l_extendedprice * (1 - l_discount) * l_tax) AS tax, sum(l_extendedprice) AS items FROM lineitem GROUP BY 1)
       SELECT o_orderkey, subtotal, tax, abs(subtotal + tax - o_totalprice) <= greatest(0.02, 0.005 * (subtotal + tax))
         AS math_consistent, o_totalprice - subtotal > greatest(0.05, 0.01 * subtotal) AS unlabeled_delta,
         abs(items - subtotal) <= greatest(0.5, 0.02 * subtotal) AS items_ok
       FROM orders LEFT JOIN i ON o_orderkey = l_orderkey""",
)
def reconcile_amounts(spark, d):
    net = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    items = table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.sum(net).alias("subtotal"), F.sum(net * F.col("l_tax")).alias("tax"), F.sum("l_extendedprice").alias("items")
    )
    joined = table(spark, d, "orders").join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    checks = rules.reconcile(F.col("subtotal"), F.col("tax"), F.col("o_totalprice"))
    return joined.withColumns({**checks, "items_ok": rules.items_match(F.col("items"), F.col("subtotal"))})


@query(
    "label_bands",
    "label:s n:i",
    f"""WITH {SCORED} SELECT CASE WHEN p * 100 >= 75 THEN 'FRAUD' WHEN p * 100 <= 25 THEN 'NOT_FRAUD' ELSE 'REVIEW' END
        AS label, count(*) AS n FROM scored GROUP BY 1""",
)
def label_bands(spark, d):
    label = rules.label_bands(F.col("p") * 100)
    return scored(spark, d).groupBy(label.alias("label")).agg(F.count("*").alias("n"))
