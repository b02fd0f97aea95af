"""Queries on assessment, fairness, explanation and monitoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyfold.functions.scalar import logistic
from tallyfold.operators import assess, explain, fairness, monitor, sampling
from tallyfold.plans.registry import query
from tallyfold.plans.stats_queries import _ranked_sql
from tallyfold.plans.views import COEFS, FEATURES, INTERCEPT, LOANS, SCORED, loans, scored, uniform_sql

KEY, Y, P = "account_id", "event", "p"


@query(
    "assess_confusion",
    "tn:i fp:i fn:i tp:i",
    f"""WITH {SCORED} SELECT count(*) FILTER (p < 0.5 AND event = 0) AS tn,
        count(*) FILTER (p >= 0.5 AND event = 0) AS fp, count(*) FILTER (p < 0.5 AND event = 1) AS fn,
        count(*) FILTER (p >= 0.5 AND event = 1) AS tp FROM scored""",
)
def assess_confusion(spark, d):
    return assess.confusion(scored(spark, d), Y, P)


LIFT_SQL = """r AS (SELECT *, row_number() OVER ({by} ORDER BY p DESC, account_id) AS rnk,
   count(*) OVER ({by}) AS total FROM scored),
 b AS (SELECT {keys} ceil(rnk / ceil(total / 20.0::DOUBLE)) AS bin, count(*) AS n, sum(event) AS events
   FROM r GROUP BY ALL),
 l AS (SELECT *, 100.0::DOUBLE * events / sum(events) OVER ({by}) AS resp,
   100.0::DOUBLE * sum(events) OVER ({by} ORDER BY bin) / sum(events) OVER ({by}) AS cumresp FROM b)"""


@query(
    "assess_lift",
    "bin:i depth:f6 n:i events:i resp:f6 cumresp:f6 lift:f6 cumlift:f6 gain:f6",
    f"""WITH {SCORED}, {LIFT_SQL.format(by='', keys='')}
        SELECT *, bin * 5 AS depth, resp / 5 AS lift, cumresp / (bin * 5) AS cumlift,
        cumresp / (bin * 5) - 1 AS gain FROM l""",
)
def assess_lift(spark, d):
    return assess.lift_table(scored(spark, d), KEY, Y, P)


# A score whose input is missing for some rows: those rows are left out of every measure.
_HOLED = f"{SCORED.replace('scored AS', 'whole AS')}, scored AS (SELECT * FROM whole WHERE status <> 'P')"


def _holed(spark, d):
    return scored(spark, d).withColumn(P, F.when(F.col("status") != "P", F.col(P)))


@query(
    "assess_lift_missing",
    "bin:i n:i events:i resp:f6 cumresp:f6",
    f"WITH {_HOLED}, {LIFT_SQL.format(by='', keys='')} SELECT * FROM l",
)
def assess_lift_missing(spark, d):
    return assess.lift_table(_holed(spark, d), KEY, Y, P)


ROC_SQL = """cells AS (SELECT {keys} CAST(floor(p * 1000) AS BIGINT) AS cell, sum(event) AS n1,
   sum(1 - event) AS n0 FROM scored GROUP BY ALL),
 grid AS (SELECT {keys} g.cell FROM ({groups}) CROSS JOIN range(1001) AS g(cell)),
 full_ AS (SELECT {gkeys} grid.cell, coalesce(n1, 0) AS n1, coalesce(n0, 0) AS n0
   FROM grid LEFT JOIN cells ON grid.cell = cells.cell {on}),
 c AS (SELECT *, sum(n1) OVER ({by} ORDER BY cell DESC) AS tp, sum(n0) OVER ({by} ORDER BY cell DESC) AS fp,
   sum(n1) OVER ({by}) AS t1, sum(n0) OVER ({by}) AS t0 FROM full_),
 roc AS (SELECT *, t1 - tp AS fn, t0 - fp AS tn, cell / 1000.0::DOUBLE AS cutoff,
   tp / CAST(t1 AS DOUBLE) AS sensitivity, fp / CAST(t0 AS DOUBLE) AS fpr,
   round(tp / CAST(t1 AS DOUBLE) - fp / CAST(t0 AS DOUBLE), 12) AS ks,
   (tp + t0 - fp) / CAST(t1 + t0 AS DOUBLE) AS accuracy FROM c),
 rocf AS (SELECT *, CAST(row_number() OVER ({by} ORDER BY ks DESC, cell) = 1 AS INT) AS ks_flag FROM roc)"""
ROC_ALL = ROC_SQL.format(keys="", groups="SELECT 1", gkeys="", on="", by="")


@query(
    "assess_roc",
    "cutoff:f3 tp:i fp:i fn:i tn:i sensitivity:f6 fpr:f6 accuracy:f6 ks:f6 ks_flag:i",
    f"WITH {SCORED}, {ROC_ALL} SELECT * FROM rocf",
)
def assess_roc(spark, d):
    return assess.roc_table(scored(spark, d), Y, P)


AUC_SQL = """pv AS (SELECT {keys} p, sum(event) AS n1, sum(1 - event) AS n0 FROM scored GROUP BY ALL),
 cum AS (SELECT *, sum(n0) OVER ({by} ORDER BY p) AS c0 FROM pv),
 auc AS (SELECT {keys} sum(n1 * (c0 - 0.5::DOUBLE * n0)) / (sum(n1)::DOUBLE * sum(n0)::DOUBLE) AS auc
   FROM cum GROUP BY ALL)"""


@query(
    "assess_auc",
    "part:i auc:f8 gini:f8",
    f"""WITH {SCORED}, {AUC_SQL.format(keys='part,', by='PARTITION BY part')}
        SELECT part, auc, 2 * auc - 1 AS gini FROM auc""",
)
def assess_auc(spark, d):
    return assess.auc(scored(spark, d), Y, P, ["part"])


@query(
    "assess_ks",
    "cutoff:f3 ks:f8 sensitivity:f6 fpr:f6",
    f"WITH {SCORED}, {ROC_ALL} SELECT * FROM rocf WHERE ks_flag = 1",
)
def assess_ks(spark, d):
    return assess.best_ks(scored(spark, d), Y, P)


@query(
    "assess_class_report",
    "label:s precision:f6 recall:f6 f1:f6 support:i",
    f"""WITH {SCORED}, c AS (SELECT CAST(l AS VARCHAR) AS label,
          CAST(count(*) FILTER (CAST(p >= 0.5 AS INT) = l AND event = l) AS DOUBLE) AS hit,
          count(*) FILTER (CAST(p >= 0.5 AS INT) = l) AS said, count(*) FILTER (event = l) AS support
          FROM scored, (VALUES (0), (1)) AS t(l) GROUP BY 1),
        r AS (SELECT label, hit / said AS precision, hit / support AS recall,
          2 * hit / (said + support) AS f1, support FROM c)
        SELECT * FROM r UNION ALL
        SELECT 'macro', avg(precision), avg(recall), avg(f1), sum(support) FROM r UNION ALL
        SELECT 'weighted', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
          sum(f1 * support) / sum(support), sum(support) FROM r""",
)
def assess_class_report(spark, d):
    return assess.class_report(scored(spark, d), Y, P)


@query(
    "assess_accuracy_by_part",
    "part:s n:i accuracy:f8",
    f"""WITH {SCORED}, a AS (SELECT CAST(part AS VARCHAR) AS part, CAST((p >= 0.5) = (event = 1) AS DOUBLE) AS ok
          FROM scored)
        SELECT part, count(*) AS n, avg(ok) AS accuracy FROM a GROUP BY 1
        UNION ALL SELECT 'all', count(*), avg(ok) FROM a""",
)
def assess_accuracy_by_part(spark, d):
    """One pass: the overall figure is the weighted mean of the three partition rows."""
    parts = assess.accuracy(scored(spark, d), Y, P, by=["part"])
    whole = parts.agg(
        F.lit("all").alias("part"),
        F.sum("n").alias("n"),
        (F.sum(F.col("accuracy") * F.col("n")) / F.sum("n")).alias("accuracy"),
    )
    return parts.withColumn("part", F.col("part").cast("string")).unionByName(whole.select("part", "n", "accuracy"))


FIT_SQL = """count(*) AS n, sum(event) AS events, avg((event - p) * (event - p)) AS ase,
   sqrt(avg((event - p) * (event - p))) AS rase,
   avg(-CASE WHEN event = 1 THEN ln(p) ELSE ln(1 - p) END) AS mcll,
   avg(CAST((p >= 0.5) <> (event = 1) AS DOUBLE)) AS mce"""


@query(
    "assess_fit",
    "part:i n:i events:i ase:f8 rase:f8 mcll:f8 mce:f8",
    f"WITH {SCORED} SELECT part, {FIT_SQL} FROM scored GROUP BY 1",
)
def assess_fit(spark, d):
    return assess.fit_stats(scored(spark, d), Y, P, by=["part"])


def _all_sql(by: str, view: str) -> str:
    part = f"PARTITION BY {by}"
    return f"""WITH {view}, fit AS (SELECT {by}, {FIT_SQL} FROM scored GROUP BY 1),
        {AUC_SQL.format(keys=by + ',', by=part)},
        {ROC_SQL.format(keys=by + ',', groups=f'SELECT DISTINCT {by} FROM cells', gkeys=f'grid.{by},',
                        on=f'AND grid.{by} = cells.{by}', by=part)},
        {LIFT_SQL.format(keys=by + ',', by=part)}
        SELECT fit.*, auc, 2 * auc - 1 AS gini, rocf.ks, rocf.cutoff AS ks_cutoff, l.resp / 5 AS lift_top
        FROM fit JOIN auc USING ({by}) JOIN rocf USING ({by}) JOIN l USING ({by})
        WHERE rocf.ks_flag = 1 AND l.bin = 1"""


_KPI = "n:i events:i ase:f8 rase:f8 mcll:f8 mce:f8 auc:f8 gini:f8 ks:f8 ks_cutoff:f3 lift_top:f6"


@query("assess_all_by_part", f"part:i {_KPI}", _all_sql("part", SCORED))
def assess_all_by_part(spark, d):
    return assess.assess_groups(scored(spark, d), KEY, Y, P, ["part"])


@query(
    "assess_all_missing",
    f"part:i n_missing:i {_KPI}",
    f"""SELECT a.*, m.n_missing FROM ({_all_sql("part", _HOLED)}) AS a JOIN
        (WITH {SCORED} SELECT part, count(*) FILTER (status = 'P') AS n_missing FROM scored GROUP BY 1) AS m
        ON a.part = m.part""",
)
def assess_all_missing(spark, d):
    return assess.assess_groups(_holed(spark, d), KEY, Y, P, ["part"])


@query(
    "assess_regression",
    "mae:f6 mse:f4 rmse:f6 tweedie_deviance:f6 d2_tweedie:f6 d2_absolute:f6",
    f"""WITH {LOANS}, s AS (SELECT qty AS y, 25.5::DOUBLE * n_lines AS m FROM loans),
        b AS (SELECT avg(y) AS mean, quantile_disc(y, 0.5) AS med FROM s),
        t AS (SELECT *, 2 * (pow(y, 0.2) / (-0.16) - y * pow(m, -0.8) / (-0.8) + pow(m, 0.2) / 0.2) AS dev,
          2 * (pow(y, 0.2) / (-0.16) - y * pow(mean, -0.8) / (-0.8) + pow(mean, 0.2) / 0.2) AS dev0 FROM s, b)
        SELECT avg(abs(y - m)) AS mae, avg((y - m) * (y - m)) AS mse, sqrt(avg((y - m) * (y - m))) AS rmse,
          avg(dev) AS tweedie_deviance, 1 - avg(dev) / avg(dev0) AS d2_tweedie,
          1 - avg(abs(y - m)) / avg(abs(y - med)) AS d2_absolute FROM t""",
)
def assess_regression(spark, d):
    rows = loans(spark, d).select("qty", (25.5 * F.col("n_lines")).alias("predicted"))
    return assess.regression_fit(rows, "qty", "predicted")


@query(
    "assess_odds",
    "variable:s coefficient:f9 odds_ratio:f6 odds_ratio_per_std:f6",
    f"WITH {LOANS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, {b!r}::DOUBLE AS coefficient, exp({b!r}::DOUBLE) AS odds_ratio, "
        f"exp({b!r}::DOUBLE * stddev_samp({c})) AS odds_ratio_per_std FROM loans"
        for c, b in COEFS.items()
    ),
)
def assess_odds(spark, d):
    return assess.odds_ratios(loans(spark, d), COEFS)


@query(
    "assess_kfold_freq",
    "fold:i predicted:i wrong:i n:i",
    f"""WITH {SCORED}, f AS (SELECT event, p, ceil(rnk * 10 / CAST(total AS DOUBLE)) AS fold
          FROM ({_ranked_sql('scored', 'account_id', 3)}))
        SELECT fold, round(p) AS predicted, abs(event - round(p)) AS wrong, count(*) AS n FROM f GROUP BY 1, 2, 3""",
)
def assess_kfold_freq(spark, d):
    folded = sampling.kfold(scored(spark, d).select(KEY, Y, P), KEY, 10, seed=3)
    return assess.fold_frequencies(folded, "fold", Y, P)


SENSITIVE = ["segment", "priority", "region"]


def _metrics_sql() -> str:
    """Independent statement of the group metrics, for event level 1 and cut-off 0.5."""
    lv = " UNION ALL ".join(
        f"SELECT '{s}' AS bias_var, CAST({s} AS VARCHAR) AS level, account_id, event, p FROM scored0" for s in SENSITIVE
    )
    part = "PARTITION BY bias_var, level"
    return f"""{SCORED.replace('scored AS', 'scored0 AS')}, scored AS ({lv}),
 k AS (SELECT bias_var, level, count(*) AS n, count(*) FILTER (p >= 0.5 AND event = 1) AS tp,
   count(*) FILTER (p >= 0.5 AND event = 0) AS fp, count(*) FILTER (p < 0.5 AND event = 0) AS tn,
   count(*) FILTER (p < 0.5 AND event = 1) AS fn, avg(p) AS predicted_event, avg((event - p) * (event - p)) AS ase,
   avg(-CASE WHEN event = 1 THEN ln(p) ELSE ln(1 - p) END) AS mcll FROM scored GROUP BY 1, 2),
 {AUC_SQL.format(keys='bias_var, level,', by=part)},
 kc AS (SELECT bias_var, level, p, sum(n1) OVER ({part}) AS t1, sum(n0) OVER ({part}) AS t0,
   sum(n1) OVER ({part} ORDER BY p DESC) AS tp, sum(n0) OVER ({part} ORDER BY p DESC) AS fp FROM pv),
 kr AS (SELECT *, round(tp / CAST(t1 AS DOUBLE) - fp / CAST(t0 AS DOUBLE), 12) AS ks,
   (t1 - tp + fp) / CAST(t1 + t0 AS DOUBLE) AS wrong FROM kc),
 kb AS (SELECT bias_var, level, ks AS max_ks, wrong AS miscevent_ks FROM kr
   QUALIFY row_number() OVER ({part} ORDER BY ks DESC, p) = 1),
 rk AS (SELECT *, row_number() OVER ({part} ORDER BY p DESC, account_id) AS rnk, count(*) OVER ({part}) AS total
   FROM scored),
 tops AS (SELECT bias_var, level,
   sum(event) FILTER (rnk > ceil(total / 20.0::DOUBLE) AND rnk <= 2 * ceil(total / 20.0::DOUBLE)) AS e2,
   sum(event) FILTER (rnk <= 2 * ceil(total / 20.0::DOUBLE)) AS e12 FROM rk GROUP BY 1, 2),
 gm AS (SELECT k.bias_var, k.level, n, tp, fp, tn, fn, tp / (tp + fn)::DOUBLE AS tpr, fp / (fp + tn)::DOUBLE AS fpr,
   tn / (fp + tn)::DOUBLE AS tnr, fn / (tp + fn)::DOUBLE AS fnr, fp / (tp + fp)::DOUBLE AS fdr,
   (tp + tn) / n::DOUBLE AS acc, auc AS c, 2.0::DOUBLE * tp / (2 * tp + fp + fn) AS f1, 2 * auc - 1 AS gini,
   (fp + fn) / n::DOUBLE AS miscevent, miscevent_ks, (fp + fn) / n::DOUBLE AS mce, ase, sqrt(ase) AS rase, mcll,
   max_ks, tp / (tp + fn)::DOUBLE - fp / (fp + tn)::DOUBLE AS cutoff_ks,
   10.0::DOUBLE * e12 / (tp + fn) - 1 AS gain, 20.0::DOUBLE * e2 / (tp + fn) AS lift,
   100.0::DOUBLE * e2 / (tp + fn) AS resp, 100.0::DOUBLE * e12 / (tp + fn) AS cumresp,
   10.0::DOUBLE * e12 / (tp + fn) AS cumlift, (tp + fp) / n::DOUBLE AS into_event, predicted_event,
   1 - predicted_event AS p0, predicted_event AS p1
   FROM k JOIN auc USING (bias_var, level) JOIN kb USING (bias_var, level) JOIN tops USING (bias_var, level))"""


METRICS_SQL = _metrics_sql()


def _group_metrics(spark, d):
    return fairness.group_metrics(scored(spark, d), KEY, Y, P, SENSITIVE, event_level=1)


@query(
    "fair_group_metrics",
    "bias_var:s level:s n:i tp:i fp:i tn:i fn:i " + " ".join(f"{m}:f7" for m in fairness.METRICS),
    f"WITH {METRICS_SQL} SELECT * FROM gm",
)
def fair_group_metrics(spark, d):
    return _group_metrics(spark, d)


@query(
    "fair_max_diff",
    "bias_var:s metric:s value:f7 base:s compare:s",
    f"""WITH {METRICS_SQL}, long_ AS (UNPIVOT (SELECT bias_var, level, {', '.join(fairness.METRICS)} FROM gm)
          ON {', '.join(fairness.METRICS)} INTO NAME metric VALUE value)
        SELECT bias_var, metric, max(value) - min(value) AS value,
          first(level ORDER BY round(value, 12) DESC, level DESC) AS base,
          first(level ORDER BY round(value, 12), level) AS compare FROM long_ GROUP BY 1, 2""",
)
def fair_max_diff(spark, d):
    return fairness.max_differences(_group_metrics(spark, d))


@query(
    "fair_bias_metrics",
    "bias_var:s metric:s value:f7 note:s",
    f"""WITH {METRICS_SQL}, r AS (SELECT bias_var, max(into_event) - min(into_event) AS dp,
          max(predicted_event) - min(predicted_event) AS pp, max(acc) - min(acc) AS ea,
          max(tpr) - min(tpr) AS eo, max(fpr) - min(fpr) AS fr FROM gm GROUP BY 1)
        SELECT bias_var, 'DemographicParity' AS metric, dp AS value, '' AS note FROM r UNION ALL
        SELECT bias_var, 'PredictiveParity', pp, '' FROM r UNION ALL
        SELECT bias_var, 'EqualAccuracy', ea, '' FROM r UNION ALL
        SELECT bias_var, 'EqualOpportunity', eo, '' FROM r UNION ALL
        SELECT bias_var, 'EqualizedOdds', greatest(eo, fr), CASE WHEN fr > eo
          THEN 'Max FPR difference is greater than max TPR difference.'
          ELSE 'Max TPR difference is greater than max FPR difference.' END FROM r""",
)
def fair_bias_metrics(spark, d):
    return fairness.bias_metrics(_group_metrics(spark, d))


@query(
    "fair_regression",
    "bias_var:s level:s n:i mean_actual:f6 mean_predicted:f6 rmse:f6",
    f"WITH {LOANS} "
    + " UNION ALL ".join(
        f"SELECT '{s}' AS bias_var, CAST({s} AS VARCHAR) AS level, count(*) AS n, avg(qty) AS mean_actual, "
        f"avg(25.5::DOUBLE * n_lines) AS mean_predicted, sqrt(avg(pow(qty - 25.5::DOUBLE * n_lines, 2))) AS rmse "
        f"FROM loans GROUP BY 2"
        for s in SENSITIVE
    ),
)
def fair_regression(spark, d):
    rows = loans(spark, d).withColumn("predicted", 25.5 * F.col("n_lines"))
    return fairness.regression_groups(rows, "qty", "predicted", SENSITIVE)


def _score(inputs):
    """The scorecard as a function of its input columns (inputs not given stay out)."""
    xbeta = F.lit(INTERCEPT)
    for c, x in inputs.items():
        xbeta = xbeta + F.lit(COEFS[c]) * x
    return logistic(xbeta)


def _sigmoid_sql(values: dict[str, str]) -> str:
    return f"(1 / (1 + exp(-({INTERCEPT} + {' + '.join(f'({COEFS[c]!r}) * {v}' for c, v in values.items())}))))"


def _pd_sql() -> str:
    ranges = ", ".join(f"min({c}) AS lo_{c}, max({c}) AS hi_{c}" for c in FEATURES)
    parts = []
    for c in FEATURES:
        at = f"(lo_{c} + (hi_{c} - lo_{c}) * (b / 19.0::DOUBLE))"
        score = _sigmoid_sql({x: at if x == c else x for x in FEATURES})
        parts.append(
            f"SELECT '{c}' AS variable, b + 1 AS bin_num, max({at}) AS bin_value, avg({score}) AS mean_prediction, "
            f"stddev_samp({score}) / sqrt(count(*)) AS standard_error FROM loans, r, range(20) AS g(b) GROUP BY 2"
        )
    return f"WITH {LOANS}, r AS (SELECT {ranges} FROM loans) " + " UNION ALL ".join(parts)


@query("explain_pd", "variable:s bin_num:i bin_value:f5 mean_prediction:f7 standard_error:f7", _pd_sql())
def explain_pd(spark, d):
    return explain.partial_dependence(loans(spark, d), _score, FEATURES, bins=20)


FOUR = FEATURES[:4]


def _shapley_sql(inputs, plan, bg_rows: int, seed: int) -> str:
    needed = sorted({s for t in plan.values() for _, a, b in t for s in (a, b)}, key=lambda s: (len(s), sorted(s)))
    at = {s: i for i, s in enumerate(needed)}
    values = ", ".join(
        f"avg({_sigmoid_sql({c: f'l.{c}' if c in s else f'b.{c}' for c in inputs})}) AS v{i}" for s, i in at.items()
    )
    effects = ", ".join(
        " + ".join(f"{w!r}::DOUBLE * (v{at[a]} - v{at[b]})" for w, a, b in plan[c]) + f" AS {c}" for c in inputs
    )
    return f"""{LOANS}, bg AS (SELECT * FROM loans ORDER BY {uniform_sql('account_id', seed)}, account_id
          LIMIT {bg_rows}),
        v AS (SELECT l.account_id, {values} FROM loans l, bg b GROUP BY 1),
        shap AS (SELECT account_id, v{at[frozenset()]} AS intercept, {effects} FROM v)"""


_EXACT = _shapley_sql(FOUR, explain.shapley_plan(FOUR), 25, 1)


def _exact(spark, d):
    return explain.shapley(loans(spark, d), KEY, _score, FOUR, background_rows=25, seed=1)


@query(
    "explain_shapley_exact",
    "account_id:i variable:s shapley_value:f7",
    f"WITH {_EXACT} UNPIVOT (SELECT account_id, {', '.join(FOUR)} FROM shap) "
    f"ON {', '.join(FOUR)} INTO NAME variable VALUE shapley_value",
)
def explain_shapley_exact(spark, d):
    return explain.shapley_long(_exact(spark, d), KEY, FOUR)


_ORDERS = explain.seeded_permutations(FEATURES, 6, 1)


@query(
    "explain_shapley_perm",
    "account_id:i intercept:f7 " + " ".join(f"{c}:f7" for c in FEATURES),
    f"WITH {_shapley_sql(FEATURES, explain.shapley_plan(FEATURES, _ORDERS), 10, 1)} SELECT * FROM shap",
)
def explain_shapley_perm(spark, d):
    return explain.shapley(
        loans(spark, d), KEY, _score, FEATURES, background_rows=10, seed=1, permutations=6
    )


@query(
    "explain_shapley_wide",
    "account_id:i intercept:f7 total:f7 " + " ".join(f"{c}:f7" for c in FOUR),
    f"WITH {_EXACT} SELECT s.*, {_sigmoid_sql({c: f'l.{c}' for c in FOUR})} AS total "
    "FROM shap s JOIN loans l USING (account_id)",
)
def explain_shapley_wide(spark, d):
    """Wide table; `total` = intercept + effects, which the oracle states as the prediction."""
    wide = _exact(spark, d)
    total = F.col("intercept")
    for c in FOUR:
        total = total + F.col(c)
    return wide.withColumn("total", total)


@query(
    "explain_importance",
    "variable:s mean_abs:f7",
    f"WITH {_EXACT} " + " UNION ALL ".join(f"SELECT '{c}' AS variable, avg(abs({c})) AS mean_abs FROM shap" for c in FOUR),
)
def explain_importance(spark, d):
    """Averages the wide table directly: no long table, no shuffle of rows."""
    wide = _exact(spark, d)
    means = wide.agg(*[F.avg(F.abs(c)).alias(c) for c in FOUR])
    return means.unpivot([], FOUR, "variable", "mean_abs").orderBy(F.desc("mean_abs"))


_PERIOD = SCORED.replace("SELECT *, CAST(1", "SELECT *, year(opened) AS period, CAST(1")


@query("monitor_kpi", f"period:i {_KPI}", _all_sql("period", _PERIOD))
def monitor_kpi(spark, d):
    rows = scored(spark, d).withColumn("period", F.year("opened"))
    return monitor.period_kpis(rows, KEY, Y, P, "period")


_DRIFT = ["amount", "qty", "n_lines"]
_TENTHS = "[" + ", ".join(f"{i}/10.0::DOUBLE" for i in range(1, 10)) + "]"


@query(
    "monitor_psi",
    "variable:s period:i psi:f7",
    f"""WITH {LOANS}, p AS (SELECT *, year(opened) AS period FROM loans),
        e AS (SELECT {', '.join(f"list_distinct(quantile_disc({c}, {_TENTHS})) AS e_{c}" for c in _DRIFT)}
          FROM p WHERE period = 1995),
        n AS ({' UNION ALL '.join(
          f"SELECT '{c}' AS variable, period, len(list_filter(e_{c}, lambda x: x < {c})) AS bin, count(*) AS n "
          f"FROM p, e GROUP BY 2, 3" for c in _DRIFT)}),
        f AS (SELECT v.variable, v.period, b.bin, coalesce(n.n, 0) + 0.5::DOUBLE AS n
          FROM (SELECT DISTINCT variable, period FROM n) v
          JOIN (SELECT DISTINCT variable, bin FROM n) b ON v.variable = b.variable
          LEFT JOIN n ON n.variable = v.variable AND n.period = v.period AND n.bin = b.bin),
        s AS (SELECT *, n / sum(n) OVER (PARTITION BY variable, period) AS share FROM f)
        SELECT s.variable, s.period, sum((s.share - b.share) * ln(s.share / b.share)) AS psi
        FROM s JOIN s b ON s.variable = b.variable AND s.bin = b.bin AND b.period = 1995 GROUP BY 1, 2""",
)
def monitor_psi(spark, d):
    rows = loans(spark, d).select(*_DRIFT, F.year("opened").alias("period"))
    return monitor.stability(rows, _DRIFT, "period", 1995)
