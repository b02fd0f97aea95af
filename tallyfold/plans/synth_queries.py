"""Queries on synthetic data, portfolios, streams and Python table functions."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import functions as F

from tallyfold.functions.scalar import linear_predictor, logistic
from tallyfold.operators import portfolio, rules, synth
from tallyfold.operators.series import difference
from tallyfold.plans.registry import query
from tallyfold.plans.series_text_queries import DAILY, _daily
from tallyfold.plans.views import LOANS, loans, table, uniform_sql
from tallyfold.streaming import jobs

_SMOTE = ["amount", "qty", "net_worth"]


@query(
    "synth_smote_exact",
    "account_id:i " + " ".join(f"{c}:f5" for c in _SMOTE),
    f"""WITH {LOANS}, m AS (SELECT account_id, amount, qty, net_worth, row_number() OVER
          (ORDER BY amount, account_id) AS r FROM loans WHERE event = 1),
        c AS (SELECT a.*, b.amount AS b_amount, b.qty AS b_qty, b.net_worth AS b_net_worth, b.r AS br
          FROM m a JOIN m b ON b.r IN (a.r - 1, a.r + 1)),
        n AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY account_id ORDER BY abs(amount - b_amount), br) = 1)
        SELECT account_id, {', '.join(
          f"{c} + {uniform_sql('account_id', 10)} * (b_{c} - {c}) AS {c}" for c in _SMOTE)} FROM n""",
)
def synth_smote_exact(spark, d):
    events = loans(spark, d).filter("event = 1")
    return synth.smote_ordered(events, "account_id", "amount", _SMOTE, seed=10)


def _smote_sql(copies: str) -> str:
    """All pairs of the class, the five nearest of each row, and the same draws."""
    draw = "vec_id || '#' || copy"
    return f"""WITH m AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings WHERE label = 1),
        d AS (SELECT a.vec_id, a.v, b.vec_id AS other, b.v AS ov, round(list_distance(a.v, b.v), 9) AS d
          FROM m a JOIN m b ON a.vec_id <> b.vec_id),
        n AS (SELECT vec_id, any_value(v) AS v, list({{'d': d, 'id': other, 'v': ov}} ORDER BY d, other)[1:5] AS near FROM d GROUP BY 1),
        r AS (SELECT *, count(*) OVER () AS total,
            row_number() OVER (ORDER BY CAST('0x' || substr(md5(vec_id || '|12'), 1, 8) AS BIGINT), CAST(vec_id AS VARCHAR)) AS rank FROM n),
        c AS (SELECT *, unnest(range(1, CAST({copies} AS INT) + 1)) AS copy FROM r),
        p AS (SELECT *, near[CAST(floor({uniform_sql(draw, 10)} * len(near)) AS INT) + 1] AS pick, {uniform_sql(draw, 11)} AS u FROM c)
        SELECT vec_id, copy, pick.id AS neighbour, v[1] + u * (pick.v[1] - v[1]) AS first FROM p"""


@query("synth_smote", "vec_id:i copy:i neighbour:i first:f5", _smote_sql("2"))
def synth_smote(spark, d):
    made = synth.smote(table(spark, d, "embeddings"), "vec_id", "embedding", "label", 1, per_row=2)
    return made.withColumn("first", F.element_at("vector", 1))


@query(
    "synth_smote_rows",
    "vec_id:i copy:i neighbour:i first:f5",
    _smote_sql("floor(400::DOUBLE / total) + CASE WHEN rank <= 400 % total THEN 1 ELSE 0 END"),
)
def synth_smote_rows(spark, d):
    """400 rows in all, however large the class."""
    made = synth.smote(table(spark, d, "embeddings"), "vec_id", "embedding", "label", 1, num_rows=400)
    return made.withColumn("first", F.element_at("vector", 1))


@query("synth_gmm", "component:i weight:f4 mean:f2 std:f2")
def synth_gmm(spark, d):
    rows = synth.mixture_table(table(spark, d, "orders"), "o_totalprice", max_clusters=10)
    return spark.createDataFrame(rows, "component int, weight double, mean double, std double")


_NOMINAL, _INTERVAL = ["segment", "status"], ["amount", "qty"]
_GRID = "[" + ", ".join(f"{i}/100.0::DOUBLE" for i in range(101)) + "]"


def _level_sql(c: str) -> str:
    u = uniform_sql("row_id", f"1{c}")
    return f"(SELECT level FROM lv WHERE variable = '{c}' AND upto > {u} ORDER BY level LIMIT 1)"


def _interval_sql(c: str) -> str:
    at = f"({uniform_sql('row_id', f'1{c}')} * 100)"
    return f"q_{c}[CAST(floor({at}) AS INT) + 1] + ({at} - floor({at})) * (q_{c}[CAST(floor({at}) AS INT) + 2] - q_{c}[CAST(floor({at}) AS INT) + 1])"


SYNTH = f"""{LOANS}, q AS (SELECT {', '.join(f'quantile_disc({c}, {_GRID}) AS q_{c}' for c in _INTERVAL)} FROM loans),
 lc AS ({' UNION ALL '.join(f"SELECT '{c}' AS variable, {c} AS level, count(*) AS n FROM loans GROUP BY 2" for c in _NOMINAL)}),
 lv AS (SELECT variable, level, CAST(sum(n) OVER (PARTITION BY variable ORDER BY level) AS DOUBLE)
   / sum(n) OVER (PARTITION BY variable) AS upto FROM lc),
 ids AS (SELECT range AS row_id FROM range((SELECT count(*) FROM loans))),
 syn AS (SELECT row_id, {', '.join(f'{_level_sql(c)} AS {c}' for c in _NOMINAL)},
   {', '.join(f'{_interval_sql(c)} AS {c}' for c in _INTERVAL)} FROM ids, q)"""


def _synthetic(rows):
    return synth.synthesize(rows, _NOMINAL, _INTERVAL, rows.count(), seed=1)


@query("synth_table", "row_id:i segment:s status:s amount:f5 qty:f5", f"WITH {SYNTH} SELECT * FROM syn")
def synth_table(spark, d):
    return _synthetic(loans(spark, d).select(*_NOMINAL, *_INTERVAL))


_TWENTIETHS = "[" + ", ".join(f"{i}/20.0::DOUBLE" for i in range(1, 20)) + "]"


@query(
    "synth_compare",
    "variable:s bin:i original:f7 synthetic:f7",
    f"""WITH {SYNTH}, e AS (SELECT {', '.join(f"list_distinct(quantile_disc({c}, {_TWENTIETHS})) AS e_{c}" for c in _INTERVAL)}
          FROM loans),
        b AS ({' UNION ALL '.join(
          f"SELECT '{c}' AS variable, len(list_filter(e_{c}, lambda x: x < {c})) AS bin, 1 AS o FROM loans, e UNION ALL "
          f"SELECT '{c}', len(list_filter(e_{c}, lambda x: x < {c})), 0 FROM syn, e" for c in _INTERVAL)}),
        n AS (SELECT variable, bin, sum(o) AS a, sum(1 - o) AS s FROM b GROUP BY 1, 2)
        SELECT variable, bin, CAST(a AS DOUBLE) / sum(a) OVER (PARTITION BY variable) AS original,
          CAST(s AS DOUBLE) / sum(s) OVER (PARTITION BY variable) AS synthetic FROM n""",
)
def synth_compare(spark, d):
    rows = loans(spark, d).select(*_NOMINAL, *_INTERVAL)
    return synth.compare_distributions(rows, _synthetic(rows), _INTERVAL)


def _returns(spark, d):
    logged = _daily(spark, d).withColumn("y", F.ln("value"))
    return difference(logged, "event_type", "slot", "y", [1], "r").filter("r IS NOT NULL")


@query(
    "portfolio_trials",
    "trial:i event_type:s investment:f7",
    f"""WITH {DAILY}, r AS (SELECT event_type, slot, ln(value) - lag(ln(value)) OVER
          (PARTITION BY event_type ORDER BY slot) AS r FROM s),
        v AS (SELECT * FROM r WHERE r IS NOT NULL), m AS (SELECT event_type, avg(r) AS mean FROM v GROUP BY 1),
        c AS (SELECT a.event_type AS i, b.event_type AS j, covar_samp(a.r, b.r) AS cov FROM v a JOIN v b
          ON a.slot = b.slot GROUP BY 1, 2),
        k AS (SELECT trial, event_type, mean, trial || '#' || event_type AS cell FROM m, range(1, 201) AS t(trial)),
        p AS (SELECT *, {uniform_sql('cell', 8)} AS w FROM k WHERE {uniform_sql('cell', 7)} < 0.5),
        z AS (SELECT trial, event_type, mean, 0.1 + (1 - 0.1 * count(*) OVER (PARTITION BY trial)) * w
          / sum(w) OVER (PARTITION BY trial) AS weight FROM p),
        e AS (SELECT trial, sum(weight * mean) AS ret FROM z GROUP BY 1),
        q AS (SELECT a.trial, sum(a.weight * b.weight * cov) AS risk FROM z a JOIN z b ON a.trial = b.trial
          JOIN c ON c.i = a.event_type AND c.j = b.event_type GROUP BY 1),
        best AS (SELECT trial FROM e JOIN q USING (trial) WHERE risk <= 0.05 ORDER BY round(ret, 12) DESC, trial LIMIT 1)
        SELECT trial, event_type, weight AS investment FROM z JOIN best USING (trial)""",
)
def portfolio_trials(spark, d):
    return portfolio.best_portfolio(
        _returns(spark, d), "event_type", "slot", "r", trials=200, seed=7, risk_limit=0.05
    )


def _decide_event(df):
    """Score, review routing and rules on one event record: expressions only."""
    p = logistic(linear_predictor({"value": 0.02}, -1.0))
    out = df.withColumn("p", p).withColumn("review_decision", rules.review_band(F.col("p"), 0.75, 0.5))
    return rules.apply_rules(
        out, [rules.Rule("flag_error", when=[("event_type", "= 'error'"), ("p", ">= 0.5")], then=[("alert", "1")])]
    ).select("event_id", "p", "review_decision", "alert")


@query(
    "stream_score",
    "event_id:i p:f6 review_decision:s alert:i",
    """WITH s AS (SELECT event_id, event_type, 1 / (1 + exp(-(-1 + 0.02::DOUBLE * value))) AS p FROM events)
       SELECT event_id, p, CASE WHEN p >= 0.75 THEN 'auto_escalate' WHEN p >= 0.5 THEN 'review' ELSE 'do_not_review' END
       AS review_decision, CASE WHEN event_type = 'error' AND p >= 0.5 THEN 1 END AS alert FROM s""",
)
def stream_score(spark, d):
    """The stream's output after all files; the oracle states the batch result."""
    return jobs.run_available(jobs.score_stream(jobs.stream_table(spark, f"{d}/events.parquet"), _decide_event))


@query(
    "stream_kpi",
    "window_start:t event_type:s n:i total:f4",
    """WITH w AS (SELECT date_trunc('day', ts) AS window_start, event_type, count(*) AS n, sum(value) AS total
         FROM events GROUP BY 1, 2)
       SELECT * FROM w WHERE window_start + INTERVAL 1 DAY <= (SELECT max(ts) - INTERVAL 1 HOUR FROM events)""",
)
def stream_kpi(spark, d):
    """Daily windows closed by a one-hour watermark; the last, still open window is not emitted."""
    events = jobs.stream_table(spark, f"{d}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    kpis = jobs.windowed_kpi(
        events, "ts", "1 day", "1 hour", ["event_type"], {"n": F.count("*"), "total": F.sum("value")}
    )
    return jobs.run_available(kpis)


def _initials(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        yield pd.DataFrame({"p_partkey": pdf["p_partkey"], "initials": pdf["p_name"].str.replace(r"(\w)\w*\s*", r"\1", regex=True)})


@query(
    "udf_map",
    "p_partkey:i initials:s",
    r"SELECT p_partkey, regexp_replace(p_name, '(\w)\w*\s*', '\1', 'g') AS initials FROM part",
)
def udf_map(spark, d):
    """A Python table step: Arrow batches in, Arrow batches out."""
    return table(spark, d, "part").select("p_partkey", "p_name").mapInPandas(
        _initials, "p_partkey bigint, initials string"
    )
