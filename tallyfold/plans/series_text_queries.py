"""Queries on time series and text."""

from __future__ import annotations

import json

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfold.operators import relational, series, text
from tallyfold.plans.registry import query
from tallyfold.plans.views import table


def _daily(spark, d):
    grid = series.to_grid(table(spark, d, "events"), "event_type", "ts", "value", "day")
    return grid.withColumn("slot", F.to_date("slot"))


DAILY = """s AS (SELECT event_type, CAST(ts AS DATE) AS slot, sum(value) AS value, count(*) AS n
   FROM events GROUP BY 1, 2)"""
AR1 = f"""{DAILY}, y AS (SELECT event_type, slot, ln(value) AS y FROM s WHERE value > 0),
 d AS (SELECT y.*, y.y - b.y AS dy FROM y LEFT JOIN y b ON b.event_type = y.event_type AND b.slot = y.slot - 1),
 l AS (SELECT d.*, b.dy AS ly FROM d LEFT JOIN d b ON b.event_type = d.event_type AND b.slot = d.slot - 1),
 f AS (SELECT event_type, regr_slope(dy, ly) AS phi, regr_intercept(dy, ly) AS constant, regr_count(dy, ly) AS n,
   regr_syy(dy, ly) * (1 - regr_r2(dy, ly)) / (regr_count(dy, ly) - 2) AS sigma2,
   max_by(y, slot) AS last_log, max_by(dy, slot) FILTER (dy IS NOT NULL) AS last_diff FROM l GROUP BY 1)"""


@query("ts_ar1_fit", "event_type:s phi:f7 constant:f7 sigma2:f7 n:i", f"WITH {AR1} SELECT * FROM f")
def ts_ar1_fit(spark, d):
    return series.ar1_fit(_daily(spark, d), "event_type", "slot", "value")


@query(
    "ts_ar1_forecast",
    "event_type:s step:i forecast:f4",
    f"""WITH {AR1}, m AS (SELECT *, constant / (1 - phi) AS mu FROM f)
        SELECT event_type, h AS step, exp(last_log + h * mu + (last_diff - mu) * phi * (1 - pow(phi, h)) / (1 - phi))
        AS forecast FROM m, range(1, 7) AS t(h)""",
)
def ts_ar1_forecast(spark, d):
    return series.ar1_forecast(series.ar1_fit(_daily(spark, d), "event_type", "slot", "value"), "event_type", 6)


_SLOPE = """n * (-2 * x * (f2 - 2 * m * f1 + m * m * runs)
   - 2 * (hb - m * (h1 + b1) + m * m * pairs - x * (b2 - 2 * m * b1 + m * m * pairs)))
   / ((1 - x * x) * (f2 - 2 * m * f1 + m * m * runs) + h2 - 2 * x * hb + x * x * b2
      - 2 * (1 - x) * m * (h1 - x * b1) + pairs * ((1 - x) * m) * ((1 - x) * m)) + 2 * runs * x / (1 - x * x)"""
#: The zero of the slope by halving, as a recursive table; sums are about each series' mean difference.
AR1_ML = f"""RECURSIVE {DAILY}, y AS (SELECT event_type, slot, ln(value) AS y FROM s WHERE value > 0),
 d AS (SELECT y.event_type, y.slot, y.y, y.y - b.y AS dy FROM y LEFT JOIN y b ON b.event_type = y.event_type AND b.slot = y.slot - 1),
 c AS (SELECT event_type, avg(dy) AS c FROM d GROUP BY 1),
 l AS (SELECT d.event_type, d.slot, d.y, d.dy AS raw, d.dy - c.c AS h, b.dy - c.c AS b FROM d JOIN c USING (event_type)
   LEFT JOIN d b ON b.event_type = d.event_type AND b.slot = d.slot - 1),
 u AS (SELECT event_type, max_by(y, slot) AS last_log, max_by(raw, slot) FILTER (raw IS NOT NULL) AS last_diff,
   count(h) AS n, count(h) FILTER (b IS NULL) AS runs, count(h) FILTER (b IS NOT NULL) AS pairs,
   coalesce(sum(h) FILTER (b IS NULL), 0) AS f1, coalesce(sum(h * h) FILTER (b IS NULL), 0) AS f2,
   sum(h) FILTER (b IS NOT NULL) AS h1, sum(b) FILTER (h IS NOT NULL) AS b1, sum(h * h) FILTER (b IS NOT NULL) AS h2,
   sum(b * b) FILTER (h IS NOT NULL) AS b2, sum(h * b) AS hb FROM l GROUP BY 1),
 z AS (SELECT event_type, -1.0::DOUBLE AS lo, 1.0::DOUBLE AS hi, 0 AS k FROM u WHERE pairs > 1
   UNION ALL
   SELECT event_type, CASE WHEN slope < 0 THEN x ELSE lo END, CASE WHEN slope < 0 THEN hi ELSE x END, k + 1
   FROM (SELECT *, {_SLOPE} AS slope FROM (SELECT *, ((1 + x) * f1 + h1 - x * b1) / ((1 + x) * runs + (1 - x) * pairs) AS m
     FROM (SELECT z.*, (lo + hi) / 2 AS x, u.* EXCLUDE (event_type) FROM z JOIN u USING (event_type) WHERE k < {series.HALVINGS})))),
 p AS (SELECT u.*, (lo + hi) / 2 AS x FROM z JOIN u USING (event_type) WHERE k = {series.HALVINGS}),
 f AS (SELECT event_type, x AS phi, m + c AS mean, (m + c) * (1 - x) AS constant, n, last_log, last_diff, {_SLOPE} AS slope,
   ((1 - x * x) * (f2 - 2 * m * f1 + m * m * runs) + h2 - 2 * x * hb + x * x * b2 - 2 * (1 - x) * m * (h1 - x * b1)
     + pairs * ((1 - x) * m) * ((1 - x) * m)) / (n - 2) AS sigma2
   FROM (SELECT *, ((1 + x) * f1 + h1 - x * b1) / ((1 + x) * runs + (1 - x) * pairs) AS m FROM p) JOIN c USING (event_type))"""


@query(
    "ts_ar1_ml_fit",
    "event_type:s phi:f7 mean:f7 constant:f7 sigma2:f7 n:i slope:f5",
    f"WITH {AR1_ML} SELECT event_type, phi, mean, constant, sigma2, n, 0.0::DOUBLE AS slope FROM f",
)
def ts_ar1_ml_fit(spark, d):
    """Exact likelihood; the slope of the likelihood at the estimate is zero."""
    return series.ar1_likelihood(_daily(spark, d), "event_type", "slot", "value")


@query(
    "ts_ar1_ml_forecast",
    "event_type:s step:i forecast:f4",
    f"""WITH {AR1_ML} SELECT event_type, h AS step, exp(last_log + h * mean + (last_diff - mean) * phi * (1 - pow(phi, h)) / (1 - phi))
        AS forecast FROM f, range(1, 7) AS t(h)""",
)
def ts_ar1_ml_forecast(spark, d):
    return series.ar1_forecast(series.ar1_likelihood(_daily(spark, d), "event_type", "slot", "value"), "event_type", 6)


@query(
    "ts_seasonal_diff",
    "event_type:s slot:d w:f7",
    f"""WITH {DAILY}, d AS (SELECT s.event_type, s.slot, ln(s.value) - ln(b.value) AS d1 FROM s
          LEFT JOIN s b ON b.event_type = s.event_type AND b.slot = s.slot - 1)
        SELECT d.event_type, d.slot, d.d1 - b.d1 AS w FROM d
        LEFT JOIN d b ON b.event_type = d.event_type AND b.slot = d.slot - 7""",
)
def ts_seasonal_diff(spark, d):
    logged = _daily(spark, d).withColumn("y", F.ln("value"))
    return series.difference(logged, "event_type", "slot", "y", [1, 7], "w")


@query("ts_airline", "event_type:s step:i theta:f4 seasonal_theta:f4 sigma2:f6 forecast:f2")
def ts_airline(spark, d):
    regular = series.regularize(_daily(spark, d), "event_type", "day")
    return series.airline(regular, "event_type", "slot", "value", season=7, lead=4)


@query(
    "ts_regularize",
    "event_type:s slot:t value:f4 n:i",
    """WITH g AS (SELECT event_type, date_trunc('hour', ts) AS slot, sum(value) AS value, count(*) AS n
         FROM events GROUP BY 1, 2),
       e AS (SELECT event_type, unnest(generate_series(min(slot)::TIMESTAMP, max(slot)::TIMESTAMP, INTERVAL 1 HOUR)) AS slot
         FROM g GROUP BY 1)
       SELECT e.event_type, e.slot, g.value, coalesce(g.n, 0) AS n FROM e LEFT JOIN g
       ON e.event_type = g.event_type AND e.slot = g.slot""",
)
def ts_regularize(spark, d):
    events = table(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    return series.regularize(series.to_grid(events, "event_type", "ts", "value", "hour"), "event_type", "hour")


@query(
    "ts_panel_pairs",
    "slot:d category:s adjusted:f5 unadjusted:f5",
    f"""WITH {DAILY}, a AS (SELECT *, avg(value / n) OVER (PARTITION BY event_type ORDER BY slot
          ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS adjusted FROM s)
        SELECT slot, event_type AS category, adjusted, value / n AS unadjusted FROM a""",
)
def ts_panel_pairs(spark, d):
    """A wide daily panel (7-day mean and raw mean per event type) taken apart into pairs."""
    week = Window.partitionBy("event_type").orderBy("slot").rowsBetween(-6, 0)
    daily = _daily(spark, d).withColumn("rate", F.col("value") / F.col("n"))
    smooth = daily.withColumn("smooth", F.avg("rate").over(week))
    kinds = relational.found_levels(table(spark, d, "events"), "event_type")
    wide = smooth.groupBy("slot").agg(
        *[F.max(F.when(F.col("event_type") == k, F.col("smooth"))).alias(f"sa_{k}") for k in kinds],
        *[F.max(F.when(F.col("event_type") == k, F.col("rate"))).alias(f"nsa_{k}") for k in kinds],
    )
    return series.panel_pairs(wide, "slot", kinds)


@query(
    "text_terms",
    "doc_id:i position:i term:s start:i",
    r"""WITH c AS (SELECT doc_id, regexp_extract_all(text, '[^\p{L}]*\p{L}+') AS p FROM documents),
       u AS (SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS position FROM c),
       o AS (SELECT *, regexp_extract(piece, '\p{L}+') AS t, sum(length(piece)) OVER
         (PARTITION BY doc_id ORDER BY position) AS upto FROM u)
       SELECT doc_id, position, lower(t) AS term, upto - length(t) + 1 AS start FROM o""",
)
def text_terms(spark, d):
    return text.terms(table(spark, d, "documents"), "doc_id", "text")


@query(
    "text_spell",
    "term:s parent:s parent_n:i",
    r"""WITH t AS (SELECT unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM documents),
       c AS (SELECT term, count(*) AS n FROM t GROUP BY 1),
       v AS (SELECT term, n, i, left(term, i - 1) || substr(term, i + 1) AS shorter,
         left(term, i - 1) || '_' || substr(term, i + 1) AS hole
         FROM (SELECT term, n, unnest(range(1, length(term) + 1)) AS i FROM c WHERE n <= 2 OR n >= 50)),
       r AS (SELECT * FROM v WHERE n <= 2), f AS (SELECT * FROM v WHERE n >= 50),
       p AS (SELECT r.term, f.term AS parent, f.n AS parent_n FROM r JOIN f ON r.hole = f.hole
         UNION SELECT r.term, c.term, c.n FROM r JOIN c ON r.shorter = c.term AND c.n >= 50
         UNION SELECT c.term, f.term, f.n FROM f JOIN c ON f.shorter = c.term AND c.n <= 2)
       SELECT * FROM p QUALIFY row_number() OVER (PARTITION BY term ORDER BY parent_n DESC, parent) = 1""",
)
def text_spell(spark, d):
    counts = text.term_counts(table(spark, d, "documents"), "text")
    return text.spelling(counts, rare=2, frequent=50)


@query(
    "text_name_correct",
    "p_partkey:i word_lev:i word_rev:s",
    """WITH w AS (SELECT p_partkey, split_part(p_name, ' ', 1) AS word FROM part)
       SELECT p_partkey, levenshtein(lower(word), 'smal') AS word_lev,
       CASE WHEN levenshtein(lower(word), 'smal') <= 2 THEN 'smal' ELSE word END AS word_rev FROM w""",
)
def text_name_correct(spark, d):
    words = table(spark, d, "part").select("p_partkey", F.split_part("p_name", F.lit(" "), F.lit(1)).alias("word"))
    return text.correct_name(words, "word", "smal")


@query(
    "text_mask_spans",
    "doc_id:i masked:s",
    """WITH s AS (SELECT doc_id, text, least(5, length(text)) AS e1, 11 AS s2, least(20, length(text)) AS e2
         FROM documents)
       SELECT doc_id, repeat('*', e1) || CASE WHEN length(text) >= 11
         THEN substr(text, 6, 5) || repeat('*', e2 - 10) || substr(text, e2 + 1)
         ELSE substr(text, e1 + 1) END AS masked FROM s""",
)
def text_mask_spans(spark, d):
    """Annotations arrive as JSON spans; here 1-5 and 11-20 of every text."""
    spans = json.dumps([{"start": 1, "end": 5}, {"start": 11, "end": 20}])
    return table(spark, d, "documents").select(
        "doc_id", text.mask_spans(F.col("text"), F.lit(spans)).alias("masked")
    )


def _mask_sql(x: str) -> str:
    for name, pattern in text.ENTITY_PATTERNS:
        x = f"regexp_replace({x}, '{pattern}', '[{name}]', 'g')"
    return x


@query(
    "text_mask_pii",
    "doc_id:i masked:s",
    f"SELECT doc_id, {_mask_sql('text')} AS masked FROM documents",
)
def text_mask_pii(spark, d):
    return table(spark, d, "documents").select("doc_id", text.mask_entities("text").alias("masked"))


SYSTEM = "Summarize the driver at fault and the damage to each vehicle. Return valid JSON only."


def offline_client(message: str) -> str:
    """A stand-in endpoint: names the first two words of the user text as vehicles."""
    body = json.loads(message)[1]["content"]
    words = body.split()[:2]
    if len(words) < 2:
        raise ValueError("nothing to summarize")
    return json.dumps(
        {"driver_at_fault": words[:1], "vehicles_involved": words, "damage_to_each_vehicle": ["front", "rear"]},
        ensure_ascii=False,
    )


def _replies(spark, d):
    rows = table(spark, d, "conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("call_id"), "text"
    )
    return text.map_model(rows, "call_id", "text", SYSTEM, offline_client, "offline", ["offline"], first_wait=0.0)


_WORDS = r"""w AS (SELECT conv_id * 1000 + turn AS call_id, text,
   list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '') AS words FROM conversations)"""


@query(
    "llm_map",
    "call_id:i reply:s",
    f"""WITH {_WORDS} SELECT call_id, CASE WHEN text IS NULL OR text = '' THEN '' WHEN len(words) < 2 THEN
        '{{"driver_at_fault": "ERROR", "vehicles_involved": "ERROR", "damage_to_each_vehicle": "ERROR"}}'
        ELSE '{{"driver_at_fault": [' || to_json(words[1]) || '], "vehicles_involved": [' || to_json(words[1]) || ', ' ||
        to_json(words[2]) || '], "damage_to_each_vehicle": ["front", "rear"]}}' END AS reply FROM w""",
)
def llm_map(spark, d):
    return _replies(spark, d)


@query(
    "llm_prompt",
    "conv_id:i turn:i prompt:s",
    f"""SELECT conv_id, turn, '[{{"role":"system","content":"{SYSTEM}"}},{{"role":"user","content":' ||
        to_json(coalesce(text, '')) || '}}]' AS prompt FROM conversations""",
)
def llm_prompt(spark, d):
    return table(spark, d, "conversations").select("conv_id", "turn", text.prompt(SYSTEM, "text").alias("prompt"))


@query(
    "llm_parse",
    "call_id:i bad:b driver:s pos:i vehicle:s damage:s",
    f"""WITH {_WORDS} SELECT call_id, len(words) < 2 AS bad, CASE WHEN len(words) >= 2 THEN words[1] END AS driver,
        CASE WHEN len(words) >= 2 THEN i END AS pos, CASE WHEN len(words) >= 2 THEN words[i + 1] END AS vehicle,
        CASE WHEN len(words) >= 2 THEN CASE i WHEN 0 THEN 'front' ELSE 'rear' END END AS damage
        FROM w, (VALUES (0), (1)) AS t(i) WHERE len(words) >= 2 OR i = 0""",
)
def llm_parse(spark, d):
    return text.parse_replies(_replies(spark, d), "call_id", "reply")


@query(
    "text_summary",
    "o_orderkey:i summary:s",
    """SELECT o_orderkey, 'Order ' || o_orderkey || ' of customer ' || o_custkey || ' is in state ' || o_orderstatus ||
       ' with priority ' || o_orderpriority || '.' AS summary FROM orders""",
)
def text_summary(spark, d):
    sentence = F.format_string(
        "Order %d of customer %d is in state %s with priority %s.",
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
    )
    return table(spark, d, "orders").select("o_orderkey", sentence.alias("summary"))
