"""Queries on aggregation, distributions, windows, sorting and sampling."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfold.operators import ranking, sampling, stats
from tallyfold.operators.relational import wide_to_long
from tallyfold.operators.series import difference
from tallyfold.plans.registry import query
from tallyfold.plans.views import FEATURES, LOANS, SCORED, loans, scored, table, uniform_sql

NUMERIC = ["event", *FEATURES]


@query("agg_count", "n:i", "SELECT count(*) AS n FROM lineitem")
def agg_count(spark, d):
    return table(spark, d, "lineitem").agg(F.count("*").alias("n"))


@query(
    "freq_oneway",
    "o_orderpriority:s count:i percent:f6 cum_count:i cum_percent:f6",
    """SELECT o_orderpriority, n AS count, 100.0 * n / sum(n) OVER () AS percent,
       sum(n) OVER (ORDER BY o_orderpriority) AS cum_count,
       100.0 * sum(n) OVER (ORDER BY o_orderpriority) / sum(n) OVER () AS cum_percent
       FROM (SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1)""",
)
def freq_oneway(spark, d):
    return stats.one_way(table(spark, d, "orders"), "o_orderpriority")


@query(
    "freq_crosstab_by",
    "part:i segment:s event:i count:i",
    f"WITH {SCORED} SELECT part, segment, event, count(*) AS count FROM scored GROUP BY 1, 2, 3",
)
def freq_crosstab_by(spark, d):
    return stats.crosstab_by(scored(spark, d), "part", "segment", "event")


@query(
    "stats_simple",
    "variable:s n:i mean:f6 std:f6 sum:f4 min:f6 max:f6",
    f"WITH {LOANS} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS n, avg({c}) AS mean, stddev_samp({c}) AS std, "
        f"sum({c}) AS sum, min({c}) AS min, max({c}) AS max FROM loans"
        for c in NUMERIC
    ),
)
def stats_simple(spark, d):
    return stats.simple_stats(loans(spark, d), NUMERIC)


def normal_cdf_sql(x: str) -> str:
    t = f"(1 / (1 + 0.3275911 * abs(({x}) / sqrt(2))))"
    poly = (
        f"((((1.061405429 * {t} - 1.453152027) * {t} + 1.421413741) * {t} - 0.284496736) * {t}"
        f" + 0.254829592) * {t}"
    )
    return f"(0.5 * (1 + sign({x}) * (1 - {poly} * exp(-(({x}) * ({x})) / 2))))"


_PAIRS = [(a, b) for a in NUMERIC for b in NUMERIC]


@query(
    "stats_corr",
    "variable:s with_variable:s r:f6 n:i p_value:f5",
    # All correlations in one pass over the view, which is joined once.
    f"WITH {LOANS}, k AS MATERIALIZED (SELECT count(*) AS n, "
    + ", ".join((f"corr({a}, {b})" if a != b else "CAST(1 AS DOUBLE)") + f" AS r{i}" for i, (a, b) in enumerate(_PAIRS))
    + " FROM loans), c AS ("
    + " UNION ALL ".join(f"SELECT '{a}' AS variable, '{b}' AS with_variable, r{i} AS r, n FROM k" for i, (a, b) in enumerate(_PAIRS))
    + "), t AS MATERIALIZED (SELECT *, CASE WHEN variable <> with_variable THEN"
    " atan(abs(r) / sqrt(1 - r * r)) END AS angle FROM c),"
    # P(|T| <= t) is the integral of cos(u)^(n-3) from 0 to atan(t / sqrt(n-2)), over that to pi/2.
    " area AS (SELECT variable, with_variable,"
    " sum(CASE WHEN i IN (0, 4000) THEN 0.5 ELSE 1 END * pow(cos(angle * i / 4000), n - 3)) * angle AS part,"
    " sum(CASE WHEN i IN (0, 4000) THEN 0.5 ELSE 1 END * pow(abs(cos(pi() / 2 * i / 4000)), n - 3)) * pi() / 2 AS whole"
    " FROM t, range(4001) AS g(i) GROUP BY variable, with_variable, angle)"
    " SELECT t.variable, t.with_variable, r, n, 1 - part / whole AS p_value"
    " FROM t JOIN area ON t.variable = area.variable AND t.with_variable = area.with_variable",
)
def stats_corr(spark, d):
    return stats.correlations(loans(spark, d), NUMERIC)


@query(
    "agg_mean_abs",
    "variable:s mean_abs:f6",
    f"WITH {LOANS} "
    + " UNION ALL ".join(f"SELECT '{c}' AS variable, avg(abs({c})) AS mean_abs FROM loans" for c in FEATURES),
)
def agg_mean_abs(spark, d):
    return stats.mean_abs(wide_to_long(loans(spark, d), [], FEATURES), "variable", "value")


def _bin_sql(x: str, bins: int, lo: str = "lo", hi: str = "hi") -> str:
    return f"least(CAST(floor(({x} - {lo}) / (({hi} - {lo}) / {bins}.0::DOUBLE)) AS BIGINT), {bins - 1})"


@query(
    "agg_hist2d",
    "segment:s bin:i count:i",
    f"""WITH {LOANS}, r AS (SELECT min(amount) AS lo, max(amount) AS hi FROM loans)
        SELECT segment, {_bin_sql('amount', 25)} AS bin, count(*) AS count FROM loans, r GROUP BY 1, 2""",
)
def agg_hist2d(spark, d):
    return stats.histogram_2d(loans(spark, d), "amount", "segment", 25)


@query(
    "agg_hist",
    "bin:i count:i low:f2 high:f2",
    f"""WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders)
        SELECT {_bin_sql('o_totalprice', 50)} AS bin, count(*) AS count, min(o_totalprice) AS low,
        max(o_totalprice) AS high FROM orders, r GROUP BY 1""",
)
def agg_hist(spark, d):
    return stats.histogram(table(spark, d, "orders"), "o_totalprice", 50)


@query(
    "agg_kde",
    "point:i x:f2 density:f9",
    f"""WITH r AS (SELECT min(o_totalprice) AS lo, max(o_totalprice) AS hi FROM orders),
        h AS (SELECT {_bin_sql('o_totalprice', 200)} AS bin, lo, hi, count(*) AS n
              FROM orders, r GROUP BY 1, 2, 3),
        m AS (SELECT lo + (bin + 0.5) * (hi - lo) / 200 AS mid, lo, hi, n FROM h),
        g AS (SELECT point, lo + point * (hi - lo) / 49 AS x, mid, n FROM m, range(50) AS t(point))
        SELECT point, x, sum(n * exp(-0.5 * ((x - mid) / 15000) * ((x - mid) / 15000))
          / CAST(37599.424119465 AS DOUBLE)) / sum(n) AS density FROM g GROUP BY 1, 2""",
)
def agg_kde(spark, d):
    return stats.kernel_density(table(spark, d, "orders"), "o_totalprice", bandwidth=15000.0)


@query(
    "stats_edf_ks",
    "ks_d:f9 kuiper_v:f9 cramer_von_mises:f6 n_a:i n_b:i",
    f"""WITH {SCORED}, v AS (SELECT amount AS x, count(*) FILTER (event = 1) AS na,
          count(*) FILTER (event = 0) AS nb FROM scored GROUP BY 1),
        c AS (SELECT na, nb, sum(na) OVER (ORDER BY x) AS ca, sum(nb) OVER (ORDER BY x) AS cb,
          sum(na) OVER () AS ta, sum(nb) OVER () AS tb FROM v),
        f AS (SELECT *, ca / CAST(ta AS DOUBLE) - cb / CAST(tb AS DOUBLE) AS diff FROM c)
        SELECT max(abs(diff)) AS ks_d, greatest(max(diff), 0) + greatest(max(-diff), 0) AS kuiper_v,
        sum(diff * diff * (na + nb) * (ta::DOUBLE * tb) / ((ta + tb)::DOUBLE * (ta + tb))) AS cramer_von_mises,
        max(ta) AS n_a, max(tb) AS n_b FROM f""",
)
def stats_edf_ks(spark, d):
    return stats.edf_tests(loans(spark, d), "amount", "event", 1, 0)


_PROFILED = {"p_partkey": "bigint", "p_brand": "string", "p_size": "int", "p_retailprice": "double"}


def _profile_sql(c: str, kind: str) -> str:
    x = f"CAST({c} AS DOUBLE)" if kind != "string" else "CAST(NULL AS DOUBLE)"
    skew = (
        f"(SELECT avg(z * z * z) FROM (SELECT ({c} - m) / s AS z FROM part, "
        f"(SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM part)))"
        if kind != "string"
        else "CAST(NULL AS DOUBLE)"
    )
    return (
        f"SELECT '{c}' AS variable, '{kind}' AS type, count(*) AS rows, count(*) - count({c}) AS missing, "
        f"count(DISTINCT {c}) AS \"distinct\", avg({x}) AS mean, stddev_samp({x}) AS std, "
        f"{skew} AS skewness, kurtosis_pop({x}) AS kurtosis FROM part"
    )


@query(
    "profile_columns",
    "variable:s type:s rows:i missing:i distinct:i mean:f6 std:f6 skewness:f6 kurtosis:f6",
    " UNION ALL ".join(_profile_sql(c, kind) for c, kind in _PROFILED.items()),
)
def profile_columns(spark, d):
    return stats.profile(table(spark, d, "part"), list(_PROFILED), exact_distinct=True)


@query(
    "agg_weighted_claims",
    "segment:s observed:f3 predicted:f3 difference:f3 relative:f6",
    f"""WITH {SCORED}, t AS (SELECT segment, sum(qty * event) AS observed, sum(qty * p) AS predicted
          FROM scored GROUP BY 1)
        SELECT *, predicted - observed AS difference, (predicted - observed) / observed AS relative FROM t""",
)
def agg_weighted_claims(spark, d):
    return stats.weighted_claims(scored(spark, d), "qty", "event", "p", ["segment"])


@query(
    "profile_model_card",
    "event:i variable:s level:s n:i mean:f6 std:f6 min:f6 max:f6 share:f6",
    f"WITH {LOANS}, m AS ("
    + " UNION ALL ".join(
        f"SELECT event, '{c}' AS variable, CAST(NULL AS VARCHAR) AS level, count({c}) AS n, avg({c}) AS mean,"
        f" stddev_samp({c}) AS std, CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max,"
        f" CAST(NULL AS DOUBLE) AS share FROM loans GROUP BY 1"
        for c in FEATURES
    )
    + "), k AS ("
    + " UNION ALL ".join(
        f"SELECT event, '{c}' AS variable, CAST({c} AS VARCHAR) AS level, count(*) AS n FROM loans GROUP BY 1, 3"
        for c in ("segment", "priority")
    )
    + """) SELECT * FROM m UNION ALL SELECT event, variable, level, n, NULL, NULL, NULL, NULL,
         n / CAST(sum(n) OVER (PARTITION BY event, variable) AS DOUBLE) FROM k""",
)
def profile_model_card(spark, d):
    return stats.card_profile(loans(spark, d), FEATURES, ["segment", "priority"], "event")


@query(
    "win_row_number",
    "o_orderkey:i row_number:i total:i",
    """SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS row_number,
       count(*) OVER () AS total FROM orders""",
)
def win_row_number(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return ranking.rank_by_value(orders, "o_totalprice", "o_orderkey", rank="row_number", stored=True)


@query(
    "win_diff",
    "event_type:s day:d total:f4 diff1:f4 diff7:f4 diff1_7:f4",
    """WITH s AS (SELECT event_type, CAST(ts AS DATE) AS day, sum(value) AS total FROM events GROUP BY 1, 2),
       a AS (SELECT s.*, s.total - b.total AS diff1, s.total - c.total AS diff7 FROM s
             LEFT JOIN s b ON b.event_type = s.event_type AND b.day = s.day - 1
             LEFT JOIN s c ON c.event_type = s.event_type AND c.day = s.day - 7)
       SELECT a.*, a.diff1 - b.diff1 AS diff1_7 FROM a
       LEFT JOIN a b ON b.event_type = a.event_type AND b.day = a.day - 7""",
)
def win_diff(spark, d):
    """Lag and seasonal differences of daily series; the window sees one row per day."""
    daily = table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(
        F.sum("value").alias("total")
    )
    once = difference(daily, "event_type", "day", "total", [1], "diff1")
    seasonal = difference(once, "event_type", "day", "total", [7], "diff7")
    return difference(seasonal, "event_type", "day", "total", [1, 7], "diff1_7")


@query(
    "win_running_best",
    "day:d best:f2 best_so_far:f2 improved:b",
    """WITH s AS (SELECT CAST(o_orderdate AS DATE) AS day, max(o_totalprice) AS best FROM orders GROUP BY 1),
       r AS (SELECT *, max(best) OVER (ORDER BY day) AS best_so_far,
         max(best) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM s)
       SELECT day, best, best_so_far, coalesce(best > before, true) AS improved FROM r""",
)
def win_running_best(spark, d):
    """Incumbent trajectory. Orders collapse to days before the ordered window."""
    daily = table(spark, d, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(
        F.max("o_totalprice").alias("best")
    )
    w = Window.partitionBy(F.lit(0)).orderBy("day")
    before = F.max("best").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return daily.select(
        "day",
        "best",
        F.max("best").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("best_so_far"),
        F.coalesce(F.col("best") > before, F.lit(True)).alias("improved"),
    )


@query(
    "topk_fetch",
    "o_orderkey:i o_totalprice:f2",
    "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 5",
)
def topk_fetch(spark, d):
    return (
        table(spark, d, "orders")
        .select("o_orderkey", "o_totalprice")
        .orderBy(F.desc("o_totalprice"), "o_orderkey")
        .limit(5)
    )


@query(
    "sample_srs",
    "account_id:i amount:f2",
    f"""WITH {LOANS} SELECT account_id, amount FROM loans
        ORDER BY {uniform_sql('account_id', 12345)}, account_id LIMIT 500""",
)
def sample_srs(spark, d):
    return sampling.simple_random_sample(loans(spark, d).select("account_id", "amount"), "account_id", 500, 12345)


def _ranked_sql(table_sql: str, key: str, seed, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    return (
        f"SELECT *, row_number() OVER ({part} ORDER BY {uniform_sql(key, seed)}, CAST({key} AS VARCHAR)) AS rnk,"
        f" count(*) OVER ({part}) AS total FROM {table_sql}"
    )


@query(
    "split_exact",
    "o_orderkey:i analytic_partition:i",
    f"""SELECT o_orderkey, CASE WHEN rnk <= round(total * 0.6) THEN 1
          WHEN rnk <= round(total * 0.6) + round(total * 0.3) THEN 0 ELSE 2 END AS analytic_partition
        FROM ({_ranked_sql('orders', 'o_orderkey', 10)})""",
)
def split_exact(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey")
    return sampling.split_exact(orders, "o_orderkey", seed=10)


@query(
    "split_hash",
    "o_orderkey:i analytic_partition:i",
    f"""SELECT o_orderkey, CASE WHEN u < 0.6 THEN 1 WHEN u < 0.9 THEN 0 ELSE 2 END AS analytic_partition
        FROM (SELECT o_orderkey, {uniform_sql('o_orderkey', 10)} AS u FROM orders)""",
)
def split_hash(spark, d):
    return sampling.split_by_hash(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 10)


@query(
    "split_partind",
    "part_ind:i n:i total:f2",
    f"""SELECT CASE WHEN rnk <= round(total * 0.3) THEN 1
          WHEN rnk <= round(total * 0.3) + round(total * 0.6) THEN 2 ELSE 0 END AS part_ind,
          count(*) AS n, sum(o_totalprice) AS total
        FROM ({_ranked_sql('orders', 'o_orderkey', 10)}) GROUP BY 1""",
)
def split_partind(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    coded = sampling.split_exact(orders, "o_orderkey", 10, ((1, 0.3), (2, 0.6), (0, 0.1)), "part_ind")
    return coded.groupBy("part_ind").agg(F.count("*").alias("n"), F.sum("o_totalprice").alias("total"))


@query(
    "sample_kfold",
    "o_orderkey:i fold:i",
    f"""SELECT o_orderkey, ceil(rnk * 10 / CAST(total AS DOUBLE)) AS fold
        FROM ({_ranked_sql('orders', 'o_orderkey', 3)})""",
)
def sample_kfold(spark, d):
    return sampling.kfold(table(spark, d, "orders").select("o_orderkey"), "o_orderkey", 10, seed=3)


@query(
    "sample_oversample",
    "account_id:i event:i freq:f6",
    f"""WITH {LOANS}, r AS ({_ranked_sql('loans', 'account_id', 5, 'event')}),
        s AS (SELECT *, round(0.9 * sum(event) OVER ()) AS kept, count(*) OVER () - sum(event) OVER () AS n0 FROM r),
        z AS (SELECT *, CASE WHEN event = 1 THEN kept ELSE least(kept, n0) END AS size FROM s)
        SELECT account_id, event, total / CAST(size AS DOUBLE) AS freq FROM z WHERE rnk <= size""",
)
def sample_oversample(spark, d):
    rows = loans(spark, d).select("account_id", "event")
    return sampling.oversample(rows, "account_id", "event", 1, seed=5)


@query(
    "sample_balboot",
    "account_id:i event:i replicate:i copies:i",
    f"""WITH {LOANS}, c AS (SELECT account_id, event, account_id || '#' || r AS k
          FROM loans, range(1, 11) AS t(r)),
        b AS (SELECT account_id, event, ceil(rnk * 10 / CAST(total AS DOUBLE)) AS replicate
          FROM ({_ranked_sql('c', 'k', 5, 'event')}))
        SELECT account_id, event, replicate, count(*) AS copies FROM b GROUP BY 1, 2, 3""",
)
def sample_balboot(spark, d):
    rows = loans(spark, d).select("account_id", "event")
    boot = sampling.balanced_bootstrap(rows, "account_id", "event", reps=10, seed=5)
    return boot.groupBy("account_id", "event", "replicate").agg(F.count("*").alias("copies"))


@query(
    "sample_strata_n",
    "o_orderkey:i o_orderstatus:s",
    f"""SELECT o_orderkey, o_orderstatus FROM ({_ranked_sql('orders', 'o_orderkey', 9, 'o_orderstatus')})
        WHERE rnk <= CASE o_orderstatus WHEN 'F' THEN 8 WHEN 'O' THEN 12 ELSE 20 END""",
)
def sample_strata_n(spark, d):
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.stratified_n(orders, "o_orderkey", "o_orderstatus", {"F": 8, "O": 12, "P": 20}, seed=9)
