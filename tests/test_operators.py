"""Properties and brute-force checks on small generated tables."""

from __future__ import annotations

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyfold.functions import scalar as fn
from tallyfold.operators import (
    assess,
    explain,
    fairness,
    matching,
    models,
    prep,
    ranking,
    relational,
    rules,
    sampling,
    scoring,
    series,
    stats,
    synth,
    text,
)
from tallyfold.sources import io


@pytest.fixture(scope="module")
def skewed(spark):
    """3000 rows; a third share one score, and one group holds two thirds."""
    df = spark.range(3000).select(
        F.col("id").alias("key"),
        F.when(F.col("id") % 3 == 0, 0.25).otherwise(F.round(fn.hash_uniform("id", 1), 9)).alias("p"),
        (fn.hash_uniform("id", 2) < 0.3).cast("int").alias("y"),
        F.when(F.col("id") % 3 < 2, "big").when(F.col("id") % 2 == 0, "small").alias("g"),
    )
    return df.cache()


def test_rank_by_value_equals_window(skewed):
    ranked = ranking.rank_by_value(skewed, "p", "key", by=["g"])
    w = Window.partitionBy("g").orderBy(F.desc("p"), "key")
    plain = skewed.withColumn("want", F.row_number().over(w))
    joined = ranked.join(plain.select("key", "want"), "key")
    assert joined.count() == 3000
    assert joined.filter("rank <> want").count() == 0
    assert ranked.filter("g IS NULL").count() == skewed.filter("g IS NULL").count() > 0


def test_rank_by_hash_equals_window(skewed):
    ranked = ranking.rank_by_hash(skewed, "key", 5, by=["g"])
    w = Window.partitionBy("g").orderBy(fn.hash_int("key", 5), F.col("key").cast("string"))
    plain = skewed.select("key", F.row_number().over(w).alias("want"))
    assert ranked.join(plain, "key").filter("rank <> want").count() == 0


def test_running_totals_equal_window(skewed):
    counts = skewed.groupBy("g", "p").agg(F.sum("y").alias("n"))
    got = ranking.running_totals(counts, "p", {"c": "n"}, ["g"])
    w = Window.partitionBy("g").orderBy("p").rowsBetween(Window.unboundedPreceding, 0)
    assert got.withColumn("want", F.sum("n").over(w)).filter("c <> want").count() == 0
    assert got.count() == counts.count()


def test_hot_value_gets_its_own_bucket():
    splits, hot = ranking.quantile_splits([1.0, 2.0, 2.0, 2.0, 3.0])
    assert splits == [-math.inf, 1.0, 2.0, math.nextafter(2.0, math.inf), 3.0, math.inf]
    assert [splits[h] for h in hot] == [2.0]


def test_lift_ends_at_one(skewed):
    rows = assess.lift_table(skewed, "key", "y", "p").orderBy("bin").collect()
    assert len(rows) == 20 and sum(r["n"] for r in rows) == 3000
    assert rows[-1]["cumlift"] == pytest.approx(1.0) and rows[-1]["cumresp"] == pytest.approx(100.0)


def test_auc_equals_pair_count(spark, skewed):
    some = skewed.limit(300).collect()
    pos, neg = [r["p"] for r in some if r["y"]], [r["p"] for r in some if not r["y"]]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    small = spark.createDataFrame(some)
    got = assess.auc(small, "y", "p").first()
    assert got["auc"] == pytest.approx(want) and got["gini"] == pytest.approx(2 * want - 1)


def test_group_metric_identities(skewed):
    m = fairness.group_metrics(skewed, "key", "y", "p", ["g"], event_level=1).collect()
    assert sum(r["n"] for r in m) == 3000
    for r in m:
        assert r["tpr"] + r["fnr"] == pytest.approx(1) and r["acc"] + r["mce"] == pytest.approx(1)
        assert r["gini"] == pytest.approx(2 * r["c"] - 1) and r["rase"] == pytest.approx(math.sqrt(r["ase"]))
        assert r["gain"] == pytest.approx(r["cumlift"] - 1) and r["cutoff_ks"] == pytest.approx(r["tpr"] - r["fpr"])
        assert r["max_ks"] >= r["cutoff_ks"] - 1e-9


def test_event_level_is_mirrored(skewed):
    one = fairness.group_metrics(skewed, "key", "y", "p", ["g"], event_level=1).filter("level = 'big'").first()
    zero = fairness.group_metrics(skewed, "key", "y", "p", ["g"], event_level=0).filter("level = 'big'").first()
    assert zero["predicted_event"] == pytest.approx(one["p0"]) and zero["c"] == pytest.approx(one["c"])


def test_max_difference_orders_groups(skewed):
    m = fairness.group_metrics(skewed, "key", "y", "p", ["g"], event_level=1)
    by = {r["level"]: r for r in m.collect()}
    for r in fairness.max_differences(m).collect():
        assert r["value"] == pytest.approx(by[r["base"]][r["metric"]] - by[r["compare"]][r["metric"]])
        assert r["value"] >= 0


def test_partition_counts():
    # Recorded partition sizes of a 15351-row table.
    assert sampling.split_counts(15351, [0.3, 0.6, 0.1]) == [4605, 9211, 1535]


@pytest.mark.parametrize("n", [1, 7, 100, 1535])
def test_split_keeps_every_row(spark, n):
    got = sampling.split_exact(spark.range(n), "id", 3).groupBy("analytic_partition").count().collect()
    sizes = {r["analytic_partition"]: r["count"] for r in got}
    train, validate, test = sampling.split_counts(n, [0.6, 0.3, 0.1])
    assert (sizes.get(1, 0), sizes.get(0, 0), sizes.get(2, 0)) == (train, validate, test)


def test_folds_and_bootstrap_are_balanced(skewed):
    folds = [r["count"] for r in sampling.kfold(skewed, "key", 7, 1).groupBy("fold").count().collect()]
    assert len(folds) == 7 and sum(folds) == 3000 and max(folds) - min(folds) <= 1
    boot = sampling.balanced_bootstrap(skewed, "key", "g", 4, 1)
    assert {r["count"] for r in boot.groupBy("key").count().collect()} == {4}
    per = boot.groupBy("g", "replicate").count().groupBy("g").agg(F.countDistinct("count").alias("d")).collect()
    assert all(r["d"] == 1 for r in per)


def test_oversample_reaches_the_share(skewed):
    got = sampling.oversample(skewed, "key", "y", 1, 3).groupBy("y").agg(F.count("*").alias("n"), F.first("freq").alias("f"))
    rows = {r["y"]: r for r in got.collect()}
    events = skewed.filter("y = 1").count()
    assert rows[1]["n"] == rows[0]["n"] == round(0.9 * events)
    assert rows[1]["n"] * rows[1]["f"] == pytest.approx(events)


def test_normal_cdf(spark):
    xs = [-6.0, -1.96, -0.5, 0.0, 0.5, 1.0, 3.0]
    df = spark.createDataFrame([(x,) for x in xs], "x double").select("x", fn.normal_cdf("x").alias("c"))
    for r in df.collect():
        assert r["c"] == pytest.approx(0.5 * math.erfc(-r["x"] / math.sqrt(2)), abs=2e-7)


def test_black_scholes_guards_its_domain(spark):
    rows = [(200.0, 0.5, 15.0, 5.0, 1.0, 1.0), (1.0, 0.0, 15.0, 5.0, 1.0, 1.0), (1.0, 0.5, 15.0, 5.0, 0.0, 1.0)]
    names = ["n", "v", "k", "s", "t", "r"]
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in names))
    got = [r[0] for r in df.select(fn.black_scholes(*names)).collect()]
    d1 = (math.log(5 / 15) + 1.125) / 0.5
    cdf = lambda x: 0.5 * math.erfc(-x / math.sqrt(2))
    assert got[0] == pytest.approx(200 * (cdf(d1) * 5 - cdf(d1 - 0.5) * 15 * math.exp(-1)), abs=1e-3)
    assert got[1] is None and got[2] is None


def test_running_sum_of_long_and_short_arrays(spark):
    lengths = [[], [3], list(range(40)), [1] * 1000]
    df = spark.createDataFrame([(a,) for a in lengths], "a array<int>")
    got = [r[0] for r in df.select(fn.running_sum(F.col("a"))).collect()]
    assert got == [[sum(a[:i]) for i in range(len(a))] for a in lengths]


def test_terms_have_exact_offsets(spark):
    body = "  Été, the 2nd\ncafé-bar! " * 30 + "..."
    df = spark.createDataFrame([(1, body), (2, "12 34"), (3, "")], "id int, t string")
    rows = text.terms(df, "id", "t").collect()
    assert rows and all(r["id"] == 1 for r in rows)
    for r in rows:
        assert body[r["start"] - 1 : r["start"] - 1 + len(r["term"])].lower() == r["term"]


def test_near_pairs_are_complete(spark):
    rng = random.Random(3)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(60)})
    df = spark.createDataFrame([(w,) for w in words], "w string")
    pairs = df.select(F.col("w").alias("x")).join(df.select(F.col("w").alias("y")), F.levenshtein("x", "y") <= 2)
    want = {tuple(r) for r in pairs.collect()}
    got = {(r["a"], r["b"]) for r in matching.near_pairs(df, "w", df, "w", 2).collect()}
    assert got == want


def _edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("k", [0, 1, 2, 3])
def test_near_pairs_of_short_and_repetitive_texts(spark, k):
    """All lengths from none, runs of equal characters, shared ends, a right side without some lengths."""
    draw = random.Random(k)
    words = sorted({"".join(draw.choice("ab1") for _ in range(n)) for n in range(7) for _ in range(12)})
    for left, right in ((words, words[::2]), ([f"xxa{w}é" for w in words], [f"xxa{w}é" for w in words if len(w) in (0, 5)])):
        a, b = (spark.createDataFrame([(w,) for w in [*side, None]], "w string") for side in (left, right))
        got = [(r["a"], r["b"], r["distance"]) for r in matching.near_pairs(a, "w", b, "w", k).collect()]
        want = {(x, y, _edits(x, y)) for x in left for y in right if _edits(x, y) <= k}
        assert len(got) == len(set(got)) and set(got) == want


def test_near_pairs_bring_no_far_texts_of_one_length_together(spark):
    """Numbers that differ in up to four digits share what is left after two deletions; they are not compared."""
    numbers = spark.range(1000).select(F.format_string("%04d", F.col("id") * 7 % 10000).alias("a"))
    met = matching._met(numbers, numbers.withColumnRenamed("a", "b"), 2)
    assert met.filter(F.levenshtein("a", "b") > 2).count() == 0


def test_entity_chains_are_followed(spark):
    # 0-1-2-...-19 linked alternately by rule a and rule b: one long chain, one hot value, one loner.
    rows = [(i, f"a{i // 2}", f"b{(i + 1) // 2}") for i in range(20)]
    rows += [(100 + i, "hot", f"x{i}") for i in range(50)] + [(999, None, None)]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    got = {r["id"]: r["cluster_id"] for r in matching.resolve_entities(df, "id", [["a"], ["b"]]).collect()}
    assert all(got[i] == 0 for i in range(20))
    assert all(got[100 + i] == 100 for i in range(50)) and got[999] == 999


def test_mask_spans(spark):
    spans = json.dumps([{"start": 3, "end": 4}, {"start": 1, "end": 1}, {"start": 8, "end": 99}, {"start": 20, "end": 22}])
    df = spark.createDataFrame([("abcdefghij", spans), ("abc", None)], "t string, s string")
    got = [r[0] for r in df.select(text.mask_spans(F.col("t"), F.col("s"))).collect()]
    assert got == ["*b**efg***", "abc"]


def test_retry_then_answer_then_error():
    calls = []

    def busy_twice(message):
        calls.append(message)
        if len(calls) < 3:
            raise text.Busy
        return "fine"

    assert text.call_with_retry(busy_twice, "m", first_wait=0.0) == "fine" and len(calls) == 3
    def always(message):
        raise text.Busy

    assert json.loads(text.call_with_retry(always, "m", first_wait=0.0))["driver_at_fault"] == "ERROR"


def test_model_calls_check_the_deployment(spark):
    df = spark.createDataFrame([(1, "x"), (2, "")], "id int, t string")
    with pytest.raises(ValueError):
        text.map_model(df, "id", "t", "s", str, "other", ["known"])
    got = {r["id"]: r["reply"] for r in text.map_model(df, "id", "t", "s", lambda m: "ok", "known", ["known"], 2).collect()}
    assert got == {1: "ok", 2: ""}


def test_broken_replies_are_bad_rows(spark):
    good = json.dumps({"driver_at_fault": ["A"], "vehicles_involved": ["v1", "v2"], "damage_to_each_vehicle": ["d1", "d2"]})
    df = spark.createDataFrame([(1, good), (2, "{oops"), (3, "")], "id int, r string")
    rows = text.parse_replies(df, "id", "r").orderBy("id", "pos").collect()
    assert [(r["id"], r["bad"], r["vehicle"], r["damage"]) for r in rows] == [
        (1, False, "v1", "d1"), (1, False, "v2", "d2"), (2, True, None, None), (3, True, None, None),
    ]


def test_rules_agree_with_an_interpreter(spark):
    rng = random.Random(1)
    rows = [
        (i, rng.choice([None, 500, 620, 621, 700, 800]), rng.choice([None, 10.0, 100.0, 101.0]),
         rng.choice([1000.0, 5000.0, 150000.0, 200000.0]), 2600.0, rng.choice(["TRUE", "false", None]))
        for i in range(200)
    ]
    schema = (
        "id int, orig_credit_score int, orig_debt_to_income double, orig_amount double, orig_net_worth double, rel string"
    )
    out = rules.decide_loan(spark.createDataFrame(rows, schema), "rel").collect()

    def want(score, dti, amount, rel):
        s, r = score if score is not None else math.inf, dti if dti is not None else -math.inf
        if s <= 620 or r > 100 or amount >= 200000 or amount < 5000:
            return "deny"
        if score is None or dti is None:
            return "deny"
        low, high = (720, 30) if rel == "TRUE" else (680, 40)
        return "approve" if score >= low and dti <= high else "deny"

    for got, r in zip(sorted(out, key=lambda x: x["id"]), rows, strict=True):
        assert got["loan_decision"] == want(r[1], r[2], r[3], r[5]), r
        assert got["MonthlyIncome"] == pytest.approx(100.0)


def test_rule_tables_are_read(spark):
    head = {"ruleset_id": "1", "rule_id": "r1", "rule_nm": "n1", "rule_seq_no": "1", "conditional": "if", "record_rule_fired_flag": "Y"}
    rows = [
        {**head, "lhs_term": "x", "expression": ">= 3", "expression_type": "CONDITION", "expression_order": "1"},
        {**head, "lhs_term": "", "expression": "y = x/2", "expression_type": "ACTION", "expression_order": "1"},
    ]
    out = rules.apply_rules(spark.createDataFrame([(2.0,), (4.0,)], "x double"), rules.read_rules(rows)).collect()
    assert [(r["y"], r["rules_fired"]) for r in out] == [(None, []), (2.0, ["n1"])]
    with pytest.raises(ValueError):
        rules.apply_rules(out and spark.range(1), [rules.Rule("bad", then=[("x", "1; drop table t")])])


def test_stored_rule_sets_come_back_in_any_row_order(spark):
    sets = {"a": rules.SCREENING, "b": rules.CURRENT_CUSTOMER}
    rows = [rules.rule_rows(spark, name, given) for name, given in sets.items()]
    stored = rows[0].unionByName(rows[1]).orderBy("expression", F.desc("rule_id"))
    for name, given in sets.items():
        back = rules.stored_rules(stored, name)
        assert [(r.name, r.chain, list(r.when), list(r.then), r.record) for r in back] == [
            (r.name, r.chain, list(r.when), list(r.then), r.record) for r in given
        ]
    with pytest.raises(ValueError):
        rules.stored_rules(stored, "c")


def test_shapley_adds_up(spark):
    df = spark.range(60).select(
        "id", *[(fn.hash_uniform("id", i) * 4 - 2).alias(c) for i, c in enumerate("abc")]
    )
    score = lambda x: fn.logistic(sum((x[c] * b for c, b in zip("abc", (1.0, -2.0, 0.5), strict=True) if c in x), F.lit(0.1)))
    wide = explain.shapley(df, "id", score, list("abc"), 10, 1)
    perm = explain.shapley(df, "id", score, list("abc"), 10, 1, permutations=3)
    for got in (wide, perm):
        both = got.join(df.select("id", score({c: F.col(c) for c in "abc"}).alias("p")), "id")
        assert both.filter("abs(intercept + a + b + c - p) > 1e-9").count() == 0


def test_reshape_round_trip(spark):
    wide = spark.createDataFrame([(1, 1.0, 2.0), (2, 3.0, 4.0)], "id int, a double, b double")
    long = relational.wide_to_long(wide, ["id"], ["a", "b"])
    back = relational.long_to_wide(long, "id", "variable", "value", ["a", "b"])
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, wide.collect()))


def test_stored_tables_are_promoted_copied_and_replaced(spark):
    spark.range(10).selectExpr("id", "CAST(id % 2 AS string) AS k").createOrReplaceTempView("tallyfold_view")
    io.drop_table(spark, "tallyfold_kept")
    first = io.promote_table(spark, "tallyfold_view", "tallyfold_kept")
    with pytest.raises(ValueError, match="already stored"):
        io.promote_table(spark, "tallyfold_view", "tallyfold_kept")
    assert spark.newSession().table("tallyfold_kept").count() == 10
    copied = io.copy_table(spark, "tallyfold_kept", "tallyfold_copy", ["k"], "id > 6")
    assert copied.columns == ["k"] and copied.count() == 3
    with pytest.raises(ValueError, match="already stored"):
        io.copy_table(spark, "tallyfold_kept", "tallyfold_copy")
    again = io.replace_table(spark.table("tallyfold_kept").filter("id < 4"), "tallyfold_kept", ["k"])
    assert (again.count(), first.count(), copied.count()) == (4, 10, 3)
    assert dict(again.dtypes) == {"id": "bigint", "k": "string"}
    broken = spark.table("tallyfold_kept").withColumn("id", F.raise_error(F.lit("stop")).cast("bigint"))
    with pytest.raises(Exception, match="stop"):
        io.replace_table(broken, "tallyfold_kept")
    assert spark.table("tallyfold_kept").count() == 4
    assert io.copy_table(spark, "tallyfold_kept", "tallyfold_copy", where="id < 0", replace=True).count() == 0
    assert io.drop_table(spark, "tallyfold_kept") and io.drop_table(spark, "tallyfold_copy") and not io.drop_table(spark, "tallyfold_copy")


def test_pivots_find_their_levels(spark):
    rows = [(1, "a", 1.0), (1, "b", 2.0), (2, "b", None), (2, "c", 3.0), (3, None, 4.0), (None, "a", 5.0)]
    df = spark.createDataFrame(rows, "id int, variable string, value double")
    wide = relational.long_to_wide(df, "id", "variable", "value")
    assert wide.columns == ["id", "a", "b", "c"]
    want = {(1, 1.0, 2.0, None), (2, None, None, 3.0), (3, None, None, None), (None, 5.0, None, None)}
    assert set(map(tuple, wide.collect())) == want
    maps = {r["id"]: r["levels"] for r in relational.long_to_map(df, "id", "variable", "value").collect()}
    assert maps == {1: {"a": 1.0, "b": 2.0}, 2: {"b": None, "c": 3.0}, 3: {}, None: {"a": 5.0}}
    again = relational.long_to_map(df.union(df.selectExpr("id", "variable", "value + 1")), "id", "variable", "value")
    assert again.filter("id = 1").first()["levels"] == {"a": 2.0, "b": 3.0}
    assert relational.long_to_wide(df.limit(0), "id", "variable", "value").columns == ["id"]
    assert relational.long_to_map(df.limit(0), "id", "variable", "value").count() == 0
    with pytest.raises(ValueError, match="more than 2 levels"):
        relational.found_levels(df, "variable", 2)
    many = spark.range(5000).selectExpr("CAST(id % 2 AS int) AS id", "CAST(id AS string) AS variable", "CAST(id AS double) AS value")
    assert [len(r["levels"]) for r in relational.long_to_map(many, "id", "variable", "value").collect()] == [2500, 2500]


def test_a_sixth_event_type_appears(spark, tmp_path):
    from tallyfold.plans.catalogue import REGISTRY

    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    more = events.limit(50).withColumn("event_type", F.lit("refund"))
    events.unionByName(more).write.parquet(str(tmp_path / "events.parquet"))
    wide = REGISTRY["pivot_id"].run(spark, str(tmp_path))
    assert len(wide.columns) == 7 and wide.filter("refund IS NOT NULL").count() == more.select("user_id").distinct().count()
    assert REGISTRY["pivot_map"].run(spark, str(tmp_path)).filter("event_type = 'refund'").count() > 0
    assert REGISTRY["ts_panel_pairs"].run(spark, str(tmp_path)).filter("category = 'refund'").count() > 0


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert sorted(str(r[0]) for r in relational.delete_where(df, F.col("x") != 1).collect()) == ["1", "None"]


def test_logit_recovers_coefficients(spark):
    df = spark.range(20000).select(
        (fn.hash_uniform("id", 1) * 4 - 2).alias("a"), (fn.hash_uniform("id", 2) * 4 - 2).alias("b"), "id"
    )
    df = df.withColumn("y", (fn.hash_uniform("id", 3) < fn.logistic(0.5 + F.col("a") - 2 * F.col("b"))).cast("int")).cache()
    model = models.logit(df, ["a", "b"], "y")
    b = models.coefficients(model, ["a", "b"])
    assert b["a"] == pytest.approx(1.0, abs=0.1) and b["b"] == pytest.approx(-2.0, abs=0.15)
    penal = models.coefficients(models.logit(df, ["a", "b"], "y", c=1e-4), ["a", "b"])
    assert abs(penal["b"]) < abs(b["b"]) * 0.9


def test_exported_trees_equal_the_model(spark):
    df = spark.range(2000).select(
        (fn.hash_uniform("id", 1) * 4).alias("a"), (fn.hash_uniform("id", 2) * 4).alias("b"), "id"
    )
    df = df.withColumn("y", (F.col("a") * F.col("b") > 3).cast("int"))
    model = models.boosted_trees(df, ["a", "b"], "y", trees=4, depth=3)
    both = models.probability(model, df).withColumn("q", scoring.boosted_probability(scoring.flat_trees(model, df, ["a", "b"])))
    assert both.filter("abs(p - q) > 1e-8").count() == 0
    assert assess.auc(both, "y", "p").first()["auc"] > 0.95


def test_mitigation_lowers_parity_gap(spark):
    df = spark.range(4000).select(
        "id", (fn.hash_uniform("id", 1) * 4 - 2).alias("a"), (F.col("id") % 2).cast("string").alias("g")
    )
    shifted = F.col("a") + F.when(F.col("g") == "1", 0.7).otherwise(-0.7)
    df = df.withColumn("a", shifted).withColumn("y", (fn.hash_uniform("id", 2) < fn.logistic(F.col("a"))).cast("int"))
    df = df.withColumn("gi", F.col("g").cast("int")).cache()

    def fit_score(rows, label, weight):
        return models.probability(models.logit(rows, ["a", "gi"], label, weight=weight, tol=1e-6), rows)

    out, trail = fairness.mitigate(df, "y", "g", fit_score, learning_rate=0.02, max_iters=5)
    assert trail[-1]["demographic_parity"] < trail[0]["demographic_parity"]
    assert out.count() == 4000 and "p" in out.columns


def test_airline_fit_finds_the_moving_average():
    rng = np.random.default_rng(1)
    e, s = rng.normal(0, 0.05, 700), 7
    w = e.copy()
    w[1:] -= 0.5 * e[:-1]
    w[s:] -= 0.4 * e[:-s]
    w[s + 1 :] += 0.2 * e[: -s - 1]
    d = list(w[: s + 1])
    for x in w[s + 1 :]:
        d.append(d[-s] + x)
    theta, seasonal, _, ahead = series.airline_one(np.exp(np.cumsum(d) * 0.1), s, 3)
    assert theta == pytest.approx(0.5, abs=0.15) and seasonal == pytest.approx(0.4, abs=0.15)
    assert len(ahead) == 3 and np.isfinite(ahead).all()


def test_quantile_edges_interpolate(spark):
    xs = [float(x * x) for x in range(101)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    edges = prep.quantile_edges(df, ["x"], 4)["x"]
    assert edges == pytest.approx([625.0, 2500.0, 5625.0])
    assert edges == pytest.approx(list(np.quantile(xs, [0.25, 0.5, 0.75])))


def test_exact_edges_equal_sketch_edges_on_small_tables(skewed):
    for interpolate in (True, False):
        sketch = prep.quantile_edges(skewed, ["p", "key"], 7, interpolate)
        exact = prep.quantile_edges(skewed, ["p", "key"], 7, interpolate, exact=True)
        for column, edges in exact.items():
            assert sketch[column] == pytest.approx(edges)


def test_smote_stays_between_neighbours(spark):
    df = spark.range(200).select(
        "id", F.array(*[fn.hash_uniform("id", i).cast("float") for i in range(4)]).alias("v"), (F.col("id") % 4).cast("int").alias("label")
    )
    made = synth.smote(df, "id", "v", "label", 1, per_row=2, neighbours=3)
    rows, source = made.collect(), {r["id"]: r["v"] for r in df.filter("label = 1").collect()}
    assert len(rows) == 100
    for r in rows:
        a, b = source[r["id"]], source[r["neighbour"]]
        for x, lo, hi in zip(r["vector"], a, b, strict=True):
            assert min(lo, hi) - 1e-6 <= x <= max(lo, hi) + 1e-6


def test_files_get_their_folder_as_label(spark, tmp_path):
    for label in ("damage", "no_damage"):
        (tmp_path / "in" / label).mkdir(parents=True)
        (tmp_path / "in" / label / "1.png").write_bytes(b"\x89PNG" + label.encode())
    rows = io.labelled_files(spark, str(tmp_path / "in"), "*.png").orderBy("label").collect()
    assert [(r["label"], r["file"], r["bytes"]) for r in rows] == [("damage", "1.png", 10), ("no_damage", "1.png", 13)]


def test_narratives_skip_headings(spark, tmp_path):
    (tmp_path / "r.txt").write_text('example prompt\n\nreport\n\n"first one"\n\n"second,\nin two lines"\n')
    got = [r[0] for r in io.read_narratives(spark, str(tmp_path / "r.txt")).collect()]
    assert got == ["first one", "second,\nin two lines"]


def test_saved_table_round_trip(spark):
    io.save_table(spark.range(10).withColumn("k", F.col("id") % 2), "tallyfold_saved", ["k"])
    assert spark.table("tallyfold_saved").filter("k = 1").count() == 5
    spark.sql("DROP TABLE tallyfold_saved")


def test_warehouse_wants_one_request(spark):
    with pytest.raises(ValueError):
        io.read_warehouse(spark, "jdbc:none", table="t", sql="select 1")


def test_edf_tests_against_direct_sums(spark, skewed):
    rows = skewed.filter("g IS NOT NULL").collect()
    a = sorted(r["p"] for r in rows if r["y"] == 1)
    b = sorted(r["p"] for r in rows if r["y"] == 0)
    f = lambda s, x: np.searchsorted(s, x, side="right") / len(s)
    d = np.array([f(a, x) - f(b, x) for x in sorted(set(a) | set(b))])
    got = stats.edf_tests(skewed.filter("g IS NOT NULL"), "p", "y", 1, 0).first()
    assert got["ks_d"] == pytest.approx(np.abs(d).max()) and got["kuiper_v"] == pytest.approx(max(d.max(), 0) + max(-d.min(), 0))


def test_rank_keeps_rows_without_a_value(spark):
    rows = [(k, None if k % 4 == 0 else k / 100.0) for k in range(40)]
    ranked = ranking.rank_by_value(spark.createDataFrame(rows, "key long, p double"), "p", "key").collect()
    assert sorted(r["rank"] for r in ranked) == list(range(1, 41))
    assert all(r["rank"] > 30 for r in ranked if r["p"] is None)


def test_different_records_never_share_a_cluster(spark):
    rows = [("a|b", "c"), ("a", "b|c"), ("a\\", "|c"), ("a", "\\|c"), ("a|b", "c")]
    df = spark.createDataFrame(rows, "x string, y string").withColumn("id", matching.cluster_key(["x", "y"]))
    assert df.select("id").distinct().count() == 4


def test_edges_are_exact_beyond_the_sketch(spark):
    n = 120_000
    df = spark.range(n).select(((F.col("id") * 7919) % n).cast("double").alias("x"))
    want = np.quantile(np.arange(n, dtype=float), [i / 7 for i in range(1, 7)], method="averaged_inverted_cdf")
    got = prep.quantile_edges(df, ["x"], 7)["x"]
    assert max(abs(a - b) for a, b in zip(got, want, strict=True)) <= 1.0


def test_small_groups_do_not_fail(spark):
    short = spark.createDataFrame([("s", t, float(t + 1) ** 1.1) for t in range(4)], "s string, t int, v double")
    assert series.ar1_fit(short, "s", "t", "v").first()["sigma2"] is None
    flat = spark.createDataFrame([(1.0, 0)] * 5, "x double, y int")
    table = prep.woe_table(flat, {"x": [0.5]}, "y", 1).collect()
    assert all(r["woe"] is None for r in table)


def test_lags_follow_the_calendar(spark):
    days = [("s", d, v) for d, v in [("2024-01-02", 1.0), ("2024-01-03", 4.0), ("2024-01-10", 9.0)]]
    df = spark.createDataFrame(days, "s string, d string, v double").withColumn("d", F.to_date("d"))
    once = series.difference(df, "s", "d", "v", [1], "w").orderBy("d").collect()
    assert [r["w"] for r in once] == [None, 3.0, None]
    weekly = series.difference(df, "s", "d", "v", [7], "w").orderBy("d").collect()
    assert [r["w"] for r in weekly] == [None, None, 5.0]


def test_airline_marks_a_series_it_cannot_fit(spark):
    df = spark.createDataFrame([("a", t, -1.0) for t in range(40)], "s string, t int, v double")
    rows = series.airline(df, "s", "t", "v", season=7, lead=3).collect()
    assert len(rows) == 1 and rows[0]["step"] == 0 and rows[0]["forecast"] is None


def test_missing_scores_take_part_in_no_measure(spark):
    rows = [(i, i % 2, None if i % 4 == 0 else (i + 0.5) / 40) for i in range(40)]
    df = spark.createDataFrame(rows, "key int, y int, p double")
    kept = df.filter("p IS NOT NULL")
    fit, want = assess.fit_stats(df, "y", "p").first().asDict(), assess.fit_stats(kept, "y", "p").first().asDict()
    assert fit.pop("n_missing") == 10 and want.pop("n_missing") == 0 and fit == pytest.approx(want)
    assert assess.lift_table(df, "key", "y", "p", bins=4).collect() == assess.lift_table(kept, "key", "y", "p", bins=4).collect()
    assert assess.auc(df, "y", "p").first() == assess.auc(kept, "y", "p").first()


def test_tiny_probabilities_stay_distinct(spark):
    df = spark.createDataFrame([(1, -27.0), (2, -28.0)], "key int, x double")
    p = [r["P_y1"] for r in scoring.score_logit(df, {"x": 1.0}, 0.0, "y").orderBy("key").collect()]
    assert p == pytest.approx([math.exp(-27.0), math.exp(-28.0)], rel=1e-9)


def test_student_tail():
    # df 1 is the Cauchy distribution, df 2 has a closed form.
    for x in (0.0, 0.3, 2.0, 40.0):
        assert stats.beta_share(1 / (1 + x * x), 0.5, 0.5) == pytest.approx(1 - 2 * math.atan(x) / math.pi, abs=1e-12)
        assert stats.beta_share(2 / (2 + x * x), 1.0, 0.5) == pytest.approx(1 - x / math.sqrt(2 + x * x), abs=1e-12)


def test_synthetic_columns_keep_their_missing_share(spark):
    df = spark.range(400).select(
        F.when(F.col("id") % 2 == 0, F.col("id").cast("double")).alias("x"),
        F.when(F.col("id") % 4 > 0, F.lit("a")).alias("c"),
        F.lit(None).cast("double").alias("none"),
    )
    got = synth.synthesize(df, ["c"], ["x", "none"], 4000, seed=1).agg(F.count("x"), F.count("c"), F.count("none")).first()
    assert got[0] == pytest.approx(2000, abs=200) and got[1] == pytest.approx(3000, abs=200) and got[2] == 0


def test_standardize_within_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 10.0), ("b", 30.0), ("c", 5.0)], "g string, x double")
    got = {(r["g"], r["orig_x"]): r["x"] for r in prep.standardize_within(df, ["x"], "g", "orig_").collect()}
    assert got["a", 1.0] == pytest.approx(-(0.5**0.5)) and got["b", 30.0] == pytest.approx(0.5**0.5)
    assert got["c", 5.0] is None
