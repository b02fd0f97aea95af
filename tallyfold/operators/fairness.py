"""Group fairness of a binary classifier, all sensitive variables in one job."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.assess import fit_columns, has_score, safe_ratio, same, score_curve
from tallyfold.operators.ranking import rank_by_value
from tallyfold.session import cut_lineage

BY = ["bias_var", "level"]

METRICS = [
    "tpr", "fpr", "tnr", "fnr", "fdr", "acc", "c", "f1", "gini", "miscevent", "miscevent_ks", "mce",
    "ase", "rase", "mcll", "max_ks", "cutoff_ks", "gain", "lift", "resp", "cumresp", "cumlift",
    "into_event", "predicted_event", "p0", "p1",
]


def by_level(df: DataFrame, sensitive: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """One row per (row, sensitive variable): bias_var and its level as text."""
    pairs = [F.struct(F.lit(s).alias("bias_var"), F.col(s).cast("string").alias("level")) for s in sensitive]
    return df.select(*keep, F.inline(F.array(*pairs)))


def group_metrics(
    df: DataFrame, key: str, y: str, p: str, sensitive: Sequence[str], event_level: int, cut: float = 0.5
) -> DataFrame:
    """Counts, rates, ranking and fit measures per level of each sensitive variable.

    `event_level` says which class (1 or 0) counts as the event; `p` is always P(y = 1).
    Lift measures are those of the top two of 20 bins (10 % depth). Rows without a score are
    counted as n_missing and take part in nothing else.
    """
    if event_level not in (0, 1):
        raise ValueError("event_level is 0 or 1")
    event = F.col(y) if event_level == 1 else 1 - F.col(y)
    prob = F.col(p) if event_level == 1 else 1 - F.col(p)
    narrow = cut_lineage(df.select(key, event.alias("_y"), prob.alias("_p"), *sensitive))
    rows = by_level(narrow, sensitive, [key, "_y", "_p"])

    said, is_event = F.col("_p") >= cut, F.col("_y") == 1
    counts = rows.groupBy(*BY).agg(
        F.count_if(said & is_event).alias("tp"),
        F.count_if(said & ~is_event).alias("fp"),
        F.count_if(~said & ~is_event).alias("tn"),
        F.count_if(~said & is_event).alias("fn"),
        F.avg("_p").alias("predicted_event"),
        *fit_columns("_y", "_p", cut),
    )

    curve = score_curve(rows, "_y", "_p", BY)
    w = Window.partitionBy(*BY)
    below = F.col("c0") - F.col("n0") + 0.5 * F.col("n0")
    totals = curve.groupBy(*BY).agg(
        F.sum("n1").alias("_t1"),
        F.sum("n0").alias("_t0"),
        F.sum(F.col("n1").cast("double") * below).alias("_area"),
    )
    tp, fp = F.col("_t1") - F.col("c1") + F.col("n1"), F.col("_t0") - F.col("c0") + F.col("n0")
    ks = F.round(safe_ratio(tp, F.col("_t1")) - safe_ratio(fp, F.col("_t0")), 12)
    wrong = safe_ratio(F.col("_t1") - tp + fp, F.col("_t1") + F.col("_t0"))
    peaks = (
        same(curve, totals, BY)
        .groupBy(*BY, "_t1", "_t0", "_area")
        .agg(F.max(F.struct(ks.alias("ks"), (-F.col("p")).alias("at"), wrong.alias("wrong"))).alias("_k"))
        .select(
            *BY,
            safe_ratio(F.col("_area"), F.col("_t1").cast("double") * F.col("_t0")).alias("c"),
            F.col("_k.ks").alias("max_ks"),
            F.col("_k.wrong").alias("miscevent_ks"),
        )
    )

    ranked = rank_by_value(has_score(rows, "_p"), "_p", key, BY, rank="_rank", total="_total", stored=True)
    size = F.ceil(F.col("_total") / 20)
    top = ranked.groupBy(*BY).agg(
        F.sum(F.when((F.col("_rank") > size) & (F.col("_rank") <= 2 * size), F.col("_y")).otherwise(0)).alias("_e2"),
        F.sum(F.when(F.col("_rank") <= 2 * size, F.col("_y")).otherwise(0)).alias("_e12"),
    )

    out = same(same(counts, peaks, BY), top, BY)
    tp, fp, tn, fn, n = (F.col(c) for c in ("tp", "fp", "tn", "fn", "n"))
    tpr, fpr = safe_ratio(tp, tp + fn), safe_ratio(fp, fp + tn)
    resp, cumresp = safe_ratio(100.0 * F.col("_e2"), tp + fn), safe_ratio(100.0 * F.col("_e12"), tp + fn)
    mine, other = ("p1", "p0") if event_level == 1 else ("p0", "p1")
    return out.withColumns(
        {
            "tpr": tpr,
            "fpr": fpr,
            "tnr": safe_ratio(tn, fp + tn),
            "fnr": safe_ratio(fn, tp + fn),
            "fdr": safe_ratio(fp, tp + fp),
            "acc": safe_ratio(tp + tn, n),
            "f1": safe_ratio(2.0 * tp, 2 * tp + fp + fn),
            "gini": 2.0 * F.col("c") - 1.0,
            "miscevent": F.col("mce"),
            "cutoff_ks": tpr - fpr,
            "into_event": safe_ratio(tp + fp, n),
            "resp": resp,
            "cumresp": cumresp,
            "lift": resp / 5.0,
            "cumlift": cumresp / 10.0,
            "gain": cumresp / 10.0 - 1.0,
            mine: F.col("predicted_event"),
            other: 1.0 - F.col("predicted_event"),
        }
    ).select(*BY, "n", "n_missing", "tp", "fp", "tn", "fn", *METRICS)


def _long(metrics: DataFrame) -> DataFrame:
    return metrics.unpivot(BY, METRICS, "metric", "value").filter("value IS NOT NULL")


def max_differences(metrics: DataFrame) -> DataFrame:
    """Per metric and variable: largest difference, base = larger group, compare = smaller."""
    high = F.max_by(F.struct("value", "level"), F.struct(F.round("value", 12), F.col("level")))
    low = F.min_by(F.struct("value", "level"), F.struct(F.round("value", 12), F.col("level")))
    grouped = _long(metrics).groupBy("bias_var", "metric").agg(high.alias("_h"), low.alias("_l"))
    return grouped.select(
        "bias_var",
        "metric",
        (F.col("_h.value") - F.col("_l.value")).alias("value"),
        F.col("_h.level").alias("base"),
        F.col("_l.level").alias("compare"),
    )


def bias_metrics(metrics: DataFrame) -> DataFrame:
    """Demographic parity, predictive parity, equal accuracy, equal opportunity, equalized odds."""

    def spread(c: str) -> Column:
        return F.max(c) - F.min(c)

    ranges = metrics.groupBy("bias_var").agg(
        spread("into_event").alias("DemographicParity"),
        spread("predicted_event").alias("PredictiveParity"),
        spread("acc").alias("EqualAccuracy"),
        spread("tpr").alias("EqualOpportunity"),
        spread("fpr").alias("_fpr"),
    )
    wide = ranges.withColumn("EqualizedOdds", F.greatest("EqualOpportunity", "_fpr"))
    note = F.when(
        F.col("_fpr") > F.col("EqualOpportunity"), "Max FPR difference is greater than max TPR difference."
    ).otherwise("Max TPR difference is greater than max FPR difference.")
    names = ["DemographicParity", "PredictiveParity", "EqualAccuracy", "EqualOpportunity", "EqualizedOdds"]
    long = wide.withColumn("_note", note).unpivot(["bias_var", "_note"], names, "metric", "value")
    return long.select(
        "bias_var",
        "metric",
        "value",
        F.when(F.col("metric") == "EqualizedOdds", F.col("_note")).otherwise("").alias("note"),
    )


def regression_groups(df: DataFrame, actual: str, predicted: str, sensitive: Sequence[str]) -> DataFrame:
    """Mean actual, mean prediction and RMSE per level."""
    rows = by_level(df.select(actual, predicted, *sensitive), sensitive, [actual, predicted])
    error = F.col(actual) - F.col(predicted)
    return rows.groupBy(*BY).agg(
        F.count("*").alias("n"),
        F.avg(actual).alias("mean_actual"),
        F.avg(predicted).alias("mean_predicted"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def mitigate(
    df: DataFrame,
    y: str,
    group: str,
    fit_score: Callable[[DataFrame, str, str], DataFrame],
    cut: float = 0.5,
    learning_rate: float = 0.01,
    max_iters: int = 10,
    tolerance: float = 0.005,
    bound: float = 100.0,
) -> tuple[DataFrame, list[dict]]:
    """Exponentiated-gradient reduction towards demographic parity.

    Each round relabels and reweights the rows by the current multipliers, refits through
    `fit_score(rows, label, weight) -> rows with p`, and raises the multipliers of groups
    that are called too often or too rarely. The answer averages the rounds' scores. The
    driver holds two numbers per group and round.
    """
    sizes = {r[group]: r["n"] for r in df.groupBy(group).agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    theta = {(g, s): 0.0 for g in sizes for s in (1, -1)}
    trail: list[dict] = []
    scores: list[Column] = []
    current = df
    for step in range(max_iters):
        norm = 1.0 + sum(math.exp(v) for v in theta.values())
        lam = {k: bound * math.exp(v) / norm for k, v in theta.items()}
        signed = {g: lam[g, 1] - lam[g, -1] for g in sizes}
        everyone = sum(signed.values())
        push = F.coalesce(
            *[F.when(F.col(group) == g, float(signed[g] * total / n - everyone)) for g, n in sizes.items()]
        )
        cost = (1.0 - 2.0 * F.col(y)) + push
        rows = current.withColumns(
            {"_label": (cost < 0).cast("double"), "_weight": F.greatest(F.abs(cost), F.lit(1e-6))}
        )
        current = fit_score(rows, "_label", "_weight").withColumnRenamed("p", f"_p{step}").drop("_label", "_weight")
        scores.append(F.col(f"_p{step}"))
        mean = sum(scores[1:], scores[0]) / float(len(scores))
        rates = current.groupBy(group).agg(F.avg((mean >= cut).cast("double")).alias("rate"))
        called = {r[group]: r["rate"] for r in rates.collect()}
        overall = sum(called[g] * n for g, n in sizes.items()) / total
        gap = max(called.values()) - min(called.values())
        trail.append({"iteration": step + 1, "demographic_parity": gap})
        if gap <= tolerance:
            break
        for g in sizes:
            off = called[g] - overall
            theta[g, 1] += learning_rate * off * total / sizes[g]
            theta[g, -1] -= learning_rate * off * total / sizes[g]
    mean = sum(scores[1:], scores[0]) / float(len(scores))
    return current.withColumn("p", mean).select(*df.columns, "p"), trail
