"""Assessment of scored tables.

Conventions: `y` is 0/1 with 1 the event, `p` the event probability at full precision.
Ties in a ranking are broken by the row key. A row without a score takes part in no measure;
`fit_columns` counts such rows as n_missing. Every function takes `by`, so partitions,
periods and groups are assessed in one job.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyfold.operators.ranking import order_statistics, rank_by_value, running_totals
from tallyfold.session import cut_lineage


def safe_ratio(a: Column, b: Column) -> Column:
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def hit(p: str, cut: float | Column, op: str = ">=") -> Column:
    """Class by cut-off; the comparison is a parameter."""
    p_ = F.col(p)
    return {">=": p_ >= cut, ">": p_ > cut}[op]


def has_score(df: DataFrame, p: str) -> DataFrame:
    return df.filter(F.col(p).isNotNull())


def confusion(df: DataFrame, y: str, p: str, cut: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    said, event = hit(p, cut), F.col(y) == 1
    return df.groupBy(*by).agg(
        F.count_if(~said & ~event).alias("tn"),
        F.count_if(said & ~event).alias("fp"),
        F.count_if(~said & event).alias("fn"),
        F.count_if(said & event).alias("tp"),
    )


def lift_table(
    df: DataFrame, key: str, y: str, p: str, by: Sequence[str] = (), bins: int = 20, stored: bool = False
) -> DataFrame:
    """Lift by descending score in bins of ceil(N/bins) rows. The ranking is distributed;
    only the at most `bins` rows per group reach the cumulating window."""
    ranked = rank_by_value(has_score(df, p).select(key, y, p, *by), p, key, by, rank="_rank", total="_total", stored=stored)
    size = F.ceil(F.col("_total") / bins)
    cells = ranked.groupBy(*by, F.ceil(F.col("_rank") / size).alias("bin")).agg(
        F.count("*").alias("n"), F.sum(y).alias("events")
    )
    return _lift_columns(cells, by, bins)


def _lift_columns(cells: DataFrame, by: Sequence[str], bins: int) -> DataFrame:
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    upto = w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    step, total = 100.0 / bins, F.sum("events").over(w)
    resp = safe_ratio(100.0 * F.col("events"), total)
    cum = safe_ratio(100.0 * F.sum("events").over(upto), total)
    depth = F.col("bin") * step
    return cells.select(
        *by,
        "bin",
        depth.alias("depth"),
        "n",
        "events",
        resp.alias("resp"),
        cum.alias("cumresp"),
        (resp / step).alias("lift"),
        (cum / depth).alias("cumlift"),
        (cum / depth - 1.0).alias("gain"),
    )


def roc_table(df: DataFrame, y: str, p: str, steps: int = 1000, by: Sequence[str] = ()) -> DataFrame:
    """Counts and rates at the cut-offs 0, 1/steps, ..., 1; an event is called when p >= cut-off.

    Rows collapse to at most steps+1 cells per group first. `ks_flag` marks the best KS.
    """
    event = F.col(y) == 1
    cells = has_score(df, p).groupBy(*by, F.floor(F.col(p) * steps).cast("int").alias("cell")).agg(
        F.count_if(event).alias("_n1"), F.count_if(~event).alias("_n0")
    )
    groups = cells.groupBy(*by).agg(F.sequence(F.lit(0), F.lit(steps)).alias("_all"))
    grid = groups.select(*by, F.explode("_all").alias("cell"))
    on = [grid["cell"] == cells["cell"], *[grid[c].eqNullSafe(cells[c]) for c in by]]
    full = grid.join(cells, on, "left").select(
        *[grid[c] for c in [*by, "cell"]],
        F.coalesce("_n1", F.lit(0)).alias("_n1"),
        F.coalesce("_n0", F.lit(0)).alias("_n0"),
    )
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    above = w.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    tp, fp = F.sum("_n1").over(above), F.sum("_n0").over(above)
    counts = full.select(
        *by,
        "cell",
        tp.alias("tp"),
        fp.alias("fp"),
        (F.sum("_n1").over(w) - tp).alias("fn"),
        (F.sum("_n0").over(w) - fp).alias("tn"),
    )
    tpr = safe_ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    fpr = safe_ratio(F.col("fp"), F.col("fp") + F.col("tn"))
    rates = counts.withColumns(
        {
            "cutoff": F.col("cell") / F.lit(float(steps)),
            "sensitivity": tpr,
            "fpr": fpr,
            "accuracy": safe_ratio(F.col("tp") + F.col("tn"), F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")),
            "ks": F.round(tpr - fpr, 12),
        }
    )
    best = F.row_number().over(w.orderBy(F.desc("ks"), "cell"))
    return rates.withColumn("ks_flag", (best == 1).cast("int")).drop("cell")


def score_curve(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """(by, p, n1, n0, c1, c0): class counts per distinct score and cumulated upwards.

    A score shared by many rows is one row here. The counts are written once: their quantiles
    cut them into even buckets, then the windows run inside a bucket.
    """
    event = F.col(y) == 1
    counts = has_score(df, p).groupBy(*by, F.col(p).alias("p")).agg(
        F.count_if(event).alias("n1"), F.count_if(~event).alias("n0")
    )
    return running_totals(cut_lineage(counts), "p", {"c1": "n1", "c0": "n0"}, by)


def auc(df: DataFrame, y: str, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC (ties count half) and Gini."""
    below = (F.col("c0") - F.col("n0")) + 0.5 * F.col("n0")
    area = F.sum(F.col("n1").cast("double") * below) / F.nullif(
        F.sum("n1").cast("double") * F.sum("n0").cast("double"), F.lit(0.0)
    )
    out = score_curve(df, y, p, by).groupBy(*by).agg(area.alias("auc"))
    return out.withColumn("gini", 2.0 * F.col("auc") - 1.0)


def best_ks(df: DataFrame, y: str, p: str, steps: int = 1000, by: Sequence[str] = ()) -> DataFrame:
    return roc_table(df, y, p, steps, by).filter("ks_flag = 1").select(*by, "cutoff", "ks", "sensitivity", "fpr")


def class_report(df: DataFrame, y: str, p: str, cut: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means."""
    c = confusion(df, y, p, cut)
    rows = c.select(
        F.inline(
            F.array(
                F.struct(F.lit("0").alias("label"), F.col("tn").alias("hit"), (F.col("tn") + F.col("fn")).alias("said"), (F.col("tn") + F.col("fp")).alias("support")),
                F.struct(F.lit("1").alias("label"), F.col("tp").alias("hit"), (F.col("tp") + F.col("fp")).alias("said"), (F.col("tp") + F.col("fn")).alias("support")),
            )
        )
    )
    precision = F.coalesce(safe_ratio(F.col("hit"), F.col("said")), F.lit(0.0))
    recall = F.coalesce(safe_ratio(F.col("hit"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(safe_ratio(2.0 * F.col("hit"), F.col("said") + F.col("support")), F.lit(0.0))
    per_class = rows.select(
        "label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
    )
    measures = ["precision", "recall", "f1"]
    macro = per_class.agg(*[F.avg(m).alias(m) for m in measures], F.sum("support").alias("support"))
    weighted = per_class.agg(
        *[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m) for m in measures],
        F.sum("support").alias("support"),
    )
    return (
        per_class.unionByName(macro.withColumn("label", F.lit("macro")))
        .unionByName(weighted.withColumn("label", F.lit("weighted")))
    )


def accuracy(df: DataFrame, y: str, p: str, cut: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    right = (hit(p, cut) == (F.col(y) == 1)).cast("double")
    return df.groupBy(*by).agg(F.count(p).alias("n"), F.avg(right).alias("accuracy"))


def fit_columns(y: str, p: str, cut: float = 0.5) -> list[Column]:
    """Aggregates over the scored rows: rows, events, ASE, RASE, log loss, misclassification;
    and the number of rows without a score."""
    y_, p_ = F.col(y), F.col(p)
    held = F.greatest(F.least(p_, F.lit(1 - 1e-15)), F.lit(1e-15))
    # least and greatest skip NULL, so a missing score is ruled out by name.
    loss = -F.when(p_.isNull(), None).when(y_ == 1, F.ln(held)).otherwise(F.ln(1 - held))
    square = (y_ - p_) * (y_ - p_)
    return [
        F.count(p_).alias("n"),
        F.count_if(p_.isNull()).alias("n_missing"),
        F.sum(F.when(p_.isNotNull(), y_)).alias("events"),
        F.avg(square).alias("ase"),
        F.sqrt(F.avg(square)).alias("rase"),
        F.avg(loss).alias("mcll"),
        F.avg((hit(p, cut) != (y_ == 1)).cast("double")).alias("mce"),
    ]


def fit_stats(df: DataFrame, y: str, p: str, cut: float = 0.5, by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(*fit_columns(y, p, cut))


def same(a: DataFrame, b: DataFrame, by: Sequence[str]) -> DataFrame:
    """Join two per-group results; a group without scores has only the first."""
    return a.join(b.withColumnsRenamed({c: f"_{c}" for c in by}), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by], "left").drop(
        *[f"_{c}" for c in by]
    )


def assess_groups(df: DataFrame, key: str, y: str, p: str, by: Sequence[str]) -> DataFrame:
    """Fit statistics, AUC, Gini, best KS and top-bin lift per group.

    The four columns they share are written once; five passes read them.
    """
    df = cut_lineage(df.select(key, y, p, *by))
    lift = lift_table(df, key, y, p, by, stored=True).filter("bin = 1").select(*by, F.col("lift").alias("lift_top"))
    ks = best_ks(df, y, p, by=by).select(*by, "ks", F.col("cutoff").alias("ks_cutoff"))
    out = fit_stats(df, y, p, by=by)
    for other in (auc(df, y, p, by), ks, lift):
        out = same(out, other, by)
    return out


def regression_fit(
    df: DataFrame, y: str, pred: str, weight: str | None = None, power: float = 1.8
) -> DataFrame:
    """MAE, MSE, RMSE, mean Tweedie deviance (1 < power < 2), its D2 and the absolute-error D2."""
    y_, m = F.col(y).cast("double"), F.col(pred).cast("double")
    w = F.col(weight).cast("double") if weight else F.lit(1.0)
    n = df.agg(F.count(y_).alias("n")).first()["n"]
    median = order_statistics(df, y, [(n + 1) // 2])[(n + 1) // 2] if n else None
    base = df.agg(
        F.struct((F.sum(w * y_) / F.sum(w)).alias("mean"), F.lit(median).cast("double").alias("median")).alias("b")
    ).scalar()

    def deviance(mu: Column) -> Column:
        a, b = 1.0 - power, 2.0 - power
        return 2.0 * (F.pow(y_, F.lit(b)) / (a * b) - y_ * F.pow(mu, F.lit(a)) / a + F.pow(mu, F.lit(b)) / b)

    def mean(x: Column) -> Column:
        return F.sum(w * x) / F.sum(w)

    return df.withColumn("_b", base).agg(
        mean(F.abs(y_ - m)).alias("mae"),
        mean((y_ - m) * (y_ - m)).alias("mse"),
        F.sqrt(mean((y_ - m) * (y_ - m))).alias("rmse"),
        mean(deviance(m)).alias("tweedie_deviance"),
        (1.0 - mean(deviance(m)) / mean(deviance(F.col("_b.mean")))).alias("d2_tweedie"),
        (1.0 - mean(F.abs(y_ - m)) / mean(F.abs(y_ - F.col("_b.median")))).alias("d2_absolute"),
    )


def odds_ratios(df: DataFrame, coefs: Mapping[str, float]) -> DataFrame:
    """exp(coefficient) per unit and per standard deviation of each input."""
    parts = [
        F.struct(
            F.lit(c).alias("variable"),
            F.lit(float(b)).alias("coefficient"),
            F.exp(F.lit(float(b))).alias("odds_ratio"),
            F.exp(F.lit(float(b)) * F.stddev_samp(c)).alias("odds_ratio_per_std"),
        )
        for c, b in coefs.items()
    ]
    return df.agg(F.array(*parts).alias("_o")).select(F.inline("_o"))


def fold_frequencies(df: DataFrame, fold: str, y: str, p: str) -> DataFrame:
    """Misclassification table: rows by fold, rounded prediction and |y - prediction|."""
    said = F.round(F.col(p), 0).cast("int")
    return df.groupBy(fold, said.alias("predicted"), F.abs(F.col(y) - said).alias("wrong")).agg(
        F.count("*").alias("n")
    )
