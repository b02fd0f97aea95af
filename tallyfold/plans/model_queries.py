"""Queries that train. Fits are not comparable across engines row by row; where a fit has a
property that SQL can state, a second query checks it."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from tallyfold.operators import assess, boosting, fairness, models, sampling, scoring, selection
from tallyfold.plans.registry import query
from tallyfold.plans.views import FEATURES, SCORED, scored
from tallyfold.session import cut_lineage

Y = "event"


def _rows(spark, d):
    """The modelling rows, written once: training reads them many times."""
    return _stored(scored(spark, d).select("account_id", Y, *FEATURES, "segment", "priority", "part"))


def _train(spark, d):
    return _rows(spark, d).filter("part = 1")


def _stored(df):
    """Written once for loops that read it many times."""
    return cut_lineage(df)


@query("train_logit_l2", "variable:s coefficient:f6 odds_ratio:f6")
def train_logit_l2(spark, d):
    train = _train(spark, d)
    return models.coefficient_table(train, models.logit(train, FEATURES, Y, c=1.0), FEATURES)


def _observed_sql(y: str) -> str:
    return f"WITH {SCORED} " + " UNION ALL ".join(
        f"SELECT '{n}' AS variable, avg({x} * {y}) AS observed, avg({x} * {y}) AS fitted FROM scored WHERE part = 1"
        for n, x in [("intercept", "1.0::DOUBLE"), *[(c, c) for c in FEATURES]]
    )


@query("train_logit_l2_check", "variable:s observed:f3 fitted:f3", _observed_sql("event"))
def train_logit_l2_check(spark, d):
    """With penalty |b|^2/2 beside c times the loss, sum(x*y) = sum(x*p) + b/c, term by term."""
    train = _train(spark, d)
    model = models.logit(train, FEATURES, Y, c=1.0)
    n, slopes = train.count(), models.coefficients(model, FEATURES)
    held = F.coalesce(*[F.when(F.col("variable") == c, b / n) for c, b in slopes.items()], F.lit(0.0))
    equations = models.score_equations(models.probability(model, train), FEATURES, Y, "p")
    return equations.withColumn("fitted", F.col("fitted") + held)


@query("train_logit_event0_check", "variable:s observed:f3 fitted:f3", _observed_sql("(1 - event)"))
def train_logit_event0_check(spark, d):
    """Modelling event 0 (good credit): P(0) meets the observed share of zeros, term by term."""
    train = _train(spark, d).withColumn("good", 1 - F.col(Y))
    fitted = models.probability(models.logit(train, FEATURES, "good"), train)
    return models.score_equations(fitted, FEATURES, "good", "p")


@query("train_logit_mle", "variable:s coefficient:f6 std_error:f6 p_value:f6")
def train_logit_mle(spark, d):
    """Binomial GLM: coefficients with standard errors and p-values."""
    model = models.glm(_train(spark, d), FEATURES, Y, "binomial").stages[-1]
    summary = model.summary
    rows = list(
        zip(
            [*FEATURES, "intercept"],
            [*(float(x) for x in model.coefficients), float(model.intercept)],
            [float(x) for x in summary.coefficientStandardErrors],
            [float(x) for x in summary.pValues],
            strict=True,
        )
    )
    return spark.createDataFrame(rows, "variable string, coefficient double, std_error double, p_value double")


@query("train_logit_mle_check", "variable:s observed:f3 fitted:f3", _observed_sql("event"))
def train_logit_mle_check(spark, d):
    """At the likelihood maximum the mean of x*p equals the mean of x*y, term by term."""
    train = _train(spark, d)
    fitted = models.probability(models.logit(train, FEATURES, Y), train)
    return models.score_equations(fitted, FEATURES, Y, "p")


def _gbt_report(spark, d, **params):
    rows = _rows(spark, d).withColumn("_validate", F.col("part") == 0)
    used = rows.filter("part < 2")
    model = models.boosted_trees(used, FEATURES, Y, validation="_validate", **params)
    return assess.accuracy(models.probability(model, rows), Y, "p", by=["part"])


@query("train_gbt", "part:i n:i accuracy:f6")
def train_gbt(spark, d):
    return _gbt_report(spark, d)


@query("train_gbt_d3", "part:i n:i accuracy:f6")
def train_gbt_d3(spark, d):
    return _gbt_report(spark, d, depth=3)


def _with_gaps(spark, d):
    """The modelling rows with every fifth net worth missing; part 0 validates."""
    gap = F.when(F.col("account_id") % 5 > 0, F.col("net_worth"))
    rows = scored(spark, d).select("account_id", Y, *FEATURES, "part").withColumn("net_worth", gap)
    return _stored(rows.filter("part < 2").withColumn("validate", F.col("part") == 0))


_GAPS = f"""{SCORED}, gaps AS (SELECT account_id, event, n_lines, qty, avg_disc, amount,
   CASE WHEN account_id % 5 > 0 THEN net_worth END AS net_worth, part FROM scored WHERE part < 2)"""


@query("train_gbt_second_order", "round:i train_loss:f6 valid_loss:f6 train_wrong:f6 valid_wrong:f6 kept:b")
def train_gbt_second_order(spark, d):
    """Depth 3, rate 0.1, 100 rounds, ridge 1; stops when 50 rounds bring no lower validation loss."""
    model = boosting.second_order(_with_gaps(spark, d), FEATURES, Y, "account_id", validation="validate", patience=50)
    return _trail(spark, model)


def _trail(spark, model):
    names = ["train_loss", "valid_loss", "train_wrong", "valid_wrong"]
    rows = [(t["round"], *(t.get(c) for c in names), t["kept"]) for t in model.trail]
    return spark.createDataFrame(rows, "round int, " + ", ".join(f"{c} double" for c in names) + ", kept boolean")


@query(
    "train_gbt_leaves_check",
    "tree:i n:i outside:i",
    f"""WITH {_GAPS} SELECT t.tree, count(*) AS n, 0 AS outside FROM gaps, range(0, 5) AS t(tree) WHERE part = 1 GROUP BY 1""",
)
def train_gbt_leaves_check(spark, d):
    """Every leaf is -rate * G / (H + ridge) of the rows in it: for each tree the rows whose leaf is not."""
    rows = _with_gaps(spark, d)
    trees = boosting.second_order(rows, FEATURES, Y, "account_id", trees=5, validation="validate").trees
    out = None
    for k in range(5):
        before, upto = trees.first(k).margin(), trees.first(k + 1).margin()
        p = 1.0 / (1.0 + F.exp(-F.col("m")))
        at = rows.filter("part = 1").select(Y, before.alias("m"), F.round(upto - before, 9).alias("leaf"))
        sums = at.withColumns({"g": p - F.col(Y), "h": p * (1 - p)}).groupBy("leaf").agg(
            F.sum("g").alias("g"), F.sum("h").alias("h"), F.count("*").alias("rows")
        )
        wrong = F.abs(F.col("leaf") + 0.1 * F.col("g") / (F.col("h") + 1.0)) > 1e-6
        part = sums.agg(
            F.lit(k).alias("tree"), F.sum("rows").alias("n"),
            F.coalesce(F.sum(F.when(wrong, F.col("rows"))), F.lit(0)).alias("outside"),
        )
        out = part if out is None else out.unionByName(part)
    return out


def _stagnant(spark, d):
    """Depth 5, half of the rows a round, 50 bins, leaves of 5; stops after 5 rounds without a lower error."""
    return boosting.second_order(
        _with_gaps(spark, d), FEATURES, Y, "account_id", depth=5, subsample=0.5, bins=50, leaf=5, min_hessian=0.0,
        validation="validate", metric="wrong", patience=5,
    )


@query("train_gbt_stagnation", "round:i train_loss:f6 valid_loss:f6 train_wrong:f6 valid_wrong:f6 kept:b")
def train_gbt_stagnation(spark, d):
    """The errors of every round, and the round that is kept."""
    return _trail(spark, _stagnant(spark, d))


@query(
    "train_gbt_stagnation_check",
    "part:i n:i wrong:i",
    f"WITH {_GAPS} SELECT part, count(*) AS n, 0 AS wrong FROM gaps GROUP BY 1",
)
def train_gbt_stagnation_check(spark, d):
    """The error of the kept round, counted again from the scores: wrong is the difference in rows."""
    model = _stagnant(spark, d)
    kept = next(t for t in model.trail if t["kept"])
    told = F.when(F.col("part") == 1, F.lit(kept["train_wrong"])).otherwise(F.lit(kept["valid_wrong"]))
    missed = (model.probability() >= 0.5) != (F.col(Y) == 1)
    counted = _with_gaps(spark, d).select("part", missed.alias("missed")).groupBy("part").agg(
        F.count("*").alias("n"), F.count_if("missed").alias("missed")
    )
    return counted.select("part", "n", (F.col("missed") - F.round(told * F.col("n"))).alias("wrong"))


@query("train_rf", "part:i n:i accuracy:f6")
def train_rf(spark, d):
    rows = _rows(spark, d)
    model = models.forest(rows.filter("part = 1"), FEATURES, Y, key="account_id")
    return assess.accuracy(models.probability(model, rows), Y, "p", by=["part"])


@query("train_gbt_reg", "mae:f4 rmse:f4 d2_absolute:f6")
def train_gbt_reg(spark, d):
    rows = _rows(spark, d)
    model = models.tree_regression(
        rows.filter("part = 1"), ["n_lines", "avg_disc"], "qty", "boosting", nominal=["segment", "priority"], maxIter=100, stepSize=0.1
    )
    scored_rows = models.prediction(model, rows.filter("part = 0"))
    return assess.regression_fit(scored_rows, "qty", "predicted")


_GLM = ["n_lines", "avg_disc"]


def _glm_report(spark, d, family, **params):
    train = _train(spark, d)
    return models.coefficient_table(train, models.glm(train, _GLM, "qty", family, **params), _GLM)


@query("train_tweedie", "variable:s coefficient:f6 odds_ratio:f6")
def train_tweedie(spark, d):
    """Tweedie, power 1.8, log link, penalty 0.1, weighted by exposure."""
    train = _train(spark, d)
    model = models.penalised_tweedie(train, _GLM, "qty", 0.1, "n_lines")
    return models.coefficient_table(train, model, _GLM)


@query(
    "train_tweedie_penalty_check",
    "variable:s n:i imbalance:f6",
    f"""WITH {SCORED} SELECT variable, count(*) AS n, 0.0::DOUBLE AS imbalance FROM scored,
        (VALUES ('intercept'), ('n_lines'), ('avg_disc')) AS v(variable) WHERE part = 1 GROUP BY 1""",
)
def train_tweedie_penalty_check(spark, d):
    """The penalised score equations hold, term by term."""
    train = _train(spark, d)
    model = models.penalised_tweedie(train, _GLM, "qty", 0.1, "n_lines")
    return models.tweedie_equations(train, _GLM, "qty", "n_lines", model, 0.1)


@query("train_gamma", "variable:s coefficient:f6 odds_ratio:f6")
def train_gamma(spark, d):
    return _glm_report(spark, d, "gamma")


def _fitted_levels(spark, d, family, **params):
    """Fitted mean per level of a 0/1 input: with an intercept and no penalty, any log-link
    family fits the (weighted) mean of each level."""
    train = _train(spark, d).select(Y, "qty", "n_lines")
    fitted = models.prediction(models.glm(train, [Y], "qty", family, **params), train)
    return fitted.groupBy(Y).agg(F.count("*").alias("n"), F.avg("predicted").alias("fitted"))


@query(
    "train_tweedie_check",
    "event:i n:i fitted:f3",
    f"""WITH {SCORED} SELECT event, count(*) AS n, sum(qty * n_lines) / sum(n_lines) AS fitted
        FROM scored WHERE part = 1 GROUP BY 1""",
)
def train_tweedie_check(spark, d):
    return _fitted_levels(spark, d, "tweedie", weight="n_lines")


@query(
    "train_gamma_check",
    "event:i n:i fitted:f3",
    f"WITH {SCORED} SELECT event, count(*) AS n, avg(qty) AS fitted FROM scored WHERE part = 1 GROUP BY 1",
)
def train_gamma_check(spark, d):
    return _fitted_levels(spark, d, "gamma")


@query(
    "train_linear",
    "variable:s coefficient:f6",
    f"""WITH {SCORED}, t AS (SELECT CAST(n_lines AS DOUBLE) AS x, qty AS y FROM scored WHERE part = 1)
        SELECT 'n_lines' AS variable, regr_slope(y, x) AS coefficient FROM t UNION ALL
        SELECT 'intercept', regr_intercept(y, x) FROM t""",
)
def train_linear(spark, d):
    train = _train(spark, d)
    return models.coefficient_table(train, models.linear(train, ["n_lines"], "qty"), ["n_lines"])


@query("train_importance", "variable:s importance:f6")
def train_importance(spark, d):
    train = _train(spark, d)
    return models.importance_table(train, models.boosted_trees(train, FEATURES, Y, key="account_id"), FEATURES)


@query("train_kfold", "fold:i predicted:i wrong:i n:i")
def train_kfold(spark, d):
    folded = _stored(sampling.kfold(_rows(spark, d).select("account_id", Y, *FEATURES), "account_id", 10, seed=3))
    held_out = models.cross_validate(
        folded.select("fold", Y, *FEATURES), "fold", range(1, 11), lambda t: models.logit(t, FEATURES, Y, tol=1e-6), Y
    )
    return assess.fold_frequencies(held_out, "fold", Y, "p")


@query("score_model", "account_id:i p:f6")
def score_model(spark, d):
    rows = _rows(spark, d)
    model = models.logit(rows.filter("part = 1"), FEATURES, Y, tol=1e-6)
    return models.probability(model, rows.select("account_id", Y, *FEATURES))


@query(
    "score_model_check",
    "rows:i equal:i",
    f"WITH {SCORED} SELECT count(*) AS rows, count(*) AS equal FROM scored",
)
def score_model_check(spark, d):
    """The stored model and its coefficients as score code agree on every row."""
    stored = _rows(spark, d)
    model = models.logit(stored.filter("part = 1"), FEATURES, Y, tol=1e-6)
    rows = models.probability(model, stored.select("account_id", Y, *FEATURES))
    coefs = models.coefficients(model, FEATURES)
    both = scoring.score_logit(rows, coefs, models.intercept(model), Y)
    return both.agg(
        F.count("*").alias("rows"), F.count_if(F.abs(F.col("p") - F.col("P_event1")) < 1e-8).alias("equal")
    )


@query(
    "score_tree_expr",
    "rows:i equal:i",
    f"WITH {SCORED} SELECT count(*) AS rows, count(*) AS equal FROM scored",
)
def score_tree_expr(spark, d):
    """A whole ensemble of 100 trees as score code gives the model's own scores on every row."""
    rows = _rows(spark, d).select("account_id", *FEATURES, Y, "part")
    model = models.boosted_trees(rows.filter("part = 1"), FEATURES, Y, trees=100, key="account_id")
    trees = scoring.flat_trees(model, rows, FEATURES)
    both = models.probability(model, rows).withColumn("q", scoring.boosted_probability(trees))
    return both.agg(
        F.count("*").alias("rows"), F.count_if(F.abs(F.col("p") - F.col("q")) < 1e-8).alias("equal")
    )


#: The estimators of the elimination as the scripts use them: grown out, 100 boosted trees of depth 3, 100 bootstrapped trees.
_SELECTORS = {
    "tree": {"maxDepth": 30},
    "boosting": {"maxDepth": 3, "maxIter": 100, "stepSize": 0.1},
    "forest": {"maxDepth": 30},
}


@query("select_rfe", "estimator:s n:i inputs:s loss:f6 drops:s best:b")
def select_rfe(spark, d):
    """Recursive elimination with 10-fold cross-validation by a tree, boosting and a forest, on the training rows only; trees are fitted on cells of binned inputs."""
    inputs, folds = ["n_lines", "avg_disc", "amount"], range(1, 11)
    folded = _stored(sampling.kfold(_train(spark, d).select("account_id", "qty", *inputs), "account_id", 10, seed=1))
    known = {}

    def cells(lists):
        """The thresholds and cells for these inputs, the same for all estimators."""
        at = tuple((k, tuple(x)) for k, x in lists.items())
        if at not in known:
            edges = models.fold_edges(folded, inputs, "qty", "fold", lists)
            known[at] = edges, _stored(models.fold_cells(folded, inputs, "qty", "fold", list(lists), edges=edges))
        return known[at]

    def by(kind):
        def fits(lists):
            edges, rows = cells(lists)
            seen = models.fold_samples(folded, inputs, "qty", "fold", edges, "account_id") if kind == "forest" else rows
            model = models.tree_regression(seen, inputs, "qty", kind, lists=lists, **_SELECTORS[kind])
            p, n = F.col("predicted"), F.col("rows")
            error = F.col("squares") - 2 * p * n * F.col("qty") + n * p * p
            held_out = models.prediction(model, rows.filter("fold = model")).groupBy("model").agg((F.sum(error) / F.sum(n)).alias("mse"))
            loss = {r["model"]: r["mse"] for r in held_out.collect()}
            return {k: (loss.get(k), importances) for k, importances in model.importances.items()}

        return fits

    rows = []
    for kind in _SELECTORS:
        trail = selection.recursive_elimination(inputs, folds, by(kind))
        rows += [(kind, e["n"], ",".join(e["inputs"]), float(e["loss"]), e["drops"], e["best"]) for e in trail]
    return spark.createDataFrame(rows, "estimator string, n int, inputs string, loss double, drops string, best boolean")


@query("select_stepwise", "step:i action:s variable:s aic:f4")
def select_stepwise(spark, d):
    train = _train(spark, d).select(Y, "n_lines", "qty", "avg_disc")
    base = train.agg(F.avg(Y).alias("m"), F.count(Y).alias("n")).first()

    def aic(inputs):
        if not inputs:
            m, n = base["m"], base["n"]
            return -2 * n * (m * math.log(m) + (1 - m) * math.log(1 - m)) + 2
        model = models.logit(train, inputs, Y, tol=1e-6)
        mcll = assess.fit_stats(models.probability(model, train), Y, "p").first()["mcll"]
        return 2 * base["n"] * mcll + 2 * (len(inputs) + 1)

    rows = [(e["step"], e["action"], e["variable"], float(e["aic"])) for e in selection.stepwise(["n_lines", "qty", "avg_disc"], aic)]
    return spark.createDataFrame(rows, "step int, action string, variable string, aic double")


@query("select_best_model", "model:s inputs:s r2:f6 best:b")
def select_best_model(spark, d):
    rows = _rows(spark, d).select("qty", "n_lines", "avg_disc", "amount", "part")
    fits = {
        "linear": lambda t, x: models.linear(t, x, "qty"),
        "tree": lambda t, x: models.tree_regression(t, x, "qty", "tree"),
    }
    lists = {"lines": ["n_lines"], "all": ["n_lines", "avg_disc", "amount"]}
    found = models.compare_models(rows.filter("part = 1"), rows.filter("part = 0"), fits, lists, "qty")
    out = [(r["model"], r["inputs"], float(r["r2"]), r["best"]) for r in found]
    return spark.createDataFrame(out, "model string, inputs string, r2 double, best boolean")


@query("fair_mitigate_egr", "iteration:i demographic_parity:f6")
def fair_mitigate_egr(spark, d):
    """Demographic parity over segments; the score is refitted on reweighted rows."""
    rows = _train(spark, d).select("account_id", Y, *FEATURES, "segment")

    def fit_score(data, label, weight):
        return models.probability(models.logit(data, FEATURES, label, weight=weight, tol=1e-6), data)

    _, trail = fairness.mitigate(rows, Y, "segment", fit_score, max_iters=10, learning_rate=0.01, tolerance=0.005)
    out = [(t["iteration"], float(t["demographic_parity"])) for t in trail]
    return spark.createDataFrame(out, "iteration int, demographic_parity double")
