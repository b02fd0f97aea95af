"""Training with Spark ML, the parameters of the modelling scripts as defaults."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import Imputer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyfold.operators import regression
from tallyfold.operators.forest import Forest
from tallyfold.operators.forest import fit as fit_forest
from tallyfold.operators.gradient import GradientBoosted, split_candidates  # noqa: F401
from tallyfold.operators.gradient import fit as fit_gradient

FEATURES = "_features"
SEED = 12345


def _assembler(inputs: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(inputs), outputCol=FEATURES, handleInvalid="skip")


def _fit(stages: list, df: DataFrame, columns: Sequence[str]) -> PipelineModel:
    """Fit on the needed columns only, so that the scan below is pruned."""
    return Pipeline(stages=stages).fit(df.select(*dict.fromkeys(c for c in columns if c)))


def logit(
    df: DataFrame, inputs: Sequence[str], target: str, c: float | None = None, weight: str | None = None,
    tol: float = 1e-9, max_iter: int = 100,
) -> PipelineModel:
    """Logistic regression: maximum likelihood, or with L2 penalty at inverse strength `c`.

    A penalty 0.5*|b|^2 beside c * total loss is regParam = 1/(c*n) beside the mean loss.
    """
    reg = 0.0
    if c is not None:
        total = df.agg((F.sum(weight) if weight else F.count(target)).alias("n")).first()["n"]
        reg = 1.0 / (c * total)
    est = LogisticRegression(
        featuresCol=FEATURES, labelCol=target, regParam=reg, elasticNetParam=0.0,
        standardization=c is None, tol=tol, maxIter=max_iter,
    )
    if weight:
        est = est.setWeightCol(weight)
    return _fit([_assembler(inputs), est], df, [*inputs, target, weight])


def boosted_trees(
    df: DataFrame, inputs: Sequence[str], target: str, trees: int = 100, rate: float = 0.1,
    subsample: float = 0.5, depth: int = 5, leaf: int = 5, bins: int = 50, seed: int = SEED,
    validation: str | None = None, key: str | None = None,
) -> PipelineModel | GradientBoosted:
    """Boosted classification trees; the draws hash `key`.

    A boolean `validation` column stops the boosting early, mostly after a few trees; such fits are Spark's own.
    """
    if not validation:
        return fit_gradient(df, inputs, target, trees, rate, subsample, depth, leaf, bins, seed, key)
    est = GBTClassifier(
        featuresCol=FEATURES, labelCol=target, maxIter=trees, stepSize=rate, subsamplingRate=subsample,
        maxDepth=depth, minInstancesPerNode=leaf, maxBins=bins, seed=seed,
    )
    est = est.setValidationIndicatorCol(validation)
    return _fit([_assembler(inputs), est], df, [*inputs, target, validation])


def forest(
    df: DataFrame, inputs: Sequence[str], target: str, trees: int = 100, depth: int = 20, leaf: int = 5,
    seed: int = SEED, key: str | None = None,
) -> Forest:
    """A random forest for a 0/1 target; the bootstrap draws hash `key`."""
    return fit_forest(df, inputs, target, trees, depth, leaf, key=key, seed=seed)


REGRESSORS = {"tree": DecisionTreeRegressor, "boosting": GBTRegressor, "forest": RandomForestRegressor}


def tree_regression(
    df: DataFrame, inputs: Sequence[str], target: str, kind: str = "boosting", nominal: Sequence[str] = (),
    seed: int = SEED, weight: str | None = None, lists: Mapping[int, Sequence[str]] | None = None, **params,
) -> PipelineModel | regression.CellTrees:
    """Tree regressors for an interval target; nominal inputs are indexed, not dummied.

    With `lists`, one fit for each model of fold_cells (a forest: of fold_samples), on the inputs listed for it.
    """
    if lists is not None:
        return regression.fit(df, inputs, lists, target, kind, **params)
    coded = [f"_{c}" for c in nominal]
    stages: list = []
    if nominal:
        stages.append(StringIndexer(inputCols=list(nominal), outputCols=coded, handleInvalid="keep"))
    est = REGRESSORS[kind](featuresCol=FEATURES, labelCol=target, seed=seed, **params)
    if weight:
        est = est.setWeightCol(weight)
    return _fit([*stages, _assembler([*inputs, *coded]), est], df, [*inputs, *nominal, target, weight])


def fold_edges(
    df: DataFrame, inputs: Sequence[str], target: str, fold: str, lists: Mapping[int, Sequence[str]], bins: int = 32
) -> regression.Edges:
    """For each fold k (the model) the thresholds of its listed inputs, as a tree chooses them that looks at all rows outside fold k."""
    return regression.fold_edges(regression.narrowed(df, inputs, target, fold), inputs, lists, bins)


def fold_cells(
    df: DataFrame, inputs: Sequence[str], target: str, fold: str, folds: Sequence[int], bins: int = 32,
    edges: regression.Edges | None = None,
) -> DataFrame:
    """The rows of each fold as cells of binned inputs: (model, fold, inputs, rows, target, squares).

    For each k of `folds` (the column model) the bins are those of a tree trained on the rows outside fold k. A split
    between bins depends on a cell's rows and mean only, so trees are fitted on at most bins^inputs cells a fold, whatever
    the number of rows. Rows without an input are left out; a row without target is an error, as for Spark's estimators.
    `edges` may give other inputs to each model; those it does not list are 0.
    """
    rows = regression.narrowed(df, inputs, target, fold)
    if edges is None:
        edges = regression.fold_edges(rows, inputs, {k: list(inputs) for k in folds}, bins)
    return regression.cells(rows, inputs, target, {k: edges[k] for k in folds}, bins)


def fold_samples(
    df: DataFrame, inputs: Sequence[str], target: str, fold: str, edges: regression.Edges, key: str,
    trees: int = 100, seed: int = SEED, bins: int = 32,
) -> DataFrame:
    """The cells of fold_cells as the bootstrap samples of a forest's trees hold them; the draws hash `key`."""
    return regression.samples(regression.narrowed(df, inputs, target, fold, key), inputs, target, edges, trees, seed, bins)


def glm(
    df: DataFrame, inputs: Sequence[str], target: str, family: str, weight: str | None = None,
    power: float = 1.8, reg: float = 0.0, max_iter: int = 100,
) -> PipelineModel:
    """Generalised linear models with log link (binomial: logit), iteratively reweighted."""
    est = GeneralizedLinearRegression(
        featuresCol=FEATURES, labelCol=target, family=family, regParam=reg, maxIter=max_iter, tol=1e-9
    )
    if family == "tweedie":
        est = est.setVariancePower(power).setLinkPower(0.0)
    elif family == "gamma":
        est = est.setLink("log")
    if weight:
        est = est.setWeightCol(weight)
    return _fit([_assembler(inputs), est], df, [*inputs, target, weight])


def penalised_tweedie(
    df: DataFrame, inputs: Sequence[str], target: str, alpha: float, weight: str, power: float = 1.8,
    rounds: int = 20, tolerance: float = 1e-7,
) -> PipelineModel:
    """Tweedie GLM that minimises half the mean unit deviance plus alpha/2 * |b|^2, weighted.

    The estimator divides the penalised sums by the working weights w * mu^(2-power) and not by
    the row weights, so its regParam is alpha * sum(w) / sum(w * mu^(2-power)). As mu is an
    outcome of the fit, the fit is repeated until that ratio stands.
    """
    reg, model = alpha, None
    for _ in range(rounds):
        model = glm(df, inputs, target, "tweedie", weight=weight, power=power, reg=reg)
        w = F.col(weight)
        working = F.sum(w * F.pow("predicted", F.lit(2.0 - power)))
        now = alpha * prediction(model, df).agg((F.sum(w) / working).alias("r")).first()["r"]
        if abs(now - reg) <= tolerance * reg:
            return model
        reg = now
    raise ValueError(f"the penalty did not settle in {rounds} fits")


def tweedie_equations(
    df: DataFrame, inputs: Sequence[str], target: str, weight: str, model: PipelineModel, alpha: float,
    power: float = 1.8,
) -> DataFrame:
    """Score equations of the penalised fit, per term: sum(w mu^(1-power) (y - mu) x) / sum(w)
    minus alpha * b, which is zero at the optimum (the intercept has no penalty)."""
    rows = prediction(model, df)
    w, mu = F.col(weight), F.col("predicted")
    pull = w * F.pow(mu, F.lit(1.0 - power)) * (F.col(target) - mu)
    slopes = coefficients(model, inputs)
    terms = [("intercept", F.lit(1.0), 0.0), *[(c, F.col(c).cast("double"), alpha * slopes[c]) for c in inputs]]
    parts = [
        F.struct(
            F.lit(name).alias("variable"),
            F.count("*").alias("n"),
            (F.sum(pull * x) / F.sum(w) - F.lit(held)).alias("imbalance"),
        )
        for name, x, held in terms
    ]
    return rows.agg(F.array(*parts).alias("_e")).select(F.inline("_e"))


def linear(df: DataFrame, inputs: Sequence[str], target: str) -> PipelineModel:
    est = LinearRegression(featuresCol=FEATURES, labelCol=target, solver="normal")
    return _fit([_assembler(inputs), est], df, [*inputs, target])


def with_missing_indicators(df: DataFrame, inputs: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Missing values made usable by trees: a 0/1 indicator beside the median-filled input."""
    flagged = df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in inputs})
    filled = Imputer(strategy="median", inputCols=list(inputs), outputCols=[f"{c}_filled" for c in inputs])
    out = filled.fit(flagged).transform(flagged)
    return out, [f"{c}_{s}" for c in inputs for s in ("filled", "missing")]


def coefficients(model: PipelineModel, inputs: Sequence[str]) -> dict[str, float]:
    last = model.stages[-1]
    return dict(zip(inputs, (float(x) for x in last.coefficients), strict=True))


def intercept(model: PipelineModel) -> float:
    return float(model.stages[-1].intercept)


def coefficient_table(df: DataFrame, model: PipelineModel, inputs: Sequence[str]) -> DataFrame:
    """(variable, coefficient, odds ratio): one row per term, a handful of literals."""
    terms = {"intercept": intercept(model), **coefficients(model, inputs)}
    rows = [(c, b, math.exp(b)) for c, b in terms.items()]
    return df.sparkSession.createDataFrame(rows, "variable string, coefficient double, odds_ratio double")


def importance_table(df: DataFrame, model: PipelineModel | GradientBoosted, inputs: Sequence[str]) -> DataFrame:
    if isinstance(model, GradientBoosted):
        rows = [(c, model.importance[c]) for c in inputs]
    else:
        rows = list(zip(inputs, (float(x) for x in model.stages[-1].featureImportances.toArray()), strict=True))
    table = df.sparkSession.createDataFrame(rows, "variable string, importance double")
    return table.orderBy(F.desc("importance"), "variable")


def probability(model: PipelineModel | Forest | GradientBoosted, df: DataFrame, out: str = "p") -> DataFrame:
    """Score a table and keep its columns beside P(event)."""
    if isinstance(model, Forest | GradientBoosted):
        return model.probability(df, out)
    scored = model.transform(df)
    return scored.withColumn(out, vector_to_array("probability")[1]).select(*df.columns, out)


def prediction(model: PipelineModel | regression.CellTrees, df: DataFrame, out: str = "predicted") -> DataFrame:
    if isinstance(model, regression.CellTrees):
        return model.prediction(df, out)
    return model.transform(df).withColumn(out, F.col("prediction")).select(*df.columns, out)


def score_equations(
    df: DataFrame, inputs: Sequence[str], target: str, fitted: str
) -> DataFrame:
    """Observed and fitted mean of x*y per term. They agree exactly where a canonical-link
    likelihood has its maximum, which makes a fit checkable without refitting."""
    parts = [
        F.struct(
            F.lit(name).alias("variable"),
            F.avg(x * F.col(target)).alias("observed"),
            F.avg(x * F.col(fitted)).alias("fitted"),
        )
        for name, x in [("intercept", F.lit(1.0)), *[(c, F.col(c).cast("double")) for c in inputs]]
    ]
    return df.agg(F.array(*parts).alias("_e")).select(F.inline("_e"))


def compare_models(
    train: DataFrame, validate: DataFrame, fits: Mapping[str, Callable[[DataFrame, Sequence[str]], PipelineModel]],
    lists: Mapping[str, Sequence[str]], target: str,
) -> list[dict]:
    """Fit every model on every variable list and score R2 on the validate rows."""
    results = []
    for model_name, fit in fits.items():
        for list_name, inputs in lists.items():
            rows = prediction(fit(train, inputs), validate.select(target, *inputs))
            e = F.col(target) - F.col("predicted")
            r2 = rows.agg((1 - F.sum(e * e) / (F.var_pop(target) * F.count(target))).alias("r2")).first()["r2"]
            results.append({"model": model_name, "inputs": list_name, "r2": r2})
    best = max(results, key=lambda r: (r["r2"], r["model"], r["inputs"]))
    return [{**r, "best": r is best} for r in results]


def cross_validate(
    df: DataFrame, fold: str, folds: Sequence[int], fit: Callable[[DataFrame], PipelineModel], y: str
) -> DataFrame:
    """Train outside each fold, score inside it, and stack the held-out scores."""
    parts = [probability(fit(df.filter(F.col(fold) != k)), df.filter(F.col(fold) == k)) for k in folds]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.select(fold, y, "p")
