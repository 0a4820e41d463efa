"""Boosted-tree forecasts with Spark ML."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtide.config import DEFAULTS
from loadtide.functions.numeric import from_model_scale, to_model_scale
from loadtide.functions.timegrid import naive_utc
from loadtide.operators.evaluate import fold_mean, forecast_metrics, metrics_long
from loadtide.operators.features import TIME, FeatureSpec
from loadtide.operators.forecast import next_truth, time_folds
from loadtide.session import ensure_checkpoints, materialize

MODEL = "gbt"
SCALED_LABEL, SCALED_PRED = "_label", "_fit"


def model_inputs(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """Numeric inputs for trees that have no branch for absent values.

    Lag and rolling columns become 0 where absent and get a companion flag, so a split can
    tell absent from zero.
    """
    partial = [c for c in cols if "_lag_" in c or "_roll_" in c]
    values = {f"f_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in cols}
    flags = {f"a_{c}": F.col(c).isNull().cast("double") for c in partial}
    return df.withColumns({**values, **flags}), [*values, *flags]


def regressor(inputs: Sequence[str], params: Mapping[str, object]) -> Pipeline:
    gbt = GBTRegressor(
        featuresCol="_features",
        labelCol=SCALED_LABEL,
        predictionCol=SCALED_PRED,
        maxDepth=int(params["max_depth"]),
        stepSize=float(params["learning_rate"]),
        subsamplingRate=float(params["subsample"]),
        featureSubsetStrategy=str(params["colsample"]),
        maxIter=int(params["max_iter"]),
        seed=int(params["seed"]),
        checkpointInterval=10,
    )
    return Pipeline(stages=[VectorAssembler(inputCols=list(inputs), outputCol="_features"), gbt])


def fit_trees(
    train: DataFrame,
    target: str,
    spec: FeatureSpec = FeatureSpec(),
    params: Mapping[str, object] | None = None,
) -> PipelineModel:
    """Model of the next value with all rounds; byte sums are fitted on a log scale."""
    ensure_checkpoints(train.sparkSession)
    rows, inputs = _labelled(train, target, spec)
    return regressor(inputs, {**DEFAULTS["modeling"]["trees"], **(params or {})}).fit(rows)


def _labelled(df: DataFrame, target: str, spec: FeatureSpec) -> tuple[DataFrame, list[str]]:
    prepared, inputs = model_inputs(df, spec.feature_cols(target))
    label = to_model_scale(target, F.col(spec.labels[target]).cast("double"))
    return prepared.select(*inputs, label.alias(SCALED_LABEL)), inputs


def validation_curve(model: PipelineModel, held_out: DataFrame, target: str, spec: FeatureSpec = FeatureSpec()) -> list[float]:
    """Mean squared error (on the model's scale) on ``held_out`` after each round, from one pass over the rows."""
    assembler, gbt = model.stages
    rows, _ = _labelled(held_out, target, spec)
    return list(gbt.evaluateEachIteration(assembler.transform(rows), "squared"))


def best_round(errors: Sequence[float], patience: int) -> int:
    """The round (from 1) of least error, looking no further than ``patience`` rounds without a new least one."""
    best = 0
    for k, error in enumerate(errors):
        if error < errors[best]:
            best = k
        elif k - best >= patience:
            break
    return best + 1


def cut_model(model: PipelineModel, rounds: int) -> PipelineModel:
    """The model as it was after its first ``rounds`` rounds; every round adds one tree, so no new fit is needed."""
    assembler, gbt = model.stages
    jvm = gbt._java_obj
    gateway = SparkSession.active().sparkContext._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for k in range(rounds):
        trees[k], weights[k] = jvm.trees()[k], jvm.treeWeights()[k]
    short = GBTRegressionModel(gateway.jvm.org.apache.spark.ml.regression.GBTRegressionModel(jvm.uid(), trees, weights))
    short._resetUid(gbt.uid)
    return PipelineModel([assembler, short.setFeaturesCol(gbt.getFeaturesCol()).setPredictionCol(gbt.getPredictionCol())])


def fit_early(
    train: DataFrame,
    held_out: DataFrame,
    target: str,
    spec: FeatureSpec = FeatureSpec(),
    params: Mapping[str, object] | None = None,
    patience: int | None = None,
) -> tuple[PipelineModel, list[float]]:
    """Fit on ``train``, cut at the best round on ``held_out``; the model and the curve."""
    patience = DEFAULTS["modeling"]["cv"]["patience"] if patience is None else patience
    model = fit_trees(train, target, spec, params)
    errors = validation_curve(model, held_out, target, spec)
    return cut_model(model, best_round(errors, patience)), errors


def predict_trees(model: PipelineModel, df: DataFrame, target: str, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    prepared, inputs = model_inputs(df, spec.feature_cols(target))
    scored = model.transform(prepared).withColumn("pred", from_model_scale(target, F.col(SCALED_PRED)))
    return scored.drop("_features", SCALED_PRED, *inputs)


def score_test(
    model: PipelineModel,
    test: DataFrame,
    target: str,
    tag: str,
    spec: FeatureSpec = FeatureSpec(),
    keys: Sequence[str] = (),
) -> DataFrame:
    """Predictions of the rows whose following value is known."""
    truth = next_truth(test, target, tag, keys=keys)
    scored = predict_trees(model, truth, target, spec)
    return scored.select(
        *keys, naive_utc(F.col(TIME)).alias(TIME), target, "true_next", "pred", F.lit(MODEL).alias("model")
    )


def validate_folds(
    train: DataFrame,
    target: str,
    tag: str,
    spec: FeatureSpec = FeatureSpec(),
    params: Mapping[str, object] | None = None,
    cv: Mapping[str, int] | None = None,
    keys: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame] | None:
    """(metrics, curves) of expanding folds, or None if the series is too short for two.

    Metrics have model, target, window, fold and the wide metrics of each fold's model, cut at its best round. Curves have target, window, fold,
    round, error and is_best, a row per round.
    """
    cv = {**DEFAULTS["modeling"]["cv"], **(cv or {})}
    folds = materialize(
        time_folds(train, tag, splits=cv["splits"], test_days=cv["test_days"], gap_steps=cv["gap_steps"], keys=keys), "folds"
    )
    last = folds.agg(F.max("fold")).first()[0]
    if last is None:
        return None
    per_fold, curves = [], []
    for fold in range(1, last + 1):
        part = folds.filter(F.col("fold") == fold)
        held_out = part.filter("role = 'validation'")
        model, errors = fit_early(part.filter("role = 'train'"), held_out, target, spec, params, cv["patience"])
        best = best_round(errors, cv["patience"])
        curves += [(target, tag, fold, k, float(e), k == best) for k, e in enumerate(errors, 1)]
        scored = predict_trees(model, held_out, target, spec)
        wide = forecast_metrics(
            scored.withColumn("true_next", F.col(spec.labels[target]).cast("double")), by=(), target=target
        )
        ids = {"model": MODEL, "target": target, "window": tag, "fold": fold}
        per_fold.append(wide.select(*[F.lit(v).alias(n) for n, v in ids.items()], "*"))
    # one row per fold and round
    schema = "target string, window string, fold int, round int, error double, is_best boolean"
    return reduce(DataFrame.unionAll, per_fold), train.sparkSession.createDataFrame(curves, schema)


def cross_validate(
    train: DataFrame,
    target: str,
    tag: str,
    spec: FeatureSpec = FeatureSpec(),
    params: Mapping[str, object] | None = None,
    cv: Mapping[str, int] | None = None,
    keys: Sequence[str] = (),
) -> DataFrame | None:
    """Mean metrics over expanding folds, each with its own early stop, or None if the series is too short for two."""
    found = validate_folds(train, target, tag, spec, params, cv, keys)
    return None if found is None else fold_mean(metrics_long(found[0].drop("fold"), ("model", "target", "window")))
