"""Forecast metrics, benchmark tables and residuals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric names and the smallest truth a percentage error is taken from.
METRICS = ["RMSE", "MSE", "MAE", "MAPE"]
MIN_TRUTH = {"hits": 1.0, "bytes_sum": 1024.0}


def percentage_error(truth: Column, pred: Column, min_truth: Column) -> Column:
    """Mean absolute percentage error over rows whose truth is large enough."""
    return F.avg(F.when(F.abs(truth) >= min_truth, F.abs((truth - pred) / truth))) * 100


def forecast_metrics(
    preds: DataFrame,
    by: Sequence[str] = ("model", "target", "window"),
    *,
    target: str | None = None,
    truth_col: str = "true_next",
    pred_col: str = "pred",
) -> DataFrame:
    """Wide metrics per group; ``target`` names the metric kind if it is not a column."""
    truth, pred = F.col(truth_col), F.col(pred_col)
    kind = F.lit(target) if target else F.col("target")
    floor = F.when(kind == "bytes_sum", MIN_TRUTH["bytes_sum"]).otherwise(MIN_TRUTH["hits"])
    mse = F.avg((truth - pred) * (truth - pred))
    return preds.groupBy(*by).agg(
        F.sqrt(mse).alias("RMSE"),
        mse.alias("MSE"),
        F.avg(F.abs(truth - pred)).alias("MAE"),
        percentage_error(truth, pred, floor).alias("MAPE"),
    )


def metrics_long(wide: DataFrame, ids: Sequence[str], split: str | None = None) -> DataFrame:
    """One row per metric. ``split`` adds the constant column of that name."""
    if split is not None:
        wide, ids = wide.withColumn("split", F.lit(split)), [*ids, "split"]
    return wide.unpivot(list(ids), METRICS, "metric", "value")


def fold_mean(fold_metrics: DataFrame, by: Sequence[str] = ("model", "target", "window")) -> DataFrame:
    """Mean over folds; a fold without a value makes the mean unknown."""
    known = F.count("value") == F.count(F.lit(1))
    return fold_metrics.groupBy(*by, "metric").agg(F.when(known, F.avg("value")).alias("value"))


def benchmark_table(
    long: DataFrame,
    *,
    split: str = "test",
    models: Sequence[str] | None = None,
    keep: str = "oldest",
) -> DataFrame:
    """One row per target, window and metric, one column per model.

    Of repeated values the first written one counts (by batch, then by place in it), or the last with ``keep="latest"``.
    """
    if keep not in ("oldest", "latest"):
        raise ValueError("keep is 'oldest' or 'latest'")
    pick = F.min_by if keep == "oldest" else F.max_by
    rows = long.filter((F.lower("split") == split.lower()) & F.col("value").isNotNull())
    return (
        rows.groupBy("target", "window", "metric")
        .pivot("model", list(models) if models else None)
        .agg(pick("value", F.struct("batch", "seq")))
        .orderBy("target", "window", "metric")
    )


def kpi_lookup(long: DataFrame, model: str, target: str, window: str) -> DataFrame:
    """One row with the test RMSE, MAE and MAPE of a model, NULL where there is none."""
    rows = long.filter(
        (F.lower("split") == "test")
        & (F.col("model") == model)
        & (F.col("target") == target)
        & (F.col("window") == window)
    )
    first = F.struct("batch", "seq")
    return rows.agg(
        *[
            F.min_by(F.col("value"), F.when(F.col("metric") == m, first)).alias(m)
            for m in ("RMSE", "MAE", "MAPE")
        ]
    )


def residuals(case: DataFrame) -> DataFrame:
    return case.withColumn("residual", F.col("y_true") - F.col("y_pred"))
