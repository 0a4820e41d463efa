"""The stages from raw logs to policy comparison, tied together by tables."""

from __future__ import annotations

import os
from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadtide.config import settings
from loadtide.operators import capacity, evaluate, features, forecast, trees
from loadtide.operators.buckets import build_series
from loadtide.session import materialize, pin_utc
from loadtide.sources import tables
from loadtide.sources.logs import scan_access_log
from loadtide.sources.metrics_store import append_metrics, read_metrics


def series_stage(spark: SparkSession, logs: Mapping[str, str | Sequence[str]], out: str, cfg: Mapping[str, Any]) -> DataFrame:
    """Dense series of the train and test logs, written by split and tag."""
    gaps = cfg["gaps"]
    events = [scan_access_log(spark, paths).withColumn("split", F.lit(s)) for s, paths in logs.items()]
    ts3 = build_series(
        reduce(DataFrame.unionByName, events),
        cfg["tags"],
        outages=gaps["outages"],
        unknown_gap_min_hours=gaps["unknown_gap_min_hours"],
        keys=["split"],
    )
    tables.write_series(ts3, out)
    return tables.read_series(spark, out)


def split_tag(ts3: DataFrame, split: str, tag: str) -> DataFrame:
    return ts3.filter((F.col("split") == split) & (F.col("tag") == tag)).drop("split", "tag")


def feature_stage(
    ts3: DataFrame, tag: str, spec: features.FeatureSpec, gap_cfg: Mapping[str, Any]
) -> dict[str, DataFrame]:
    train, test = (split_tag(ts3, s, tag) for s in ("train", "test"))
    features.assert_quality(test)
    return {
        "train": materialize(features.train_features(train, test, tag, spec), f"train-{tag}"),
        "test": materialize(features.test_features(train, test, tag, spec, **gap_cfg), f"test-{tag}"),
        "truth": features.truth_frame(test),
    }


def forecast_stage(
    ts3: DataFrame, cfg: Mapping[str, Any], spec: features.FeatureSpec, metrics_path: str, run_id: str, with_trees: bool
) -> DataFrame:
    """Predictions of all models, targets and tags in one long table; metrics are appended."""
    preds, scores = [], []
    for tag in cfg["tags"]:
        train, test = (split_tag(ts3, s, tag) for s in ("train", "test"))
        built = feature_stage(ts3, tag, spec, cfg["gaps"]) if with_trees else {}
        for target in cfg["targets"]:
            found = [forecast.seasonal_naive(train, test, tag, target)]
            if with_trees:
                params = cfg["modeling"]["trees"]
                model = trees.fit_trees(built["train"], target, spec, params)
                found.append(trees.score_test(model, built["test"], target, tag, spec))
                cv = trees.cross_validate(built["train"], target, tag, spec, params, cfg["modeling"]["cv"])
                if cv is not None:
                    scores.append(cv.withColumn("split", F.lit("cv_mean")))
            for df in found:
                preds.append(
                    df.withColumnRenamed(target, "y").withColumns(
                        {"target": F.lit(target), "window": F.lit(tag)}
                    )
                )
    long = materialize(reduce(DataFrame.unionByName, preds), "predictions")
    ids = ("model", "target", "window")
    scores.append(evaluate.metrics_long(evaluate.forecast_metrics(long), ids, "test"))
    append_metrics(reduce(DataFrame.unionByName, scores), metrics_path, run_id)
    return long


def policy_stage(case: DataFrame, policies: DataFrame, *, keys: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Static and predictive runs of a capacity case with events, summaries and savings."""
    ready = materialize(capacity.with_policy(case, policies), "case")
    static = capacity.static_policy(ready, capacity.static_size(ready, keys=keys), keys=keys)
    predictive = capacity.predictive_policy(ready, keys=keys)
    moves = ("action", "reason", "from_instances")
    steps = materialize(
        capacity.steps_view(predictive, keys, *moves, "win_minutes").unionByName(
            capacity.steps_view(static, keys, "win_minutes"), allowMissingColumns=True
        ),
        "steps",
    )
    events = capacity.scale_events(steps, keys=keys)
    summary = capacity.run_summary(steps, events, keys=keys)
    return {
        "steps": steps,
        "events": events,
        "summary": summary,
        "comparison": capacity.compare_policies(summary, keys=keys),
    }


def run_study(
    spark: SparkSession,
    logs: Mapping[str, str | Sequence[str]],
    out: str,
    overrides: Mapping[str, Any] | None = None,
    *,
    run_id: str = "run-1",
    utc_offset: str = "-04:00",
    with_trees: bool = True,
) -> dict[str, DataFrame]:
    """Logs to series, features, forecasts, benchmark and policy tables below ``out``."""
    pin_utc(spark)
    cfg = settings(overrides)
    spec = features.FeatureSpec(
        lag_days=tuple(cfg["features"]["lag_days"]),
        roll_windows=tuple(cfg["features"]["roll_windows"]),
        roll_use_std=cfg["features"]["roll_use_std"],
        use_cyclic=cfg["features"]["use_cyclic"],
        horizon_steps=cfg["features"]["horizon_steps"],
        utc_offset=utc_offset,
    )
    ts3 = series_stage(spark, logs, os.path.join(out, "series"), cfg)
    metrics_path = os.path.join(out, "metrics")
    preds = forecast_stage(ts3, cfg, spec, metrics_path, run_id, with_trees)
    long = read_metrics(spark, metrics_path)
    policies = capacity.policy_table(spark, {"default": cfg["scaling"]})
    case = preds.select(
        "model",
        F.col("bucket_start").cast("timestamp").alias("timestamp"),
        F.col("target").alias("metric"),
        "window",
        F.coalesce("y", F.lit(0.0)).alias("y_true"),
        F.coalesce("pred", F.lit(0.0)).alias("y_pred"),
    )
    result = policy_stage(case, policies, keys=["model"])
    result |= {"series": ts3, "predictions": preds, "benchmark": evaluate.benchmark_table(long)}
    for name in ("steps", "events", "summary", "comparison", "benchmark"):
        tables.write_csv(result[name], os.path.join(out, name))
    return result
