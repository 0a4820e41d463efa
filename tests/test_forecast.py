import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadtide.operators import blocks, evaluate, explore, forecast, trees
from loadtide.operators.features import FeatureSpec, test_features as make_test_features, train_features
from loadtide.session import materialize
from loadtide.sources import metrics_store, tables

T0 = dt.datetime(2024, 1, 1)


def series(spark, hits, start=T0, gap=()):
    rows = [
        (start + dt.timedelta(minutes=15 * i), float(h), float(10 * h), int(i in gap))
        for i, h in enumerate(hits)
    ]
    return spark.createDataFrame(rows, "bucket_start timestamp, hits double, bytes_sum double, is_gap int")


@pytest.mark.parametrize("n_train,gap", [(300, ()), (40, ()), (300, (10, 11, 12))])
def test_naive_equals_list_walk(spark, n_train, gap):
    rng = np.random.default_rng(1)
    train, test = rng.integers(0, 50, n_train), rng.integers(0, 50, 150)
    history = [float(v) for i, v in enumerate(train) if i not in gap]
    want = []
    for v in test[:-1]:
        history.append(float(v))
        want.append(history[-96] if len(history) >= 96 else history[-1])
    df = forecast.seasonal_naive(
        series(spark, train, gap=gap), series(spark, test, T0 + dt.timedelta(minutes=15 * n_train)), "15m", "hits"
    )
    assert [r["pred"] for r in df.orderBy("bucket_start").collect()] == want


def test_tile(spark):
    df = series(spark, range(10))
    tile = lambda **k: [r["forecast"] for r in forecast.tile_last_season(df, "hits", **k).orderBy("horizon_step").collect()]
    assert tile(horizon=7, season=4) == [6, 7, 8, 9, 6, 7, 8]
    assert tile(horizon=3, season=20) == [9, 9, 9]
    empty = forecast.tile_last_season(df.filter("false"), "hits", 2, 4)
    assert [r["forecast"] for r in empty.collect()] == [0, 0]


def test_folds(spark):
    n = 192 * 4 + 10
    df = forecast.time_folds(series(spark, range(n)), "15m")
    got = {
        (r["fold"], r["role"]): (r["lo"], r["hi"])
        for r in df.groupBy("fold", "role").agg(F.min("hits").alias("lo"), F.max("hits").alias("hi")).collect()
    }
    # (778 - 1) // 192 - 1 = 3 folds at the end, one row apart from their train rows
    assert got == {
        (k, role): span
        for k, start in ((1, n - 576), (2, n - 384), (3, n - 192))
        for role, span in (("train", (0, start - 2)), ("validation", (start, start + 191)))
    }
    assert forecast.time_folds(series(spark, range(400)), "15m").count() == 0


def test_mape_threshold(spark):
    df = spark.createDataFrame([(0.5, 9.0), (2.0, 1.0)], "true_next double, pred double")
    assert evaluate.forecast_metrics(df, (), target="hits").first()["MAPE"] == 50.0
    assert evaluate.forecast_metrics(df, (), target="bytes_sum").first()["MAPE"] is None


def test_store_and_pivot(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for run, value in (("run-1", 1.0), ("run-2", 2.0)):
        writer = metrics_store.MetricsWriter(spark, path, run)
        writer.write_one(model="m", target="hits", window="5m", split="TEST", metrics={"RMSE": value, "MAPE": None})
        writer.write_one(model="n", target="hits", window="5m", split="cv_mean", metrics={"RMSE": 9.0})
    long = metrics_store.read_metrics(spark, path)
    assert long.count() == 6
    (row,) = evaluate.benchmark_table(long).collect()
    assert row.asDict() == {"target": "hits", "window": "5m", "metric": "RMSE", "m": 1.0}
    assert evaluate.benchmark_table(long, keep="latest").first()["m"] == 2.0
    assert evaluate.kpi_lookup(long, "m", "hits", "5m").first().asDict() == {"RMSE": 1.0, "MAE": None, "MAPE": None}
    with pytest.raises(ValueError):
        evaluate.benchmark_table(long, keep="any")


def test_order_of_runs_is_the_order_of_appends(spark, tmp_path):
    path = str(tmp_path / "metrics")
    for k, run in enumerate([*(f"run-{i}" for i in range(1, 12)), "run-1"]):
        writer = metrics_store.MetricsWriter(spark, path, run)
        writer.write_one(model="m", target="hits", window="5m", split="test", metrics={"RMSE": float(k), "MAE": 1.0})
    long = metrics_store.read_metrics(spark, path)
    first = lambda keep: evaluate.benchmark_table(long, keep=keep).filter("metric = 'RMSE'").first()["m"]
    assert (first("oldest"), first("latest")) == (0.0, 11.0)
    assert evaluate.kpi_lookup(long, "m", "hits", "5m").first()["RMSE"] == 0.0


def test_metrics_csv_repair(spark, tmp_path):
    assert metrics_store.load_metrics_csv(spark, None).count() == 0
    assert metrics_store.load_metrics_csv(spark, str(tmp_path / "none")).columns == metrics_store.METRIC_COLS
    (tmp_path / "m.csv").write_text("model,value,other\nx,1.5,a\ny,bad,b\n")
    rows = metrics_store.load_metrics_csv(spark, str(tmp_path / "m.csv")).orderBy("model").collect()
    assert [(r["model"], r["value"], r["split"]) for r in rows] == [("x", 1.5, None), ("y", None, None)]


def test_fold_mean_is_unknown_if_a_fold_is(spark):
    df = spark.createDataFrame(
        [("a", "hits", "5m", "MAE", 1.0), ("a", "hits", "5m", "MAE", 3.0), ("a", "hits", "5m", "MAPE", None), ("a", "hits", "5m", "MAPE", 1.0)],
        "model string, target string, window string, metric string, value double",
    )
    assert {r["metric"]: r["value"] for r in evaluate.fold_mean(df).collect()} == {"MAE": 2.0, "MAPE": None}


def test_metadata_round_trip(spark, tmp_path):
    spec = FeatureSpec()
    tables.write_metadata(tables.feature_metadata(spark, ["5m", "15m"], spec), str(tmp_path / "meta"))
    rows = {r["tag"]: r for r in tables.read_metadata(spark, str(tmp_path / "meta")).collect()}
    assert rows["5m"]["hits_feature_cols"] == spec.feature_cols("hits")
    assert rows["15m"]["labels"] == {"hits": "y_hits_next", "bytes_sum": "y_bytes_sum_next"}
    df = tables.annotate(spark.range(1), "id", {"features": ["a"]})
    assert df.schema["id"].metadata == {"features": ["a"]}


def test_series_table_prunes(spark, tmp_path):
    df = series(spark, range(5)).withColumns({"split": F.lit("train"), "tag": F.lit("5m")})
    both = df.unionAll(df.withColumn("split", F.lit("test")))
    tables.write_series(both, str(tmp_path / "s"))
    read = tables.read_series(spark, str(tmp_path / "s"), "train", "5m").select("hits")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 5 and "ReadSchema: struct<hits:double>" in plan and "PartitionFilters: [isnotnull" in plan


def test_range_reaches_the_scan(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = tables.between(df, "1997-01-01", "1998-01-01", "o_orderdate")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan


def test_autocorrelation_equals_dot_products(spark, monkeypatch):
    monkeypatch.setattr(blocks, "POSITION_BLOCK", 16)
    x = np.random.default_rng(2).normal(size=200).cumsum()
    df = series(spark, x)
    s = x - x.mean()
    got = {r["lag"]: r["acf"] for r in explore.autocorrelation(df, "hits", [0, 1, 7, 150, 300]).collect()}
    for k in (1, 7, 150):
        assert got[k] == pytest.approx(np.dot(s[:-k], s[k:]) / np.dot(s, s))
    assert got[300] is None and got[0] == 1.0


def test_histogram_matches_numpy(spark):
    x = np.random.default_rng(2).normal(size=500)
    rows = explore.histogram(series(spark, x), "hits", 20).orderBy("bin").collect()
    assert [r["count"] for r in rows] == np.histogram(x, 20)[0].tolist()
    flat = explore.histogram(series(spark, [3, 3, 3]), "hits", 4).orderBy("bin").collect()
    assert [r["count"] for r in flat] == np.histogram([3, 3, 3], 4)[0].tolist()


def test_trees_beat_the_naive_forecast(spark):
    rng = np.random.default_rng(7)
    t = np.arange(96 * 20)
    load = 60 + 40 * np.sin(2 * np.pi * t / 96) + 25 * np.sin(2 * np.pi * t / (96 * 3.3)) + rng.normal(0, 4, len(t))
    cut = 96 * 15
    train, test = series(spark, load[:cut]), series(spark, load[cut:], T0 + dt.timedelta(days=15))
    spec = FeatureSpec(lag_days=(1, 2), roll_windows=("1h",))
    feats = materialize(train_features(train, test, "15m", spec))
    model = trees.fit_trees(feats, "hits", spec, {"max_iter": 25, "learning_rate": 0.2})
    preds = trees.score_test(model, make_test_features(train, test, "15m", spec), "hits", "15m", spec)
    both = preds.select("model", "true_next", "pred").unionAll(
        forecast.seasonal_naive(train, test, "15m", "hits").select("model", "true_next", "pred")
    )
    mae = {r["model"]: r["MAE"] for r in evaluate.forecast_metrics(both, ("model",), target="hits").collect()}
    assert preds.count() == 96 * 5 - 1 and mae["gbt"] < mae["seasonal_naive"]


def test_cross_validation(spark):
    load = pd.Series(np.tile(np.arange(96), 9)) + 5
    train = series(spark, load)
    spec = FeatureSpec(lag_days=(1, 2), roll_windows=("1h",))
    feats = train_features(train, train.limit(1), "15m", spec)
    feats = materialize(feats)
    means = trees.cross_validate(feats, "hits", "15m", spec, {"max_iter": 3}, {"splits": 2})
    assert {r["metric"] for r in means.collect()} == set(evaluate.METRICS)
    assert trees.cross_validate(feats.limit(300), "hits", "15m", spec, {"max_iter": 3}) is None


def test_best_round():
    curve = [5.0, 4.0, 4.5, 3.0, 3.0, 3.5, 3.6, 2.0]
    assert trees.best_round(curve, 50) == 8 and trees.best_round(curve, 3) == 4 and trees.best_round(curve, 1) == 2
    assert trees.best_round([1.0], 5) == 1


def test_a_fold_stops_at_the_least_error_of_its_curve(spark):
    rng = np.random.default_rng(3)
    load = pd.Series(200 + 30 * np.sin(np.arange(96 * 9) / 96 * 2 * np.pi) + rng.normal(0, 12, 96 * 9))
    train = series(spark, load)
    spec = FeatureSpec(lag_days=(1,), roll_windows=("1h",))
    feats = materialize(train_features(train, train.limit(1), "15m", spec))
    early, late = feats.filter("bucket_start < '2024-01-07'"), feats.filter("bucket_start >= '2024-01-07'")
    params = {"max_iter": 12, "learning_rate": 0.6}
    full = trees.fit_trees(early, "hits", spec, params)
    curve = trees.validation_curve(full, late, "hits", spec)
    model, again = trees.fit_early(early, late, "hits", spec, params, patience=12)
    best = int(np.argmin(curve)) + 1
    assert again == pytest.approx(curve) and len(curve) == 12 and best < 12 and model.stages[-1].getNumTrees == best
    # the cut model's error is the curve's at that round, and it predicts as a model of as many rounds
    mse = lambda m: trees.predict_trees(m, late, "hits", spec).agg(F.avg((F.col("pred") - F.col("y_hits_next")) ** 2)).first()[0]
    assert mse(model) == pytest.approx(min(curve)) and mse(full) == pytest.approx(curve[-1])
    assert mse(trees.fit_trees(early, "hits", spec, {**params, "max_iter": best})) == pytest.approx(min(curve))
    _, curves = trees.validate_folds(feats, "hits", "15m", spec, {"max_iter": 4}, {"splits": 2, "patience": 4})
    rows = curves.collect()
    assert {(r.fold, r.round) for r in rows} == {(f, k) for f in (1, 2) for k in range(1, 5)}
    for f in (1, 2):
        own = {r.round: r.error for r in rows if r.fold == f}
        assert [r.round for r in rows if r.fold == f and r.is_best] == [min(own, key=own.get)]


def test_a_constant_forecast_turns_the_checks_red(spark):
    from catalog import spark_queries as Q

    load = 50 + 30 * np.sin(np.arange(96 * 6) / 96 * 2 * np.pi)
    train = series(spark, load)
    spec = FeatureSpec(lag_days=(1,), roll_windows=("1h",))
    feats = materialize(train_features(train, train.limit(1), "15m", spec))
    learns = lambda m: Q._learning(m, feats, "hits", spec).first()[0]
    assert learns(trees.fit_trees(feats, "hits", spec, {"max_iter": 3}))
    assert not learns(trees.fit_trees(feats.withColumn("y_hits_next", F.lit(5.0)), "hits", spec, {"max_iter": 1}))


def test_random_scores_turn_the_forest_checks_red(spark):
    from catalog import spark_queries as Q
    from loadtide.operators import isoforest

    rng = np.random.default_rng(5)
    n = len(isoforest.FEATURES)
    rows = [(i, *map(float, rng.normal(size=n) * (8 if i % 100 == 0 else 1))) for i in range(600)]
    df = spark.createDataFrame(rows, "bucket_start long, " + ", ".join(f"{c} double" for c in isoforest.FEATURES))
    out = materialize(isoforest.isolation_anomalies(df, trees=50))
    assert tuple(Q._forest_checks(out).first()) == (True, True)
    chance = out.withColumn("if_score", F.rand(3)).withColumn("if_is_anomaly", F.lit(0).cast("tinyint"))
    assert not Q._forest_checks(materialize(chance)).first()["score_follows_distance"]
    three = out.withColumn("if_is_anomaly", (F.col("if_score") >= F.lit(out.approxQuantile("if_score", [0.9], 0)[0])).cast("tinyint"))
    assert not Q._forest_checks(materialize(three)).first()["flags_are_top"]


def test_constant_columns_have_no_correlation(spark):
    df = series(spark, [1, 2, 3, 4]).withColumn("flat", F.lit(7.0))
    rows = {(r["metric_a"], r["metric_b"]): r["corr"] for r in explore.correlation_pairs(df, ["hits", "flat"]).collect()}
    assert rows["hits", "hits"] == pytest.approx(1.0) and rows["flat", "hits"] is None and rows["flat", "flat"] is None
