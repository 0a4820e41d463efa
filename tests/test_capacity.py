import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadtide.config import settings
from loadtide.operators import anomaly, blocks, capacity, isoforest
from loadtide.operators import quantiles
from loadtide.operators.quantiles import exact_quantile
from loadtide.plans.load_study import policy_stage

T0 = dt.datetime(2024, 1, 1)
SC = settings()["scaling"]


@pytest.mark.parametrize(
    "caps",
    [
        {("hits", "5m"): 100},
        {"('hits','5m')": 100},
        {"hits,5m": 100},
        {"hits|5m": 100},
        {"hits__5m": 100},
        {"hits": {"5m": 100}},
    ],
)
def test_capacity_key_shapes(caps):
    assert capacity.capacity_entries(caps) == {("hits", "5m"): 100.0}


def test_capacity_keys_with_underscores():
    assert capacity.capacity_entries({"bytes_sum__15m": 1, "(\"bytes_sum\", '1m')": 2, "odd": 3}) == {
        ("bytes_sum", "15m"): 1.0,
        ("bytes_sum", "1m"): 2.0,
    }
    assert capacity.capacity_entries(None) == {}


def test_settings_are_checked():
    with pytest.raises(ValueError, match="no capacity"):
        settings({"targets": ["hits", "other"]})
    with pytest.raises(ValueError, match="unsupported tag"):
        settings({"tags": ["2m"]})
    with pytest.raises(ValueError, match="min <= max"):
        settings({"scaling": {"min_instances": 9, "max_instances": 3}})
    assert settings({"scaling": {"window_minutes": {"5m": 6}}})["scaling"]["window_minutes"]["1m"] == 1


def test_required_instances(spark):
    df = spark.createDataFrame([(float(d),) for d in (-5, 0, 100, 300, 1000, 100000)], "d double")
    need = capacity.required_instances(F.col("d"), F.lit(100.0), F.lit(0.3), F.lit(2), F.lit(50))
    got = [r[0] for r in df.select(need).collect()]
    assert got == [2, 2, 2, 4, 13, 50] and got == sorted(got)


@pytest.mark.parametrize("now,want,moved", [(5, 30, 15), (30, 5, 20), (5, 9, 9), (5, 5, 5), (48, 90, 50), (4, 0, 2), (1, 1, 2)])
def test_bounded_step(spark, now, want, moved):
    step = capacity.bounded_step(F.lit(now), F.lit(want), F.lit(10), F.lit(2), F.lit(50))
    assert spark.range(1).select(step).first()[0] == moved


def case(spark, truth, pred=None, metric="hits", window="5m", extra=()):
    pred = truth if pred is None else pred
    rows = [
        (T0 + dt.timedelta(minutes=5 * i), metric, window, float(a), float(b)) for i, (a, b) in enumerate(zip(truth, pred))
    ]
    return spark.createDataFrame(rows, "timestamp timestamp, metric string, window string, y_true double, y_pred double")


def test_missing_capacity_is_an_error(spark):
    policies = capacity.policy_table(spark, {"default": SC})
    with pytest.raises(Exception, match="no capacity for hits/2m"):
        capacity.with_policy(case(spark, [1, 2], window="2m"), policies).collect()


def test_missing_capacity_is_found_whatever_is_read(spark):
    policies = capacity.policy_table(spark, {"default": SC})
    odd = case(spark, [1, 2], metric="zzz")
    with pytest.raises(Exception, match="no capacity for zzz/5m"):
        capacity.with_policy(odd, policies).select("metric", "y_true").collect()


def test_many_policies(spark):
    policies = capacity.policy_table(spark, {f"s{k}": SC for k in range(20_000 // 6 + 1)})
    assert policies.count() > 20_000
    got = capacity.with_policy(case(spark, [5, 6, 7]), policies)
    assert got.count() == 3 * (20_000 // 6 + 1) and got.select("timestamp", "scenario").distinct().count() == got.count()


@pytest.mark.parametrize("block", [64, 1 << 16])
def test_predictive_steps_follow_the_forecast(spark, block, monkeypatch):
    monkeypatch.setattr(blocks, "POSITION_BLOCK", block)
    pred = np.abs(np.random.default_rng(11).normal(600, 900, 400))
    ready = capacity.with_policy(case(spark, pred * 0.9, pred), capacity.policy_table(spark, {"default": SC}))
    got = capacity.predictive_policy(ready)
    rows = got.orderBy("timestamp").collect()
    want = [min(50, max(2, math.ceil(p / 100 * 1.3))) for p in pred]
    assert [r["instances"] for r in rows] == want and [r["from_instances"] for r in rows] == [2, *want[:-1]]
    events = capacity.scale_events(got).orderBy("timestamp").collect()
    moved = [(a, b) for a, b in zip([2, *want], want) if a != b]
    assert [(e["from_instances"], e["to_instances"]) for e in events] == moved
    assert all((e["action"] == "scale_out") == (e["delta"] > 0) for e in events)


def test_policy_stage_tables(spark):
    rng = np.random.default_rng(4)
    truth = rng.uniform(100, 3000, 120)
    out = policy_stage(case(spark, truth, truth[::-1]), capacity.policy_table(spark, {"default": SC}))
    summary = {r["policy_mode"]: r for r in out["summary"].collect()}
    assert set(summary) == {"static", "predictive"}
    assert summary["static"]["num_scale_events"] == 0 and summary["predictive"]["num_scale_events"] > 0
    row = out["comparison"].first()
    assert row["saving"] == pytest.approx(
        summary["static"]["estimated_total_cost"] - summary["predictive"]["estimated_total_cost"]
    )
    counts = capacity.instance_distribution(out["steps"], keys=["policy_mode"])
    assert counts.agg(F.sum("pct_time")).first()[0] == pytest.approx(2.0)


def test_no_events_no_days(spark):
    policies = capacity.policy_table(spark, {"default": SC})
    got = capacity.predictive_policy(capacity.with_policy(case(spark, [0] * 5), policies))
    assert capacity.daily_event_counts(capacity.scale_events(got)).count() == 0


@pytest.mark.parametrize("block", [64, 1 << 16])
def test_mad_equals_pandas(spark, block, monkeypatch):
    monkeypatch.setattr(blocks, "POSITION_BLOCK", block)
    x = np.random.default_rng(6).poisson(20, 500).astype(float)
    x[[100, 101, 102, 300]] = 500
    got = anomaly.mad_spikes(case(spark, x), "y_true", window_rows=24, k=6.0).orderBy("timestamp").toPandas()
    s = pd.Series(x)
    dev = (s - s.rolling(24, min_periods=12).median()).abs()
    mad = dev.rolling(24, min_periods=12).median()
    score = (dev / mad.replace(0, np.nan)).fillna(0)
    np.testing.assert_allclose(got.anomaly_score, score)
    assert got.is_spike.tolist() == (score > 6).astype(int).tolist()
    assert got.is_ddos.tolist() == ((score > 6).astype(int).rolling(3).sum() >= 3).astype(int).tolist()
    assert got.is_ddos.sum() >= 1


def test_flat_series_has_no_spikes(spark):
    got = anomaly.mad_spikes(case(spark, [5] * 30 + [50]), "y_true", window_rows=24, k=1.0)
    assert got.agg(F.sum("is_spike"), F.max("anomaly_score")).first()[:] == (0, 0.0)


def test_sustained(spark):
    df = spark.createDataFrame([(T0 + dt.timedelta(minutes=i), f) for i, f in enumerate([1, 1, 0, 1, 1, 1, 1])], "timestamp timestamp, is_spike int")
    assert [r["is_ddos"] for r in anomaly.sustained(df).orderBy("timestamp").collect()] == [0, 0, 0, 0, 0, 1, 1]


def test_isolation_forest_finds_the_outliers(spark):
    rng = np.random.default_rng(8)
    pdf = pd.DataFrame(rng.normal(size=(3000, 3)), columns=["a", "b", "c"])
    pdf.loc[[7, 900], ["a", "b", "c"]] = [[9, 9, 9], [-9, 9, -9]]
    df = spark.createDataFrame(pdf.assign(id=range(3000)))
    opts = {"cols": ["a", "b", "c"], "id_cols": ["id"], "trees": 60}
    out = isoforest.isolation_anomalies(df, **opts)
    top = [r["id"] for r in out.orderBy(F.desc("if_score")).limit(2).collect()]
    assert set(top) == {7, 900} and out.agg(F.sum("if_is_anomaly")).first()[0] == 30
    again = isoforest.isolation_scores(df.repartition(5), **opts).join(out.select("id", F.col("if_score").alias("s")), "id")
    assert again.filter("abs(if_score - s) > 1e-12").count() == 0
    assert out.agg(F.min("if_score"), F.max("if_score")).first()[1] < 1


def test_tree_samples_are_whole(spark):
    df = spark.range(5000).select("id", F.rand(1).alias("x0"))
    sizes = isoforest.tree_samples(df, ["id"], 1, 20, 256, 42).groupBy("tree").count().collect()
    assert len(sizes) == 20 and {r["count"] for r in sizes} == {256}
    few = isoforest.tree_samples(df.limit(40), ["id"], 1, 3, 256, 42).groupBy("tree").count().collect()
    assert {r["count"] for r in few} == {40}


def test_top_anomalies(spark):
    df = case(spark, range(60)).withColumn("anomaly_score", F.col("y_true"))
    rows = anomaly.top_anomalies(df).collect()
    assert len(rows) == 50 and rows[0]["y_true"] == 59


@pytest.mark.parametrize("n,share", [(1, 0.5), (2, 0.99), (1000, 0.99), (50000, 0.99), (50000, 0.5), (50000, 0.0), (777, 1.0)])
def test_exact_quantile(spark, n, share):
    x = np.random.default_rng(n).exponential(size=n)
    x[: n // 3] = np.round(x[: n // 3], 1)
    df = spark.createDataFrame(pd.DataFrame({"v": x}))
    assert exact_quantile(df, "v", share).first()["q"] == pytest.approx(np.quantile(x, share), rel=1e-12)


@pytest.mark.parametrize("few", [10, 40_000])
def test_exact_quantiles_of_groups(spark, few, monkeypatch):
    """Both sides of the bound between whole range and sketched bracket, heavy ties, NULL keys and values."""
    monkeypatch.setattr(quantiles, "FEW", few)
    monkeypatch.setattr(quantiles, "ACCURACY", 10_000 if few > 10 else 200)
    monkeypatch.setattr(quantiles, "MARGIN", 2.0 / quantiles.ACCURACY)
    rng = np.random.default_rng(few)
    parts = {"a": rng.exponential(size=45_000), "b": np.round(rng.normal(size=9000)), None: rng.normal(size=50) * 1e9, "c": np.zeros(500)}
    rows = [(k, float(v), None if i % 3 else float(-v)) for k, x in parts.items() for i, v in enumerate(x)] + [("none", None, None)]
    df = spark.createDataFrame(rows, "k string, v double, w double")
    wanted = {"v50": ("v", 0.5), "v99": ("v", 0.99), "w0": ("w", 0.0), "w95": ("w", 0.95)}
    got = {r["k"]: r for r in quantiles.exact_quantiles(df, wanted, ["k"]).collect()}
    assert set(got) == {*parts, "none"} and got["none"][1:] == (None,) * 4
    for k, x in parts.items():
        for name, (c, share) in wanted.items():
            assert got[k][name] == pytest.approx(np.quantile(x if c == "v" else -x[::3], share), rel=1e-12)


def test_exact_quantile_of_nothing(spark):
    assert exact_quantile(spark.createDataFrame([(None,)], "v double"), "v", 0.5).first()["q"] is None
