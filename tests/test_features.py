import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from loadtide.functions import timegrid
from loadtide.operators import features
from loadtide.operators.features import FeatureSpec

T0 = dt.datetime(2020, 1, 1)
SPEC = FeatureSpec()


def series(spark, hits, step=300, gap=None, start=T0):
    n = len(hits)
    pdf = pd.DataFrame(
        {
            "bucket_start": [start + dt.timedelta(seconds=step * i) for i in range(n)],
            "hits": np.asarray(hits, dtype=float),
            "bytes_sum": np.asarray(hits, dtype=float) * 10,
            "is_gap": np.zeros(n, dtype=int) if gap is None else np.asarray(gap),
        }
    )
    return spark.createDataFrame(pdf).withColumn("is_gap", F.col("is_gap").cast("tinyint")), pdf


def test_rolling_sees_only_the_past(spark):
    df, _ = series(spark, range(20))
    out = features.with_rolling(df.withColumn("segment_id", F.lit(1)), "5m", "hits", ["1h"])
    rows = {r["bucket_start"]: r for r in out.collect()}
    row = rows[T0 + dt.timedelta(hours=1)]
    assert row["hits_roll_mean_1h"] == 5.5
    assert row["hits_roll_std_1h"] == pytest.approx(np.std(range(12), ddof=1))
    assert rows[T0 + dt.timedelta(minutes=55)]["hits_roll_mean_1h"] is None


def brute_force(pdf, step):
    """Row by row, with pandas, inside segments."""
    per_day = 86400 // step
    d = pdf.copy()
    start = (d.is_gap == 0) & (d.is_gap.shift(1).fillna(1) == 1)
    d["segment_id"] = np.where(d.is_gap == 0, start.cumsum(), -1)
    d = d[d.is_gap == 0]
    out = []
    for _, g in d.groupby("segment_id"):
        g = g.copy()
        for k in SPEC.lag_days:
            g[f"hits_lag_{k}d"] = g.hits.shift(k * per_day)
        for name, sec in timegrid.ROLL_SECONDS.items():
            n = sec // step
            w = g.hits.shift(1).rolling(n, min_periods=n)
            g[f"hits_roll_mean_{name}"], g[f"hits_roll_std_{name}"] = w.mean(), w.std()
        g["y_hits_next"] = g.hits.shift(-1)
        out.append(g)
    return pd.concat(out).set_index("bucket_start")


@pytest.mark.parametrize("step,tag,days", [(900, "15m", 75), (300, "5m", 34)])
def test_features_equal_brute_force_over_blocks(spark, step, tag, days):
    rng = np.random.default_rng(3)
    n = days * 86400 // step
    gap = np.zeros(n, dtype=int)
    gap[50:60] = 1
    gap[n // 3 : n // 3 + 70] = 1
    df, pdf = series(spark, rng.poisson(30, n), step, gap)
    got = features.train_features(df, df.limit(1), tag, SPEC, keep_unlabelled=True).toPandas()
    got = got.set_index("bucket_start").sort_index()
    want = brute_force(pdf, step)
    assert len(got) == len(want) and (got.segment_id == want.segment_id).all()
    cols = [c for c in want.columns if "lag" in c or "roll" in c or c == "y_hits_next"]
    np.testing.assert_allclose(got[cols].astype(float), want[cols], rtol=1e-9, atol=1e-9)


def test_changing_a_value_never_changes_earlier_features(spark):
    rng = np.random.default_rng(5)
    hits = rng.poisson(20, 96 * 12).astype(float)
    at = 96 * 9
    changed = hits.copy()
    changed[at:] += 1000
    frames = []
    for h in (hits, changed):
        df, _ = series(spark, h, 900)
        cols = [c for c in SPEC.all_cols if "hits" in c or "bytes" in c]
        out = features.train_features(df, df.limit(1), "15m", SPEC).toPandas().sort_values("bucket_start")
        frames.append(out[out.bucket_start <= T0 + dt.timedelta(minutes=15 * at)][cols])
    pd.testing.assert_frame_equal(frames[0].reset_index(drop=True), frames[1].reset_index(drop=True))


def test_label_is_missing_at_the_end_of_each_segment(spark):
    df, _ = series(spark, range(10), gap=[0, 0, 0, 1, 1, 0, 0, 0, 0, 0])
    out = features.train_features(df, df.limit(1), "5m", SPEC)
    assert sorted(r["hits"] for r in out.collect()) == [0, 1, 5, 6, 7, 8]


def test_hole_between_splits_keeps_lags_by_time(spark):
    day = 96
    train, _ = series(spark, range(day * 2), 900)
    test, _ = series(spark, range(1000, 1000 + day), 900, start=T0 + dt.timedelta(days=2, hours=3))
    spec = FeatureSpec(lag_days=(1, 2), roll_windows=("1h",))
    out = features.test_features(train, test, "15m", spec).toPandas().sort_values("bucket_start")
    first = out.iloc[0]
    assert first.bucket_start == T0 + dt.timedelta(days=2, hours=3)
    assert first.hits_lag_1d == day + 12 and first.hits_lag_2d == 12 and first.hits_roll_mean_1h == 0.0
    assert len(out) == day


def test_spec_sizes():
    assert len(SPEC.feature_cols("hits")) == 25
    assert len(SPEC.feature_cols("bytes_sum")) == 37
    assert len(SPEC.all_cols) == 45


def test_guards(spark):
    df, _ = series(spark, range(5))
    features.assert_quality(df)
    with pytest.raises(ValueError, match="duplicate"):
        features.assert_quality(df.unionAll(df))
    holes = df.withColumn("hits", F.when(F.col("hits") > 1, F.col("hits")))
    with pytest.raises(ValueError, match="hits NA rate"):
        features.assert_quality(holes)
    with pytest.raises(ValueError, match="missing required cols"):
        features.train_features(df.drop("hits"), df, "5m")


def test_calendar_uses_the_offset(spark):
    df, _ = series(spark, [1], start=dt.datetime(2024, 1, 7, 2, 5))  # Sunday UTC, Saturday at -04:00
    row = features.with_time_features(df, "5m", F.lit(T0).cast("timestamp"), FeatureSpec(utc_offset="-04:00")).first()
    assert (row["hour"], row["minute"], row["dayofweek"], row["is_weekend"]) == (22, 5, 5, 1)


def test_tag_constants():
    assert timegrid.roll_steps("5m", ["1h", "6h", "1d"]) == {"1h": 12, "6h": 72, "1d": 288}
    assert timegrid.steps_per_day("1m") == 1440 and timegrid.steps_per_hour("15m") == 4
    with pytest.raises(ValueError):
        timegrid.roll_steps("5m", ["2h"])


def test_missing_values_inside_a_window(spark):
    df, _ = series(spark, range(40))
    holes = df.withColumn("segment_id", F.lit(1)).withColumn("hits", F.when(F.col("hits") > 13, F.col("hits")))
    rows = features.with_rolling(holes, "5m", "hits", ["1h"]).orderBy("bucket_start").collect()
    known = [r["hits_roll_mean_1h"] for r in rows]
    assert known[:26] == [None] * 26 and known[26] == 19.5
