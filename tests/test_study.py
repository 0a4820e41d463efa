"""All stages on two small log folders."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from loadtide.plans.eda import eda_tables
from loadtide.plans.load_study import run_study
from loadtide.session import build_session, shared_dir


def write_logs(folder, start, days, seed):
    rng = np.random.default_rng(seed)
    folder.mkdir()
    lines = []
    for m in range(0, days * 1440, 3):
        t = start + dt.timedelta(minutes=m)
        for _ in range(rng.poisson(2 + np.sin(m / 1440 * 6.28))):
            size = rng.integers(0, 5000)
            lines.append(f'h{rng.integers(9)} - - [{t:%d/%b/%Y:%H:%M:%S} -0400] "GET /a HTTP/1.0" 200 {size}')
    (folder / "a.log").write_text("\n".join(lines))


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("study")
    write_logs(root / "train", dt.datetime(1995, 8, 1), 9, 1)
    write_logs(root / "test", dt.datetime(1995, 8, 10), 3, 2)
    logs = {"train": str(root / "train"), "test": str(root / "test")}
    overrides = {"tags": ["15m"], "modeling": {"trees": {"max_iter": 5}, "cv": {"splits": 2}}}
    return run_study(spark, logs, str(root / "out"), overrides), root


def test_stages(spark, study):
    out, root = study
    assert out["predictions"].select("model", "target").distinct().count() == 4
    bench = {(r["target"], r["metric"]): r for r in out["benchmark"].collect()}
    assert len(bench) == 8 and bench["hits", "RMSE"]["gbt"] > 0
    assert out["comparison"].count() == 4
    assert spark.read.option("header", True).csv(str(root / "out" / "summary")).count() == 8


def test_outage_of_the_default_settings_is_applied(study):
    assert study[0]["series"].agg(F.sum("is_gap_storm")).first()[0] > 100


def test_eda_tables(study):
    made = eda_tables(study[0]["series"], "15m", "-04:00", trees=20)
    sizes = {name: df.count() for name, df in made.items()}
    assert sizes["tail_risk"] == 2 and sizes["heatmap_hits"] == 7 and sizes["lag_correlation"] == 16
    assert sizes["tail_drift"] == 5 and sizes["correlation"] == 21 and sizes["anomalies"] >= 1


def test_stages_can_be_dropped(spark, monkeypatch):
    from loadtide import session

    monkeypatch.setattr(session, "_made", [])
    kept = session.materialize(spark.range(5), "x")
    path = session._made[0]
    assert kept.count() == 5 and session.drop_stages(spark) == 1
    assert not spark._jvm.java.io.File(path).exists() and session._made == []


def test_shared_dir_follows_the_session(spark, tmp_path):
    before = spark.conf.get("spark.checkpoint.dir", None)
    assert build_session().conf.get("spark.sql.session.timeZone") == "UTC"
    path = shared_dir(spark, "x")
    assert not before or path.startswith(before)
