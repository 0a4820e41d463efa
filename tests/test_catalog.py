"""Every registered query against its SQL on the smallest tables."""

import pytest

from catalog.compare import connect, difference
from catalog.oracle import ORACLES
from catalog.spark_queries import QUERIES
from tests.paths import SMALL


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_is_checked():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", [n for n in QUERIES if n in ORACLES])
def test_same_as_sql(spark, con, name):
    assert difference(spark, con, name, SMALL) is None


def test_entry(spark):
    from __spark_entry__ import entry

    df = entry(spark)
    assert df.count() > 8000 and "is_gap" in df.columns


WHOLE = """a1_log_scan a2_incremental_ingest a8_csv_overwrite b1_line_extract b2_request_split b3_time_parse b4_bytes_parse b5_status_cast
b8_status_class b9_guarded_ratios b10_feature_ratio b14_tz_normalise c2_bucket_aggregate c2_keyed_service c3_multi_resolution c5_spine_join
c10_keyed_hosts d1_keyed_hosts d4_rolling_mean d7_label_drop d14_feature_report e5_time_folds""".split()


def test_whole_log_has_every_event(spark):
    from catalog import fixture

    assert fixture.log_lines(spark, SMALL, whole=True).count() == fixture.table(spark, SMALL, "events").count()
    # lines of garbage are the only ones that no query sees
    broken = fixture.table(spark, SMALL, "events").filter("second(ts) = 13").count()
    assert QUERIES["a1_log_scan"](spark, SMALL).count() == fixture.table(spark, SMALL, "events").count() - broken


@pytest.mark.parametrize("name", WHOLE)
def test_no_event_is_left_out(name):
    assert "event_id % 5" not in ORACLES[name]


@pytest.mark.parametrize("name", ["c8_unknown_gaps", "c9_gap_label"])
def test_holes_need_no_sort_of_the_dense_rows(spark, name):
    plan = QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Sort [" not in plan


def test_one_row_group_is_parsed_by_many_tasks(spark):
    from pyspark.sql import functions as F

    from catalog import fixture

    spark.conf.set("spark.sql.adaptive.enabled", "false")  # it would join these few rows again
    try:
        assert fixture.table(spark, SMALL, "events").rdd.getNumPartitions() == 1
        assert fixture.events(spark, SMALL).select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
