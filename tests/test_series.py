import datetime as dt

import pytest
from pyspark.sql import functions as F

from loadtide.operators import blocks as B
from loadtide.operators import buckets, gaps
from loadtide.operators.buckets import bucket_events, dense_series, densify

T0 = dt.datetime(2024, 3, 1)
EVENT = "datetime timestamp, host string, status int, bytes bigint"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def events(spark, *rows):
    return spark.createDataFrame([(at(m), h, s, b) for m, h, s, b in rows], EVENT)


def one(minute, **kw):
    return (minute, kw.get("host", "a"), kw.get("status", 200), kw.get("bytes", 1))


def test_all_missing_bytes_stay_unknown_then_fill_to_zero(spark):
    ts2 = bucket_events(events(spark, one(0, bytes=None), one(1, bytes=None)), "5m")
    (row,) = ts2.collect()
    assert row["bytes_sum"] is None and row["avg_bytes_per_req"] is None and row["hits"] == 2
    (row,) = dense_series(ts2, "5m").collect()
    assert row["bytes_sum"] == 0.0 and row["avg_bytes_per_req"] == 0.0


def test_null_times_are_left_out(spark):
    df = events(spark, one(0)).unionAll(spark.createDataFrame([(None, "x", 200, 1)], EVENT))
    assert bucket_events(df, "5m").collect()[0]["unique_hosts"] == 1


@pytest.mark.parametrize("missing,flag", [(143, 0), (144, 1)])
def test_unknown_gap_threshold(spark, missing, flag):
    ts3 = dense_series(bucket_events(events(spark, one(0), one(5 * (missing + 1))), "5m"), "5m")
    assert ts3.count() == missing + 2
    assert ts3.agg(F.sum("is_gap_unknown")).first()[0] == flag * missing
    hole = ts3.filter("is_missing_bucket = 1")
    assert hole.filter("hits = 0").count() == (0 if flag else missing)
    assert hole.filter("hits is null").count() == (missing if flag else 0)


def test_known_outage_is_half_open_and_blanks_observations(spark):
    ts2 = bucket_events(events(spark, *[one(5 * i) for i in range(6)]), "5m")
    ts3 = dense_series(ts2, "5m", outages=[("2024-03-01T00:07:00Z", "2024-03-01T00:17:30Z")])
    rows = {r["bucket_start"]: r for r in ts3.collect()}
    assert [rows[at(5 * i)]["is_gap_storm"] for i in range(6)] == [0, 1, 1, 0, 0, 0]
    assert rows[at(5)]["hits"] is None and rows[at(5)]["is_missing_bucket"] == 0


def test_outage_table_per_key(spark):
    df = events(spark, *[one(5 * i) for i in range(4)]).withColumn("k", F.explode(F.array(F.lit("x"), F.lit("y"))))
    outages = spark.createDataFrame([(at(5), at(10), "x"), (at(5), at(12), "x")], "start timestamp, end timestamp, k string")
    ts3 = dense_series(bucket_events(df, "5m", keys=["k"]), "5m", outages=outages, keys=["k"])
    assert {(r["k"], r["bucket_start"]) for r in ts3.filter("is_gap_storm = 1").collect()} == {("x", at(5)), ("x", at(10))} - {
        ("x", at(10))
    }


def test_outage_table_on_several_grids(spark):
    df = events(spark, *[one(i) for i in range(60)])
    outages = [("2024-03-01T00:10:00Z", "2024-03-01T00:31:00Z")]
    table = spark.createDataFrame([(at(10), at(31))], "start timestamp, end timestamp")
    a = buckets.build_series(df, outages=outages).select("tag", "bucket_start", "is_gap_storm")
    b = buckets.build_series(df, outages=table).select("tag", "bucket_start", "is_gap_storm")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.filter("is_gap_storm = 1").count() == 27


def test_density_over_many_blocks(spark):
    minutes = [0, 15, 60 * 24 * 40, 60 * 24 * 95, 60 * 24 * 95 + 15]
    ts2 = bucket_events(events(spark, *[one(m) for m in minutes]), "15m")
    dense = densify(ts2, 900, block_seconds=86400)
    assert dense.count() == minutes[-1] // 15 + 1 == dense.select("bucket_start").distinct().count()
    spine = buckets.bucket_spine(ts2, 900)
    assert dense.select("bucket_start").exceptAll(spine).count() == 0
    runs = {r[0] for r in dense.select("_absent_run").distinct().collect()}
    assert runs == {None, 96 * 40 - 2, 96 * 55 - 1}


def test_run_lengths_across_blocks(spark):
    flags = [0, 1, 1, 0, 1, 1, 1, 1, 1, 0, 0, 1]
    df = spark.createDataFrame([(at(i), f) for i, f in enumerate(flags)], "bucket_start timestamp, is_missing_bucket int")
    out = gaps.missing_run_lengths(df, block_seconds=180).orderBy("bucket_start")
    assert [r["run_length"] for r in out.collect()] == [0, 2, 2, 0, 5, 5, 5, 5, 5, 0, 0, 1]
    by_flags = gaps.label_gaps(df.withColumn("hits", F.when(F.col("is_missing_bucket") == 0, 1)), 60)
    assert by_flags.count() == len(flags)


@pytest.mark.parametrize("block", [60, 180, 86400])
@pytest.mark.parametrize(
    "gap,want",
    [
        ([1, 1, 0, 0, 1, 0, 0, 0], [-1, -1, 1, 1, -1, 2, 2, 2]),
        ([0, 0, 0, 1, None, 0, 1, 0], [1, 1, 1, -1, 2, 2, -1, 3]),
    ],
)
def test_segments(spark, gap, want, block):
    df = spark.createDataFrame([(at(i), g) for i, g in enumerate(gap)], "bucket_start timestamp, is_gap int")
    out = gaps.segment_ids(df, block_seconds=block).orderBy("bucket_start")
    assert [r["segment_id"] for r in out.collect()] == want


def test_null_keys_keep_their_rows(spark):
    df = events(spark, one(0), one(20)).withColumn("k", F.lit(None).cast("string"))
    ts3 = dense_series(bucket_events(df, "5m", keys=["k"]), "5m", keys=["k"])
    assert gaps.segment_ids(ts3, keys=["k"]).count() == 5


def test_empty_input(spark):
    ts2 = bucket_events(events(spark, one(0)).filter("false"), "5m")
    assert dense_series(ts2, "5m").count() == 0 and buckets.bucket_spine(ts2, 300).count() == 0


def test_grids_agree_with_single_builds(spark):
    hosts = ["a", "b", "c", None]
    df = events(spark, *[(i * 7 % 200, hosts[i * 3 % 4], 200 + 100 * (i % 4), i) for i in range(150)])
    both = buckets.bucket_events_all(df)
    for tag in ("1m", "5m", "15m"):
        alone = bucket_events(df, tag)
        part = both.filter(F.col("tag") == tag).select(alone.columns)
        assert alone.exceptAll(part).count() == 0 and part.count() == alone.count()


def test_unknown_tag(spark):
    with pytest.raises(ValueError, match="unsupported tag"):
        bucket_events(events(spark, one(0)), "2m")


def full_exchanges(df, column):
    """Number of exchanges that move ``column``, reused ones counted once."""
    text = df.sparkSession._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return sum(part.startswith("Exchange") and f"{column}#" in part.split("\n")[1] for part in text.replace("\n(", "\x00(").split("\x00") for part in [part.split(") ", 1)[-1]])


@pytest.mark.parametrize("keys", [["k"], ["k", "n"], []])
def test_carries_shuffle_the_rows_once(spark, keys):
    rows = [(at(5 * i), k, n, float(i), 0) for i in range(40) for k in ("x", None) for n in (1, None)]
    df = spark.createDataFrame(rows, "bucket_start timestamp, k string, n int, payload double, is_gap int")
    if len(keys) < 2:
        df = df.filter("n = 1" if keys else "k = 'x' and n = 1")
    blocks_of = lambda d: B.running_sum(d, F.lit(1), "pos", order="bucket_start", keys=keys, size=3600)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        summed, numbered = blocks_of(df), gaps.segment_ids(df, keys=keys, block_seconds=3600)
        flagged = df.withColumn("is_missing_bucket", (F.col("payload") >= 3).cast("int"))
        runs = gaps.missing_run_lengths(flagged, keys=keys, block_seconds=3600)
        assert full_exchanges(summed, "payload") == 1 and full_exchanges(numbered, "payload") == 1 and full_exchanges(runs, "payload") == 1
        for out, col, want in (
            (summed, "pos", lambda i: i + 1), (numbered, "segment_id", lambda i: 1), (runs.drop("is_missing_bucket"), "run_length", lambda i: 37 if i >= 3 else 0),
        ):
            assert set(out.columns) == {*df.columns, col}
            got = out.collect()
            assert len(got) == df.count() and all(r[col] == want(int(r["payload"])) for r in got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_run_lengths_equal_a_walk(spark):
    import random
    from itertools import groupby

    rng = random.Random(8)
    flags = {k: [int(rng.random() < p) for _ in range(300)] for k, p in (("a", 0.5), ("b", 0.95), (None, 0.05), ("all", 1.0), ("none", 0.0))}
    df = spark.createDataFrame([(k, at(5 * i), i, f) for k, own in flags.items() for i, f in enumerate(own)], "k string, bucket_start timestamp, i int, is_missing_bucket int")
    want = {}
    for k, own in flags.items():
        i = 0
        for f, run in groupby(own):
            n = len(list(run))
            want |= {(k, i + j): n * f for j in range(n)}
            i += n
    for block in (300, 1500, 10**9):
        got = gaps.missing_run_lengths(df, keys=["k"], block_seconds=block)
        assert got.columns == [*df.columns, "run_length"]
        assert {(r.k, r.i): r.run_length for r in got.collect()} == want


def test_gap_spans_are_the_dense_series_in_runs(spark):
    # holes of every length up to two days, of two keys and a null one; outages that overlap, touch rows and lie in long holes
    times = {k: sorted({(i * i * 37 + i * k) % 4000 for i in range(60 * k, 60 * k + 60)}) for k in (1, 2)}
    rows = [(str(k) if k == 1 else None, 1704067200 + 900 * t, 1) for k, ts in times.items() for t in ts]
    ts2 = spark.createDataFrame(rows, "k string, t long, hits long").select("k", F.timestamp_seconds("t").alias("bucket_start"), "hits")
    outages = [("2024-01-05T00:00:00Z", "2024-01-06T03:07:00Z"), ("2024-01-06T01:00:00Z", "2024-01-06T05:00:00Z"), ("2024-01-20T00:00:00Z", "2024-01-20T00:05:00Z"), ("2024-01-25T00:00:00Z", "2024-01-25T00:15:00Z")]
    dense = gaps.label_gaps(buckets.densify(ts2, 900, ["k"]), 900, run_length=F.col("_absent_run"), outages=outages, keys=["k"])
    want = gaps.segment_ids(dense, keys=["k"]).groupBy("k", "segment_id").agg(F.count(F.lit(1)), F.min("bucket_start"), F.max("bucket_start"))
    for block in (86400, 28 * 86400):
        spans = buckets.gap_spans(ts2, 900, outages=outages, keys=["k"], block_seconds=block)
        got = gaps.segment_ids(spans, keys=["k"], block_seconds=block).groupBy("k", "segment_id").agg(F.sum("rows"), F.min("bucket_start"), F.max("last"))
        assert sorted(map(str, got.collect())) and {tuple(r) for r in got.collect()} == {tuple(r) for r in want.collect()}
        assert spans.count() <= 2 * len(rows) + 4 * 2 * len(times) < dense.count() / 4
    assert want.filter("segment_id > 1").count() > 10
