import datetime as dt
import random

from pyspark.sql import functions as F

from loadtide.operators.buckets import bucket_events, densify
from loadtide.operators.gaps import missing_run_lengths
from loadtide.streaming import corrections as C
from loadtide.streaming.outages import stream_unknown_outages, timer_state
from loadtide.streaming.series import append_to_table, stream_buckets

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "host string, datetime timestamp, status int, bytes long"


def events(spark, n=600, seed=1):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", "c", None]), T0 + dt.timedelta(seconds=rng.randrange(0, 5 * 86400)), rng.choice([200, 404, 500]), rng.choice([None, 7])) for _ in range(n)]
    return spark.createDataFrame(rows + [("a", None, 200, 1)], SCHEMA)


def same(spark, out, want):
    got = C.corrected_series(spark, out)
    cols = sorted(want.columns)
    key = lambda df: sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
    assert key(got) == key(want)


def test_shuffled_files_give_the_batch_result(spark, tmp_path):
    df = events(spark).cache()
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    # every file holds events of all days: all but the first batch are late
    df.repartition(6, F.hash("datetime", "host")).write.parquet(src)
    for k in range(2):
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 2).parquet(src)
        C.correct_series(stream, out, state, "15m").awaitTermination()
        if k == 0:
            same(spark, out, bucket_events(df, "15m"))
            events(spark, 50, 2).coalesce(1).write.mode("append").parquet(src)
    same(spark, out, bucket_events(df.union(events(spark, 50, 2)), "15m"))


def test_replayed_batches_change_nothing(spark, tmp_path):
    parts = [events(spark, 200, s).cache() for s in range(3)]
    out = str(tmp_path / "out")
    for batch in (0, 1, 1, 2, 0, 2):
        C.upsert(parts[batch], batch, out, "15m", ["host"])
    want = bucket_events(parts[0].union(parts[1]).union(parts[2]), "15m", keys=["host"])
    same(spark, out, want)
    C.compact(spark, out, 1, ["host"])
    assert sorted({r[0] for r in spark.read.parquet(f"{out}/partials").select("batch").distinct().collect()}) == [1, 2]
    C.upsert(parts[2], 2, out, "15m", ["host"])
    C.upsert(parts[0], 3, out, "15m", ["host"])
    same(spark, out, bucket_events(parts[0].union(parts[1]).union(parts[2]).union(parts[0]), "15m", keys=["host"]))
    C.upsert(parts[0].limit(0), 4, out, "15m", ["host"])


def test_only_touched_blocks_are_written(spark, tmp_path):
    out = str(tmp_path / "out")
    df = events(spark)
    C.upsert(df, 0, out, "15m")
    names = lambda: {str(p): p.stat().st_mtime_ns for p in (tmp_path / "out" / "series").rglob("*.parquet")}
    before = names()
    C.upsert(df.filter(F.col("datetime") < "2024-01-02"), 1, out, "15m")
    after = names()
    assert 0 < len(set(before) & set(after)) < len(before)


def test_silence_is_told_before_the_next_event(spark, tmp_path):
    rng = random.Random(4)
    minutes = {"a": [0, 15, 30, 1500, 1515, 3990], "b": list(range(0, 5000, 15)), "c": sorted(rng.sample(range(0, 5000, 15), 60)), None: [0, 15 * 49, 15 * 99]}
    rows = [(h, T0 + dt.timedelta(minutes=m)) for h, ms in minutes.items() for m in ms]
    rows.sort(key=lambda r: r[1])
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    schema = "host string, bucket_start timestamp"
    for k in range(5):  # a restart after each file
        spark.createDataFrame(rows[k * len(rows) // 5 : (k + 1) * len(rows) // 5], schema).coalesce(1).write.mode("append").parquet(src)
        with timer_state(spark):
            stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(src)
            append_to_table(stream_unknown_outages(stream, "15m", keys=["host"]), out, state).awaitTermination()
    told = spark.read.parquet(out)
    closed = {(r.host, r.gap_start, r.gap_end, r.rows) for r in told.filter("status = 'closed'").collect()}
    opened = [(r.host, r.gap_start) for r in told.filter("status = 'open'").collect()]
    sparse = spark.createDataFrame([(h, t, 1) for h, t in rows], schema + ", hits int")
    runs = missing_run_lengths(densify(sparse, 900, ["host"]).withColumn("is_missing_bucket", F.col("hits").isNull().cast("int")), keys=["host"])
    found = runs.filter("run_length >= 48").groupBy("host", "run_length", F.expr("bucket_start")).count()
    want = set()
    for h in minutes:
        times = sorted(minutes[h])
        for x, y in zip(times, times[1:]):
            if (y - x) // 15 - 1 >= 48:
                want.add((h, T0 + dt.timedelta(minutes=x + 15), T0 + dt.timedelta(minutes=y), (y - x) // 15 - 1))
    assert closed == want and found.count() == sum(w[3] for w in want)
    assert len(opened) == len(set(opened)) and {w[:2] for w in want if w[0] == "a"} <= set(opened)


def test_a_series_per_host_keeps_no_sketch(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    df = events(spark).filter("datetime is not null").cache()
    last = spark.createDataFrame([("end", T0 + dt.timedelta(days=n), 200, 1) for n in (20, 30)], SCHEMA)
    df.unionByName(last).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema(SCHEMA).parquet(src)
    made = stream_buckets(stream, "15m", keys=["host"])
    plan = lambda df: df._jdf.queryExecution().analyzed().toString()
    assert "approx_count_distinct" not in plan(made) and "approx_count_distinct" in plan(stream_buckets(stream, "15m"))
    append_to_table(made, out, state).awaitTermination()
    got = spark.read.schema(made.schema).parquet(out).filter("host is null or host <> 'end'")
    cols = ["host", "bucket_start", "hits", "unique_hosts", "bytes_sum"]
    key = lambda df: sorted((tuple(r) for r in df.select(*cols).collect()), key=str)
    assert key(got) == key(bucket_events(df, "15m", keys=["host"]))
