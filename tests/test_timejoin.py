import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loadtide.operators import timejoin as J

T0 = dt.datetime(2024, 1, 1)
at = lambda s: None if s is None else T0 + dt.timedelta(seconds=s)


def plain_asof(left, right, tolerance=None):
    out = []
    for k, t, i in left:
        fit = [(u, v) for q, u, v in right if q == k and u is not None and t is not None and u <= t]
        best = max(fit, default=None)
        if best and tolerance is not None and t - best[0] > tolerance:
            best = None
        out.append((k, t, i, best[1] if best else None, at(best[0]) if best else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("tolerance", [None, 300])
def test_asof_equals_plain(spark, tolerance):
    rng = random.Random(1)
    key = lambda: rng.choice(["a", "b", None])
    left = [(key(), rng.randrange(0, 20000), i) for i in range(300)] + [("a", None, 900), ("none", 5, 901)]
    # long holes: many blocks hold no right row at all
    right = [(key(), rng.choice([0, 7000]) + rng.randrange(0, 600), float(v)) for v in range(120)] + [("a", None, 1.0)]
    right += [("a", 7100, 5.0), ("a", 7100, 3.0)]
    a = spark.createDataFrame([(k, at(t), i) for k, t, i in left], "k string, bucket_start timestamp, i int")
    b = spark.createDataFrame([(k, at(t), v) for k, t, v in right], "k string, datetime timestamp, v double")
    got = J.asof_join(a, b, ["v"], keys=["k"], out_time="met", tolerance_seconds=tolerance, block_seconds=500)
    rows = {(r.k, r.bucket_start, r.i, r.v, r.met) for r in got.collect()}
    assert rows == {(k, at(t), i, v, m) for k, t, i, v, m in plain_asof(left, right, tolerance)} and got.count() == len(left)


def test_asof_without_keys_and_rows(spark):
    a = spark.createDataFrame([(at(5), 1)], "bucket_start timestamp, i int")
    b = spark.createDataFrame([(at(1), 2.0)], "datetime timestamp, v double")
    assert [r.v for r in J.asof_join(a, b, ["v"]).collect()] == [2.0]
    assert [r.v for r in J.asof_join(a, b.limit(0), ["v"]).collect()] == [None]
    assert J.asof_join(a.limit(0), b, ["v"]).collect() == []


def test_asof_shuffles_both_sides_once(spark):
    a = spark.range(100).selectExpr("id", "timestamp_seconds(id * 60) as bucket_start", "id % 3 as k")
    b = spark.range(100).selectExpr("timestamp_seconds(id * 50) as datetime", "id % 3 as k", "id as v")
    plan = J.asof_join(a, b, ["v"], keys=["k"])._jdf.queryExecution().executedPlan().toString()
    # the rows once, the totals per block, and these per key
    assert plan.count("Exchange hashpartitioning") <= 4 and plan.count("REPARTITION") == 1 and "NestedLoop" not in plan


def test_intervals_equal_plain(spark):
    rng = random.Random(2)

    def made(n, longest):
        out = []
        for i in range(n):
            lo = rng.randrange(0, 40000)
            out.append((rng.choice(["a", "b", None]), lo, lo + rng.choice([0, 1, 59, 900, 901, 3600, longest, -5]), i))
        return out

    left = made(120, 5000) + [("a", 0, 40000, 900), ("a", None, 5, 901)]
    right = made(100, 14400) + [("a", -100000, 900000, 800), ("b", 10, None, 801)]
    right += [("a", 100, 200, 802)] * 2
    frame = lambda rows: spark.createDataFrame([(k, at(a), at(b), i) for k, a, b, i in rows], "k string, start timestamp, end timestamp, i int")
    ok = lambda rows: [r for r in rows if None not in r[:3] and r[1] < r[2]]
    want = sorted((x[3], y[3]) for x in ok(left) for y in ok(right) if x[0] == y[0] and x[1] < y[2] and y[1] < x[2])
    got = J.interval_join(frame(left), frame(right), keys=["k"], base_seconds=60, salts=3)
    assert sorted((r.left.i, r.right.i) for r in got.collect()) == want and len(want) > 200
    swapped = J.interval_join(frame(right), frame(left), keys=["k"], base_seconds=900)
    assert sorted((r.right.i, r.left.i) for r in swapped.collect()) == want
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert J.interval_join(frame(left), frame([]), keys=["k"]).collect() == []


@pytest.mark.parametrize("unit", [1, 60, 86400, 0.25])
def test_overlap_totals_equal_the_joined_pairs(spark, unit):
    rng = random.Random(int(unit * 4))
    moment = lambda s: None if s is None else at(0) + dt.timedelta(seconds=s)

    def made(n, grid):
        out = []
        for i in range(n):
            lo = rng.randrange(-50, 400) * grid
            out.append((rng.choice(["a", "b", None]), moment(lo), moment(lo + rng.choice([0, 1, 2, 7, 300, -5]) * grid), i))
        return out

    schema = "k string, start timestamp, end timestamp, i int"
    left = spark.createDataFrame(made(80, unit) + made(80, unit / 2 + 0.375) + [("a", None, at(5), 900), ("a", at(0), at(10**6), 901)], schema)
    right = spark.createDataFrame(made(90, unit) + [("a", moment(-unit * 900), moment(unit * 900), 800), ("b", at(0), None, 801)], schema)
    totals = {"n": F.count(F.lit(1)), "min_i": F.min("i"), "max_i": F.max("i"), "all": F.sum("i")}
    for keys in ([], ["k"]):
        pairs = J.interval_join(left, right, keys=keys)
        shared = F.unix_seconds(F.least("left.end", "right.end")) - F.unix_seconds(F.greatest("left.start", "right.start"))
        i = F.col("right.i")
        want = pairs.groupBy(F.col("left.i").alias("i")).agg(F.count(F.lit(1)), F.min(i), F.max(i), F.sum(i), F.sum(shared))
        got = J.overlap_totals(left, right, ["i"], totals, keys=keys)
        assert got.columns == ["i", "n", "min_i", "max_i", "all", "seconds"]
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() > 30
    assert J.overlap_totals(left, right.limit(0), ["i"], totals).collect() == []


def test_overlap_totals_form_no_pairs(spark):
    # a hundred million pairs; the node rows of both sides are some hundred thousand
    left = spark.range(10000).selectExpr("id as i", "timestamp_seconds(id) as start", "timestamp_seconds(id + 100000) as end")
    right = spark.range(10000).selectExpr("id as j", "timestamp_seconds(id * 2) as start", "timestamp_seconds(id * 2 + 100000) as end")
    got = J.overlap_totals(left, right, ["i"], {"n": F.count(F.lit(1)), "min_j": F.min("j")})
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" in plan and "NestedLoop" not in plan and "Cartesian" not in plan
    assert got.agg(F.sum("n"), F.max("min_j")).first()[:] == (10**8, 0)


def test_interval_query_groups_no_pairs(spark):
    from catalog.spark_queries import QUERIES
    from tests.paths import SMALL

    plan = QUERIES["n3_interval_join"](spark, SMALL)._jdf.queryExecution().analyzed().toString()
    assert "_node" in plan and "leftsalt" not in plan
