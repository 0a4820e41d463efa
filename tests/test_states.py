import datetime as dt
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from loadtide.operators import states as S
from loadtide.operators.recent import recent_totals
from loadtide.session import materialize

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "service string, host string, datetime timestamp, status int, bytes long"


def made(spark, n=4000, seed=1):
    rng = random.Random(seed)
    rows = [
        (rng.choice(["a", "a", "b", None]), f"h{min(int(rng.paretovariate(0.6)), 700)}", T0 + dt.timedelta(seconds=rng.randrange(0, 3 * 86400)),
         rng.choice([200, 404, 500]), rng.choice([None, int(rng.lognormvariate(5, 2))]))
        for _ in range(n)
    ]
    return rows, spark.createDataFrame([*rows, ("a", "h1", None, 200, 1)], SCHEMA)


def test_merged_states_are_near_the_exact_numbers(spark):
    rows, df = made(spark)
    stored = materialize(S.bucket_states(df, keys=["service"]))
    got = S.read_states(S.merge_states(stored, ["service", F.to_date("bucket_start").alias("day")]))
    for r in got.collect():
        own = [x for x in rows if x[0] == r.service and x[2].date() == r.day]
        hosts, sizes = len({x[1] for x in own}), sorted(x[4] for x in own if x[4] is not None)
        assert r.hits == len(own) and r.bytes_sum == sum(sizes) and r.err_4xx == sum(x[3] == 404 for x in own)
        assert abs(r.unique_hosts - hosts) <= max(1, 5 * 0.0163 * hosts)
        for p, v in ((0.95, r.p95_bytes), (0.99, r.p99_bytes)):
            assert sum(s < v for s in sizes) / len(sizes) <= p + S.RANK_ERROR and sum(s <= v for s in sizes) / len(sizes) >= p - S.RANK_ERROR
    # merged states are states: days to all time, equal to merging at once
    days = S.merge_states(stored, ["service", F.to_date("bucket_start").alias("day")])
    twice = S.read_states(S.merge_states(days, ["service"])).select("service", "hits", "unique_hosts").collect()
    once = S.read_states(S.merge_states(stored, ["service"])).select("service", "hits", "unique_hosts").collect()
    assert sorted(map(str, twice)) == sorted(map(str, once))


def test_rollup_is_one_scan_and_one_shuffle(spark):
    rows, df = made(spark)
    stored = materialize(S.bucket_states(df, keys=["service"]).withColumn("day", F.to_date("bucket_start")))
    out = S.rollup_states(stored, S.rollup_sets(["service", "day"]), ["service", "day"])
    want = Counter()
    for x in rows:
        for service, day, g in ((x[0], x[2].date(), 0), (x[0], None, 1), (None, None, 3)):
            want[service, day, g] += 1
    got = {(r.service, r.day, r.grouping): r.hits for r in out.collect()}
    assert got == dict(want)
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("FileScan") == 1


def test_heavy_hitters(spark, monkeypatch):
    monkeypatch.setattr(S, "TRACKED", 64)
    rows, df = made(spark, 6000, 2)
    stored = materialize(S.value_states(df, "host", keys=["service"]))
    for r in S.heavy_hitters(stored, ["service"], 5).collect():
        true = sum(x[0] == r.service and x[1] == r.value for x in rows)
        assert r["count"] <= true + r.short and true <= r["count"] + r.short
    found = {(r.service, r.value) for r in S.heavy_hitters(stored, ["service"], 60).collect()}
    for service in ("a", "b", None):
        own = Counter(x[1] for x in rows if x[0] == service)
        assert all((service, v) in found for v, n in own.items() if n > sum(own.values()) / 48)


@pytest.mark.parametrize("block", [400, 10**6])
def test_recent_totals_equal_plain(spark, block):
    rng = random.Random(3)
    rows = [(i, rng.choice(["a", "b", None]), rng.choice([None, *range(0, 3000, 7)]), rng.randrange(2)) for i in range(500)]
    df = spark.createDataFrame([(i, h, None if t is None else T0 + dt.timedelta(seconds=t), e) for i, h, t, e in rows], "i int, host string, datetime timestamp, error int")
    got = recent_totals(df, 60, {"errors": F.sum("error"), "n": F.count(F.lit(1))}, keys=["host"], block_seconds=block)
    assert got.columns == [*df.columns, "errors", "n"]
    for r in got.collect():
        _, h, t, _ = rows[r.i]
        near = [] if t is None else [e for _, k, u, e in rows if k == h and u is not None and t - 60 <= u <= t]
        assert (r.errors, r.n) == ((None, None) if t is None else (sum(near), len(near)))
    assert got.count() == len(rows)
