import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from loadtide.operators.sessions import sessions
from loadtide.streaming.sessions import stream_sessions

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "host string, datetime timestamp, status int, bytes long"


def plain(rows, gap):
    out = []
    for host in {r[0] for r in rows}:
        own = sorted((t, s, b) for h, t, s, b in rows if h == host and t is not None)
        run = []
        for e in [*own, None]:
            if run and (e is None or e[0] - run[-1][0] > gap):
                sizes = [b for _, _, b in run if b is not None]
                out.append((host, run[0][0], run[-1][0], len(run), sum(sizes) if sizes else None, sum(400 <= s <= 599 for _, s, _ in run)))
                run = []
            if e:
                run.append(e)
    return sorted(out, key=str)


def frame(spark, rows):
    return spark.createDataFrame([(h, None if t is None else T0 + dt.timedelta(seconds=t), s, b) for h, t, s, b in rows], SCHEMA)


def seconds(df):
    of = lambda t: int((t - T0).total_seconds())
    rows = df.select("host", "session_start", "last_event", "hits", "bytes_sum", "errors").collect()
    return sorted(((r[0], of(r[1]), of(r[2]), *r[3:]) for r in rows), key=str)


def made(seed=1, n=400):
    rng = random.Random(seed)
    rows = [(rng.choice(["a", "b", None]), rng.randrange(0, 30000), rng.choice([200, 404, 503]), rng.choice([None, 5, 9])) for _ in range(n)]
    rows += [("long", t, 200, 1) for t in range(90, 9000, 100)]  # one session over many blocks
    rows += [("edge", 0, 200, None), ("edge", 120, 200, None), ("edge", 241, 500, None), ("edge", None, 200, 1)]
    return rows


@pytest.mark.parametrize("block", [130, 1000, 10**7])
def test_sessions_equal_plain(spark, block):
    rows = made()
    got = seconds(sessions(frame(spark, rows), 120, block_seconds=block))
    assert got == plain(rows, 120) and ("long", 90, 8990, 90, 90, 0) in got


def test_without_keys_and_rows(spark):
    rows = [("a", 0, 200, 1), ("b", 50, 200, 1), ("c", 500, 200, 1)]
    got = sessions(frame(spark, rows), 120, keys=[], totals={"n": F.count(F.lit(1)), "max_b": F.max("bytes")}, block_seconds=60)
    assert sorted((r.n, r.max_b) for r in got.collect()) == [(1, 1), (2, 1)]
    assert sessions(frame(spark, []), 120).collect() == []


def test_stream_equals_batch_after_a_restart(spark, tmp_path):
    rows = sorted(made(2), key=lambda r: (r[1] is None, r[1] or 0))
    rows += [("late", 200_000, 200, 1)]  # moves the watermark past the others
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    third = len(rows) // 3
    for k in range(3):
        frame(spark, rows[k * third : len(rows) if k == 2 else (k + 1) * third]).coalesce(1).write.mode("append").parquet(src)
        made_ = stream_sessions(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(src), 120)
        query = made_.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
    got = seconds(spark.read.parquet(out))
    assert got == [r for r in plain(rows, 120) if r[0] != "late"]
