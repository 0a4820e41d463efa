"""Stored states of buckets that are merged later: over time, over keys, in rollups, without another scan of the events.

A state row holds sums and sketches of one bucket of a key. Merging is the same aggregation whatever the grouping, and the partial
aggregation before the shuffle shrinks states as it would events, so a hot key costs no more than its buckets per task.

Bounds: a distinct count has a relative standard error of ``1.04 / sqrt(2 ** HOST_BITS)``, 1.6 % (small sets are exact); a quantile is off by
``RANK_ERROR`` in rank at most, 99 times of 100; a value of the heavy hitters is found if it holds more than one part in
``TRACKED * 3 / 4`` of its group, and its count is short of the true one by no more than that.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadtide.functions.numeric import client_error, server_error
from loadtide.functions.timegrid import bucket_floor, step_seconds
from loadtide.operators.buckets import TIME

HOST_BITS = 12
QUANTILE_K = 400
RANK_ERROR = 0.01
TRACKED = 1024
SUMS = ("hits", "bytes_sum", "err_4xx", "err_5xx")


def bucket_states(
    events: DataFrame, tag: str = "1m", *, keys: Sequence[str] = (), time_col: str = "datetime", host_col: str = "host"
) -> DataFrame:
    """(keys, bucket_start, sums, hosts, sizes): one state row per key and bucket; ``hosts`` and ``sizes`` are sketches."""
    status = F.col("status")
    return (
        events.filter(F.col(time_col).isNotNull())
        .groupBy(*keys, bucket_floor(F.col(time_col), step_seconds(tag)).alias(TIME))
        .agg(
            F.count(F.lit(1)).alias("hits"),
            F.sum("bytes").alias("bytes_sum"),
            F.count_if(client_error(status)).alias("err_4xx"),
            F.count_if(server_error(status)).alias("err_5xx"),
            F.hll_sketch_agg(host_col, F.lit(HOST_BITS)).alias("hosts"),
            F.kll_sketch_agg_bigint("bytes", F.lit(QUANTILE_K)).alias("sizes"),
        )
    )


def _merged() -> list[Column]:
    return [
        *[F.sum(c).alias(c) for c in SUMS],
        F.hll_union_agg("hosts").alias("hosts"),
        F.kll_merge_agg_bigint("sizes", F.lit(QUANTILE_K)).alias("sizes"),
    ]


def merge_states(states: DataFrame, by: Sequence[str | Column]) -> DataFrame:
    """States of larger groups, by columns or expressions of state rows; the result is a state table again."""
    return states.groupBy(*by).agg(*_merged())


def rollup_states(states: DataFrame, sets: Sequence[Sequence[str]], dims: Sequence[str]) -> DataFrame:
    """States of several groupings in one pass; ``grouping`` has a bit per dimension, the last one lowest, set where it is summed over.

    One scan and one shuffle, however many ``sets``: each state row is copied per set, and combined before the shuffle.
    """
    grouped = states.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(d) for d in dims])
    return grouped.agg(F.grouping_id().alias("grouping"), *_merged())


def rollup_sets(dims: Sequence[str]) -> list[list[str]]:
    """All, all but the last dimension, and so on to none."""
    return [list(dims[:n]) for n in range(len(dims), -1, -1)]


def read_states(states: DataFrame, levels: Mapping[str, float] | None = None) -> DataFrame:
    """The numbers of state rows: sums, rates, distinct hosts and quantiles of sizes (null where no size is known)."""
    levels = levels or {"p95_bytes": 0.95, "p99_bytes": 0.99}
    known = F.kll_sketch_get_n_bigint("sizes") > 0
    quantile = {n: F.when(known, F.kll_sketch_get_quantile_bigint("sizes", F.lit(p))) for n, p in levels.items()}
    return states.withColumns(
        {"unique_hosts": F.hll_sketch_estimate("hosts"), "error_rate": (F.col("err_4xx") + F.col("err_5xx")) / F.col("hits"), **quantile}
    ).drop("hosts", "sizes")


def value_states(events: DataFrame, value: str, *, keys: Sequence[str] = (), seconds: int = 86400, time_col: str = "datetime") -> DataFrame:
    """(keys, bucket_start, state, known): the most frequent values per key and stretch of time, as a mergeable state."""
    rows = events.filter(F.col(time_col).isNotNull() & F.col(value).isNotNull())
    state = F.expr(f"approx_top_k_accumulate(`{value}`, {TRACKED})")
    return rows.groupBy(*keys, bucket_floor(F.col(time_col), seconds).alias(TIME)).agg(state.alias("state"), F.count(F.lit(1)).alias("known"))


def heavy_hitters(states: DataFrame, by: Sequence[str], k: int) -> DataFrame:
    """(by, value, count, known, short): up to ``k`` most frequent values of merged states; the true count is between count and count + short."""
    merged = states.groupBy(*by).agg(F.expr(f"approx_top_k_combine(state, {TRACKED})").alias("state"), F.sum("known").alias("known"))
    top = F.explode(F.expr(f"approx_top_k_estimate(state, {k})"))
    short = F.floor(F.col("known") / (TRACKED * 3 // 4)).alias("short")
    return merged.select(*by, top.alias("t"), "known", short).select(*by, F.col("t.item").alias("value"), F.col("t.count").alias("count"), "known", "short")
