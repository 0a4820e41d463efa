"""Bucketed series of an event stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadtide.functions.numeric import client_error, server_error
from loadtide.functions.timegrid import step_seconds
from loadtide.operators.buckets import TIME, with_rates
from loadtide.operators.gaps import in_known_outage


def stream_buckets(
    events: DataFrame,
    tag: str,
    *,
    watermark: str = "10 minutes",
    keys: Sequence[str] = (),
    time_col: str = "datetime",
    host_col: str = "host",
    relative_error: float = 0.01,
) -> DataFrame:
    """Sparse series of a stream; a bucket is final once the watermark has passed it.

    Distinct hosts are a sketch, since exact distinct counts would keep every host of every
    open bucket in state. A series per host has one or none and needs no sketch, which would take 13 KB of every open bucket.
    """
    status = F.col("status")
    hosts = F.max(F.col(host_col).isNotNull().cast("bigint")) if host_col in keys else F.approx_count_distinct(host_col, relative_error)
    timed = events.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, watermark)
    buckets = timed.groupBy(*keys, F.window(time_col, f"{step_seconds(tag)} seconds")).agg(
        F.count(F.lit(1)).alias("hits"),
        F.sum("bytes").cast("double").alias("bytes_sum"),
        hosts.alias("unique_hosts"),
        F.count_if(client_error(status)).alias("err_4xx"),
        F.count_if(server_error(status)).alias("err_5xx"),
    )
    return with_rates(
        buckets.select(
            *keys, F.col("window.start").alias(TIME), "hits", "bytes_sum", "unique_hosts", "err_4xx", "err_5xx"
        )
    )


def stream_known_outages(buckets: DataFrame, tag: str, outages: Sequence[tuple[str, str]]) -> DataFrame:
    """Flag known outages on the fly; stateless."""
    hit = in_known_outage(F.col(TIME), step_seconds(tag), outages)
    return buckets.withColumn("is_gap_storm", hit.cast("tinyint"))


def append_to_table(buckets: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    return (
        buckets.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
