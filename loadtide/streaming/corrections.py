"""Bucketed series that late events correct, by an upsert of the blocks a micro-batch touches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loadtide.functions.numeric import client_error, server_error
from loadtide.functions.timegrid import bucket_floor, step_seconds
from loadtide.operators import blocks as B
from loadtide.operators.buckets import TIME, with_rates

BATCH = "batch"
DAY_BLOCK = 86400


def partial_buckets(events: DataFrame, tag: str, keys: Sequence[str] = (), *, time_col: str = "datetime", host_col: str = "host") -> DataFrame:
    """Additive rows per key, bucket and host; hosts stay apart so that distinct counts remain exact."""
    status = F.col("status")
    return (
        events.filter(F.col(time_col).isNotNull())
        .groupBy(*keys, bucket_floor(F.col(time_col), step_seconds(tag)).alias(TIME), F.col(host_col).alias("_host"))
        .agg(
            F.count(F.lit(1)).alias("_n"), F.sum("bytes").alias("_bytes"),
            F.count_if(client_error(status)).alias("_4xx"), F.count_if(server_error(status)).alias("_5xx"),
        )
    )


def merge_partials(partials: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The sparse series of all partial rows, equal to that of their events."""
    per_host = partials.groupBy(*keys, B.BLOCK, TIME, "_host").agg(*[F.sum(c).alias(c) for c in ("_n", "_bytes", "_4xx", "_5xx")])
    return with_rates(
        per_host.groupBy(*keys, B.BLOCK, TIME).agg(
            F.sum("_n").alias("hits"), F.sum("_bytes").cast("double").alias("bytes_sum"), F.count("_host").alias("unique_hosts"),
            F.sum("_4xx").alias("err_4xx"), F.sum("_5xx").alias("err_5xx"),
        )
    )


def _overwrite(df: DataFrame, path: str, *parts: str) -> None:
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*parts).parquet(path)


def upsert(events: DataFrame, batch: int, out: str, tag: str, keys: Sequence[str] = (), block_seconds: int = DAY_BLOCK) -> None:
    """Add the events of micro-batch ``batch`` to the series table below ``out``.

    The batch's partial rows replace the partitions (block, batch) they belong to, so a batch that is played again leaves what it
    left before. Then only the touched blocks are summed anew, from the partial rows of all batches, and replaced. A run that
    is cut short between the two steps is made good by the replay, which Spark starts with the same batch.
    """
    spark = events.sparkSession
    rows = B.named_blocks(partial_buckets(events, tag, keys), B.epoch(TIME), block_seconds).withColumn(BATCH, F.lit(batch).cast("bigint"))
    _overwrite(rows, f"{out}/partials", B.BLOCK, BATCH)
    kept = spark.read.schema(rows.schema).parquet(f"{out}/partials")
    # blocks, not rows: their number is the time a batch spans
    touched = [r[0] for r in kept.filter(F.col(BATCH) == batch).select(B.BLOCK).distinct().collect()]
    if touched:
        _overwrite(merge_partials(kept.filter(F.col(B.BLOCK).isin(touched)), keys), f"{out}/series", B.BLOCK)


def compact(spark: SparkSession, out: str, before: int, keys: Sequence[str] = ()) -> None:
    """Join the partial rows of the batches up to ``before`` to rows of that batch, block by block; the series stays as it is.

    Only for batches that can't be played again any more, since a replay would add their events once more. The joined rows
    are written aside first, so a run cut short is made good by the next one.
    """
    kept = spark.read.parquet(f"{out}/partials")
    old = kept.filter(F.col(BATCH) <= before)
    joined = old.groupBy(*keys, TIME, "_host", B.BLOCK).agg(*[F.sum(c).alias(c) for c in ("_n", "_bytes", "_4xx", "_5xx")])
    side = f"{out}/compacted-{before}"
    joined.withColumn(BATCH, F.lit(before).cast("bigint")).write.mode("overwrite").parquet(side)
    empty = old.filter(F.col(BATCH) < before).limit(0)
    _overwrite(spark.read.parquet(side).select(*empty.columns), f"{out}/partials", B.BLOCK, BATCH)
    fs_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for r in old.filter(F.col(BATCH) < before).select(B.BLOCK, BATCH).distinct().collect():
        path = fs_path(f"{out}/partials/{B.BLOCK}={r[0]}/{BATCH}={r[1]}")
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def correct_series(events: DataFrame, out: str, checkpoint: str, tag: str, *, keys: Sequence[str] = (), block_seconds: int = DAY_BLOCK) -> StreamingQuery:
    """Keep the series table below ``out`` in step with an event stream; events may come in any order and however late."""
    return (
        events.writeStream.foreachBatch(lambda df, batch: upsert(df, batch, out, tag, keys, block_seconds))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def corrected_series(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.parquet(f"{out}/series").drop(B.BLOCK)
