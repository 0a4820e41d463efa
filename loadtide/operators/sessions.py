"""Sessions: runs of events of one key without a pause longer than a gap."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadtide.operators import blocks as B

LAST_EVENT = "last_event"


def session_totals() -> dict[str, Column]:
    """Additive totals of a session of log events."""
    status = F.col("status")
    return {
        "hits": F.count(F.lit(1)),
        "bytes_sum": F.sum("bytes"),
        "errors": F.count_if((status >= 400) & (status <= 599)),
    }


def sessions(
    events: DataFrame,
    gap_seconds: int,
    *,
    keys: Sequence[str] = ("host",),
    time_col: str = "datetime",
    totals: Mapping[str, Column] | None = None,
    block_seconds: int = B.DEFAULT_BLOCK_SECONDS,
) -> DataFrame:
    """(keys, session_start, last_event, totals): one row per session; a pause of ``gap_seconds`` still belongs to it.

    Events go to blocks of time, so a host with a third of all events is many groups. Each block finds its own sessions; only its first and last
    one can reach into other blocks. Whether they do is known from one row per key and block: the block's first and last event and
    whether it is one session throughout. Chains of blocks without a pause then share a name, and their pieces are summed.
    ``totals`` are sums, counts or extremes whose pieces are added up (a name that starts with ``max_`` or ``min_`` takes the extreme).
    Events without a time are left out; null keys are one key.
    """
    totals = dict(totals or session_totals())
    rows = events.filter(F.col(time_col).isNotNull()).withColumn("_t", F.col(time_col).cast("timestamp"))
    rows, by = B.keyed(B.named_blocks(rows, B.epoch("_t"), block_seconds), keys)
    inside = B.block_window(by, "_t")
    gap = F.lit(gap_seconds * 1_000_000)
    pause = F.unix_micros("_t") - F.unix_micros(F.lag("_t").over(inside))
    numbered = (
        rows.repartition(*by, B.BLOCK)
        .withColumn("_new", F.coalesce(pause > gap, F.lit(True)).cast("int"))
        .withColumn("_nr", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    )
    pieces = numbered.groupBy(*by, B.BLOCK, "_nr").agg(
        F.min("_t").alias("_from"), F.max("_t").alias("_to"), *[c.alias(n) for n, c in totals.items()]
    )
    # one row per key and block
    ends = pieces.groupBy(*by, B.BLOCK).agg(F.min("_from").alias("_first"), F.max("_to").alias("_last"), F.max("_nr").alias("_n"))
    along = Window.partitionBy(*(by or [F.lit(0)])).orderBy(B.BLOCK)
    near = F.unix_micros("_first") - F.unix_micros(F.lag("_last").over(along)) <= gap
    ends = ends.withColumn("_joined", F.coalesce(near, F.lit(False)))
    fresh = F.when((F.col("_n") > 1) | ~F.col("_joined"), F.col(B.BLOCK))
    ends = ends.withColumn("_open", F.max(fresh).over(along.rowsBetween(Window.unboundedPreceding, 0)))
    ends = ends.withColumn("_into", F.when(F.col("_joined"), F.lag("_open").over(along)))
    ends = ends.select(*[F.col(k).alias(f"_c_{k}") for k in by], F.col(B.BLOCK).alias("_c_block"), "_n", "_open", "_into")
    same = F.col(B.BLOCK) == F.col("_c_block")
    for k in by:
        same = same & (F.col(k) == F.col(f"_c_{k}"))
    known = pieces.join(ends, same)
    # a session is named by the block in which it starts and by its number there; the open end of a chain by its block alone
    first, last = F.col("_nr") == 1, F.col("_nr") == F.col("_n")
    block = F.when(first & F.col("_into").isNotNull(), F.col("_into")).when(last, F.col("_open")).otherwise(F.col(B.BLOCK))
    nr = F.when((first & F.col("_into").isNotNull()) | last, F.lit(-1)).otherwise(F.col("_nr"))
    named = known.withColumns({"_block_of": block, "_nr_of": nr})

    def whole(name: str) -> Column:
        join = F.max if name.startswith("max_") else F.min if name.startswith("min_") else F.sum
        return join(name).alias(name)

    joined = named.groupBy(*by, "_block_of", "_nr_of").agg(
        F.min("_from").alias("session_start"), F.max("_to").alias(LAST_EVENT), *[whole(n) for n in totals]
    )
    return joined.select(*([f"{B.KEY}.*"] if by else []), "session_start", LAST_EVENT, *totals)
