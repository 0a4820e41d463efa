"""Totals of the last seconds at every event, whatever the events' spacing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadtide.operators import blocks as B


def recent_totals(
    events: DataFrame,
    seconds: int,
    totals: Mapping[str, Column],
    *,
    keys: Sequence[str] = (),
    time_col: str = "datetime",
    block_seconds: int = 86400,
) -> DataFrame:
    """``events`` with ``totals`` (aggregates) over the events of the key from ``seconds`` before up to the event's own time.

    The frame is a distance of time: events of one instant see each other, and both ends count. Rows go to blocks of
    time with the frame as their halo, in one shuffle, so no key is a single window. Events without a time get null totals; null keys
    are one key.
    """
    known, lost = events.filter(F.col(time_col).isNotNull()), events.filter(F.col(time_col).isNull())
    rows = known.select(F.struct(*[F.col(f"`{c}`") for c in known.columns]).alias("_row"), "*").withColumn("_at", F.unix_micros(F.col(time_col).cast("timestamp")))
    rows, by = B.keyed(rows, keys)
    halo = B.with_halo(rows, B.epoch(time_col), by, before=seconds + 1, size=block_seconds)
    frame = Window.partitionBy(*by, B.BLOCK).orderBy("_at").rangeBetween(-seconds * 1_000_000, 0)
    made = B.owned(halo.withColumns({n: c.over(frame) for n, c in totals.items()}))
    empty = lost.select(F.struct(*[F.col(f"`{c}`") for c in lost.columns]).alias("_row"))
    return made.select("_row.*", *totals).unionByName(empty.select("_row.*"), allowMissingColumns=True)
