"""Sessions of an event stream."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadtide.operators.sessions import LAST_EVENT, session_totals


def stream_sessions(
    events: DataFrame,
    gap_seconds: int,
    *,
    watermark: str = "10 minutes",
    keys: Sequence[str] = ("host",),
    time_col: str = "datetime",
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The sessions of ``operators.sessions``, each emitted once the watermark has passed its gap."""
    timed = events.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, watermark)
    # Spark's session ends before its gap has passed in full; one microsecond makes the gap itself belong to it
    window = F.session_window(time_col, F.lit(f"{gap_seconds * 1_000_000 + 1} microseconds"))
    made = timed.groupBy(*keys, window.alias("_w")).agg(
        F.max(time_col).alias(LAST_EVENT), *[c.alias(n) for n, c in (totals or session_totals()).items()]
    )
    return made.select(*keys, F.col("_w.start").alias("session_start"), LAST_EVENT, *(totals or session_totals()))
