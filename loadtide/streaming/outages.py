"""Unknown outages of a stream of finished buckets: found by a timer while a series is still silent."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from loadtide.functions.timegrid import step_seconds
from loadtide.operators.buckets import TIME
from loadtide.operators.gaps import min_gap_rows

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Silence(StatefulProcessor):
    """State per key: seconds of the last bucket, and whether the silence since then was already told."""

    def __init__(self, keys: list[str], step: int, rows: int):
        self.keys, self.step, self.rows = keys, step, rows

    def _row(self, key: tuple, *values) -> Row:
        return Row(**dict(zip([*self.keys, "_from", "_to", "rows", "status"], [*key, *values])))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", T.StructType([T.StructField("at", T.LongType()), T.StructField("told", T.BooleanType())]))

    def _due(self, at: int) -> int:
        """Milliseconds at which a silence after bucket ``at`` has lasted long enough."""
        return (at + self.step * (self.rows + 1)) * 1000

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        before, told = self.last.get() if self.last.exists() else (None, False)
        at = before
        # the finished buckets that one micro-batch holds of a key
        for now in sorted({r["_at"] for r in rows}):
            if at is not None and now <= at:
                continue
            absent = 0 if at is None else (now - at) // self.step - 1
            if absent >= self.rows:
                yield self._row(key, at + self.step, now, absent, "closed")
            at = now
        if at != before:
            if before is not None and not told:
                self.handle.deleteTimer(self._due(before))
            self.handle.registerTimer(self._due(at))
            self.last.update((at, False))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        at, _ = self.last.get()
        if expiredTimerInfo.getExpiryTimeInMs() == self._due(at):
            self.last.update((at, True))
            yield self._row(key, at + self.step, None, None, "open")

    def close(self) -> None:
        pass


@contextmanager
def timer_state(spark: SparkSession):
    """The state store that timers need, for the queries started inside."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def stream_unknown_outages(buckets: DataFrame, tag: str, *, keys: Sequence[str], unknown_gap_min_hours: int = 12, watermark: str = "0 seconds") -> DataFrame:
    """(keys, gap_start, gap_end, rows, status) of a stream of finished buckets (keys, bucket_start), as ``stream_buckets`` emits them.

    A row of status ``open`` tells that a series has been silent for the given hours, before its next bucket comes: the other
    series' buckets move the watermark on, which sets off the timer. ``closed`` comes with the next bucket and has the
    length in rows, the run length of the batch operators. Each silence is told once, restarts included. Buckets
    that were finished together must come in one micro-batch (no limit on files), since the watermark moves to the latest of them. Start the
    query inside ``timer_state``.
    """
    step = step_seconds(tag)
    timed = buckets.select(*keys, F.col(TIME).cast("timestamp").alias(TIME), F.unix_seconds(F.col(TIME).cast("timestamp")).alias("_at"))
    timed = timed.withWatermark(TIME, watermark)
    fields = [T.StructField(k, buckets.schema[k].dataType) for k in keys]
    fields += [T.StructField("_from", T.LongType()), T.StructField("_to", T.LongType()), T.StructField("rows", T.LongType()), T.StructField("status", T.StringType())]
    told = timed.groupBy(*keys).transformWithState(
        statefulProcessor=_Silence(list(keys), step, min_gap_rows(step, unknown_gap_min_hours)),
        outputStructType=T.StructType(fields), outputMode="Append", timeMode="EventTime",
    )
    return told.select(*keys, F.timestamp_seconds("_from").alias("gap_start"), F.timestamp_seconds("_to").alias("gap_end"), "rows", "status")
