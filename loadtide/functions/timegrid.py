"""Bucket grids and calendar expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The supported bucket grids and look-back windows, in seconds.
TAG_SECONDS = {"1m": 60, "5m": 300, "15m": 900}
ROLL_SECONDS = {"1h": 3600, "6h": 21600, "1d": 86400}
DAY = 86400


def step_seconds(tag: str) -> int:
    if tag not in TAG_SECONDS:
        raise ValueError(f"unsupported tag {tag!r}, expected one of {sorted(TAG_SECONDS)}")
    return TAG_SECONDS[tag]


def steps_per_day(tag: str) -> int:
    return DAY // step_seconds(tag)


def steps_per_hour(tag: str) -> int:
    return 3600 // step_seconds(tag)


def roll_steps(tag: str, windows: Iterable[str]) -> dict[str, int]:
    """Rows per look-back window, e.g. ``{"1h": 12}`` on the 5-minute grid."""
    step = step_seconds(tag)
    unknown = [w for w in windows if w not in ROLL_SECONDS]
    if unknown:
        raise ValueError(f"unsupported roll windows {unknown}")
    return {w: ROLL_SECONDS[w] // step for w in windows}


def step_of_tag(tag: Column) -> Column:
    """Grid step in seconds for a column of tags; an unknown tag is an error."""
    step = F.raise_error(F.concat(F.lit("unsupported tag "), F.coalesce(tag, F.lit("NULL")))).cast("bigint")
    for name, seconds in TAG_SECONDS.items():
        step = F.when(tag == name, F.lit(seconds).cast("bigint")).otherwise(step)
    return step


def as_column(value: Column | int) -> Column:
    return value if isinstance(value, Column) else F.lit(value)


def bucket_floor(ts: Column, seconds: Column | int) -> Column:
    """Start of the grid cell an instant falls in."""
    epoch = F.unix_seconds(ts)
    return F.timestamp_seconds(epoch - F.pmod(epoch, as_column(seconds)))


def naive_utc(ts: Column) -> Column:
    """UTC wall time without a zone; needs the session zone to be UTC."""
    return ts.cast("timestamp_ntz")


def time_key(ts: Column) -> Column:
    """Nanoseconds since the epoch."""
    return F.unix_micros(ts.cast("timestamp")) * F.lit(1000)


def calendar(ts: Column, offset: str = "+00:00", cyclic: bool = True) -> dict[str, Column]:
    """Calendar parts of the wall time at a fixed offset from UTC; Monday is 0."""
    local = F.from_utc_timestamp(ts, offset)
    hour, dow = F.hour(local), F.weekday(local)
    parts = {
        "hour": hour.cast("smallint"),
        "minute": F.minute(local).cast("smallint"),
        "dayofweek": dow.cast("smallint"),
        "month": F.month(local).cast("smallint"),
        "dayofyear": F.dayofyear(local).cast("smallint"),
        "is_weekend": (dow >= 5).cast("tinyint"),
    }
    if cyclic:
        by_hour = F.lit(2.0) * F.pi() * hour / F.lit(24.0)
        by_dow = F.lit(2.0) * F.pi() * dow / F.lit(7.0)
        parts |= {
            "hour_sin": F.sin(by_hour),
            "hour_cos": F.cos(by_hour),
            "dow_sin": F.sin(by_dow),
            "dow_cos": F.cos(by_dow),
        }
    return parts


def step_index(ts: Column, reference: Column, seconds: int) -> Column:
    """Whole grid steps since the reference time."""
    return F.expr("bigint(0)") + F.floor((F.unix_seconds(ts) - F.unix_seconds(reference)) / seconds)
