"""Events to bucketed series: aggregation, dense grid, outage labels, fill."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadtide.functions.numeric import client_error, per_hit, server_error
from loadtide.functions.timegrid import TAG_SECONDS, as_column, bucket_floor, step_of_tag, step_seconds
from loadtide.operators import blocks as B
from loadtide.operators.gaps import in_known_outage, label_gaps, min_gap_rows
from loadtide.session import materialize

TIME = "bucket_start"
# The columns blanked inside outages and zero-filled elsewhere.
FILL_COLS = [
    "hits",
    "bytes_sum",
    "avg_bytes_per_req",
    "err_4xx",
    "err_5xx",
    "error_rate",
    "unique_hosts",
]


def with_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "avg_bytes_per_req": per_hit(F.col("bytes_sum"), F.col("hits")),
            "error_rate": per_hit(F.col("err_4xx") + F.col("err_5xx"), F.col("hits")),
        }
    )


def with_class_rates(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {f"rate_{c}": per_hit(F.col(f"err_{c}"), F.col("hits")) for c in ("4xx", "5xx")}
    )


def bucket_events(
    events: DataFrame,
    tag: str,
    *,
    keys: Sequence[str] = (),
    time_col: str = "datetime",
    host_col: str = "host",
) -> DataFrame:
    """Sparse series on one grid. Events without a time are left out."""
    status = F.col("status")
    return with_rates(
        events.filter(F.col(time_col).isNotNull())
        .groupBy(*keys, bucket_floor(F.col(time_col), step_seconds(tag)).alias(TIME))
        .agg(
            F.count(F.lit(1)).alias("hits"),
            F.sum("bytes").cast("double").alias("bytes_sum"),
            F.countDistinct(host_col).alias("unique_hosts"),
            F.count_if(client_error(status)).alias("err_4xx"),
            F.count_if(server_error(status)).alias("err_5xx"),
        )
    )


def bucket_events_all(
    events: DataFrame,
    tags: Sequence[str] = tuple(TAG_SECONDS),
    *,
    keys: Sequence[str] = (),
    time_col: str = "datetime",
    host_col: str = "host",
) -> DataFrame:
    """Sparse series on several grids from one scan, told apart by ``tag``.

    Events shrink to one row per key, finest bucket and host; hosts are part of that key,
    so a hot series is spread over many tasks. A row then notes on which grids its host is
    new in the bucket, which makes exact distinct counts plain sums: rows are shuffled once
    more by host, not once per grid.
    """
    sizes = sorted((step_seconds(t), t) for t in tags)
    finest, coarsest = sizes[0][0], sizes[-1][0]
    if any(s % finest or coarsest % s for s, _ in sizes):
        raise ValueError("grids must nest")
    status = F.col("status")
    per_host = (
        events.filter(F.col(time_col).isNotNull())
        .groupBy(*keys, bucket_floor(F.col(time_col), finest).alias("_fine"), F.col(host_col).alias("_host"))
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.sum("bytes").alias("_bytes"),
            F.count_if(client_error(status)).alias("_4xx"),
            F.count_if(server_error(status)).alias("_5xx"),
        )
        .withColumn("_coarse", bucket_floor(F.col("_fine"), coarsest))
    )
    visits = Window.partitionBy(*keys, "_coarse", "_host").orderBy("_fine")
    seen = per_host.withColumn("_before", F.lag("_fine").over(visits))
    grids = F.array(
        *[
            F.struct(
                F.lit(t).alias("tag"),
                bucket_floor(F.col("_fine"), s).alias(TIME),
                (
                    F.col("_host").isNotNull()
                    & (F.col("_before").isNull() | (F.col("_before") < bucket_floor(F.col("_fine"), s)))
                ).alias("fresh"),
            )
            for s, t in sizes
        ]
    )
    return with_rates(
        seen.withColumn("_g", F.explode(grids))
        .groupBy(*keys, F.col("_g.tag").alias("tag"), F.col(f"_g.{TIME}").alias(TIME))
        .agg(
            F.sum("_n").alias("hits"),
            F.sum("_bytes").cast("double").alias("bytes_sum"),
            F.count_if("_g.fresh").alias("unique_hosts"),
            F.sum("_4xx").alias("err_4xx"),
            F.sum("_5xx").alias("err_5xx"),
        )
    )


def bucket_spine(ts2: DataFrame, step: int, keys: Sequence[str] = ()) -> DataFrame:
    """Every grid time between the first and last bucket of each key."""
    bounds = ts2.groupBy(*keys).agg(F.min(TIME).alias("_lo"), F.max(TIME).alias("_hi"))
    times = F.sequence("_lo", "_hi", F.make_dt_interval(secs=F.lit(step)))
    return bounds.filter("_lo is not null").select(*keys, F.explode(times).alias(TIME))


def densify(
    ts2: DataFrame,
    step: Column | int,
    keys: Sequence[str] = (),
    block_seconds: int = B.DEFAULT_BLOCK_SECONDS,
) -> DataFrame:
    """The series with absent buckets added, equal to spine-left-join-series.

    Each observed row brings along the absent buckets between its predecessor and itself,
    so no spine and no join are needed. ``_absent_run`` is the length of the hole an added
    row lies in and NULL on observed rows.
    """
    spans = _spans(ts2, step, keys, block_seconds)
    filled = spans.withColumn("_t", F.explode(F.sequence("_first", "_now", as_column(step).cast("bigint")))).withColumn(
        "_seen", F.col("_t") == F.col("_now")
    )
    values = [c for c in ts2.columns if c not in (*keys, TIME)]
    return filled.select(
        *keys,
        F.timestamp_seconds("_t").alias(TIME),
        *[F.when(F.col("_seen"), F.col(c)).alias(c) for c in values],
        F.when(~F.col("_seen"), F.col("_run")).alias("_absent_run"),
    )


def _spans(ts2: DataFrame, step: Column | int, keys: Sequence[str], block_seconds: int) -> DataFrame:
    """Each observed row with its time ``_now``, the time ``_first`` at which the hole before it starts, and that hole's length ``_run``."""
    rows, by = B.keyed(B.named_blocks(ts2, B.epoch(TIME), block_seconds), keys)
    near = rows.repartition(*by, B.BLOCK).withColumn("_prev", F.lag(TIME).over(B.block_window(by, TIME)))
    carried = B.with_carry(
        near,
        by,
        {"_last": F.max(TIME)},
        {"_far": F.max("_last").over(B.earlier_blocks(by))},
        source=rows,
    )
    step = as_column(step).cast("bigint")
    now = F.unix_seconds(TIME)
    prev = F.unix_seconds(F.coalesce("_prev", "_far"))
    return carried.withColumns(
        {"_now": now, "_first": F.coalesce(prev + step, now), "_run": ((now - prev) / step - 1).cast("bigint")}
    )


def gap_spans(
    ts2: DataFrame,
    step: int,
    *,
    outages: Sequence[tuple[str, str]] = (),
    unknown_gap_min_hours: int = 12,
    keys: Sequence[str] = (),
    block_seconds: int = B.DEFAULT_BLOCK_SECONDS,
) -> DataFrame:
    """(keys, bucket_start, last, rows, is_gap): the labelled dense series as runs of rows with one label, without its rows.

    A span is one observed row and the hole before it. It is cut where a known outage starts or ends and, if its hole is a long one, before the
    observed row. So there are about as many runs as observed rows, however long the holes are.
    """
    first, now, size = F.col("_first"), F.col("_now"), F.lit(step).cast("bigint")
    long_hole = (F.col("_run") > 0) & (F.col("_run") >= min_gap_rows(step, unknown_gap_min_hours))
    edges = [F.unix_seconds(bucket_floor(F.lit(x).cast("timestamp"), step)) for outage in outages for x in outage]
    inside = [F.when((e > first) & (e <= now), e) for e in edges]
    starts = F.array_sort(F.array_distinct(F.array_compact(F.array(first, F.when(long_hole, now), *inside))))
    piece = F.explode(
        F.transform("_starts", lambda a, i: F.struct(a.alias("a"), F.coalesce(F.get("_starts", i + 1) - size, now).alias("b")))
    )
    cut = _spans(ts2, step, keys, block_seconds).withColumn("_starts", starts).withColumn("_p", piece)
    a, b = F.col("_p.a"), F.col("_p.b")
    gap = in_known_outage(F.timestamp_seconds(a), step, outages) | F.coalesce(long_hole & (a < now), F.lit(False))
    return cut.select(
        *keys,
        F.timestamp_seconds(a).alias(TIME),
        F.timestamp_seconds(b).alias("last"),
        ((b - a) / size + 1).cast("bigint").alias("rows"),
        gap.cast("tinyint").alias("is_gap"),
    )


def fill_series(df: DataFrame, cols: Sequence[str] = FILL_COLS, gap_col: str = "is_gap") -> DataFrame:
    """Outage rows become NULL even where something was observed; other NULLs become 0."""
    inside = F.col(gap_col) == 1
    return df.withColumns(
        {
            c: F.when(~inside, F.coalesce(F.col(c).cast("double"), F.lit(0.0)))
            for c in cols
            if c in df.columns
        }
    )


def dense_series(
    ts2: DataFrame,
    tag: str | Column,
    *,
    outages: Sequence[tuple[str, str]] | DataFrame = (),
    unknown_gap_min_hours: int = 12,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Sparse to dense series with outage flags and filled values.

    ``tag`` is one grid for all rows, or the column that names each row's grid; the latter
    must be among the keys.
    """
    step = step_of_tag(tag) if isinstance(tag, Column) else step_seconds(tag)
    labelled = label_gaps(
        densify(ts2, step, keys),
        step,
        run_length=F.col("_absent_run"),
        outages=outages,
        unknown_gap_min_hours=unknown_gap_min_hours,
        keys=keys,
    )
    return fill_series(labelled.drop("_absent_run"))


def build_series(
    events: DataFrame,
    tags: Sequence[str] = tuple(TAG_SECONDS),
    *,
    outages: Sequence[tuple[str, str]] | DataFrame = (),
    unknown_gap_min_hours: int = 12,
    keys: Sequence[str] = (),
    time_col: str = "datetime",
    host_col: str = "host",
) -> DataFrame:
    """Dense series on all grids from one scan; the caller splits or writes by ``tag``.

    The sparse series is read twice below, so it is written once instead of scanning and
    aggregating the events twice. A train/test split column is passed as a key.
    """
    sparse = materialize(
        bucket_events_all(events, tags, keys=keys, time_col=time_col, host_col=host_col), "sparse"
    )
    return dense_series(
        sparse,
        F.col("tag"),
        outages=outages,
        unknown_gap_min_hours=unknown_gap_min_hours,
        keys=[*keys, "tag"],
    )


def series_report(ts3: DataFrame, by: Sequence[str] = ("split", "tag")) -> DataFrame:
    """Row, range and outage counts."""
    flags: Mapping[str, str] = {
        "missing": "is_missing_bucket",
        "gap": "is_gap",
        "storm": "is_gap_storm",
        "unknown": "is_gap_unknown",
    }
    counts: list[Column] = [F.sum(F.col(c).cast("bigint")).alias(n) for n, c in flags.items()]
    return ts3.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min(TIME).alias("range_start"),
        F.max(TIME).alias("range_end"),
        *counts,
    )
