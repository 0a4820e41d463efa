"""Exploratory aggregates over dense series and raw events."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadtide.functions.numeric import client_error, pearson, server_error
from loadtide.operators import blocks as B
from loadtide.operators.gaps import non_gap
from loadtide.operators.quantiles import exact_quantiles

TIME = "bucket_start"

# Reported columns, percentiles, lags and bin counts.
TAIL = {
    "hits": ("hits", ("mean", "med", "p95", "p99", "max")),
    "bytes": ("bytes_sum", ("mean", "p95", "p99", "max")),
    "err": ("error_rate", ("mean", "p95", "max")),
    "hosts": ("unique_hosts", ("mean", "p95")),
}
DRIFT_METRICS = ["hits", "bytes_sum", "error_rate", "unique_hosts", "avg_bytes_per_req"]
CORRELATED = ["hits", "bytes_sum", "avg_bytes_per_req", "unique_hosts", "error_rate", "rate_5xx"]
LAGS = [1, 2, 3, 6, 12, 24, 36, 48]
SERIES_BINS, RESIDUAL_BINS, ACF_LAGS = 80, 60, 60


def statistic(kind: str, value: Column, accuracy: int | None = None) -> Column:
    """Named aggregate; percentiles by a sketch of the given accuracy."""
    if kind in ("mean", "max"):
        return F.avg(value) if kind == "mean" else F.max(value)
    return F.percentile_approx(value, share_of(kind), accuracy)


def share_of(kind: str) -> float | None:
    if kind in ("mean", "max"):
        return None
    return 0.5 if kind == "med" else int(kind[1:]) / 100


def tail_risk(ts3: DataFrame, by: Sequence[str] = ("split", "tag"), accuracy: int | None = None) -> DataFrame:
    """Means and tails per group outside outages."""
    base = non_gap(ts3)
    names = [(f"{name}_{kind}", c, kind) for name, (c, kinds) in TAIL.items() for kind in kinds]
    exact = {} if accuracy else {n: (c, share_of(kind)) for n, c, kind in names if share_of(kind)}
    plain = base.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        *[statistic(kind, F.col(c), accuracy).alias(n) for n, c, kind in names if n not in exact],
    )
    if not exact:
        return plain
    tails = exact_quantiles(base, exact, by).select(*[F.col(k).alias(f"_t_{k}") for k in by], *exact)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in by], F.lit(True))
    return plain.join(tails, same).select(*by, "rows", *[n for n, _, _ in names])


def tail_drift(
    ts3: DataFrame, keys: Sequence[str] = (), split_col: str = "split", digits: int = 4
) -> DataFrame:
    """p95, p99 and maximum of five metrics, train next to test."""
    long = non_gap(ts3).unpivot([*keys, split_col], DRIFT_METRICS, "metric", "value")
    side = {s: F.when(F.col(split_col) == s, F.col("value")) for s in ("train", "test")}
    wide, by = long.select(*keys, "metric", *[v.alias(s) for s, v in side.items()]), [*keys, "metric"]
    tops = wide.groupBy(*by).agg(*[F.max(s).alias(f"{s}_max") for s in side])
    tails = exact_quantiles(wide, {f"{s}_{k}": (s, share_of(k)) for s in side for k in ("p95", "p99")}, by)
    tails = tails.withColumnsRenamed({k: f"_t_{k}" for k in by})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_t_{k}")) for k in by])
    names = [f"{s}_{kind}" for s in side for kind in ("p95", "p99", "max")]
    return tops.join(tails, same).select(*by, *[F.round(n, digits).alias(n) for n in names])


def local_parts(df: DataFrame, utc_offset: str) -> DataFrame:
    local = F.from_utc_timestamp(TIME, utc_offset)
    return df.withColumns({"hour": F.hour(local), "dow": F.weekday(local)})


def week_heatmap(
    ts3: DataFrame, value: str = "hits", utc_offset: str = "+00:00", keys: Sequence[str] = ()
) -> DataFrame:
    """Mean per weekday (rows) and hour (``h0``..``h23``); cells without data are 0."""
    cells = (
        local_parts(non_gap(ts3), utc_offset)
        .groupBy(*keys, "dow", "hour")
        .agg(F.avg(value).alias("v"))
    )
    wide = cells.groupBy(*keys, "dow").pivot("hour", list(range(24))).agg(F.first("v"))
    week = F.explode(F.sequence(F.lit(0), F.lit(6)))
    if keys:
        days = cells.select(*keys).distinct().withColumn("dow", week)
    else:
        days = ts3.sparkSession.range(7).select(F.col("id").cast("int").alias("dow"))
    right = wide.withColumnsRenamed({k: f"_w_{k}" for k in (*keys, "dow")})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_w_{k}")) for k in (*keys, "dow")])
    return days.join(right, same, "left").select(
        *keys, "dow", *[F.coalesce(F.col(f"`{h}`"), F.lit(0.0)).alias(f"h{h}") for h in range(24)]
    )


def seasonal_means(
    ts3: DataFrame, value: str = "hits", utc_offset: str = "+00:00", keys: Sequence[str] = ()
) -> DataFrame:
    """Mean by hour of day and by weekday, told apart by ``part``."""
    parts = local_parts(non_gap(ts3), utc_offset).withColumn(
        "_p",
        F.explode(
            F.array(
                F.struct(F.lit("hour").alias("part"), F.col("hour").alias("unit")),
                F.struct(F.lit("dow").alias("part"), F.col("dow").alias("unit")),
            )
        ),
    )
    return parts.groupBy(*keys, "_p.part", "_p.unit").agg(F.avg(value).alias(f"mean_{value}"))


def correlation_pairs(
    df: DataFrame, cols: Sequence[str] = CORRELATED, keys: Sequence[str] = ()
) -> DataFrame:
    """Lower triangle of the Pearson matrix, each pair over rows where both are known."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[: i + 1]]
    wide = df.groupBy(*keys).agg(
        *[
            pearson(F.col(a), F.col(b)).alias(f"c{i}")
            for i, (a, b) in enumerate(pairs)
        ]
    )
    rows = F.array(
        *[
            F.struct(F.lit(a).alias("metric_a"), F.lit(b).alias("metric_b"), F.col(f"c{i}").alias("corr"))
            for i, (a, b) in enumerate(pairs)
        ]
    )
    return wide.select(*keys, F.inline(rows))


def _lagged(df: DataFrame, value: Column, lags: Sequence[int], keys: Sequence[str]) -> DataFrame:
    placed = B.positions(df.withColumn("_x", value), "_pos", order=TIME, keys=keys)
    halo = B.with_halo(placed, F.col("_pos"), keys, before=max(lags), size=B.POSITION_BLOCK)
    w = B.block_window(keys, "_pos")
    return B.owned(halo.withColumns({f"_l{k}": F.lag("_x", k).over(w) for k in lags}))


def autocorrelation(
    df: DataFrame, value: str, lags: Sequence[int] = tuple(range(ACF_LAGS + 1)), keys: Sequence[str] = ()
) -> DataFrame:
    """Autocorrelation over rows in order, absent values read as 0; NULL beyond the series."""
    x = F.coalesce(F.col(value).cast("double"), F.lit(0.0))
    if keys:
        means = df.groupBy(*[F.col(k).alias(f"_m_{k}") for k in keys]).agg(F.avg(x).alias("_mean"))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_m_{k}")) for k in keys])
        centred = df.join(means, same).drop(*[f"_m_{k}" for k in keys])
        x = x - F.col("_mean")
    else:
        centred = df.withColumn("_mean", df.agg(F.avg(x)).scalar())
        x = x - F.col("_mean")
    wanted = sorted({0, *lags})
    lagged = _lagged(centred, x, wanted, keys)
    sums = lagged.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(F.col("_x") * F.col(f"_l{k}")).alias(f"_s{k}") for k in wanted]
    )
    total = F.when(F.col("_s0") == 0, F.lit(1.0)).otherwise(F.col("_s0"))
    rows = F.array(
        *[
            F.struct(F.lit(k).alias("lag"), F.when(F.col("_n") > k, F.col(f"_s{k}") / total).alias("acf"))
            for k in lags
        ]
    )
    return sums.select(*keys, F.inline(rows))


def lag_correlation(
    df: DataFrame,
    metrics: Sequence[str] = ("hits", "bytes_sum"),
    lags: Sequence[int] = LAGS,
    digits: int = 4,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Pearson correlation of a series with itself some rows earlier."""
    both = F.struct(*[F.col(m).cast("double").alias(m) for m in metrics])
    pairs = [(m, k) for m in metrics for k in lags]
    lagged = _lagged(df, both, lags, keys)
    wide = lagged.groupBy(*keys).agg(
        *[pearson(F.col("_x")[m], F.col(f"_l{k}")[m]).alias(f"c{i}") for i, (m, k) in enumerate(pairs)]
    )
    rows = [
        F.struct(F.lit(m).alias("metric"), F.lit(k).alias("lag"), F.round(f"c{i}", digits).alias("corr"))
        for i, (m, k) in enumerate(pairs)
    ]
    return wide.select(*keys, F.inline(F.array(*rows)))


def histogram(df: DataFrame, value: str, bins: int = SERIES_BINS, keys: Sequence[str] = ()) -> DataFrame:
    """Counts in equal-width bins from minimum to maximum, empty bins included."""
    x = df.select(*keys, F.col(value).cast("double").alias("x")).filter("x is not null")
    bounds = x.groupBy(*keys).agg(F.min("x").alias("a"), F.max("x").alias("b"))
    flat = F.col("a") == F.col("b")
    edges = bounds.select(
        *keys,
        F.struct(
            F.when(flat, F.col("a") - 0.5).otherwise(F.col("a")).alias("lo"),
            F.when(flat, F.col("b") + 0.5).otherwise(F.col("b")).alias("hi"),
        ).alias("e")
    )
    if keys:
        known = edges.withColumnsRenamed({k: f"_e_{k}" for k in keys})
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_e_{k}")) for k in keys])
        placed = x.join(known, same)
    else:
        placed = x.withColumn("e", edges.scalar())
    width = (F.col("e.hi") - F.col("e.lo")) / bins
    bin_no = F.least(F.floor((F.col("x") - F.col("e.lo")) / width), F.lit(bins - 1)).cast("int")
    counts = placed.groupBy(*[F.col(k).alias(f"_b_{k}") for k in keys], bin_no.alias("_bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = edges.filter("e.lo is not null").select(
        *keys, "e", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    )
    met = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_b_{k}")) for k in keys], F.col("bin") == F.col("_bin"))
    return all_bins.join(counts, met, "left").select(
        *keys,
        "bin",
        (F.col("e.lo") + F.col("bin") * width).alias("bin_start"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def raw_quality(events: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Size, range, shares of missing fields and errors, and distinct hosts and urls."""

    def share(flag: Column) -> Column:
        return F.avg(F.coalesce(flag, F.lit(False)).cast("double"))

    status = F.col("status")
    return events.groupBy(*by).agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("datetime").alias("time_min"),
        F.max("datetime").alias("time_max"),
        share(F.col("datetime").isNull()).alias("datetime_na_rate"),
        share(F.col("bytes").isNull()).alias("bytes_na_rate"),
        share(F.col("bytes_missing_flag") == 1).alias("bytes_missing_flag_rate"),
        share(status.isNull()).alias("status_na_rate"),
        F.avg(client_error(status).cast("double")).alias("rate_4xx"),
        F.avg(server_error(status).cast("double")).alias("rate_5xx"),
        F.countDistinct("host").alias("unique_hosts"),
        F.countDistinct("url").alias("unique_urls"),
    )


def top_values(events: DataFrame, col: str, n: int = 10) -> DataFrame:
    """The most frequent values of all rows, NULL among them; ties by value."""
    counts = events.groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last("value")).limit(n)


def chart_series(ts3: DataFrame, cols: Sequence[str] = ("hits", "bytes_sum"), keys: Sequence[str] = ()) -> DataFrame:
    """Time and value columns of the non-gap rows, the data behind a trend line."""
    return non_gap(ts3).select(*keys, TIME, *cols)


def overlay_points(
    flagged: DataFrame, value: str, flag: str, time_col: str = TIME, keys: Sequence[str] = ()
) -> DataFrame:
    """The flagged points drawn over a trend line."""
    return flagged.filter(F.col(flag).cast("int") == 1).select(*keys, time_col, value)
