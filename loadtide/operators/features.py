"""Leakage-free features on dense series."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadtide.functions.numeric import dense_ratio
from loadtide.functions.timegrid import (
    DAY,
    calendar,
    naive_utc,
    roll_steps,
    step_index,
    step_seconds,
    steps_per_day,
)
from loadtide.operators import blocks as B
from loadtide.operators.buckets import densify, fill_series
from loadtide.operators.gaps import label_gaps, non_gap, segment_ids

TIME, GAP, SEG = "bucket_start", "is_gap", "segment_id"
RATIO = "avg_bytes_per_req"


@dataclass(frozen=True)
class FeatureSpec:
    # Lag days, look-back windows, label distance and carried-over columns.
    lag_days: tuple[int, ...] = (1, 2, 3, 4, 5, 6, 7)
    roll_windows: tuple[str, ...] = ("1h", "6h", "1d")
    roll_use_std: bool = True
    use_cyclic: bool = True
    horizon_steps: int = 1
    require_cols: tuple[str, ...] = (TIME, "hits", "bytes_sum", GAP)
    keep_raw_extra: tuple[str, ...] = (
        "unique_hosts",
        "err_4xx",
        "err_5xx",
        "error_rate",
        "is_missing_bucket",
        "is_gap_storm",
        "is_gap_unknown",
    )
    utc_offset: str = "+00:00"
    labels: Mapping[str, str] = field(
        default_factory=lambda: {"hits": "y_hits_next", "bytes_sum": "y_bytes_sum_next"}
    )

    @property
    def time_cols(self) -> list[str]:
        parts = ["hour", "minute", "dayofweek", "month", "dayofyear", "is_weekend", "time_idx"]
        return parts + (["hour_sin", "hour_cos", "dow_sin", "dow_cos"] if self.use_cyclic else [])

    def lag_cols(self, target: str) -> list[str]:
        cols = [f"{target}_lag_{d}d" for d in self.lag_days]
        if len(self.lag_days) >= 2:
            cols.append(f"{target}_diff_lag_{self.lag_days[0]}d_{self.lag_days[1]}d")
        return cols

    def roll_cols(self, target: str) -> list[str]:
        kinds = ("mean", "std") if self.roll_use_std else ("mean",)
        return [f"{target}_roll_{k}_{w}" for w in self.roll_windows for k in kinds]

    def feature_cols(self, target: str) -> list[str]:
        if target == "hits":
            return self.time_cols + self.lag_cols("hits") + self.roll_cols("hits")
        return (
            self.time_cols
            + self.lag_cols("bytes_sum")
            + self.roll_cols("bytes_sum")
            + self.roll_cols(RATIO)
            + self.roll_cols("hits")
        )

    @property
    def all_cols(self) -> list[str]:
        return sorted({*self.feature_cols("hits"), *self.feature_cols("bytes_sum")})


def require_columns(df: DataFrame, cols: Sequence[str], name: str = "frame") -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"[{name}] missing required cols: {missing}")


def with_dense_ratio(df: DataFrame) -> DataFrame:
    return df.withColumn(RATIO, dense_ratio(F.col("bytes_sum"), F.col("hits")))


def with_time_features(
    df: DataFrame, tag: str, reference: Column, spec: FeatureSpec = FeatureSpec()
) -> DataFrame:
    parts = calendar(F.col(TIME), spec.utc_offset, spec.use_cyclic)
    parts["time_idx"] = step_index(F.col(TIME), reference, step_seconds(tag))
    return df.withColumns(parts)


def _seg_window(keys: Sequence[str]):
    return B.block_window(keys, TIME, SEG)


def _in_segment(value: Column) -> Column:
    return F.when(F.col(SEG) >= 0, value)


def lag_exprs(target: str, tag: str, keys: Sequence[str], lag_days: Sequence[int]) -> dict[str, Column]:
    w, per_day = _seg_window(keys), steps_per_day(tag)
    return {
        f"{target}_lag_{d}d": _in_segment(F.lag(F.col(target).cast("double"), d * per_day).over(w))
        for d in lag_days
    }


def diff_expr(target: str, lag_days: Sequence[int]) -> dict[str, Column]:
    if len(lag_days) < 2:
        return {}
    a, b = lag_days[:2]
    return {f"{target}_diff_lag_{a}d_{b}d": F.col(f"{target}_lag_{a}d") - F.col(f"{target}_lag_{b}d")}


def label_exprs(labels: Mapping[str, str], keys: Sequence[str], horizon: int) -> dict[str, Column]:
    w = _seg_window(keys)
    return {
        out: _in_segment(F.lead(F.col(target).cast("double"), horizon).over(w))
        for target, out in labels.items()
    }


def rolling_columns(
    blocked: DataFrame,
    targets: Sequence[str],
    tag: str,
    windows: Sequence[str],
    *,
    keys: Sequence[str] = (),
    use_std: bool = True,
    alongside: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Mean and sample deviation of the previous n rows of the segment, NULL until n values.

    A frame of n rows is the tail of one aligned n-row stretch plus the head of the next.
    Heads and tails are running aggregates, so the cost per row does not grow with n, and
    two sets of (count, sum, squared deviations) merge without cancellation. ``alongside``
    holds further expressions over the segment window, evaluated in the same pass.
    """
    step = step_seconds(tag)
    steps = roll_steps(tag, windows)
    stats = ("n", "s", "v") if use_std else ("n", "s")
    upto = (Window.unboundedPreceding, 0)
    w = _seg_window(keys)
    scratch: list[str] = []
    picks: dict[str, Column] = dict(alongside or {})
    for name, n in steps.items():
        stretch = f"_s_{name}"
        blocked = blocked.withColumn(stretch, F.floor(F.unix_seconds(TIME) / F.lit(n * step)))
        part = [*keys, B.BLOCK, SEG, stretch]
        head = Window.partitionBy(*part).orderBy(TIME).rowsBetween(*upto)
        tail = Window.partitionBy(*part).orderBy(F.desc(TIME)).rowsBetween(*upto)
        running = {}
        for i, target in enumerate(targets):
            x = F.col(target).cast("double")
            made = {"n": F.count(x), "s": F.sum(x), "v": F.var_pop(x)}
            for s in stats:
                running[f"_h{s}{i}_{name}"] = made[s].over(head)
                running[f"_t{s}{i}_{name}"] = made[s].over(tail)
                picks[f"_a{s}{i}_{name}"] = F.lag(f"_t{s}{i}_{name}", n).over(w)
                picks[f"_b{s}{i}_{name}"] = F.lag(f"_h{s}{i}_{name}", 1).over(w)
        # an aligned frame is one whole stretch and its tail already covers it
        picks[f"_split_{name}"] = F.lag(stretch, n).over(w) != F.lag(stretch, 1).over(w)
        blocked = blocked.withColumns(running)
        scratch += [stretch, *running]
    blocked = blocked.withColumns(picks)
    out = {}
    for name, n in steps.items():
        split = F.col(f"_split_{name}")
        for i, target in enumerate(targets):
            na, nb, sa, sb = (F.col(f"_{c}{i}_{name}") for c in ("an", "bn", "as", "bs"))
            total = F.when(split, na + nb).otherwise(na).cast("double")
            mean = F.try_divide(F.when(split, sa + sb).otherwise(sa), total)
            shift = F.try_divide(sb, nb) - F.try_divide(sa, na)
            full = (F.col(SEG) >= 0) & (total == float(n))
            out[f"{target}_roll_mean_{name}"] = F.when(full, mean)
            if use_std:
                va, vb = (F.col(f"_{c}{i}_{name}") for c in ("av", "bv"))
                both = va * na + vb * nb + F.try_divide(shift * shift * na * nb, total)
                squares = F.when(split, both).otherwise(va * na)
                deviation = F.sqrt(squares / F.lit(n - 1.0)) if n > 1 else F.lit(None).cast("double")
                out[f"{target}_roll_std_{name}"] = F.when(full, deviation)
    scratch += [c for c in picks if c not in (alongside or {})]
    return blocked.withColumns(out).drop(*scratch)


def _reach(spec: FeatureSpec, windows: bool, lags: bool) -> int:
    days = max(spec.lag_days, default=0) if lags else 0
    return max(days, 1 if windows else 0) * DAY


def with_lags(
    df: DataFrame, tag: str, target: str, lag_days: Sequence[int], keys: Sequence[str] = ()
) -> DataFrame:
    """Values whole days back in the same segment of a dense series."""
    halo = B.with_halo(df, B.epoch(TIME), keys, before=max(lag_days) * DAY)
    lagged = halo.withColumns(lag_exprs(target, tag, keys, lag_days))
    return B.owned(lagged.withColumns(diff_expr(target, lag_days)))


def with_rolling(
    df: DataFrame,
    tag: str,
    target: str,
    windows: Sequence[str],
    use_std: bool = True,
    keys: Sequence[str] = (),
) -> DataFrame:
    halo = B.with_halo(df, B.epoch(TIME), keys, before=DAY + step_seconds(tag))
    return B.owned(rolling_columns(halo, [target], tag, windows, keys=keys, use_std=use_std))


def with_labels(
    df: DataFrame, tag: str, target: str, label_col: str, horizon_steps: int = 1, keys: Sequence[str] = ()
) -> DataFrame:
    halo = B.with_halo(df, B.epoch(TIME), keys, after=horizon_steps * step_seconds(tag))
    return B.owned(halo.withColumns(label_exprs({target: label_col}, keys, horizon_steps)))


def history_features(
    df: DataFrame,
    tag: str,
    spec: FeatureSpec,
    keys: Sequence[str] = (),
    labels: bool = False,
) -> DataFrame:
    """Lags, rolling statistics and optionally labels of all targets in one partitioning."""
    step = step_seconds(tag)
    halo = B.with_halo(
        df,
        B.epoch(TIME),
        keys,
        before=max(_reach(spec, True, True), DAY + step),
        after=spec.horizon_steps * step if labels else 0,
    )
    exprs: dict[str, Column] = {}
    for target in ("hits", "bytes_sum"):
        exprs |= lag_exprs(target, tag, keys, spec.lag_days)
    if labels:
        exprs |= label_exprs(spec.labels, keys, spec.horizon_steps)
    rolled = rolling_columns(
        halo,
        ["hits", "bytes_sum", RATIO],
        tag,
        spec.roll_windows,
        keys=keys,
        use_std=spec.roll_use_std,
        alongside=exprs,
    )
    for target in ("hits", "bytes_sum"):
        rolled = rolled.withColumns(diff_expr(target, spec.lag_days))
    return B.owned(rolled)


def reference_time(*frames: DataFrame) -> Column:
    """First bucket of all frames, as a one-row scalar subquery of the plan."""
    times = reduce(DataFrame.unionAll, [f.select(TIME) for f in frames])
    return times.agg(F.min(TIME)).scalar()


def train_features(
    train: DataFrame,
    test: DataFrame,
    tag: str,
    spec: FeatureSpec = FeatureSpec(),
    keys: Sequence[str] = (),
    keep_unlabelled: bool = False,
) -> DataFrame:
    """Feature rows outside outages, with next-step labels; unlabelled rows are dropped."""
    for name, df in (("train", train), ("test", test)):
        require_columns(df, spec.require_cols, f"{name}_{tag}")
    clean = with_dense_ratio(non_gap(segment_ids(train, keys=keys), GAP))
    timed = with_time_features(
        history_features(clean, tag, spec, keys, labels=True), tag, reference_time(train, test), spec
    )
    extra = [c for c in spec.keep_raw_extra if c in train.columns]
    label_cols = list(spec.labels.values())
    out = timed.select(
        *keys, TIME, GAP, SEG, "hits", "bytes_sum", RATIO, *extra, *label_cols, *spec.all_cols
    )
    return out if keep_unlabelled else out.dropna(subset=label_cols)


def with_history(
    train: DataFrame,
    test: DataFrame,
    tag: str,
    *,
    outages: Sequence[tuple[str, str]] | DataFrame = (),
    unknown_gap_min_hours: int = 12,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Both splits as one dense series, the origin kept in ``_split``.

    Buckets between the end of one split and the start of the other are added and labelled
    like any hole, so that lags by rows stay lags by time.
    """
    step = step_seconds(tag)
    both = train.withColumn("_split", F.lit("train")).unionByName(
        test.withColumn("_split", F.lit("test")), allowMissingColumns=True
    )
    dense = densify(both, step, keys)
    flags = [c for c in ("is_missing_bucket", "is_gap_storm", "is_gap_unknown") if c in both.columns]
    added = F.col("_absent_run").isNotNull()
    kept = dense.withColumns({f"_kept_{c}": F.col(c) for c in (*flags, GAP)})
    labelled = label_gaps(
        kept,
        step,
        run_length=F.col("_absent_run"),
        outages=outages,
        unknown_gap_min_hours=unknown_gap_min_hours,
        keys=keys,
    )
    restored = labelled.withColumns(
        {c: F.when(added, F.col(c)).otherwise(F.col(f"_kept_{c}")) for c in (*flags, GAP)}
    )
    return fill_series(restored).drop("_absent_run", *[f"_kept_{c}" for c in (*flags, GAP)])


def test_features(
    train: DataFrame,
    test: DataFrame,
    tag: str,
    spec: FeatureSpec = FeatureSpec(),
    keys: Sequence[str] = (),
    *,
    outages: Sequence[tuple[str, str]] | DataFrame = (),
    unknown_gap_min_hours: int = 12,
) -> DataFrame:
    """Features of the test rows, looking back into the train rows."""
    both = with_history(
        train, test, tag, outages=outages, unknown_gap_min_hours=unknown_gap_min_hours, keys=keys
    )
    ready = with_dense_ratio(segment_ids(both, keys=keys))
    featured = history_features(ready, tag, spec, keys).filter(F.col("_split") == "test")
    timed = with_time_features(featured, tag, reference_time(train, test), spec)
    return timed.withColumn(TIME, naive_utc(F.col(TIME))).select(
        *keys, TIME, GAP, SEG, "hits", "bytes_sum", RATIO, *spec.all_cols
    )


def truth_frame(test: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    return segment_ids(test, keys=keys).select(
        *keys,
        naive_utc(F.col(TIME)).alias(TIME),
        F.col("hits").alias("hits_true"),
        F.col("bytes_sum").alias("bytes_sum_true"),
        GAP,
        SEG,
    )


def quality_profile(
    df: DataFrame, cols: Sequence[str] = ("hits", "bytes_sum"), keys: Sequence[str] = ()
) -> DataFrame:
    """One row per key: rows, repeated times and the share of NULLs per column."""
    per_time = df.groupBy(*keys, TIME).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count_if(F.col(c).isNull()).alias(f"_null_{c}") for c in cols],
    )
    return per_time.groupBy(*keys).agg(
        F.sum("_n").alias("rows"),
        F.sum(F.col("_n") - 1).alias("duplicate_times"),
        *[(F.sum(f"_null_{c}") / F.sum("_n")).alias(f"{c}_na_rate") for c in cols],
    )


def assert_quality(
    df: DataFrame,
    cols: Sequence[str] = ("hits", "bytes_sum"),
    keys: Sequence[str] = (),
    max_na_rate: float = 0.01,
) -> None:
    """Raise on repeated times or too many NULLs; collects one row, the worst over the keys."""
    worst = quality_profile(df, cols, keys).agg(
        F.max("duplicate_times").alias("duplicate_times"), *[F.max(f"{c}_na_rate").alias(f"{c}_na_rate") for c in cols]
    )
    row = worst.first()
    if row["duplicate_times"]:
        raise ValueError(f"duplicate timestamps: {row['duplicate_times']}")
    for c in cols:
        rate = row[f"{c}_na_rate"]
        if rate is not None and rate > max_na_rate:
            raise ValueError(f"{c} NA rate = {rate:.4f}")


def na_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Share of NULLs per column; NULL for a column that does not exist."""
    present = [c for c in cols if c in df.columns]
    shares = df.agg(
        *[F.avg(F.col(c).isNull().cast("double")).alias(c) for c in present],
        *[F.lit(None).cast("double").alias(c) for c in cols if c not in present],
    )
    pairs = F.array(*[F.struct(F.lit(c).alias("col"), F.col(c).alias("na_rate")) for c in cols])
    return shares.select(F.inline(pairs))


def feature_report(
    by_tag: Mapping[str, DataFrame], spec: FeatureSpec = FeatureSpec()
) -> DataFrame:
    """Per tag: labelled rows, rows without a label and the number of features."""
    labels = list(spec.labels.values())
    labelled = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in labels])
    rows = [
        df.agg(
            F.lit(tag).alias("tag"),
            F.count_if(labelled).alias("rows_out_train"),
            F.count_if(~labelled).alias("dropped_na_train_labels"),
            F.lit(len(spec.all_cols)).alias("n_features"),
        )
        for tag, df in by_tag.items()
    ]
    return reduce(DataFrame.unionAll, rows)
