"""Seasonal-naive forecasts and time-ordered validation splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.functions.numeric import finite_or_zero
from loadtide.functions.timegrid import DAY, naive_utc, step_seconds, steps_per_day
from loadtide.operators import blocks as B
from loadtide.operators.gaps import non_gap

TIME = "bucket_start"


def seasonal_naive(
    train: DataFrame,
    test: DataFrame,
    tag: str,
    target: str,
    *,
    keys: Sequence[str] = (),
    compact_history: bool = True,
    model_name: str = "seasonal_naive",
) -> DataFrame:
    """Next-step forecast per test row: the value one season before the forecast time.

    With ``compact_history`` the outages of the train split are closed up, otherwise they
    count as zero load. A history shorter than a season repeats its last value.
    """
    season = steps_per_day(tag)
    history = non_gap(train) if compact_history and "is_gap" in train.columns else train
    cols = [*keys, TIME, F.col(target).cast("double").alias(target)]
    both = (
        history.select(*cols, F.lit(False).alias("_test"))
        .unionByName(test.select(*cols, F.lit(True).alias("_test")))
        .withColumn("_y", finite_or_zero(F.col(target)))
    )
    placed = B.positions(both, "_pos", order=TIME, keys=keys)
    halo = B.with_halo(
        placed, F.col("_pos"), keys, before=season - 1, after=1, size=B.POSITION_BLOCK
    )
    w = B.block_window(keys, "_pos")
    ahead = halo.withColumns(
        {
            "true_next": F.lead(target, 1).over(w),
            "_season": F.lag("_y", season - 1).over(w),
        }
    )
    pred = F.when(F.col("_pos") >= season, F.col("_season")).otherwise(F.col("_y"))
    return (
        B.owned(ahead)
        .filter(F.col("_test") & F.col("true_next").isNotNull())
        .select(
            *keys,
            naive_utc(F.col(TIME)).alias(TIME),
            target,
            "true_next",
            F.greatest(pred, F.lit(0.0)).alias("pred"),
            F.lit(model_name).alias("model"),
        )
    )


def tile_last_season(
    history: DataFrame,
    value: str,
    horizon: int,
    season: int,
    *,
    keys: Sequence[str] = (),
    order: str = TIME,
) -> DataFrame:
    """Repeat the last season up to ``horizon`` steps; a short history repeats its last value."""
    placed = B.positions(history, "_pos", order=order, keys=keys)
    length = history.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    ahead = length.withColumn("horizon_step", F.explode(F.sequence(F.lit(1), F.lit(horizon))))
    back = F.when(
        F.col("_n") >= season,
        F.col("_n") - season + 1 + F.pmod(F.col("horizon_step") - 1, F.lit(season)),
    ).otherwise(F.col("_n"))
    wanted = ahead.select(*[F.col(k).alias(f"_w_{k}") for k in keys], "horizon_step", back.alias("_at"))
    same = F.col("_at") == F.col("_pos")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_w_{k}"))
    found = wanted.join(placed.select(*keys, "_pos", value), same, "left")
    return found.select(
        *[F.col(f"_w_{k}").alias(k) for k in keys],
        "horizon_step",
        F.coalesce(F.col(value).cast("double"), F.lit(0.0)).alias("forecast"),
    )


def next_truth(
    df: DataFrame, target: str, tag: str, *, keys: Sequence[str] = (), time_col: str = TIME
) -> DataFrame:
    """Rows of a dense series with the following value; the last row has none and goes."""
    halo = B.with_halo(df, B.epoch(time_col), keys, after=step_seconds(tag))
    nxt = F.lead(F.col(target).cast("double"), 1).over(B.block_window(keys, time_col))
    return B.owned(halo.withColumn("true_next", nxt)).filter("true_next is not null")


def time_folds(
    df: DataFrame,
    tag: str,
    *,
    splits: int = 5,
    test_days: int = 2,
    gap_steps: int = 1,
    keys: Sequence[str] = (),
    time_col: str = TIME,
) -> DataFrame:
    """Expanding-train folds with a gap before each validation stretch.

    A row appears once per fold it takes part in, with ``fold`` and ``role``. Series too
    short for two folds yield no rows.
    """
    size = max(1, test_days * DAY // step_seconds(tag))
    placed = B.positions(df, "_pos", order=time_col, keys=keys)
    length = df.groupBy(*[F.col(k).alias(f"_n_{k}") for k in keys]).agg(
        F.count(F.lit(1)).alias("_n")
    )
    if keys:
        same = None
        for k in keys:
            eq = F.col(k).eqNullSafe(F.col(f"_n_{k}"))
            same = eq if same is None else same & eq
        sized = placed.join(length, same).drop(*[f"_n_{k}" for k in keys])
    else:
        sized = placed.withColumn("_n", length.scalar())
    folds = F.least(F.lit(splits), F.floor((F.col("_n") - gap_steps) / F.lit(size)) - 1)
    spread = sized.withColumn("_k", folds).filter("_k >= 2")
    spread = spread.withColumn("fold", F.explode(F.sequence(F.lit(1), F.col("_k").cast("int"))))
    start = F.col("_n") - (F.col("_k") - F.col("fold") + 1) * F.lit(size)
    at = F.col("_pos") - 1
    role = F.when(at < start - gap_steps, "train").when(
        (at >= start) & (at < start + size), "validation"
    )
    return spread.withColumn("role", role).filter("role is not null").drop("_pos", "_n", "_k")
