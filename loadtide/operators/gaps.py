"""Outage labels on dense series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from loadtide.functions.timegrid import TAG_SECONDS, as_column, bucket_floor, step_of_tag
from loadtide.operators import blocks as B

TIME = "bucket_start"


def min_gap_rows(step: int, hours: int) -> int:
    return hours * 3600 // step


def in_known_outage(ts: Column, step: Column | int, outages: Sequence[tuple[str, str]]) -> Column:
    """Half-open membership in any of a few known outages, ends floored to the grid."""
    hit = F.lit(False)
    for start, end in outages:
        lo, hi = (bucket_floor(F.lit(x).cast("timestamp"), step) for x in (start, end))
        hit = hit | ((ts >= lo) & (ts < hi))
    return hit


def label_from_table(
    df: DataFrame, outages: DataFrame, step: Column | int, keys: Sequence[str]
) -> DataFrame:
    """Known outages from a table ``start, end`` (and any of the keys).

    An outage is spelled out as the buckets it covers, which turns the range condition into
    an equality join that needs no broadcast. A column ``step`` is taken to be ``tag``'s,
    so outages are spelled out once per tag.
    """
    if isinstance(step, Column):
        tags = F.array(*[F.lit(t) for t in TAG_SECONDS])
        outages = outages.drop("tag").withColumn("tag", F.explode(tags))
        step = step_of_tag(F.col("tag"))
    step = as_column(step)
    shared = [k for k in keys if k in outages.columns]
    lo, hi = (bucket_floor(F.col(c), step) for c in ("start", "end"))
    covered = (
        outages.filter(hi > lo)
        .select(
            *[F.col(k).alias(f"_o_{k}") for k in shared],
            F.explode(
                F.sequence(F.unix_seconds(lo), F.unix_seconds(hi) - step, step.cast("bigint"))
            ).alias("_o_t"),
        )
        .distinct()
        .withColumn("_hit", F.lit(True))
    )
    same = F.unix_seconds(TIME) == F.col("_o_t")
    for k in shared:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    joined = df.join(covered, same, "left")
    return joined.withColumn("_known", F.coalesce("_hit", F.lit(False))).drop(
        "_hit", "_o_t", *[f"_o_{k}" for k in shared]
    )


def missing_run_lengths(
    df: DataFrame,
    flag: str = "is_missing_bucket",
    out: str = "run_length",
    *,
    keys: Sequence[str] = (),
    time_col: str = TIME,
    block_seconds: int = B.DEFAULT_BLOCK_SECONDS,
) -> DataFrame:
    """Length of the run of flagged rows a row lies in, 0 on other rows.

    A block counts its own runs. Only its first and its last one can reach into other blocks: how many flagged rows lie
    directly before and after a block comes from one row per key and block, so the rows are shuffled once, and a
    very long run needs no window of its own.
    """
    up = F.coalesce(F.col(flag).cast("int"), F.lit(0)) == 1
    rows, by = B.keyed(B.named_blocks(df, B.epoch(time_col), block_seconds), keys)
    upto = B.block_window(by, time_col).rowsBetween(Window.unboundedPreceding, 0)
    # a run is named by the number of unflagged rows up to it
    named = rows.repartition(*by, B.BLOCK).withColumn("_run", F.sum(F.when(up, 0).otherwise(1)).over(upto))
    near = named.withColumn("_part", F.sum(up.cast("int")).over(Window.partitionBy(*by, B.BLOCK, "_run")))
    ends = near.groupBy(*by, B.BLOCK).agg(
        F.max("_run").alias("_last"),
        F.coalesce(F.max(F.when(F.col("_run") == 0, F.col("_part"))), F.lit(0)).alias("_head"),
        F.max(F.struct("_run", "_part"))["_part"].alias("_tail"),
    )

    def others(order: Column) -> WindowSpec:
        return Window.partitionBy(*(by or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    def beyond(total: str, order: Column) -> Column:
        """Flagged rows of the neighbouring blocks, up to the nearest one that holds an unflagged row."""
        nearest = F.last(F.when(F.col("_last") > 0, F.col(total)), ignorenulls=True).over(others(order))
        return F.col(total) - F.coalesce(nearest, F.lit(0))

    forward, back = F.col(B.BLOCK).asc(), F.col(B.BLOCK).desc()
    for name, piece, order in (("_tails", "_tail", forward), ("_heads", "_head", back)):
        ends = ends.withColumn(name, F.coalesce(F.sum(piece).over(others(order)), F.lit(0)))
    ends = ends.select(
        *[F.col(k).alias(f"_c_{k}") for k in by], F.col(B.BLOCK).alias("_c_block"), "_last",
        beyond("_tails", forward).alias("_before"), beyond("_heads", back).alias("_after"),
    )
    same = F.col(B.BLOCK) == F.col("_c_block")
    for k in by:
        same = same & (F.col(k) == F.col(f"_c_{k}"))
    length = F.col("_part") + F.when(F.col("_run") == 0, F.col("_before")).otherwise(0)
    length = length + F.when(F.col("_run") == F.col("_last"), F.col("_after")).otherwise(0)
    return (
        near.join(ends, same)
        .withColumn(out, F.when(up, length).otherwise(0).cast("bigint"))
        .drop("_run", "_part", "_last", "_before", "_after", "_c_block", B.BLOCK, B.KEY, *[f"_c_{k}" for k in by])
    )


def label_gaps(
    df: DataFrame,
    step: Column | int,
    *,
    run_length: Column | None = None,
    outages: Sequence[tuple[str, str]] | DataFrame = (),
    unknown_gap_min_hours: int = 12,
    keys: Sequence[str] = (),
    hits_col: str = "hits",
) -> DataFrame:
    """Flags for missing buckets, known outages, long unexplained holes, and either gap.

    ``run_length`` is the hole length where the caller knows it; otherwise runs are found
    from the missing flags.
    """
    flagged = df.withColumn("is_missing_bucket", F.col(hits_col).isNull().cast("tinyint"))
    if run_length is None:
        flagged = missing_run_lengths(flagged, out="_len", keys=keys)
        run_length = F.col("_len")
    needed = F.floor(F.lit(unknown_gap_min_hours * 3600) / as_column(step))
    long_hole = F.coalesce(run_length, F.lit(0)) >= needed
    if isinstance(outages, DataFrame):
        flagged = label_from_table(flagged, outages, step, keys)
    else:
        flagged = flagged.withColumn("_known", in_known_outage(F.col(TIME), step, outages))
    known, unknown = F.col("_known"), (F.col("is_missing_bucket") == 1) & long_hole
    return flagged.withColumns(
        {
            "is_gap_storm": known.cast("tinyint"),
            "is_gap_unknown": unknown.cast("tinyint"),
            "is_gap": (known | unknown).cast("tinyint"),
        }
    ).drop("_known", "_len")


def non_gap(df: DataFrame, gap_col: str = "is_gap") -> DataFrame:
    return df.filter(F.coalesce(F.col(gap_col).cast("int"), F.lit(0)) == 0)


def segment_ids(
    df: DataFrame,
    *,
    keys: Sequence[str] = (),
    gap_col: str = "is_gap",
    seg_col: str = "segment_id",
    time_col: str = TIME,
    block_seconds: int = B.DEFAULT_BLOCK_SECONDS,
) -> DataFrame:
    """Number the contiguous non-gap runs of each key from 1; gap rows get -1.

    Inside a block the first row is taken as following a gap. Where it really continues a
    run of the block before, that one start too many is taken back through the carry.
    """
    flagged = df.withColumn(gap_col, F.coalesce(F.col(gap_col).cast("tinyint"), F.lit(0).cast("tinyint")))
    ok = F.col(gap_col) == 0
    flagged, keys = B.keyed(flagged, keys)
    blocked = B.in_blocks(flagged, B.epoch(time_col), keys, block_seconds)
    w = B.block_window(keys, time_col)
    started = blocked.withColumn(
        "_start", (ok & (F.coalesce(F.lag(gap_col).over(w), F.lit(1)) == 1)).cast("int")
    ).withColumn("_local", F.sum("_start").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    by_block = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(B.BLOCK)
    joins = (F.col("_opens") & F.coalesce(F.lag("_closes").over(by_block), F.lit(False))).cast("int")
    starts = started.groupBy(*keys, B.BLOCK).agg(
        F.sum("_start").alias("_n"),
        F.min_by(ok, time_col).alias("_opens"),
        F.max_by(ok, time_col).alias("_closes"),
    )
    offsets = (
        starts.withColumn("_joins", joins)
        .withColumn(
            "_offset",
            F.coalesce(F.sum(F.col("_n") - F.col("_joins")).over(B.earlier_blocks(keys)), F.lit(0))
            - F.col("_joins"),
        )
        .select(
            *[F.col(k).alias(f"_c_{k}") for k in keys], F.col(B.BLOCK).alias("_c_block"), "_offset"
        )
    )
    same = F.col(B.BLOCK) == F.col("_c_block")
    for k in keys:
        same = same & (F.col(k) == F.col(f"_c_{k}"))
    seg = F.when(ok, F.col("_local") + F.col("_offset")).otherwise(F.lit(-1)).cast("int")
    return (
        started.join(offsets, same)
        .withColumn(seg_col, seg)
        .drop("_start", "_local", "_offset", "_c_block", B.BLOCK, B.KEY, *[f"_c_{k}" for k in keys])
    )
