"""Windows over long series without putting a whole series into one task.

A series is cut into time blocks. Frames of bounded reach get a halo: every row is copied
to the blocks whose rows can see it, windows partition by ``(keys, block)`` and only the
rows a block owns are kept. Running values are computed inside blocks and completed with a
carry folded over the per-block totals, a table of one row per key and block.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

BLOCK = "_block"
KEY = "_key"
OWN = "_own"
POSITION_BLOCK = 1 << 16
DEFAULT_BLOCK_SECONDS = 28 * 86400


def epoch(ts: str) -> Column:
    return F.unix_seconds(F.col(ts).cast("timestamp"))


def block_of(order: Column, size: int) -> Column:
    return F.floor(order / F.lit(size)).cast("bigint")


def keyed(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """``df`` with all keys in one struct, which is never null, and the columns to partition by.

    A null-safe join is rewritten to other expressions than the partitioning's and shuffles the rows again.
    Equality on the struct treats nulls as equal and keeps the partitioning.
    """
    return (df.withColumn(KEY, F.struct(*keys)), [KEY]) if keys else (df, [])


def with_halo(
    df: DataFrame,
    order: Column,
    keys: Sequence[str],
    *,
    before: int = 0,
    after: int = 0,
    size: int = DEFAULT_BLOCK_SECONDS,
) -> DataFrame:
    """Copy rows to every block that looks ``before``/``after`` units around its own rows."""
    size = max(size, 2 * (before + after))
    home = block_of(order, size)
    spread = F.sequence(block_of(order - F.lit(after), size), block_of(order + F.lit(before), size))
    return (
        df.withColumn("_home", home)
        .withColumn(BLOCK, F.explode(spread))
        .withColumn(OWN, F.col(BLOCK) == F.col("_home"))
        .drop("_home")
        .repartition(*keys, BLOCK)
    )


def owned(df: DataFrame, *extra: str) -> DataFrame:
    return df.filter(OWN).drop(BLOCK, OWN, *extra)


def named_blocks(df: DataFrame, order: Column, size: int = DEFAULT_BLOCK_SECONDS) -> DataFrame:
    return df.withColumn(BLOCK, block_of(order, size))


def in_blocks(
    df: DataFrame, order: Column, keys: Sequence[str], size: int = DEFAULT_BLOCK_SECONDS
) -> DataFrame:
    return named_blocks(df, order, size).repartition(*keys, BLOCK)


def block_window(keys: Sequence[str], order: str | Column, *extra: str) -> WindowSpec:
    return Window.partitionBy(*keys, BLOCK, *extra).orderBy(order)


def earlier_blocks(keys: Sequence[str]) -> WindowSpec:
    """All blocks before the current one; one row per block, so small even without keys."""
    return (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(BLOCK)
        .rowsBetween(Window.unboundedPreceding, -1)
    )


def with_carry(
    df: DataFrame,
    keys: Sequence[str],
    totals: Mapping[str, Column],
    carry: Mapping[str, Column],
    source: DataFrame | None = None,
) -> DataFrame:
    """Join values folded over the earlier blocks of the same key to every row.

    ``totals`` are aggregates per block, ``carry`` are expressions over those columns.
    ``source`` holds the same rows before they were spread by block; totals taken from it
    are combined on the map side, so only one row per block is shuffled for them.
    """
    rows = df if source is None else source
    per_block = rows.groupBy(*keys, BLOCK).agg(*[c.alias(n) for n, c in totals.items()])
    folded = per_block.select(
        *[F.col(k).alias(f"_c_{k}") for k in keys],
        F.col(BLOCK).alias("_c_block"),
        *[c.alias(n) for n, c in carry.items()],
    )
    same = F.col(BLOCK) == F.col("_c_block")
    for k in keys:
        same = same & ((F.col(k) == F.col(f"_c_{k}")) if k == KEY else F.col(k).eqNullSafe(F.col(f"_c_{k}")))
    return df.join(folded, same).drop("_c_block", *[f"_c_{k}" for k in keys])


def running_sum(
    df: DataFrame,
    value: Column,
    out: str,
    *,
    order: str,
    keys: Sequence[str] = (),
    size: int = DEFAULT_BLOCK_SECONDS,
) -> DataFrame:
    """Inclusive prefix sum along a time column."""
    rows, keys = keyed(named_blocks(df.withColumn("_v", value), epoch(order), size), keys)
    upto = block_window(keys, order).rowsBetween(Window.unboundedPreceding, 0)
    local = rows.repartition(*keys, BLOCK).withColumn("_local", F.sum("_v").over(upto))
    carried = with_carry(
        local,
        keys,
        {"_total": F.sum("_v")},
        {"_before": F.sum("_total").over(earlier_blocks(keys))},
        source=rows,
    )
    total = F.coalesce(F.col("_before"), F.lit(0)) + F.col("_local")
    return carried.withColumn(out, total).drop("_v", "_local", "_before", BLOCK, KEY)


def positions(
    df: DataFrame,
    out: str,
    *,
    order: str,
    keys: Sequence[str] = (),
    size: int = DEFAULT_BLOCK_SECONDS,
) -> DataFrame:
    """1-based row number along a time column with distinct values per key."""
    return running_sum(df, F.lit(1), out, order=order, keys=keys, size=size).withColumn(
        out, F.col(out).cast("bigint")
    )
