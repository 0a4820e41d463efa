"""Joins by time: the last value before an instant, overlaps of intervals and their totals, all by equality on blocks of time."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadtide.operators import blocks as B

LEVEL_FACTOR = 4
SALTS = 8
# microseconds of a leaf, the coarsest first: days, hours, minutes, seconds, milliseconds
LEAVES = (86_400_000_000, 3_600_000_000, 60_000_000, 1_000_000, 1_000, 1)
# a tree of at most so many nodes goes to all tasks; it depends on the range of time and the width of a leaf only
BROADCAST_NODES = 1 << 19
# how a left interval meets a node
BEGIN, OVER_START, OVER_END, OVER_BOTH = range(4)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    values: Sequence[str],
    *,
    keys: Sequence[str] = (),
    left_time: str = "bucket_start",
    right_time: str = "datetime",
    out_time: str | None = None,
    tolerance_seconds: int | None = None,
    block_seconds: int = B.DEFAULT_BLOCK_SECONDS,
) -> DataFrame:
    """``left`` with ``values`` of the last row of ``right`` at or before its time, per key.

    Both sides go to the block of their time in one shuffle. Inside a block the last value is a running one; a left row
    before the block's first right row takes the last value of the earlier blocks, from a table of one row per key and
    block. No pair of rows is ever formed. Right rows of equal time: the one with the greatest values counts. ``out_time``
    names a column for the time that was met; nothing older than ``tolerance_seconds`` is met. Null keys equal each
    other. A left row without a time meets nothing and stays; a right row without a time is ignored.
    """
    met = F.struct(F.col(right_time).cast("timestamp").alias("t"), *[F.col(v) for v in values])
    kept = F.struct(*[F.col(f"`{c}`") for c in left.columns])
    rows = left.select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(left_time).cast("timestamp").alias("_t"), kept.alias("_row")
    )
    theirs = right.filter(F.col(right_time).isNotNull()).select(
        *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(right_time).cast("timestamp").alias("_t"), met.alias("_met")
    )
    both = rows.unionByName(theirs, allowMissingColumns=True)
    both, by = B.keyed(B.named_blocks(both, F.coalesce(B.epoch("_t"), F.lit(0)), block_seconds), [f"_k{i}" for i in range(len(keys))])
    upto = Window.partitionBy(*by, B.BLOCK).orderBy("_t", F.col("_row").isNotNull(), "_met")
    upto = upto.rowsBetween(Window.unboundedPreceding, 0)
    near = both.repartition(*by, B.BLOCK).withColumn("_near", F.last("_met", ignorenulls=True).over(upto))
    carried = B.with_carry(
        near,
        by,
        {"_latest": F.max("_met")},
        {"_far": F.last("_latest", ignorenulls=True).over(B.earlier_blocks(by))},
        source=both,
    )
    found = F.coalesce("_near", "_far")
    here = F.col("_t").isNotNull()
    if tolerance_seconds is not None:
        here = here & (F.col("_t") <= found["t"] + F.make_dt_interval(secs=F.lit(tolerance_seconds)))
    out = carried.filter(F.col("_row").isNotNull()).select("_row", F.when(here, found).alias("_found"))
    extra = [F.col("_found.t").alias(out_time)] if out_time else []
    return out.select("_row.*", *[F.col("_found")[v].alias(v) for v in values], *extra)


def _level(length: Column, base: int) -> Column:
    """Index of the smallest width ``base * LEVEL_FACTOR**level`` that is not shorter than ``length``."""
    exact = F.ceil(F.log(F.greatest(length, F.lit(1)) / F.lit(float(base))) / F.log(F.lit(float(LEVEL_FACTOR))))
    # a rounding error may only make the level too large by one, never too small
    return F.greatest(exact + F.when(F.pow(F.lit(float(LEVEL_FACTOR)), exact) * base < length, 1).otherwise(0), F.lit(0)).cast("int")


def _width(level: Column, base: int) -> Column:
    return (F.pow(F.lit(float(LEVEL_FACTOR)), level) * base).cast("bigint")


def interval_join(
    left: DataFrame,
    right: DataFrame,
    *,
    keys: Sequence[str] = (),
    start: str = "start",
    end: str = "end",
    base_seconds: int = 900,
    salts: int = SALTS,
) -> DataFrame:
    """Pairs of rows whose half-open intervals overlap, as structs ``left`` and ``right``, each pair once.

    An interval lies in at most two bins of the width that fits its length. The shorter one of a pair is looked up in the bins of
    the longer one's width: it is copied once or twice for every width that occurs on the other side, some ten at most,
    however long the longest interval is. The pair counts in the bin where the later of the two starts. Rows that
    lie in a bin with a longer interval are spread over ``salts``, to which the longer one is copied, so one interval
    over everything is no single task. Empty intervals, null ends and null keys meet nothing.
    """

    def prepared(df: DataFrame, side: str) -> DataFrame:
        lo, hi = (F.col(c).cast("timestamp") for c in (start, end))
        rows = df.select(
            *[F.col(k).alias(f"_{side}k{i}") for i, k in enumerate(keys)], F.unix_micros(lo).alias(f"_{side}lo"), F.unix_micros(hi).alias(f"_{side}hi"),
            F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(side),
        ).filter(F.col(f"_{side}lo") < F.col(f"_{side}hi"))
        seconds = F.ceil((F.col(f"_{side}hi") - F.col(f"_{side}lo")) / 1e6)
        return rows.withColumn(f"_{side}level", _level(seconds, base_seconds))

    l, r = prepared(left, "left"), prepared(right, "right")  # noqa: E741
    micros = lambda level: _width(level, base_seconds) * 1_000_000
    cell = lambda t, level: F.floor(t / micros(level)).cast("bigint")

    def bins(df: DataFrame, side: str, levels: Column, salt: Column) -> DataFrame:
        at = df.withColumn(f"_{side}at", F.explode(levels))
        first, last = cell(F.col(f"_{side}lo"), F.col(f"_{side}at")), cell(F.col(f"_{side}hi") - 1, F.col(f"_{side}at"))
        return at.withColumn(f"_{side}bin", F.explode(F.sequence(first, last))).withColumn(f"_{side}salt", salt)

    def meet(short: DataFrame, s: str, long: DataFrame, t: str, own_too: bool) -> DataFrame:
        # the widths that occur: a handful of whole numbers
        levels = sorted(x[0] for x in long.select(f"_{t}level").distinct().collect())
        own = F.col(f"_{s}level")
        above = F.filter(F.array(*[F.lit(x) for x in levels]).cast("array<int>"), lambda x: (x >= own) if own_too else (x > own))
        spread = F.pmod(F.xxhash64(f"_{s}lo", f"_{s}hi", s), F.lit(salts))
        a = bins(short, s, above, spread.cast("int"))
        b = bins(long, t, F.array(F.col(f"_{t}level")), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        same = (F.col(f"_{s}at") == F.col(f"_{t}at")) & (F.col(f"_{s}bin") == F.col(f"_{t}bin")) & (F.col(f"_{s}salt") == F.col(f"_{t}salt"))
        for i in range(len(keys)):
            same = same & (F.col(f"_{s}k{i}") == F.col(f"_{t}k{i}"))
        overlap = (F.col(f"_{s}lo") < F.col(f"_{t}hi")) & (F.col(f"_{t}lo") < F.col(f"_{s}hi"))
        here = F.col(f"_{s}bin") == cell(F.greatest(f"_{s}lo", f"_{t}lo"), F.col(f"_{s}at"))
        return a.join(b, same).filter(overlap & here).select("left", "right")

    return meet(l, "left", r, "right", True).unionByName(meet(r, "right", l, "left", False))


def _stretches(lo: Column, hi: Column, levels: int, kind: int) -> list[Column]:
    """Nodes of the binary tree over [0, 2**levels) that make up ``lo`` to ``hi`` (half-open), at most two per level; null where there is none."""
    out = []
    for level in range(levels + 1):
        first, end = F.shiftright(lo + ((1 << level) - 1), level), F.shiftright(hi, level)
        some = first < end
        out.append(F.when(some & (first % 2 == 1), _node(first, level, kind)))
        out.append(F.when(some & (end % 2 == 1), _node(end - 1, level, kind)))
    return out


def _node(index: Column, level: int, kind: int) -> Column:
    return index * 128 + (2 * level + kind)


def overlap_totals(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    totals: Mapping[str, Column],
    *,
    keys: Sequence[str] = (),
    start: str = "start",
    end: str = "end",
    seconds: str = "seconds",
) -> DataFrame:
    """What grouping the pairs of ``interval_join`` by ``by`` (columns of the left) and adding up gives, without forming a pair.

    ``totals`` are aggregates of the right's columns whose pieces can be added up (a name that starts with ``max_`` or ``min_`` takes
    the extreme); ``seconds`` are those shared with the right intervals, whole seconds at both ends. A right interval meets a left one if it lies over the left
    one's start or begins inside it, never both. Right intervals are kept as totals of the nodes of a binary tree over time: of those that cover a node (two
    nodes per level and interval), and of those that begin in it. A left interval looks up the nodes over its ends and those it is
    made of. So rows grow with both inputs and the number of levels, not with the pairs. The leaves are as
    wide as the right's times allow: days, hours, minutes, seconds or less. Left intervals that meet nothing are left out.
    """
    lo, hi = (F.unix_micros(F.col(c).cast("timestamp")) for c in (start, end))
    theirs = right.withColumns({"_lo": lo, "_hi": hi}).filter("_lo < _hi")
    whole = [F.every((F.pmod("_lo", F.lit(u)) == 0) & (F.pmod("_hi", F.lit(u)) == 0)).alias(f"_{u}") for u in LEAVES]
    grid = theirs.agg(F.min("_lo").alias("origin"), F.max("_hi").alias("end"), *whole).first()
    unit = next((u for u in LEAVES if grid[f"_{u}"]), 1)
    origin = grid["origin"] or 0
    span = ((grid["end"] or 0) - origin) // unit
    levels = max(span - 1, 0).bit_length()

    def leaf(micros: Column) -> Column:
        from_origin = micros - origin
        return ((from_origin - F.pmod(from_origin, F.lit(unit))) / unit).cast("bigint")

    a, b = leaf(F.col("_lo")), leaf(F.col("_hi"))
    nodes = _stretches(a, b, levels, 0) + [_node(F.shiftright(a, n), n, 1) for n in range(levels + 1)]
    first, last = (F.floor(F.col(c) / 1_000_000).cast("bigint") for c in ("_lo", "_hi"))
    names = {n: f"_total{i}" for i, n in enumerate(totals)}
    at = [f"_k{i}" for i in range(len(keys))]
    tree = (
        theirs.withColumns({k: F.col(c) for k, c in zip(at, keys)})
        .withColumn("_node", F.explode(F.array_compact(F.array(*nodes))))
        .groupBy(*at, "_node")
        .agg(*[c.alias(names[n]) for n, c in totals.items()], F.count(F.lit(1)).alias("_n"), F.sum(last).alias("_ends"), F.sum(last - first).alias("_length"))
    )
    if not keys and 4 << levels <= BROADCAST_NODES:
        tree = F.broadcast(tree)

    mine = left.select(*[F.col(k).alias(n) for n, k in zip(at, keys)], *by, lo.alias("_lo"), hi.alias("_hi")).filter("_lo < _hi")
    mine = mine.select(*at, *by, leaf(F.col("_lo")).alias("_a"), leaf(F.col("_hi") - 1).alias("_b"), first.alias("_from"), last.alias("_to"))
    inside = lambda t: (t >= 0) & (t < span)
    look = lambda node, role: F.struct(node.alias("_at"), role.alias("_role"))
    rows = [F.when(n.isNotNull(), look(n, F.lit(BEGIN))) for n in _stretches(F.greatest(F.col("_a") + 1, F.lit(0)), F.least(F.col("_b") + 1, F.lit(span)), levels, 1)]
    for level in range(levels + 1):
        over_a, over_b = F.shiftright("_a", level), F.shiftright("_b", level)
        one = inside(F.col("_a")) & inside(F.col("_b")) & (over_a == over_b)
        rows.append(F.when(inside(F.col("_a")), look(_node(over_a, level, 0), F.when(one, OVER_BOTH).otherwise(OVER_START))))
        rows.append(F.when(inside(F.col("_b")) & ~one, look(_node(over_b, level, 0), F.lit(OVER_END))))
    asked = mine.withColumn("_look", F.explode(F.array_compact(F.array(*rows)))).select("*", "_look.*").drop("_look", "_a", "_b")
    same = F.col("_at") == F.col("_node")
    for k in at:
        same = same & (asked[k] == tree[k])
    met = asked.join(tree, same)
    role = F.col("_role")
    rest = lambda t: F.col("_ends") - F.col("_n") * F.col(t)
    # up to their ends, less what lies beyond the left one's end
    shared = F.when(role == BEGIN, F.col("_length")).when(role == OVER_START, rest("_from")).when(role == OVER_END, -rest("_to"))
    shared = shared.otherwise(F.col("_n") * (F.col("_to") - F.col("_from")))

    def piece(name: str) -> Column:
        join = F.max if name.startswith("max_") else F.min if name.startswith("min_") else F.sum
        return join(F.when(role != OVER_END, F.col(names[name]))).alias(name)

    return met.groupBy(*by).agg(*[piece(n) for n in totals], F.sum(shared).alias(seconds))
