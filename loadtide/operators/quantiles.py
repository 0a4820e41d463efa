"""Exact quantiles of groups too long for one task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# percentile_approx is off by at most one rank in ACCURACY. A bracket this wide always holds for
# more than FEW values; fewer are bracketed by their minimum and maximum.
ACCURACY = 10_000
MARGIN = 2.0 / ACCURACY
FEW = 4 * ACCURACY
CELLS = 4096
SALTS = 32


def exact_quantiles(df: DataFrame, wanted: Mapping[str, tuple[str, float]], by: Sequence[str] = ()) -> DataFrame:
    """One row per group: the keys and, per name in ``wanted``, the linearly interpolated quantile of (column, share).

    Equal to the aggregate ``percentile``, which gathers every distinct value of a group in one task.
    Here a sketch brackets the wanted ranks, values below the bracket are only counted, and those inside
    are counted in cells of the bracket. Only the cells that hold the ranks are put in order. Scans its input twice, so
    it should be a table. NULLs don't count; a group without values has NULL.
    """
    key = F.struct(*by) if by else F.struct(F.lit(0).alias("all"))
    cols = sorted({c for c, _ in wanted.values()})
    rows = df.select(key.alias("g"), *[F.col(c).cast("double").alias(f"x_{c}") for c in cols])

    def bracket(name: str):
        col, share = wanted[name]
        x = F.col(f"x_{col}")
        shares = [max(0.0, share - MARGIN), min(1.0, share + MARGIN)]
        ends = F.when(F.count(x) <= FEW, F.array(F.min(x), F.max(x))).otherwise(F.percentile_approx(x, shares, ACCURACY))
        return F.struct(ends.alias("ends"), ((F.count(x) - 1) * F.lit(share)).alias("rank")).alias(f"b_{name}")

    edges = rows.groupBy("g").agg(*[bracket(n) for n in wanted])
    if by:  # a group may hold most rows, so it is spread over salts
        salt = F.pmod(F.xxhash64(*[f"x_{c}" for c in cols]), F.lit(SALTS)).cast("int")
        spread = edges.withColumnRenamed("g", "h").withColumn("t", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        both = rows.withColumn("s", salt).join(spread, (F.col("g") == F.col("h")) & (F.col("s") == F.col("t"))).drop("s", "t")
    else:  # one row
        both = rows.join(F.broadcast(edges.withColumnRenamed("g", "h")), F.col("g") == F.col("h"))

    def seen(name: str):
        x, b = F.col(f"x_{wanted[name][0]}"), F.col(f"b_{name}")
        low, high = b["ends"][0], b["ends"][1]
        cell = F.when(high > low, F.least(F.floor((x - low) / (high - low) * CELLS), F.lit(CELLS - 1))).otherwise(F.lit(0))
        place = F.when(x < low, F.lit(-1)).otherwise(cell).cast("int")
        return F.struct(F.lit(name).alias("name"), (b["rank"]).alias("rank"), place.alias("cell"), F.when(x >= low, x).alias("x"), (x <= high).alias("ok"))

    # a value below the bracket keeps only its place; counting by value is combined before the shuffle
    long = both.select("g", F.explode(F.array(*[seen(n) for n in wanted])).alias("s")).select("g", "s.*").where("ok")
    counts = long.groupBy("g", "name", "rank", "cell", "x").agg(F.count(F.lit(1)).alias("n"))
    cells = counts.groupBy("g", "name", "rank", "cell").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("g", "name").orderBy("cell")
    cells = cells.withColumn("first", F.sum("n").over(upto) - F.col("n"))
    holds = (F.col("first") <= F.ceil("rank")) & (F.col("first") + F.col("n") > F.floor("rank"))
    near = cells.where(holds).select(F.col("g").alias("g2"), F.col("name").alias("name2"), F.col("cell").alias("cell2"), "first")
    same = (F.col("g") == F.col("g2")) & (F.col("name") == F.col("name2")) & (F.col("cell") == F.col("cell2"))
    inside = Window.partitionBy("g", "name", "cell").orderBy("x").rowsBetween(Window.unboundedPreceding, 0)
    ranked = counts.join(near, same).withColumn("last", F.col("first") + F.sum("n").over(inside) - 1)

    def at(rank):
        return F.min(F.when(F.col("last") >= rank, F.col("x")))

    picked = ranked.groupBy("g", "name").agg(at(F.floor("rank")).alias("a"), at(F.ceil("rank")).alias("b"), F.first("rank").alias("rank"))
    part = F.col("rank") - F.floor("rank")
    value = F.col("a") + (F.col("b") - F.col("a")) * part
    wide = picked.groupBy(F.col("g").alias("g3")).agg(*[F.max(F.when(F.col("name") == n, value)).alias(n) for n in wanted])
    # groups without any value come from the sketch
    out = edges.select("g").join(wide, F.col("g") == F.col("g3"), "left")
    return out.select(*[F.col("g")[k].alias(k) for k in by], *wanted)


def exact_quantile(df: DataFrame, value: str, share: float) -> DataFrame:
    """One row ``q``: the linearly interpolated quantile of a column."""
    found = exact_quantiles(df, {"q": (value, share)})
    return found.agg(F.max("q").alias("q"))
