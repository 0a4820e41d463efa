"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

A text's hash is its place on a ring of 65,536 arcs. Each shard owns arcs through its virtual nodes, and holds at most
its share of all bytes plus a small slack; what doesn't fit goes on clockwise to the next shard with room. Shards
thus stay nearly equal, and only what overflows moves.

Equal texts share a place. An arc that is heavy by itself, as one group of copies can be, is split into
finer pieces by the documents' ids. Pieces are placed heaviest arc first, so a group that fits stays whole, and one
that doesn't goes on into the next shard.

The documents are aggregated to arcs and later looked up in the table of arcs; both are DataFrame operations. Only that
table, whose size is a parameter and not the data's, is walked in order.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadtide.llm.rows import packed, unpacked
from loadtide.session import materialize

ARC_BITS = 16
HEAVY = 2048  # an arc with more than 1/2048 of all bytes is split, so there are at most as many
PIECES = 256
NAMES = ("size", "shard", "slot")
NODES = 128  # virtual nodes per shard
SLACK = 0.0005


def size_of(text: Column) -> Column:
    """Bytes of the text in UTF-8 plus 8; a null text has none."""
    return (F.coalesce(F.octet_length(text.cast("string")), F.lit(0)) + 8).cast("long")


def place(spark, loads: list[tuple[int, int, int]], shards: int, nodes: int = NODES, slack: float = SLACK) -> dict:
    """(arc, piece) -> shard for (arc, piece, bytes); the table's length is bounded by the ring's parameters.

    The ring is the order of the virtual nodes' hashes. A shard's nodes don't depend on the number of shards, so one
    more shard leaves the others' places as they are. A piece that a full shard can't take goes on to the next node of another shard.
    """
    arcs = 1 << ARC_BITS
    points = (
        spark.range(shards * nodes)
        .select(F.pmod(F.xxhash64(F.lit("node"), "id"), F.lit(arcs)).alias("at"), F.floor(F.col("id") / nodes).cast("int").alias("shard"))
        .collect()  # one row per virtual node
    )
    ring = sorted((p["at"], p["shard"]) for p in points)
    starts = [at for at, _ in ring]
    total = sum(b for _, _, b in loads)
    room = [total / shards * (1 + slack)] * shards
    by_arc: dict[int, int] = {}
    for arc, _, b in loads:
        by_arc[arc] = by_arc.get(arc, 0) + b
    split = {arc for arc, piece, _ in loads if piece}
    out = {}
    for arc, piece, b in sorted(loads, key=lambda x: (x[0] not in split, -by_arc[x[0]] if x[0] in split else 0, x[0], x[1])):
        first = bisect_left(starts, arc)
        tried: set[int] = set()
        best = None
        for step in range(len(ring)):
            shard = ring[(first + step) % len(ring)][1]
            if shard in tried:
                continue
            if room[shard] >= b:
                best = shard
                break
            tried.add(shard)
            if len(tried) == shards:
                break
        if best is None:  # a piece larger than any room left: the emptiest shard takes it
            best = max(range(shards), key=lambda s: (room[s], -s))
        room[best] -= b
        out[arc, piece] = best
    return out


def assign(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", nodes: int = NODES, slack: float = SLACK) -> DataFrame:
    """``docs`` with size, shard (from 0) and slot (gapless from 0 within the shard).

    Sizes per shard differ by about ``slack`` and a piece of the ring, or by a document where one is larger. Input
    columns of the result's names are replaced. A null text is an empty place of its own; repeated rows each have a slot. The
    result depends on the rows only, not on their partitions, but for rows that are equal in id and text. A null id is a value like
    others. All other input columns are kept. No rows: no rows.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    key = F.xxhash64(text)
    finer = F.xxhash64(F.col(id_col).cast("string"), key)
    base = docs.select(
        packed(docs, NAMES), F.col(id_col).alias("_id"), size_of(text).alias("size"),
        F.shiftrightunsigned(key, 64 - ARC_BITS).cast("int").alias("_arc"), finer.alias("_order"),
    )
    piece = F.shiftrightunsigned("_order", 56).cast("int")
    loads = base.groupBy("_arc", piece.alias("_fine")).agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    loads = materialize(loads, "ring-loads")
    arcs = materialize(loads.groupBy("_arc").agg(F.sum("b").alias("b")), "ring-arcs")
    total = arcs.agg(F.sum("b")).first()[0] or 0
    heavy = arcs.where(F.col("b") > total / HEAVY).select("_arc", F.lit(1).alias("_heavy"))  # fewer than HEAVY rows
    fine = loads.join(F.broadcast(heavy), "_arc", "left")
    fine = fine.groupBy("_arc", F.when(F.col("_heavy") == 1, F.col("_fine") + 1).otherwise(0).alias("_piece"))
    # at most 2**ARC_BITS + HEAVY * PIECES rows, whatever the input
    table = fine.agg(F.sum("b").alias("b"), F.sum("n").alias("n")).collect()
    where = place(spark, [(r["_arc"], r["_piece"], r["b"]) for r in table], shards, nodes, slack)
    used = [0] * shards
    lookup = []
    for r in sorted(table, key=lambda r: (r["_arc"], r["_piece"])):
        s = where[r["_arc"], r["_piece"]]
        lookup.append((r["_arc"], r["_piece"], s, used[s]))
        used[s] += r["n"]
    arcs_of = spark.createDataFrame(lookup, "_arc int, _piece int, shard int, _first long")
    known = base.join(F.broadcast(heavy), "_arc", "left")
    known = known.withColumn("_piece", F.when(F.col("_heavy") == 1, piece + 1).otherwise(0)).drop("_heavy")
    known = known.join(F.broadcast(arcs_of), ["_arc", "_piece"])
    order = Window.partitionBy("_arc", "_piece").orderBy("_order", "_id")
    slot = (F.col("_first") + F.row_number().over(order) - 1).cast("long")
    known = known.withColumn("slot", slot)
    return known.select(*unpacked(known, docs, NAMES), *NAMES)
