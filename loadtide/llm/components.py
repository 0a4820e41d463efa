"""Connected components by contraction: DataFrame jobs, one written table per step.

Each round every node points to the neighbour (or itself) of the lowest hashed priority, and the
edges are drawn anew between the nodes pointed to. The priority changes from round to round, so
chains shrink by a constant factor. Joins read written tables, so that adaptive execution can split
a node with many edges; minima are combined before the shuffle.

The last rounds of a large graph and all of a small one have few edges. Up to ``LAST`` edges, one task with a few
megabytes ends the work by union-find, which saves a dozen tiny jobs and gives the same components.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.session import materialize

LAST = 200_000


def _finish(table: pa.Table) -> pa.Table:
    up: dict[int, int] = {}

    def find(n: int) -> int:
        while (p := up.setdefault(n, n)) != n:
            up[n] = up[p]
            n = up[n]
        return n

    for a, b in zip(table.column("a").to_pylist(), table.column("b").to_pylist()):
        p, q = find(a), find(b)
        up[max(p, q)] = min(p, q)
    nodes = list(up)
    return pa.table({"node": pa.array(nodes, pa.int64()), "to": pa.array([find(n) for n in nodes], pa.int64())})


def components(edges: DataFrame, last: int = LAST) -> DataFrame:
    """``edges`` (a, b: long) to (node, root): one row per node with an edge, one root per component.

    Loops and repeated edges are allowed, rows with a null end are ignored. No edges: no rows.
    """
    a, b = F.col("a"), F.col("b")
    now = materialize(edges.select("a", "b").where(a != b).distinct(), "edges")
    steps: list[DataFrame] = []
    while (left := now.count()) > last:
        seed = F.lit(len(steps))
        ends = now.select(a.alias("node"), b.alias("to")).union(now.select(b, a))
        low = ends.groupBy("node").agg(F.min(F.struct(F.xxhash64("to", seed).alias("p"), "to")).alias("low"))
        own = F.struct(F.xxhash64("node", seed).alias("p"), F.col("node").alias("to"))
        step = materialize(low.select("node", F.least("low", own)["to"].alias("to")), "pointers")
        steps.append(step)
        from_a = step.select(F.col("node").alias("a"), F.col("to").alias("a2"))
        from_b = step.select(F.col("node").alias("b"), F.col("to").alias("b2"))
        moved = now.join(from_a, "a").join(from_b, "b").where("a2 <> b2")
        now = materialize(
            moved.select(F.least("a2", "b2").alias("a"), F.greatest("a2", "b2").alias("b")).distinct(), "edges"
        )
    if left or not steps:
        few = now.coalesce(1).groupBy(F.lit(0).alias("all")).applyInArrow(_finish, "node long, to long")
        steps.append(materialize(few, "pointers"))
    out = steps[0].select("node", F.col("to").alias("root"))
    for step in steps[1:]:
        nxt = step.select(F.col("node").alias("root"), "to")
        out = materialize(
            out.join(nxt, "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots"
        )
    return out
