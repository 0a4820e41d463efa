"""Exact range join of vectors under a metric: pivots, triangle inequality, independent cells.

Unit vectors of cosine c or more lie within r = sqrt(2 - 2c) of each other. Each vector goes to the cell of its
nearest pivot, and to every other cell that may hold a partner: with d its distance to its own pivot and d' to
the other, the triangle inequality leaves only cells with d' - d <= 2r and d' <= r + the cell's
radius. A vector's partners are then all in its own cell, so cells are joined on their own and each
counts its own vectors only.

Equal vectors are one node. A cell of any size is cut into blocks, and tasks compare a pair of blocks by
matrix products; they return counts and a spanning forest, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.llm.components import components
from loadtide.llm.vectors import matrix, units, usable
from loadtide.session import materialize

CELL = 2048  # vectors a pivot, as long as there are fewer than PIVOTS
PIVOTS = 4096
BLOCK = 2048
SLACK = 1e-9  # for rounding in the bounds
CELL_KEY = ["label", "dim", "cell"]


def _grouped(batch: pa.RecordBatch):
    """Row numbers and unit vectors of each (label, dim) of a batch (node, label, embedding, ...)."""
    label = batch.column("label").to_numpy()
    dim = np.diff(batch.column("embedding").offsets.to_numpy())
    kinds, which = np.unique(np.stack((label, dim), 1), axis=0, return_inverse=True)
    which = which.reshape(-1)
    for k, (lab, d) in enumerate(kinds):
        at = np.flatnonzero(which == k)
        yield int(lab), int(d), at, units(matrix(batch.column("embedding").take(pa.array(at))))


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * (x @ pivots.T)))


def _radii(pivots: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[tuple, float] = {}
        for batch in batches:
            for lab, dim, _, x in _grouped(batch):
                if (lab, dim) in pivots:
                    d = _distances(x, pivots[lab, dim])
                    near = d.argmin(axis=1)
                    for c in np.unique(near):
                        top = float(d[near == c, c].max())
                        best[lab, dim, int(c)] = max(top, best.get((lab, dim, int(c)), 0.0))
        keys = list(best)
        cols = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.int64(), pa.int32(), pa.int32()))]
        yield pa.RecordBatch.from_arrays([*cols, pa.array([best[k] for k in keys], pa.float64())], names=[*CELL_KEY, "radius"])

    return run


def _deal(pivots: dict, radii: dict, reach: float):
    """Rows of vectors for their own cell (core) and for cells that they may have a partner in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node = batch.column("node").to_numpy()
            copies = batch.column("copies").to_numpy()
            for lab, dim, at, x in _grouped(batch):
                if (lab, dim) in pivots:
                    d = _distances(x, pivots[lab, dim])
                    own = d.min(axis=1, keepdims=True)
                    goes = (d - own <= 2 * reach + SLACK) & (d <= reach + radii[lab, dim] + SLACK)
                    near = d.argmin(axis=1)
                    goes[np.arange(len(at)), near] = True
                    row, cell = np.nonzero(goes)
                    core = near[row] == cell
                else:  # a label without a pivot is one cell
                    row, cell, core = np.arange(len(at)), np.full(len(at), -1), np.ones(len(at), bool)
                n = len(row)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, lab), pa.int64()), pa.array(np.full(n, dim), pa.int32()), pa.array(cell, pa.int32()),
                        pa.array(core), pa.array(node[at][row]), pa.array(copies[at][row]),
                        pa.array([v.tobytes() for v in x[row]], pa.binary()),
                    ],
                    names=[*CELL_KEY, "core", "node", "copies", "unit"],
                )

    return run


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of a bipartite graph, given as a boolean matrix: (row, column) of its edges."""
    rows_left, cols_left = linked.any(axis=1), np.ones(linked.shape[1], bool)
    edges = []
    for start in np.flatnonzero(rows_left):
        if not rows_left[start]:
            continue
        rows_left[start] = False
        todo = [start]
        while todo:
            r = todo.pop()
            new = np.flatnonzero(linked[r] & cols_left)
            cols_left[new] = False
            for c in new:
                edges.append((r, c))
                more = np.flatnonzero(linked[:, c] & rows_left)
                rows_left[more] = False
                edges += [(m, c) for m in more]
                todo += more.tolist()
    return edges


def _compare(cosine: float):
    """Of a block pair: for each core row the number of vectors linked to it, and the forest's links."""

    def run(table: pa.Table) -> pa.Table:
        side = table.column("side").to_numpy()
        node, copies = table.column("node").to_numpy(), table.column("copies").to_numpy()
        raw = table.column("unit").to_pylist()
        x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
        one, two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        linked = np.empty((len(one), len(two)), bool)
        for k in range(0, len(one), 256):
            linked[k : k + 256] = x[one[k : k + 256]] @ x[two].T >= cosine
        linked &= node[one][:, None] != node[two][None]
        count = linked @ copies[two]
        some = np.flatnonzero(count)
        edges = forest(linked)
        a = np.concatenate((node[one[some]], node[one[[r for r, _ in edges]]])) if edges else node[one[some]]
        b = [None] * len(some) + node[two[[c for _, c in edges]]].tolist() if edges else [None] * len(some)
        links = np.concatenate((count[some], np.zeros(len(edges), np.int64)))
        return pa.table({"a": pa.array(a, pa.int64()), "links": pa.array(links, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def near_vectors(
    table: DataFrame, cosine: float = 0.98, cell: int = CELL, max_pivots: int = PIVOTS, block: int = BLOCK
) -> DataFrame:
    """One row per row of ``table`` (vec_id, embedding, label): vec_id, n_links, component_id, kept.

    Rows are compared when their labels are equal and not null and their vectors have the same length. ``n_links`` counts the other rows
    of cosine ``cosine`` or more, in double precision; ``component_id`` is the smallest vec_id reachable; ``kept`` says that it is
    the row's own. Vectors that are null, empty, zero or hold a null or non-finite component link with nothing; so do
    rows with a null label. Repeated rows and equal vectors link with one another. Other columns are ignored.

    The driver holds the pivots and their radii: ``max_pivots`` vectors at most, whatever the input.
    """
    reach = float(np.sqrt(2 - 2 * cosine))
    vec = table.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "embedding")
    good = usable(F.col("embedding")) & F.col("label").isNotNull()
    rows = vec.where(good)
    nodes = rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("copies"))
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")

    wanted = min(max_pivots, -(-nodes.count() // cell))
    pivots: dict[tuple, list] = {}
    picked = nodes.orderBy(F.xxhash64("first", "label"), "first", "node").limit(wanted).select("label", "embedding").collect()
    for r in picked:
        pivots.setdefault((r["label"], len(r["embedding"])), []).append(r["embedding"])
    held = {k: units(np.array(v, np.float64)) for k, v in pivots.items()}
    kind = nodes.select("node", "copies", "label", "embedding")
    radius = kind.mapInArrow(_radii(held), "label long, dim int, cell int, radius double")
    radii = {k: np.full(len(v), -np.inf) for k, v in held.items()}
    for r in radius.groupBy(*CELL_KEY).agg(F.max("radius").alias("radius")).collect():  # one row per pivot
        radii[r["label"], r["dim"]][r["cell"]] = r["radius"]

    shape = "label long, dim int, cell int, core boolean, node long, copies long, unit binary"
    dealt = materialize(kind.mapInArrow(_deal(held, radii, reach), shape), "cells")
    sizes = dealt.groupBy(*CELL_KEY).agg(F.ceil(F.sum(F.col("core").cast("int")) / block).cast("int").alias("ni"), F.ceil(F.count("*") / block).cast("int").alias("nj"))
    both = dealt.join(materialize(sizes, "cell-sizes"), CELL_KEY)
    spread = F.xxhash64("node")
    span = lambda n: F.sequence(F.lit(0), n - 1)
    pair = lambda i, j, side: F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), F.lit(side).alias("side"))
    as_core = F.transform(span(F.col("nj")), lambda j: pair(F.pmod(spread, F.col("ni")), j, 0))
    as_other = F.transform(span(F.col("ni")), lambda i: pair(i, F.pmod(spread, F.col("nj")), 1))
    pairs = F.when(F.col("core"), F.concat(as_core, as_other)).otherwise(as_other)
    met = both.where("ni > 0").withColumn("pair", F.explode(pairs)).select(*CELL_KEY, "pair.*", "node", "copies", "unit")
    found = met.groupBy(*CELL_KEY, "i", "j").applyInArrow(_compare(cosine), "a long, links long, b long")
    found = materialize(found, "vector-links")

    links = found.where("links > 0").groupBy(F.col("a").alias("node")).agg(F.sum("links").alias("links"))
    roots = components(found.where("b is not null").select("a", "b"))
    ids = nodes.join(roots, "node", "left").join(links, "node", "left")
    ids = materialize(ids.withColumn("root", F.coalesce("root", "node")).drop("node"), "vector-classes")
    least = materialize(ids.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    count = (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long")
    classes = ids.join(least, "root").select("label", "embedding", count.alias("n_links"), "component_id")
    out = rows.join(materialize(classes, "vector-components"), ["label", "embedding"]).select("vec_id", "n_links", "component_id")
    rest = vec.where(~good).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    out = out.union(rest)
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
