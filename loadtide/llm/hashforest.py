"""Nearest neighbours by a forest of sorted hash strings.

A tree gives each vector a string of hash bits, the sides of random hyperplanes through the centre, and keeps
the strings sorted. A query descends to its longest matching prefix in each tree; then all trees ascend together, one bit at a
time, and every string that shares the shorter prefix becomes a candidate. The ascent ends when a vector as near as
the k-th found so far would have been missed by all trees with a chance below ``miss``: easy queries end
after a few candidates, hard ones go on, to the whole segment if need be.

The index is cut into segments of bounded size at random. Each segment is a forest of its own, built once; the queries
stream past every segment, as a stated query set does, and are answered in blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadtide.llm.vectors import matrix, usable
from loadtide.session import materialize

TREES = 24
BITS = 32
SEGMENT = 8192
QUERIES = 1024
SAMPLE = 2048
MISS = 0.03


class Forest:
    """Sorted hash strings of one segment's vectors."""

    def __init__(self, vectors: np.ndarray, ids: np.ndarray, centre: np.ndarray, seed: int, trees: int, bits: int):
        self.vectors, self.ids, self.centre, self.trees, self.bits = vectors, ids, centre, trees, bits
        self.planes = np.random.default_rng(seed).standard_normal((vectors.shape[1], trees * bits))
        codes = self.codes(vectors)
        self.order = np.argsort(codes, axis=1, kind="stable")
        self.sorted = np.take_along_axis(codes, self.order, axis=1)
        self.spread = float(np.sqrt((((vectors - centre) ** 2).sum(axis=1)).mean())) if len(vectors) else 0.0

    def codes(self, x: np.ndarray) -> np.ndarray:
        """(trees, rows) hash strings as whole numbers, first bit highest."""
        out = np.empty((self.trees, len(x)), np.int64)
        weight = 1 << np.arange(self.bits - 1, -1, -1, dtype=np.int64)
        for lo in range(0, len(x), 1024):
            bit = (x[lo : lo + 1024] - self.centre) @ self.planes > 0
            out[:, lo : lo + 1024] = (bit.reshape(-1, self.trees, self.bits) @ weight).T
        return out

    def ranges(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(depth, trees, rows) places of the strings that share each number of leading bits."""
        lo = np.empty((self.bits + 1, *codes.shape), np.int64)
        hi = np.empty_like(lo)
        for depth in range(self.bits + 1):
            cut = self.bits - depth
            for t in range(self.trees):
                prefix = codes[t] >> cut
                lo[depth, t] = np.searchsorted(self.sorted[t], prefix << cut, side="left")
                hi[depth, t] = np.searchsorted(self.sorted[t], (prefix + 1) << cut, side="left")
        return lo, hi

    def missed(self, depth: int, from_centre: float, distance: float) -> float:
        """Chance that no tree shares ``depth`` bits with a vector at ``distance`` of the usual length."""
        if depth == 0:
            return 0.0
        both = 2 * from_centre * self.spread
        cosine = (from_centre**2 + self.spread**2 - distance**2) / both if both > 0 else -1.0
        agree = 1 - np.arccos(np.clip(cosine, -1, 1)) / np.pi
        return float((1 - agree**depth) ** self.trees)

    def nearest(self, queries: np.ndarray, query_ids: np.ndarray, k: int, miss: float):
        """(query row, vector row, distance) of up to k nearest found per query, other ids only."""
        lo, hi = self.ranges(self.codes(queries))
        total = (hi - lo).sum(axis=1)
        for q, x in enumerate(queries):
            own = self.ids == query_ids[q]
            left = len(self.ids) - int(own.sum())
            need = min(k, left)
            if not need:
                continue
            distance = np.full(len(self.ids), np.inf)
            seen = own.copy()
            from_centre = float(np.sqrt(((x - self.centre) ** 2).sum()))
            deep = np.flatnonzero(total[:, q] >= 2 * need)
            depth = int(deep[-1]) if len(deep) else 0
            while True:
                got = [self.order[t, lo[depth, t, q] : hi[depth, t, q]] for t in range(self.trees)]
                mark = np.zeros(len(seen), bool)
                mark[np.concatenate(got)] = True
                new = np.flatnonzero(mark & ~seen)
                seen[new] = True
                distance[new] = np.sqrt(((self.vectors[new] - x) ** 2).sum(axis=1))
                kth = np.partition(distance, need - 1)[need - 1]
                if depth == 0 or (np.isfinite(kth) and self.missed(depth, from_centre, kth) <= miss):
                    break
                depth -= 1
            best = np.flatnonzero(distance <= kth)
            best = best[np.lexsort((self.ids[best], distance[best]))][:need]
            for b in best:
                yield q, b, distance[b]


def _search(centre: dict, k: int, miss: float, seed: int, trees: int, bits: int, block: int):
    """Rows of one partition, ordered by segment with its index rows first: a forest is built once and then meets the queries."""

    def answer(forest: Forest, table: pa.RecordBatch):
        x, ids, row = matrix(table.column("embedding")), table.column("vec_id").to_numpy(), table.column("row").to_numpy()
        for lo in range(0, len(ids), block):
            found = list(forest.nearest(x[lo : lo + block], ids[lo : lo + block], k, miss))
            q = np.array([f[0] for f in found], np.int64) + lo
            v = np.array([f[1] for f in found], np.int64)
            score = pa.array([f[2] for f in found], pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(row[q]), pa.array(ids[q]), pa.array(forest.ids[v]), score], ["row", "query_id", "vec_id", "score"])

    def run(batches):
        at, parts, forest = None, [], None
        for batch in batches:
            dim, segment = batch.column("dim").to_numpy(), batch.column("segment").to_numpy()
            asked = batch.column("query").to_numpy(zero_copy_only=False)
            turns = np.flatnonzero((np.diff(dim) != 0) | (np.diff(segment) != 0) | (np.diff(asked.astype(np.int8)) != 0)) + 1
            for lo, hi in zip([0, *turns.tolist()], [*turns.tolist(), len(asked)]):
                if lo == hi:
                    continue
                if at != (dim[lo], segment[lo]):
                    at, parts, forest = (dim[lo], segment[lo]), [], None
                run_of = batch.slice(lo, hi - lo)
                if not asked[lo]:
                    parts.append((matrix(run_of.column("embedding")), run_of.column("vec_id").to_numpy()))
                    continue
                if forest is None and parts:
                    x, ids = (np.concatenate(p) for p in zip(*parts))
                    forest, parts = Forest(x, ids, centre[x.shape[1]], seed, trees, bits), []
                if forest is not None:
                    yield from answer(forest, run_of)

    return run


def search(
    table: DataFrame,
    is_query: Column,
    k: int = 10,
    miss: float = MISS,
    trees: int = TREES,
    bits: int = BITS,
    segment: int = SEGMENT,
    query_block: int = QUERIES,
    sample: int = SAMPLE,
    seed: int = 17,
) -> DataFrame:
    """query_id, rank, vec_id, score: up to ``k`` nearest rows found for each query row of ``table`` (vec_id, embedding).

    ``score`` is the Euclidean distance in double precision, nearest first, ties to the smaller vec_id. Candidates are the rows
    of other vec_ids with vectors of the same length. Vectors that are null, empty, zero or hold a null or non-finite
    component take no part, as rows with a null vec_id. Repeated rows are candidates and queries of their own. With k candidates
    or fewer, all are returned. Other columns may be used by ``is_query`` and are otherwise ignored.

    The centre is the mean of at most ``sample`` rows; every row is indexed. A task holds one segment and ``query_block`` queries at a time.
    """
    ok = usable(F.col("embedding")) & F.col("vec_id").isNotNull()
    base = table.where(ok).select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", F.coalesce(is_query, F.lit(False)).alias("asked"))
    base = materialize(base.withColumn("row", F.monotonically_increasing_id()), "forest-vectors")
    segments = -(-base.count() // segment) or 1
    drawn = base.orderBy(F.xxhash64("vec_id", "row"), "row").limit(sample).select("embedding").collect()
    by_dim: dict[int, list] = {}
    for r in drawn:
        by_dim.setdefault(len(r["embedding"]), []).append(r["embedding"])
    centre = _Centres({d: np.array(v, np.float64).mean(axis=0) for d, v in by_dim.items()})

    dim = F.size("embedding").alias("dim")
    spread = F.xxhash64("row")
    own = F.pmod(spread, F.lit(segments)).cast("int").alias("segment")
    index = base.select(dim, own, F.lit(False).alias("query"), "row", "vec_id", "embedding")
    each = F.explode(F.sequence(F.lit(0), F.lit(segments - 1))).alias("segment")
    asked = base.where("asked").select(dim, each, F.lit(True).alias("query"), "row", "vec_id", "embedding")
    ordered = index.union(asked).repartition("dim", "segment").sortWithinPartitions("dim", "segment", "query")
    found = ordered.mapInArrow(_search(centre, k, miss, seed, trees, bits, query_block), "row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("row").orderBy("score", "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


class _Centres(dict):
    """Centre by vector length; the origin for a length that the sample lacks."""

    def __missing__(self, dim: int) -> np.ndarray:
        return np.zeros(dim)
