"""Hard negatives by inner product from R-trees packed by sort-tile-recursive order.

The rows are dealt in the order of their first coordinates to lanes, each some thousand rows; within a lane they are tiled coordinate by
coordinate into leaves, whose minimum bounding boxes are packed level by level. The leaves are written once. Blocks of anchors then travel to the
lanes; an anchor goes through a lane's tree best box first. By the signs of the anchor's components a box bounds every
inner product with its rows from above and below, an interval per coordinate. Boxes outside all score windows that are
still asked for go, as do boxes strictly below the k-th score found (at the k-th score: those without a smaller id).

Of rows that agree in label and vector only the first few ids can be in any result, and only these enter the index: they
have the same score for every anchor, and ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadtide.llm.vectors import finite
from loadtide.session import materialize

SCALE = 256
LEAF = 128
LANE = 16384
FAN = 16
BLOCK = 256
PACKED = "lane int, kind int, place long, width int, ids binary, labels binary, vectors binary, positives binary, scores binary"
FIELDS = ["lane", "kind", "place", "width", "ids", "labels", "vectors", "positives", "scores"]
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.int32()] + [pa.binary()] * 5


def tiles(x: np.ndarray, leaf: int) -> list[np.ndarray]:
    """Rows in leaves of at most ``leaf``, by sort-tile-recursive packing; the widest coordinates are cut first."""
    if not len(x):
        return []
    widths = x.max(axis=0) - x.min(axis=0) if x.shape[1] else np.zeros(0)
    dims = np.argsort(-widths.astype(np.float64), kind="stable").tolist()

    def cut(rows: np.ndarray, at: int) -> Iterator[np.ndarray]:
        leaves = -(-len(rows) // leaf)
        if leaves <= 1 or at >= len(dims):
            yield from (rows[i : i + leaf] for i in range(0, len(rows), leaf))
            return
        slabs = max(2, int(np.ceil(leaves ** (1 / (len(dims) - at)))))
        step = -(-leaves // slabs) * leaf
        rows = rows[np.argsort(x[rows, dims[at]], kind="stable")]
        for i in range(0, len(rows), step):
            yield from cut(rows[i : i + step], at + 1)

    return list(cut(np.arange(len(x)), 0))


class RTree:
    """Leaves of rows (ids, labels, whole vectors) below packed levels of boxes."""

    def __init__(self, leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]], fan: int = FAN):
        self.ids = [i for i, _, _ in leaves]
        self.labels = [x for _, x, _ in leaves]
        self.vectors = [v for _, _, v in leaves]
        low = np.array([v.min(axis=0) for v in self.vectors])
        high = np.array([v.max(axis=0) for v in self.vectors])
        first = np.array([i.min() for i in self.ids])
        self.fan, self.levels = fan, [(low, high, first)]
        while len(low) > 1:
            at = np.arange(0, len(low), fan)
            low, high = np.minimum.reduceat(low, at, axis=0), np.maximum.reduceat(high, at, axis=0)
            first = np.minimum.reduceat(first, at)
            self.levels.append((low, high, first))

    def search(self, q: np.ndarray, least: np.ndarray, most: np.ndarray, k: int, allowed) -> list[list[tuple[int, int]]]:
        """Per window of scores (``least`` to ``most``) the first ``k`` (score, id) of the rows that ``allowed`` (ids, labels) lets in."""
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        windows = len(least)
        best_scores = [np.empty(0, np.int64)] * windows
        best_ids = [np.empty(0, np.int64)] * windows
        floor = least.astype(object) if q.dtype == object else least.astype(np.float64)
        last = np.full(windows, np.iinfo(np.int64).max)  # the id at the k-th score; any id may come before this one
        ceiling = most if q.dtype == object else most.astype(np.float64)

        def push(level: int, lo: int, hi: int) -> None:
            low, high, first = (x[lo:hi] for x in self.levels[level])
            top, bottom = high @ up + low @ down, low @ up + high @ down
            open_ = (bottom[:, None] <= ceiling) & ((top[:, None] > floor) | ((top[:, None] == floor) & (first[:, None] < last)))
            for i in np.flatnonzero(open_.any(axis=1)).tolist():
                heapq.heappush(queue, (-top[i], level, lo + i, bottom[i], first[i]))

        queue: list = []
        push(len(self.levels) - 1, 0, 1)
        while queue:
            minus, level, node, bottom, first = heapq.heappop(queue)
            top = -minus
            if top < floor.min():
                break
            if not ((bottom <= ceiling) & ((top > floor) | ((top == floor) & (first < last)))).any():
                continue
            if level:
                push(level - 1, node * self.fan, min((node + 1) * self.fan, len(self.levels[level - 1][0])))
                continue
            scores = self.vectors[node] @ q
            ok = allowed(self.ids[node], self.labels[node])
            inside = ok & (scores >= floor[:, None]) & (scores <= ceiling[:, None])
            for w in np.flatnonzero(inside.any(axis=1)).tolist():
                got = inside[w]
                s = np.concatenate((best_scores[w], scores[got].astype(np.int64)))
                i = np.concatenate((best_ids[w], self.ids[node][got]))
                order = np.lexsort((i, -s))[:k]
                best_scores[w], best_ids[w] = s[order], i[order]
                if len(order) == k:
                    floor[w], last[w] = s[order[-1]], i[order[-1]]
        return [list(zip(s.tolist(), i.tolist())) for s, i in zip(best_scores, best_ids)]


def _row(lane: int, kind: int, place: int, ids, labels, vectors, positives=b"", scores=b"") -> tuple:
    return (lane, kind, place, vectors.shape[1], *(x if isinstance(x, bytes) else x.astype("<i8").tobytes() for x in (ids, labels, vectors, positives, scores)))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*rows)) or [[]] * len(_TYPES), _TYPES)], names=FIELDS)


def _rows_of(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, labels and vectors of a batch (id, label, vector as whole numbers)."""
    column = batch.column(2)
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    vectors = np.zeros((len(column), width), np.int64)
    row = np.repeat(np.arange(len(column)), sizes)
    vectors[row, np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = flat
    return batch.column(0).to_numpy(), batch.column(1).to_numpy(), vectors


def _pack(width: int, leaf: int, lane: int):
    """Rows in their lane's order to leaves; a lane that is larger than asked for becomes several trees, tiled apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, made, held, size = TaskContext.get().partitionId(), 0, [], 0

        def tree():
            nonlocal made
            ids, labels, vectors = (np.concatenate([h[k] for h in held]) for k in range(3))
            for rows in tiles(vectors, leaf):
                yield _batch([_row(own, 0, made, ids[rows], labels[rows], vectors[rows])])
                made += 1

        for batch in batches:
            held.append(_rows_of(batch, width))
            size += batch.num_rows
            if size >= lane:
                yield from tree()
                held, size = [], 0
        if size:
            yield from tree()

    return run


def _pack_anchors(width: int, block: int, k: int):
    """Anchors to blocks, one row each, with their positives' ids and scores if they have come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                part = batch.slice(lo, block)
                ids, labels, vectors = _rows_of(pa.RecordBatch.from_arrays(part.columns[1:4], names=["a", "b", "c"]), width)
                found = [np.zeros((len(ids), k + 1), np.int64) for _ in range(2)]
                for j, column in enumerate(part.columns[4:6]):
                    for i, own in enumerate(column.to_pylist()):
                        found[j][i, 0] = len(own)
                        found[j][i, 1 : 1 + len(own)] = own
                keys = part.column(0).to_numpy()
                yield _batch([_row(0, 1, int(keys[0]), np.stack((keys, ids), axis=1), labels, vectors, *found)])

    return run


def _search(k: int, positives: int, window: tuple[int, int] | None):
    """Blocks of anchors against the leaves that came before them in the lane; at most ``k`` rows per lane, anchor and positive."""
    names = ["anchor", "positive", "id", "score"]
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max

    def whole_of(data: bytes, *shape: int) -> np.ndarray:
        return np.frombuffer(data, "<i8").reshape(*shape)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane, leaves, tree, top = None, [], None, 0
        for batch in batches:
            for r in batch.to_pylist():
                if r["lane"] != lane:
                    lane, leaves, tree, top = r["lane"], [], None, 0
                width = r["width"]
                labels, vectors = whole_of(r["labels"], -1), whole_of(r["vectors"], -1, width)
                if not r["kind"]:
                    leaves.append((whole_of(r["ids"], -1), labels, vectors))
                    top = max(top, int(np.abs(vectors).max(initial=0)))
                    continue
                if not leaves:
                    continue
                # doubles hold every sum of products below 2**53; beyond, Python's whole numbers do
                exact = top * int(np.abs(vectors).max(initial=0)) * max(width, 1) < 1 << 53
                kind = np.float64 if exact else object
                if tree is None or tree.vectors[0].dtype != kind:
                    tree = RTree([(i, x, v.astype(kind)) for i, x, v in leaves])
                ids, asked = whole_of(r["ids"], -1, 2), vectors.astype(kind)
                known = [whole_of(r[c], -1, positives + 1) for c in ("positives", "scores")]
                out = []
                for i, (key, own) in enumerate(ids.tolist()):
                    if window is None:
                        got = tree.search(asked[i], np.array([low]), np.array([high]), k, lambda a, b: (a != own) & (b == labels[i]))
                        out += [(key, 0, v, s) for s, v in got[0]]
                    elif n := int(known[0][i, 0]):
                        s = known[1][i, 1 : n + 1].tolist()
                        least = np.array([-(-window[0] * x // 100) for x in s])
                        most = np.array([window[1] * x // 100 for x in s])
                        got = tree.search(asked[i], least, most, k, lambda a, b: b != labels[i])
                        out += [(key, j, v, x) for j, rows in enumerate(got) for x, v in rows]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in list(zip(*out)) or [[]] * 4], names=names)

    return run


def _through(leaves: DataFrame, lanes: int, blocks: DataFrame, k: int, positives: int, window) -> DataFrame:
    """Every block of anchors through every lane: leaves first, then the blocks one by one."""
    every = F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))).alias("lane")
    asked = blocks.select(every, *FIELDS[1:])
    met = leaves.union(asked).repartition("lane").sortWithinPartitions("lane", "kind", "place")
    return met.mapInArrow(_search(k, positives, window), "anchor long, positive long, id long, score long")


def mine(
    table: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    window: tuple[int, int] = (30, 90),
    scale: int = SCALE,
    leaf: int = LEAF,
    lane: int = LANE,
    block: int = BLOCK,
) -> DataFrame:
    """anchor_id, positive_id, positive_score, rank (from 1), negative_id, negative_score of ``table`` (vec_id, label, embedding).

    A row's score is the inner product of floor(scale * x) with the anchor's. An anchor's positives are its first other rows of the same label, higher
    scores first, ties by smaller vec_id. For each of them, the negatives are the first rows of other labels whose score lies
    within ``window``, in hundredths of the positive's score (both ends included; a negative positive score leaves an empty window).

    Rows with a null vec_id or label, a null vector or a null or non-finite component take no part; zero and empty vectors do, and the
    shorter of two vectors is filled up with zeros. Labels are whole numbers. Rows that repeat in all three columns
    count once, other rows of the anchor's vec_id aren't its positives. An anchor without positives, or a positive without negatives, has no rows. Other
    columns may be used by ``is_anchor`` and are otherwise ignored. Products beyond 64 bits are an error of the job.
    """
    spark = table.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(32 << 20))
    ok = finite(F.col("embedding")) & F.col("vec_id").isNotNull() & F.col("label").isNotNull()
    number = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    base = table.where(ok).select(
        F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label"), number.alias("v"), F.coalesce(is_anchor, F.lit(False)).alias("asked")
    )
    base = materialize(base.groupBy("id", "label", "v").agg(F.max("asked").alias("asked")), "rtree-rows")
    size = base.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("width")).first()
    width = size["width"] or 0
    # equal vectors of a label tie for every anchor: only their first ids can be in a result, an anchor aside
    same = Window.partitionBy("label", "v").orderBy("id")
    first = base.withColumn("n", F.row_number().over(same)).where(F.col("n") <= max(positives + 1, negatives)).select("id", "label", "v")
    order = [F.get("v", F.lit(i)) for i in range(min(width, 4))] + [F.col("id"), F.col("label")]
    parts = -(-size["n"] // lane) or 1
    dealt = first.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    leaves = materialize(dealt.mapInArrow(_pack(width, leaf, lane), PACKED), "rtree-leaves")
    lanes = (leaves.agg(F.max("lane")).first()[0] or 0) + 1

    anchors = materialize(base.where("asked").select(F.monotonically_increasing_id().alias("anchor"), "id", "label", "v"), "rtree-anchors")
    none = F.array().cast("array<long>")
    blocks = anchors.select("anchor", "id", "label", "v", none.alias("ids"), none.alias("scores")).mapInArrow(_pack_anchors(width, block, positives), PACKED)
    near = _through(leaves, lanes, blocks, positives, positives, None)
    best = Window.partitionBy("anchor").orderBy(F.col("score").desc(), "id")
    near = near.withColumn("n", F.row_number().over(best)).where(F.col("n") <= positives)
    # at most `positives` rows of each anchor
    near = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("p"))
    known = materialize(anchors.join(near, "anchor").select("anchor", "id", "label", "v", "p.id", "p.score").toDF("anchor", "own", "label", "v", "ids", "scores"), "rtree-positives")
    blocks = known.mapInArrow(_pack_anchors(width, block, positives), PACKED)
    hard = _through(leaves, lanes, blocks, negatives, positives, window)
    best = Window.partitionBy("anchor", "positive").orderBy(F.col("score").desc(), "id")
    hard = hard.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives)
    at = (F.col("positive") + 1).cast("int")
    met = hard.join(known.select("anchor", "own", "ids", "scores"), "anchor")
    return met.select(
        F.col("own").alias("anchor_id"), F.element_at("ids", at).alias("positive_id"), F.element_at("scores", at).alias("positive_score"),
        "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"),
    )
