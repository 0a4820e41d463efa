"""Near-duplicate documents by HyperMinHash registers.

A document's 64-bit shingle hashes fall into 128 buckets. A register keeps the smallest hash of its
bucket, compressed to the number of leading zeros and ten mantissa bits. Bands of registers give
candidate groups, the collision-corrected register estimate sorts them out, and full shingle sets
confirm every link.

How groups of any size stay cheap and whole:

* Documents with the same shingle set are one node; copies are never compared.
* Every member of a band group is first held against one member. The links found join most
  members, and inside a component nothing more needs comparing.
* Groups that still hold several components are compared across components, block by block.
  The commonest component of a group is not compared with itself, tasks return links of a spanning
  forest, never pairs, and no group is capped.

Candidates: two documents of up to 31 shingles and of similarity t or more share at least two of
their n - ceil(t n) + 2 smallest hashes; every two of these are a key, so no such pair is missed. Two documents
differ in at most d = 2 n (1 - t) / (1 + t) shingles. Below 128 shingles more than d bands are used, so at least
one band is equal for certain; the pair is only missed if all such bands are empty, with an estimated chance of
1e-7 at t = 0.8. From 128 on there are 32 bands of four registers, which miss a pair at t = 0.8 with a chance below
1e-7. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadtide.llm.bloom import maybe_in
from loadtide.llm.components import components
from loadtide.llm.words import as_bytes, mix, shingle_sets
from loadtide.session import materialize

REGISTERS = 128
BITS = 7
MANTISSA = 10
BANDS = 32
SHORT = 31
BLOCK = 512
SIGMAS = 6.0

_BOUNDS = np.arange(REGISTERS, dtype=np.uint64) << np.uint64(64 - BITS)


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, 128) registers of 16 bits from sorted distinct hashes; 0 marks an empty bucket."""
    low = np.zeros((len(sets), REGISTERS), np.uint64)
    full = np.zeros((len(sets), REGISTERS), bool)
    for k, h in enumerate(sets):
        at = np.searchsorted(h, _BOUNDS)
        inside = at < len(h)
        low[k, inside] = h[at[inside]]
        full[k] = inside
    full &= (low >> np.uint64(64 - BITS)) == np.arange(REGISTERS, dtype=np.uint64)
    rest = low << np.uint64(BITS)
    zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]  # 53 bits are exact in a double
    zeros = np.minimum(zeros, 53).astype(np.uint64)
    after = (rest << zeros << np.uint64(1)) >> np.uint64(64 - MANTISSA)
    value = (zeros << np.uint64(MANTISSA)) + after + np.uint64(1)
    return np.where(full, value, np.uint64(0)).astype(np.uint16)


def band_count(n: int, threshold: float) -> int:
    """Bands for documents of up to the next size class: more than the shingles two such may differ in."""
    if n >= REGISTERS:
        return BANDS
    top = 15
    while top < n:
        top = 2 * top + 1
    differ = int(2 * top * (1 - threshold) / (1 + threshold) + 1e-9)
    bands = 4
    while bands <= differ and bands < BANDS:
        bands *= 2
    return bands


def _size_class(n: np.ndarray) -> np.ndarray:
    """The power of two above n, 16 at least; 0 from 128 on."""
    size = np.maximum(16, 1 << np.frexp(n)[1].astype(np.int64))
    return np.where(n >= REGISTERS, 0, size)


def band_keys(regs: np.ndarray, n: np.ndarray, threshold: float) -> list[np.ndarray]:
    """Keys of each text's bands that aren't empty, for its size class and the next if in reach; none for classes up to ``SHORT``."""
    own, reach = _size_class(n), _size_class(np.floor(n / threshold + 1e-9))
    found: list[list[np.ndarray]] = [[] for _ in n]
    classes = np.unique(np.concatenate((own, reach)))
    for size in classes[(classes == 0) | (classes > SHORT + 1)]:
        at = np.flatnonzero(((own == size) | (reach == size)) & (n > 0))
        bands = band_count(int(size) - 1 if size else REGISTERS, threshold)
        cut = regs[at].reshape(len(at), bands, REGISTERS // bands)
        acc = np.full((len(at), bands), int(size) * 64 + bands, np.uint64)
        for k in range(cut.shape[2]):
            acc = mix(acc * np.uint64(0x9E3779B97F4A7C15) + cut[:, :, k])
        acc = mix(acc + np.arange(bands, dtype=np.uint64))
        full = cut.any(axis=2)
        for k, i in enumerate(at):
            found[i].append(acc[k, full[k]])
    return [np.concatenate(f) if f else np.empty(0, np.uint64) for f in found]


def short_keys(sets: list[np.ndarray], threshold: float) -> list[np.ndarray]:
    """Keys of each text of up to ``SHORT`` shingles: every two of its smallest hashes, as many as must hold two common ones.

    Of o common hashes the second smallest has o - 2 common ones after it, and o is at least t n. Texts of one shingle have no near one.
    """
    found = []
    for h in sets:
        n = len(h)
        if not 1 < n <= SHORT:
            found.append(np.empty(0, np.uint64))
            continue
        first = h[: min(n, n - int(np.ceil(threshold * n - 1e-9)) + 2)]
        i, j = np.triu_indices(len(first), 1)
        found.append(mix(mix(first[i]) * np.uint64(0x9E3779B97F4A7C15) + first[j]))
    return found


def digests(sets: list[np.ndarray]) -> np.ndarray:
    """(texts, 2) sums of two independent spreads of the hashes: 128 bits that name a set."""
    out = np.zeros((len(sets), 2), np.int64)
    some = [k for k, h in enumerate(sets) if len(h)]
    if some:
        flat = np.concatenate([sets[k] for k in some])
        starts = np.cumsum([0] + [len(sets[k]) for k in some[:-1]])
        for c, salt in enumerate((0, 0xD6E8FEB86659FD93)):
            out[some, c] = np.add.reduceat(mix(flat ^ np.uint64(salt)), starts).astype(np.int64)
    return out


def estimate(x: np.ndarray, y: np.ndarray, nx: np.ndarray, ny: np.ndarray) -> np.ndarray:
    """Jaccard estimates minus what they may miss: registers (..., 128) and set sizes, broadcast.

    Two different minima of a bucket share a register with chance 0.72 nx ny / (nx + ny)**2 / 2**10
    (0.72 is the mean of a power of two below a number, over that number); that many equal
    registers are taken off.
    """
    used = ((x != 0) | (y != 0)).sum(-1)
    same = ((x == y) & (x != 0)).sum(-1)
    chance = 0.72 * nx * ny / (nx + ny) ** 2 / (1 << MANTISSA)
    return (same / np.maximum(used, 1) - chance) / (1 - chance), used


def likely(est: np.ndarray, used: np.ndarray, threshold: float) -> np.ndarray:
    return est >= threshold - SIGMAS * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))


def _percent(threshold: float) -> int:
    return round(threshold * 100)


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    common = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * common >= percent * (len(x) + len(y) - common)


def sign(docs: DataFrame, id_col: str, text_col: str, threshold: float) -> DataFrame:
    """doc_id, n_shingles, digest of the set (two longs), registers, band keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(as_bytes(batch.column(1))))
            size = np.array([len(h) for h in sets], np.int64)
            regs, digest = registers(sets), digests(sets)
            both = zip(short_keys(sets, threshold), band_keys(regs, size, threshold))
            keys = [np.concatenate(k).astype(np.int64) for k in both]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(size),
                    pa.array(digest[:, 0].copy()),
                    pa.array(digest[:, 1].copy()),
                    pa.array([r.tobytes() for r in regs], pa.binary()),
                    pa.array(keys, pa.list_(pa.int64())),
                ],
                names=["doc_id", "n_shingles", "high", "low", "regs", "bands"],
            )

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(
        run, "doc_id long, n_shingles long, high long, low long, regs binary, bands array<long>"
    )


def _sets(needed: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, hashes) of the nodes in ``needed`` (node, doc_id, high, low), from the documents' texts."""

    def run(batches):
        for batch in batches:
            sets = list(shingle_sets(as_bytes(batch.column(3))))
            want = np.column_stack([batch.column(i).to_numpy() for i in (1, 2)])
            own = (digests(sets) == want).all(axis=1)  # a doc_id may come with several texts
            hashes = pa.array([h.tobytes() for h in sets], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), hashes], names=["node", "hashes"]).filter(pa.array(own))

    # few documents have a likely partner: the texts of the others aren't shuffled
    some = docs.where(maybe_in(needed.select("doc_id"), needed.count(), F.col("_id")))
    found = needed.join(some, F.col("doc_id").eqNullSafe(F.col("_id"))).select("node", "high", "low", "text")
    return found.mapInArrow(run, "node long, hashes binary").groupBy("node").agg(F.first("hashes").alias("hashes"))


def _stack(column, dtype) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), dtype).reshape(len(raw), -1)


def _likely_pairs(threshold: float):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _stack(batch.column("rx"), np.uint16), _stack(batch.column("ry"), np.uint16)
            nx, ny = (batch.column(c).to_numpy().astype(float) for c in ("nx", "ny"))
            est, used = estimate(x, y, nx, ny)
            ok = likely(est, used, threshold) & (np.minimum(nx, ny) >= threshold * np.maximum(nx, ny) - 1e-9)
            yield batch.select(["a", "b"]).filter(pa.array(ok))

    return run


def _confirm(percent: int):
    def run(batches):
        for batch in batches:
            xs, ys = batch.column("hx").to_pylist(), batch.column("hy").to_pylist()
            ok = [_linked(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent) for x, y in zip(xs, ys)]
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    return run


class _Pair:
    """The rows of one pair of blocks, as arrays."""

    def __init__(self, side, n, root, regs):
        self.n, self.root, self.regs = n.astype(float), root, regs
        self.one, self.two = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        if not len(self.two):
            self.two = self.one

    def likely(self, threshold: float):
        """Likely pairs of different components: rows, rows, estimates."""
        n, root, regs, two = self.n, self.root, self.regs, self.two
        for k in range(0, len(self.one), 64):
            p = self.one[k : k + 64]
            ok = root[p][:, None] != root[two][None]
            ok &= np.minimum(n[p][:, None], n[two][None]) >= threshold * np.maximum(n[p][:, None], n[two][None]) - 1e-9
            i, j = np.nonzero(ok)
            for lo in range(0, len(i), 1 << 14):
                x, y = p[i[lo : lo + (1 << 14)]], two[j[lo : lo + (1 << 14)]]
                est, used = estimate(regs[x], regs[y], n[x], n[y])
                good = likely(est, used, threshold)
                yield x[good], y[good], est[good]


def _by_pair(each, names: list[str]):
    """Run ``each`` on every block pair of a partition sorted by (key, i, j), a batch and one pair in memory."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None

        def done(table: pa.Table, starts: np.ndarray):
            cols = [table.column(c).to_numpy() for c in ("side", "n", "root")]
            regs = _stack(table.column("regs"), np.uint16)
            for a, b in zip(starts[:-1], starts[1:]):
                yield from each(table.slice(a, b - a), _Pair(*(c[a:b] for c in cols), regs[a:b]))

        def out(found: list) -> Iterator[pa.RecordBatch]:
            if found:
                yield from pa.concat_tables(found).select(names).combine_chunks().to_batches()

        for batch in batches:
            table = pa.Table.from_batches([batch])
            table = table if rest is None else pa.concat_tables([rest, table])
            if not table.num_rows:
                continue
            ids = np.stack([table.column(c).to_numpy() for c in ("key", "i", "j")])
            starts = np.concatenate(([0], np.flatnonzero((ids[:, 1:] != ids[:, :-1]).any(axis=0)) + 1))
            rest = table.slice(int(starts[-1])).combine_chunks()
            if len(starts) > 1:
                yield from out(list(done(table, starts)))
        if rest is not None:
            yield from out(list(done(rest, np.array([0, rest.num_rows]))))

    return run


def _mark(threshold: float):
    """Rows of a block pair that take part in a likely pair."""

    def each(table: pa.Table, pair: _Pair):
        hit = np.zeros(table.num_rows, bool)
        for x, y, _ in pair.likely(threshold):
            hit[x] = hit[y] = True
        if hit.any():
            yield table.filter(pa.array(hit))

    return each


def _compare(threshold: float, percent: int):
    """Links between different components of a block pair, as a spanning forest."""

    def each(table: pa.Table, pair: _Pair):
        node = table.column("node").to_numpy()
        sets = [np.frombuffer(h, np.uint64) for h in table.column("hashes").to_pylist()]
        up: dict[int, int] = {}

        def find(r):
            while up.get(r, r) != r:
                up[r] = r = up.get(up[r], up[r])
            return r

        links = []
        for xs, ys, est in pair.likely(threshold):
            for k in np.argsort(-est, kind="stable"):
                x, y = int(xs[k]), int(ys[k])
                p, q = find(int(pair.root[x])), find(int(pair.root[y]))
                if p != q and _linked(sets[x], sets[y], percent):
                    up[p] = q
                    links.append((int(node[x]), int(node[y])))
        if links:
            yield pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})

    return each


def _block_pairs(groups: DataFrame) -> DataFrame:
    """Rows (key, node, root, n, regs) dealt to pairs of blocks of at most about BLOCK rows a side.

    Only groups with several components stay. Rows of a group's commonest component (``main``) meet
    the other rows only; the other rows meet everything.
    """
    counts = materialize(groups.groupBy("key", "root").agg(F.count("*").alias("c")), "roots")
    top = (
        counts.groupBy("key")
        .agg(F.max(F.struct("c", "root")).alias("top"), F.sum("c").alias("all"), F.count("*").alias("roots"))
        .where("roots > 1")
        .select("key", F.col("top.root").alias("main"), F.col("top.c").alias("main_c"), (F.col("all") - F.col("top.c")).alias("rest_c"))
    )
    top = materialize(top, "mixed")
    rows = groups.join(top, "key")
    nm = F.ceil(F.col("main_c") / BLOCK).cast("int")
    nr = F.ceil(F.col("rest_c") / BLOCK).cast("int")
    is_main = F.col("root") == F.col("main")
    own = F.when(is_main, -1 - F.pmod(F.xxhash64("node"), nm)).otherwise(F.pmod(F.xxhash64("node"), nr)).cast("int")
    rest = F.sequence(F.lit(0), nr - 1)
    mains = F.sequence(-nm, F.lit(-1))
    pairs = F.when(
        is_main, F.transform(rest, lambda r: F.struct(r.alias("i"), F.col("own").alias("j"), F.lit(1).alias("side")))
    ).otherwise(
        F.concat(
            F.transform(mains, lambda m: F.struct(F.col("own").alias("i"), m.alias("j"), F.lit(0).alias("side"))),
            F.transform(
                rest,
                lambda r: F.struct(
                    F.greatest("own", r).alias("i"),
                    F.least("own", r).alias("j"),
                    F.when(F.col("own") >= r, 0).otherwise(1).alias("side"),
                ),
            ),
        )
    )
    dealt = rows.withColumn("own", own).withColumn("pair", F.explode(pairs))
    return dealt.select("key", "pair.i", "pair.j", "pair.side", "node", "root", "n", "regs")


def _sorted_pairs(dealt: DataFrame) -> DataFrame:
    return dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when the Jaccard similarity of their sets of five-word shingles is at least
    ``threshold`` (whole percent, 0.8 or more). ``component_id`` is the smallest doc_id reachable over
    links, ``kept`` says that it is the document's own.

    Null, empty and white-space texts have no shingles, link with nothing and are kept. Fewer than
    five words count as one shingle. Repeated rows are copies of one another and all keep their row;
    rows with the same smallest doc_id are all kept. A null doc_id is never the smallest unless it is
    the only one; such rows are kept when alone. Other columns are ignored. No rows: no rows.
    """
    if threshold < 0.8:
        raise ValueError("bands are laid out for a similarity of 0.8 or more")
    percent = _percent(threshold)
    signed = materialize(sign(docs, id_col, text_col, threshold), "signatures")
    with_set = signed.where("n_shingles > 0")
    nodes = with_set.groupBy("high", "low", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), F.first("regs").alias("regs"), F.first("bands").alias("bands")
    )
    nodes = materialize(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")

    banded = nodes.select("node", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count("*").alias("c"), F.min("node").alias("hub")).where("c > 1")
    members = materialize(banded.join(materialize(shared.drop("c"), "bands"), "key"), "members")

    brief = nodes.select("node", "regs", F.col("n_shingles").alias("n"))
    x = brief.toDF("a", "rx", "nx")
    y = brief.toDF("b", "ry", "ny")
    tried = members.where("node <> hub").select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    star = materialize(tried.join(x, "a").join(y, "b").mapInArrow(_likely_pairs(threshold), "a long, b long"), "star")

    texts = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("text"))
    wanted = members.select("node").distinct().join(nodes.select("node", "doc_id", "high", "low"), "node")
    sets = materialize(_sets(materialize(wanted, "wanted"), texts), "sets")
    hx = sets.toDF("a", "hx")
    hy = sets.toDF("b", "hy")
    links = materialize(star.join(hx, "a").join(hy, "b").mapInArrow(_confirm(percent), "a long, b long"), "links")

    roots = materialize(components(links), "roots")
    groups = members.select("key", "node").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    groups = materialize(groups, "groups")
    mixed = _block_pairs(groups.join(brief, "node"))
    names = ["key", "i", "j", "side", "node", "root", "n", "regs"]
    shape = "key long, i int, j int, side int, node long, root long, n long, regs binary"
    marked = materialize(_sorted_pairs(mixed).mapInArrow(_by_pair(_mark(threshold), names), shape), "marked")
    late = _sorted_pairs(marked.join(sets, "node"))
    more = late.mapInArrow(_by_pair(_compare(threshold, percent), ["a", "b"]), "a long, b long")
    more = materialize(more, "late-links")

    final = components(roots.select(F.col("node").alias("a"), F.col("root").alias("b")).union(more))
    ids = nodes.select("node", "high", "low", "n_shingles", "doc_id").join(final, "node", "left")
    ids = materialize(ids.withColumn("root", F.coalesce("root", "node")), "classes")
    least = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    classes = materialize(
        ids.join(materialize(least, "least"), "root").select("high", "low", "n_shingles", "component_id"), "components"
    )
    out = with_set.select("doc_id", "n_shingles", "high", "low").join(classes, ["high", "low", "n_shingles"])
    alone = signed.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    out = out.select("doc_id", "n_shingles", "component_id").union(alone)
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
