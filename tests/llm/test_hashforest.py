import numpy as np
from pyspark.sql import functions as F

from loadtide.llm import hashforest as H

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, is_query, k=10):
    ids = [r[0] for r in rows]
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    out = set()
    for i, q in enumerate(ids):
        if is_query(q):
            d = np.sqrt(((x - x[i]) ** 2).sum(axis=1))
            best = sorted((float(d[j]), ids[j]) for j in range(len(ids)) if ids[j] != q)[:k]
            out |= {(q, v, s) for s, v in best}
    return out


def test_recall_and_scores(spark):
    rng = np.random.default_rng(2)
    hard = rng.standard_normal((3000, 32))
    easy = rng.standard_normal((30, 32))[rng.integers(0, 30, 3000)] * 4 + rng.standard_normal((3000, 32)) * 0.1 + 1
    for name, x in (("hard", hard), ("easy", easy)):
        rows = [(i, [float(np.float32(v)) for v in r], 0) for i, r in enumerate(x)]
        df = spark.createDataFrame(rows, SCHEMA)
        got = H.search(df, F.col("vec_id") % 50 == 0, segment=1000, query_block=20).collect()
        want = plain(rows, lambda i: i % 50 == 0)
        assert len(got) == 600
        scores = {(q, v): s for q, v, s in want}
        found = [(r.query_id, r.vec_id) for r in got]
        assert len(set(found) & scores.keys()) >= 0.9 * 600, name
        assert all(abs(r.score - scores[r.query_id, r.vec_id]) < 1e-12 for r in got if (r.query_id, r.vec_id) in scores)
        by = {}
        for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
            by.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert all(len(v) == 10 and v == sorted(v) for v in by.values())


def test_easy_queries_see_few_candidates():
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((100, 16)) * 5
    x = centres[rng.integers(0, 100, 4000)] + rng.standard_normal((4000, 16)) * 0.05
    forest = H.Forest(x, np.arange(4000), x.mean(axis=0), 1, 24, 32)
    lo, hi = forest.ranges(forest.codes(x[:50]))
    assert (np.diff((hi - lo).sum(axis=1), axis=0) <= 0).all()  # shorter prefixes share more
    found = list(forest.nearest(x[:50], np.arange(50), 5, 0.03))
    assert len(found) == 250 and max(d for _, _, d in found) < 1


def test_defined_cases(spark):
    a = [1.0, 0.0]
    rows = [(0, a, 1), (1, [1.0, 1.0], 1), (2, a, 1), (2, a, 1), (3, None, 1), (4, [0.0, 0.0], 1), (5, [None, 1.0], 1), (6, [float("nan"), 1.0], 1)]
    rows += [(None, a, 1), (7, [1.0, 2.0, 3.0], 1), (8, [], 1), (10, [float("inf"), 0.0], 1)]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", row int, segment int")
    got = sorted(map(tuple, H.search(df, F.col("vec_id") % 2 == 0, k=10).collect()))
    assert got == [(0, 1, 2, 0.0), (0, 2, 2, 0.0), (0, 3, 1, 1.0), (2, 1, 0, 0.0), (2, 1, 0, 0.0), (2, 2, 1, 1.0), (2, 2, 1, 1.0)]
    assert H.search(df.limit(0), F.col("vec_id") % 2 == 0).count() == 0
    assert H.search(df, F.lit(None).cast("boolean")).count() == 0
    many = spark.createDataFrame([(i, a, 1) for i in range(50)], SCHEMA)
    got = sorted(map(tuple, H.search(many, F.col("vec_id") == 3, k=4, segment=10).collect()))
    assert got == [(3, 1, 0, 0.0), (3, 2, 1, 0.0), (3, 3, 2, 0.0), (3, 4, 4, 0.0)]


def test_a_segment_is_built_once_whatever_the_batches(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(4)
    rows = [(2, s, asked, s * 100 + i, s * 100 + i, rng.standard_normal(2).tolist()) for s in range(3) for asked, n in ((False, 40), (True, 25)) for i in range(n)]
    names = ["dim", "segment", "query", "row", "vec_id", "embedding"]
    whole = pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in rows])
    built = []

    class Counted(H.Forest):
        def __init__(self, *a):
            built.append(len(a[1]))
            super().__init__(*a)

    monkeypatch.setattr(H, "Forest", Counted)

    def answers(size):
        run = H._search(H._Centres(), 3, 0.03, 1, 8, 16, 7)
        return [tuple(r.values()) for b in run(whole.slice(i, size) for i in range(0, len(rows), size)) for r in b.to_pylist()]

    want = answers(len(rows))
    assert built == [40] * 3 and len(want) == 3 * 25 * 3
    for size in (1, 9, 64):
        built.clear()
        assert answers(size) == want and built == [40] * 3
