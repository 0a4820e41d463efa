import math
import random

import numpy as np
from pyspark.sql import functions as F

from loadtide.llm import rtree as R

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every=10, positives=5, negatives=10, window=(30, 90), scale=256):
    kept = {(i, x, tuple(math.floor(c * scale) for c in v)) for i, v, x in rows
            if None not in (i, v, x) and all(c is not None and math.isfinite(c) for c in v)}
    out = []
    for a, label, q in kept:
        if a % every:
            continue
        dot = lambda v: sum(x * y for x, y in zip(q, v))
        pos = sorted((-dot(v), i) for i, x, v in kept if x == label and i != a)[:positives]
        other = sorted((-dot(v), i) for i, x, v in kept if x != label)
        for s, p in pos:
            hit = [(-n, i) for n, i in other if window[0] * -s <= 100 * -n <= window[1] * -s][:negatives]
            out += [(a, p, -s, r, i, n) for r, (n, i) in enumerate(hit, 1)]
    return sorted(out)


def run(spark, rows, every=10, **options):
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    return sorted(tuple(r) for r in R.mine(df, F.col("vec_id") % every == 0, **options).collect())


def test_tiles_hold_every_row_once():
    rng = np.random.default_rng(1)
    for n, d in ((1, 3), (500, 2), (1000, 8), (300, 0)):
        found = R.tiles(rng.integers(-9, 9, (n, d)), 16)
        assert sorted(np.concatenate(found).tolist()) == list(range(n)) and max(map(len, found)) <= 16
    assert R.tiles(np.zeros((0, 4), np.int64), 16) == []


def test_equal_to_plain(spark):
    rng = random.Random(1)
    centres = [[rng.gauss(0, 1) for _ in range(6)] for _ in range(4)]
    rows = []
    for i in range(600):
        c = centres[i % 4]
        rows.append((i, [x + rng.gauss(0, 0.4) for x in c], rng.randrange(3)))
    want = plain(rows)
    assert len(want) > 1000 and run(spark, rows, leaf=8, lane=100, block=7) == want
    assert run(spark, rows) == want


def test_ties_copies_and_odd_rows(spark):
    rng = random.Random(2)
    rows = [(i, [float(rng.randrange(-1, 2)) for _ in range(3)], rng.randrange(2)) for i in range(150)]
    rows += [(i, [1.0, 0.0, 1.0], 1) for i in range(1000, 1100)]  # one group of copies, many ties
    rows += [rows[10]] * 5 + [(20, [0.5, 0.5, 0.5], 0), (30, [0.5], 1), (40, [], 0), (50, [0.0, 0.0, 0.0], 1)]
    rows += [(60, None, 0), (70, [math.nan, 0.0, 0.0], 0), (None, [1.0, 1.0, 1.0], 0), (80, [1.0, None, 0.0], 1), (90, [1.0, 1.0, 1.0], None), (110, [math.inf] * 3, 0)]
    rows += [(120, [2.0, 2.0, 2.0], 7)]  # alone with its label
    assert run(spark, rows, leaf=4, lane=32, block=3) == plain(rows)


def test_products_beyond_doubles(spark):
    rng = random.Random(3)
    rows = [(i, [rng.randrange(-9, 10) * 2.0**19 + rng.randrange(256) / 256 for _ in range(3)], i % 2) for i in range(120)]
    assert run(spark, rows, leaf=8, lane=50) == plain(rows)


def test_no_rows_and_other_columns(spark):
    assert run(spark, []) == []
    assert run(spark, [(10, None, 1)]) == []
    assert run(spark, [(10, [1.0], 1)]) == []
    df = spark.createDataFrame([(0, [1.0], 1, 5), (1, [1.0], 1, 5), (2, [0.5], 2, 5)], SCHEMA + ", asked int")
    assert [tuple(r) for r in R.mine(df, F.col("asked") == 5, window=(0, 100)).collect() if r.anchor_id == 0] == [(0, 1, 65536, 1, 2, 32768)]
