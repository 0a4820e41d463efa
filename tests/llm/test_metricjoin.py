import math
import random

import numpy as np
import pytest
from tests.llm.brute import groups

from loadtide.llm import metricjoin as M

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, cosine=0.98):
    rows = sorted(rows, key=lambda r: r[0])
    ok = []
    for _, v, lab in rows:
        good = lab is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
        ok.append(np.array(v, np.float32).astype(float) if good else None)
    n = len(rows)
    links, count = [], [0] * n
    for i in range(n):
        for j in range(i):
            if ok[i] is None or ok[j] is None or rows[i][2] != rows[j][2] or len(ok[i]) != len(ok[j]):
                continue
            if ok[i] @ ok[j] / math.sqrt((ok[i] @ ok[i]) * (ok[j] @ ok[j])) >= cosine:
                links.append((i, j))
                count[i] += 1
                count[j] += 1
    root = groups(n, links)
    return sorted((r[0], count[i], rows[root[i]][0], r[0] == rows[root[i]][0]) for i, r in enumerate(rows))


def result(spark, rows, schema=SCHEMA, **options):
    return sorted(map(tuple, M.near_vectors(spark.createDataFrame(rows, schema), **options).collect()))


def vectors(seed, n=400, dim=6):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((40, dim))
    rows = []
    for i in range(n):
        v = base[rng.integers(40)] * rng.uniform(0.1, 9) + rng.standard_normal(dim) * rng.choice([0, 0.02, 0.08, 0.2])
        rows.append((i, [float(np.float32(x)) for x in v], int(rng.integers(3))))
    return rows


@pytest.mark.parametrize("cell, block", [(2048, 2048), (20, 2048), (20, 7), (300, 16)])
def test_same_as_all_pairs(spark, cell, block):
    rows = vectors(cell + block)
    assert result(spark, rows, cell=cell, block=block) == plain(rows)


def test_defined_cases(spark):
    one = [1.0, 2.0, 3.0]
    rows = [(5, one, 1), (5, one, 1), (6, one, 2), (7, one, None), (8, None, 1), (9, [0.0, 0.0, 0.0], 1), (10, [1.0, None, 3.0], 1)]
    rows += [(11, [1.0, float("nan"), 1.0], 1), (12, [1.0, float("inf"), 1.0], 1), (13, [], 1), (14, [1.0, 2.0], 1), (15, [2e38, 4e38 / 2, 3e38], 1), (4, [2.0, 4.0, 6.0], 1)]
    rows += [(16, [1e-38, 2e-38, 3e-38], 1)]
    want = plain([r for r in rows if r[0] != 16 and r[0] != 15])
    got = result(spark, rows)
    assert [r for r in got if r[0] not in (4, 5, 15, 16)] == [r for r in want if r[0] not in (4, 5)]
    assert [r for r in got if r[0] in (4, 5, 16)] == [(4, 3, 4, True), (5, 3, 4, False), (5, 3, 4, False), (16, 3, 4, False)]
    clash = [(*r, 1, 2, 3) for r in rows]
    assert result(spark, clash, SCHEMA + ", node int, cell int, core int") == got
    assert result(spark, []) == []


def test_forest_joins_what_is_linked():
    rng = random.Random(1)
    for _ in range(50):
        a, b = rng.randint(1, 9), rng.randint(1, 9)
        m = np.array([[rng.random() < 0.2 for _ in range(b)] for _ in range(a)])
        full = groups(a + b, [(i, a + j) for i in range(a) for j in range(b) if m[i, j]])
        some = M.forest(m)
        assert all(m[i, j] for i, j in some)
        assert groups(a + b, [(i, a + j) for i, j in some]) == full


def test_components_of_chains(spark):
    from loadtide.llm.components import components

    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 101), (101, 101), (7, 3)] + [(200, k) for k in range(201, 240)]
    df = spark.createDataFrame([*edges, (None, 5)], "a long, b long")
    for last in (0, 10, 200_000):
        got = {r.node: r.root for r in components(df, last=last).collect()}
        assert len({got[i] for i in range(61)}) == 1 and got[100] == got[101] != got[0] and len({got[k] for k in range(200, 240)}) == 1
        assert len(got) == 61 + 2 + 40
    assert components(df.limit(0)).count() == 0
