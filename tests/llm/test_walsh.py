import math
import random

import numpy as np
import pytest

from loadtide.llm import walsh as W

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, parts=4, entries=256, rounds=4, scale=1024):
    """The same in Python's whole numbers, every distance in full."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    size = max(1, -(-max((len(r[1]) for r in kept), default=0) // parts))
    vectors = []
    for _, v, _ in kept:
        v = [math.floor(x * scale) for x in v] + [0] * (size * parts - len(v))
        vectors.append([v[p * size : (p + 1) * size] for p in range(parts)])
    books = [[list(v[p]) for v in vectors[:entries]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            member: dict = {}
            for v in vectors:
                member.setdefault(near(v[p], books[p])[1], []).append(v[p])
            for i, own in member.items():
                books[p][i] = [sum(c) // len(own) for c in zip(*own)]
    out, by_label = [], {}
    for (i, _, label), v in zip(kept, vectors):
        got = [near(v[p], books[p]) for p in range(parts)]
        error = sum(d for d, _ in got)
        by_label[label] = by_label.get(label, 0) + error
        out.append((i, label, "".join(f"{e:02x}" for _, e in got), error))
    return sorted(((*r, by_label[r[1]]) for r in out), key=str), books


def run(spark, rows, **options):
    df, books = W.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), **options)
    return sorted((tuple(r) for r in df.collect()), key=str), books


def test_sequency_counts_sign_changes():
    for n in (1, 2, 8, 16):
        h = W.transform(np.eye(n, dtype=np.int64)).T
        assert [int((np.diff(r) != 0).sum()) for r in h] == list(range(n))
        assert (h @ h.T == n * np.eye(n)).all()


@pytest.mark.parametrize("width", [1, 3, 5, 16])
def test_nearest_is_exact_with_ties(width):
    rng = np.random.default_rng(width)
    x, e = rng.integers(-3, 4, (700, width)), rng.integers(-3, 4, (40, width))
    e[7] = e[3]
    for f in (1, 1 << 45):  # the second needs more than 64 bits
        own, d = W.nearest(x * f, e * f)
        full = ((x[:, None] - e[None]) ** 2).sum(axis=2)
        assert (own == full.argmin(axis=1)).all() and [int(v) for v in d] == [int(v) * f * f for v in full.min(axis=1)]


def test_equal_to_plain(spark):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(12)], rng.choice([0, 1, None])) for i in range(200)]
    rows += [(3, rows[3][1], 1)] * 3 + [(None, rows[9][1], 2), (900, [0.0] * 12, 0), (901, [0.1, -0.2], 0), (902, [], 1)]
    rows += [(903, None, 0), (904, [math.nan] + [0.0] * 11, 0), (905, [None] + [0.0] * 11, 0), (906, [math.inf] * 12, None)]
    want, books = plain(rows, entries=16)
    got, found = run(spark, rows, entries=16)
    assert found == books and got == want


def test_fewer_rows_than_entries_and_none(spark):
    rows = [(i, [0.5 * i, -0.25 * i, 0.0], None) for i in range(5)]
    want, books = plain(rows)
    got, found = run(spark, rows)
    assert (got, found) == (want, books) and all(r[3] == 0 for r in got)
    assert run(spark, [(1, None, 1)]) == ([], [[], [], [], []])


def test_other_columns_do_not_matter(spark):
    df = spark.createDataFrame([(1, [0.5, 1.0, 0.0, 2.0], 3, "x", 9)], SCHEMA + ", code string, of long")
    out, _ = W.compress(df)
    assert [tuple(r) for r in out.collect()] == [(1, 3, "00000000", 0, 0)]
