import random

import numpy as np
import pytest
from tests.llm.brute import near_duplicates as plain
from tests.llm.brute import shingles

from loadtide.llm import hyperminhash as H
from loadtide.llm.words import shingle_sets, word_hashes

SCHEMA = "doc_id long, text string"


def result(spark, rows, threshold=0.85, schema=SCHEMA):
    df = H.near_duplicates(spark.createDataFrame(rows, schema), threshold=threshold)
    return sorted(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


def corpus(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(400)]
    line = [rng.choice(vocab) for _ in range(60)]
    out = []
    for base in range(40):
        words = [rng.choice(vocab) for _ in range(rng.choice([3, 7, 12, 20, 40, 70, 130, 400]))]
        for _ in range(rng.randint(1, 9)):
            own = list(words)
            for _ in range(rng.randint(0, max(1, len(words) // 25))):
                own[rng.randrange(len(own))] = rng.choice(vocab)
            if rng.random() < 0.3:
                own += line
            sep = rng.choice([" ", "\n", "  ", "\t"])
            text = sep.join(own)
            out.append(text.upper() if rng.random() < 0.2 else text)
    rng.shuffle(out)
    return list(enumerate(out))


@pytest.mark.parametrize("threshold", [0.8, 0.85])
def test_same_as_all_pairs(spark, threshold):
    rows = corpus(round(threshold * 100))
    assert result(spark, rows, threshold) == plain(rows, round(threshold * 100))


def test_wide_group_across_blocks(spark, monkeypatch):
    """A group whose members differ widely, with blocks so small that every kind of block pair occurs."""
    monkeypatch.setattr(H, "BLOCK", 8)
    rng = random.Random(5)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(260):
        own = list(base)
        for _ in range(rng.randint(0, 9)):
            own[rng.randrange(150)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    assert result(spark, rows) == plain(rows, 85)


def test_defined_cases(spark):
    long = " ".join(f"v{i}" for i in range(60000))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a b"), (5, "A  B"), (6, "a b c"), (7, long), (8, long + " end"), (4, "a b")]
    got = result(spark, rows)
    assert got == sorted(
        [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True), (4, 1, 4, True), (4, 1, 4, True), (5, 1, 4, False),
         (6, 1, 6, True), (7, 59996, 7, True), (8, 59997, 7, False)]
    )
    assert result(spark, []) == []
    one = spark.createDataFrame([(3, "x y", 1, 2, "k"), (None, "x y", 1, 2, "k")], "doc_id long, text string, node int, key int, kept string")
    assert sorted(map(tuple, H.near_duplicates(one).collect()), key=str) == [(3, 1, 3, True), (None, 1, 3, False)]


def test_hashes_follow_words():
    texts = ["Ab c  d", "ab C d", "ab c de", "", "é É"]
    h, last = word_hashes([t.encode() for t in texts])
    assert list(last) == [3, 6, 9, 9, 11]
    assert list(h[:3]) == list(h[3:6]) and h[5] != h[8] and h[9] != h[10]
    rng = random.Random(1)
    docs = [" ".join(rng.choice("abcdef") for _ in range(n)) for n in range(200)]
    assert [len(s) for s in shingle_sets([d.encode() for d in docs])] == [len(shingles(d)) for d in docs]


def test_estimate_is_close():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(300):
        x = np.unique(rng.integers(0, 1 << 64, 800, np.uint64))
        y = np.unique(np.concatenate((x[:700], rng.integers(0, 1 << 64, 100, np.uint64))))
        rx, ry = H.registers([x, y])
        est, _ = H.estimate(rx, ry, len(x), len(y))
        errors.append(est - 700 / 900)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.05


def test_registers_of_extreme_hashes():
    h = np.array([0, 1, (1 << 57) - 1, 1 << 57, (1 << 64) - 1], np.uint64)
    (r,) = H.registers([h])
    assert r[0] and r[1] and r[127] and (r != 0).sum() == 3


def test_short_pairs_at_the_threshold(spark):
    """Texts of some shingles more than another's, just at 0.8: every pair is found."""
    cases = [(n, more) for n, more in [(4, 1), (8, 2), (12, 3), (16, 4), (20, 5), (24, 6)] for _ in range(2500 if n < 16 else 400)]
    rows = []
    for k, (n, more) in enumerate(cases):
        own = [f"p{k}w{i}" for i in range(n + 4 + more)]
        rows += [(2 * k, " ".join(own[: n + 4])), (2 * k + 1, " ".join(own))]
    found = {d: c for d, _, c, _ in result(spark, rows, 0.8)}
    assert [cases[k] for k in range(len(cases)) if found[2 * k + 1] != 2 * k] == []


def test_short_keys_of_all_pairs():
    rng = np.random.default_rng(2)
    for percent in (80, 85, 93):
        for _ in range(4000):
            n = int(rng.integers(2, H.SHORT + 1))
            pool = np.unique(rng.integers(0, 1 << 64, n + 8, np.uint64))
            x, y = (np.sort(rng.permutation(pool[: n + int(rng.integers(0, 3))])[:n]) for _ in range(2))
            if H._linked(x, y, percent) and not np.array_equal(x, y):
                a, b = H.short_keys([x, y], percent / 100)
                assert len(np.intersect1d(a, b))
