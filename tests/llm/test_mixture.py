import random
from collections import defaultdict

import pytest
from tests.llm.brute import WORD

from loadtide.llm import mixture as M

SCHEMA = "doc_id long, text string, source string"


def targets(sizes: dict) -> dict:
    """Share by weight, stop at three times, share again until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    w = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    left, free, out = sum(sizes.values()), set(names), {}
    while True:
        over = {s for s in free if left * w[s] > 3 * sizes[s] * sum(w[t] for t in free)}
        if not over:
            break
        for s in over:
            out[s] = 3 * sizes[s]
        left -= sum(out[s] for s in over)
        free -= over
    return out | {s: left * w[s] / sum(w[t] for t in free) for s in free}


def corpus(seed):
    rng = random.Random(seed)
    names = ["a", "B", "é", "😀", None, "", "zz", "tiny"]
    rows = []
    for i in range(900):
        s = "a" if rng.random() < 0.35 else rng.choice(names)
        if s == "tiny" and rng.random() < 0.9:
            s = "B"
        rows.append((i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.choice([0, 1, 5, 50, 300]))), s))
    return rows


@pytest.mark.parametrize("blocks", [256, 8])
def test_targets_and_counts(spark, blocks):
    rows = corpus(blocks)
    df = spark.createDataFrame(rows, SCHEMA)
    got = M.taken(df, blocks=blocks).collect()
    sizes = {i: len(WORD.findall(t)) for i, t, _ in rows}
    by_source = defaultdict(int)
    source = {i: s for i, _, s in rows}
    for i, n in sizes.items():
        by_source[source[i]] += n
    want = targets(by_source)
    took = defaultdict(int)
    assert sorted(r.doc_id for r in got) == sorted(sizes)
    for r in got:
        s = source[r.doc_id]
        assert r["size"] == sizes[r.doc_id] and r.source_size == by_source[s] and r.target == pytest.approx(want[s], rel=1e-12)
        assert 0 <= r.taken <= 3 * r["size"]
        took[s] += r.taken
    for s, t in want.items():
        assert abs(took[s] - t) <= 0.5, (s, took[s], t)
    again = M.taken(df.repartition(3), blocks=blocks).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_schedule_keeps_every_stretch_near_the_weights(spark):
    df = spark.createDataFrame(corpus(1), SCHEMA)
    sources = M.source_table(M.sizes(df), blocks=400)
    own = {r.src: r.own for r in sources.collect()}
    rows = M.schedule(sources).collect()
    counts = {s: sum(r.src == s for r in rows) for s in own}
    for r in sources.collect():
        assert abs(counts[r.src] - r.slots * r.own / r.total) <= 3 and 397 <= counts[r.src] <= 1603
    for k in range(20):
        for s in own:
            part = [r for r in rows if r.src == s and k / 20 <= r.at < (k + 1) / 20]
            assert abs(len(part) / counts[s] - 1 / 20) <= 4 / counts[s]
    blocks = defaultdict(list)
    for r in sorted(rows, key=lambda r: r.slot):
        blocks[r.src].append(r.block)
    assert all(b == list(range(len(b))) and len(b) == counts[s] for s, b in blocks.items())


def test_placements_cover_each_document_once_per_epoch(spark):
    df = spark.createDataFrame(corpus(2), SCHEMA)
    line, placed = M.mix(M.sizes(df), blocks=30)
    size = {r.row: r["size"] for r in line.collect()}
    parts = defaultdict(list)
    for r in placed.collect():
        parts[r.row, r.epoch].append((r.from_word, r.to_word))
    for (row, _), spans in parts.items():
        spans.sort()
        assert spans[0][0] >= 0 and spans[-1][1] <= size[row]
        assert all(a < b for a, b in spans) and all(p[1] == q[0] for p, q in zip(spans, spans[1:]))


def test_defined_cases(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "x y", None), (2, "", "b"), (3, "k " * 200_000, "a"), (3, "k " * 200_000, "a")]
    df = spark.createDataFrame([(*r, 1, 2, "t") for r in rows], SCHEMA + ", size int, target int, row string")
    got = M.taken(df).collect()
    assert sorted((r.doc_id or 0, r["size"]) for r in got) == [(0, 2), (1, 0), (1, 0), (2, 0), (3, 200_000), (3, 200_000)]
    assert M.taken(df.limit(0)).count() == 0
    empty = M.taken(df.where("doc_id in (1, 2)")).collect()
    assert len(empty) == 3 and all(r.taken == 0 and r.target == 0 for r in empty)


def test_rare_sources_of_a_large_corpus(spark):
    """Sources from a millionth of a hundredth to nearly all words: each gets its target to the word, spread over the whole mix."""
    own = {"big": [5_000_000] * 1000, "c": [100] * 5, "d": [100] * 100, "e": [250] * 100, "f": [500] * 100, "one": [1], "z": [4000] * 150}
    rows = [(s, n) for s, sizes in own.items() for n in sizes]
    df = spark.createDataFrame([(i, i, s, n) for i, (s, n) in enumerate(rows)], "row long, doc_id long, source string, size long")
    line, placed = M.mix(df)
    took = defaultdict(int)
    parts = defaultdict(set)
    for r in placed.groupBy("row").agg({"from_word": "sum", "to_word": "sum"}).collect():
        took[rows[r["row"]][0]] += r["sum(to_word)"] - r["sum(from_word)"]
    for s, t in targets({s: sum(n) for s, n in own.items()}).items():
        assert abs(took[s] - t) <= 0.5, (s, took[s], t)
    for r in placed.where("row >= 1000").select("row", "at").collect():
        parts[rows[r["row"]][0]].add(r["at"])
    assert all(max(parts[s]) - min(parts[s]) > 0.95 for s in "cdefz")


def test_ten_thousand_sources(spark, monkeypatch):
    """Ranks and sums go by stretches of sources, of which there are several here; no source misses its target or its slots."""
    monkeypatch.setattr(M, "STRETCH", 700)
    n = 10_000
    df = spark.range(n).selectExpr("id as row", "id as doc_id", "concat('s', lpad(id, 5, '0')) as source", "cast(1000 + id % 400 as long) as size")
    sources = M.source_table(df, blocks=16)
    want = targets({f"s{i:05}": 1000 + i % 400 for i in range(n)})
    got = {r.source: r for r in sources.collect()}
    assert len(got) == n and all(got[s].src == i and got[s].target == pytest.approx(t) for i, (s, t) in enumerate(sorted(want.items())))
    spans = sorted((r.kind, r.lo, r.lo + r.own) for r in got.values())
    assert all(p[2] == q[1] if p[0] == q[0] else q[1] == 0 for p, q in zip(spans, spans[1:]))
    line, placed = M.mix(df, blocks=16)
    took = {r["row"]: r["w"] for r in placed.selectExpr("row", "to_word - from_word as w").groupBy("row").agg({"w": "sum"}).withColumnRenamed("sum(w)", "w").collect()}
    assert all(abs(took[i] - want[f"s{i:05}"]) <= 0.5 for i in range(n))
    least = placed.groupBy("row").agg({"slot": "count"}).agg({"count(slot)": "min"}).first()[0]
    assert least >= 13
