import zlib

from loadtide.llm import ring
from loadtide.llm.queries import op5_ring

SCHEMA = "doc_id long, text string"


def shards_of(spark, rows, shards, schema=SCHEMA, **options):
    out = ring.assign(spark.createDataFrame(rows, schema), shards, **options)
    return [tuple(r) for r in out.select("doc_id", "text", "size", "shard", "slot").collect()]


def check(got, shards, rows):
    assert sorted(map(str, ((d, t) for d, t, *_ in got))) == sorted(map(str, rows))
    for s in range(shards):
        assert sorted(r[4] for r in got if r[3] == s) == list(range(sum(r[3] == s for r in got)))
    return [sum(r[2] for r in got if r[3] == s) for s in range(shards)]


def test_sizes_are_near_equal(spark):
    rows = [(i, f"text {i} " + "x" * (i * 7919 % 300)) for i in range(6000)]
    load = check(shards_of(spark, rows, 7), 7, rows)
    mean = sum(load) / 7
    assert max(load) <= mean * 1.0005 + 400 and min(load) >= mean * 0.99 - 400


def test_copies_of_a_third_of_all_rows(spark):
    rows = [(i, "same text" * 20 if i % 3 else f"own {i} " + "y" * (i % 170)) for i in range(3000)]
    got = shards_of(spark, rows, 5)
    load = check(got, 5, rows)
    assert max(load) - min(load) <= 0.02 * sum(load) / 5 + 400
    small = [(i, f"t{i // 3}" * 9) for i in range(9000)]
    homes: dict = {}
    for r in shards_of(spark, small, 5):
        homes.setdefault(r[1], set()).add(r[3])
    assert sum(len(h) > 1 for h in homes.values()) <= 5  # only where a shard is full


def test_few_rows_move_when_a_shard_is_added(spark):
    rows = [(i, f"doc {i} " + "z" * (i * 31 % 200)) for i in range(8000)]
    before = {r[0]: r[3] for r in shards_of(spark, rows, 24)}
    after = {r[0]: r[3] for r in shards_of(spark, rows, 25)}
    assert sum(before[d] != after[d] for d in before) < 0.6 * len(rows)  # a plain remainder moves 96 %


def test_defined_cases(spark):
    rows = [(1, None), (1, None), (None, "a"), (2, ""), (2, "é" * 200_000), (3, "a")]
    got = shards_of(spark, rows, 3)
    check(got, 3, rows)
    assert sorted(r[2] for r in got) == [8, 8, 8, 9, 9, 400_008]
    clash = [(*r, 5, "k", 1) for r in rows]
    again = shards_of(spark, clash, 3, SCHEMA + ", shard int, slot string, _arc int")
    assert sorted(map(str, again)) == sorted(map(str, got))
    assert shards_of(spark, [], 3) == []


def plain(rows, shards, nodes=ring.NODES, slack=ring.SLACK):
    """The ring walked document group by group, with the hashes taken from Spark as given: shard of each (arc, piece)."""
    key = lambda r: (r["arc"], r["piece"])
    load: dict = {}
    for r in rows:
        load[key(r)] = load.get(key(r), 0) + r["size"]
    heavy = {}
    for (arc, _), b in load.items():
        heavy[arc] = heavy.get(arc, 0) + b
    limit = sum(load.values()) / ring.HEAVY
    split = {a for a, b in heavy.items() if b > limit}
    groups: dict = {}
    for (arc, piece), b in load.items():
        k = (arc, piece + 1 if arc in split else 0)
        groups[k] = groups.get(k, 0) + b
    return split, groups


def test_placement_equals_a_walk_from_node_to_node(spark):
    from pyspark.sql import functions as F

    rows = [(i, "copy " * 50 if i % 4 == 0 else f"t {i} " + "q" * (i % 90)) for i in range(600)]
    shards = 5
    df = spark.createDataFrame(rows, SCHEMA)
    key = F.xxhash64("text")
    hashed = df.select("doc_id", ring.size_of(F.col("text")).alias("size"), F.shiftrightunsigned(key, 48).alias("arc"),
                       F.shiftrightunsigned(F.xxhash64(F.col("doc_id").cast("string"), key), 56).alias("piece")).collect()
    split, groups = plain(hashed, shards)
    assert split
    nodes = spark.range(shards * ring.NODES).select("id", F.pmod(F.xxhash64(F.lit("node"), "id"), F.lit(1 << 16)).alias("at")).collect()
    circle = sorted((r["at"], r["id"] // ring.NODES) for r in nodes)
    room = {s: sum(groups.values()) / shards * (1 + ring.SLACK) for s in range(shards)}
    total = {a: sum(b for (x, _), b in groups.items() if x == a) for a in split}
    want = {}
    for arc, piece in sorted(groups, key=lambda k: (k[0] not in split, -total.get(k[0], 0), k)):
        turn = [s for at, s in circle if at >= arc] + [s for at, s in circle if at < arc]
        fits = [s for s in turn if room[s] >= groups[arc, piece]]
        home = fits[0] if fits else max(range(shards), key=lambda s: (room[s], -s))
        room[home] -= groups[arc, piece]
        want[arc, piece] = home
    at = {r["doc_id"]: (r["arc"], r["piece"] + 1 if r["arc"] in split else 0) for r in hashed}
    got = {r[0]: r[3] for r in shards_of(spark, rows, shards)}
    assert got == {d: want[k] for d, k in at.items()}


def test_extra_columns_of_any_name_keep_their_values(spark):
    names = ["row", "_id", "_arc", "_order", "_heavy", "_first", "_piece", "_fine", "b", "n", "a.b", "text_crc32"]
    rows = [(i, f"t{i % 3}", *(f"{c}{i}" for c in names)) for i in range(40)]
    df = spark.createDataFrame(rows, SCHEMA + "".join(f", `{c}` string" for c in names))
    out = ring.assign(df, 3)
    assert out.columns == [*df.columns, "size", "shard", "slot"]
    assert sorted(tuple(r)[:-3] for r in out.collect()) == rows


def test_query(spark):
    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    got = op5_ring(spark, d).collect()
    assert sorted(r.doc_id for r in got) == sorted(texts)
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 8 for r in got)
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
