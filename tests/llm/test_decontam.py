import random
import re

from loadtide.llm import decontam as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
FIELDS = ("doc_id", "n_words", "n_hit", "items", "contaminated")


def low(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), m[0]) for m in WORD.finditer(text or "")]


def plain(docs, items, window=10):
    """Windows compared with every stretch of words, without an automaton."""
    wins: dict = {}
    for item, text in items:
        w = low(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if w else ():
            wins.setdefault(tuple(w[i : i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w = low(text)
        hit, found = set(), set()
        for n in {len(k) for k in wins}:
            for i in range(len(w) - n + 1):
                got = wins.get(tuple(w[i : i + n]))
                if got:
                    hit |= set(range(i, i + n))
                    found |= got
        out.append((doc, len(w), len(hit), sorted(str(x) for x in found if x is not None), bool(hit)))
    return sorted(out, key=str)


def run(spark, docs, items, **options):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    found = D.find(d, b, **options).collect()
    return found, sorted((tuple(r[f] for f in FIELDS) for r in found), key=str)


def made(seed=3, n=60):
    """Texts of few words, so that windows overlap, repeat and nearly match."""
    rng = random.Random(seed)
    vocabulary = ["a", "B", "c", "ée", "x1", "日本", "Zz"]
    glue = [" ", ", ", "\n", "-", "_", "\t\t", "\x00", "\x7f", ". "]
    text = lambda k: "".join(rng.choice(vocabulary) + rng.choice(glue) for _ in range(k))
    items = [(i, text(rng.randrange(1, 30))) for i in range(20)] + [(None, text(12)), (5, text(11)), (6, None), (7, ""), (8, "?!")]
    docs = [(i, text(rng.randrange(0, 60))) for i in range(n)]
    for i in range(0, n, 3):
        item = rng.choice(items)[1] or ""
        docs.append((1000 + i, text(5) + item + " " + text(5)))
        docs.append((2000 + i, text(5) + item[: len(item) // 2]))
    return docs + [(1, None), (2, ""), (3, "..."), (3, "..."), docs[5], (None, docs[-1][1])], items


def test_equal_to_plain(spark):
    docs, items = made()
    _, got = run(spark, docs, items)
    assert got == plain(docs, items) and any(r[2] for r in got) and any(not r[2] for r in got)


def test_several_automata_find_the_same(spark):
    docs, items = made(4)
    want = plain(docs, items)
    full, got = run(spark, docs, items, block_words=40)
    assert got == want
    one, _ = run(spark, docs, items)
    spans = lambda rows: sorted((str(r.doc_id), r.n_words, str(r.spans)) for r in rows)
    assert spans(full) == spans(one)


def test_spans_lie_in_the_original(spark):
    passage = "One, two; THREE\n\nfour «five» six seven eight nine ten eleven"
    text = "Ünder 😀 the " + passage.upper() + "! and more"
    full, got = run(spark, [(1, text)], [(9, passage)])
    assert got[0][2:] == (11, ["9"], True)
    assert [text[s.start : s.end] for s in full[0].spans] == [passage.upper()]


def test_long_item_and_long_text(spark):
    item = " ".join(f"w{i}" for i in range(2700))
    text = "x " * 5000 + item + " y" * 5000
    _, got = run(spark, [(1, text), (2, " ".join(item.split()[995:1004])), (3, " ".join(item.split()[990:1005]))], [(1, item)])
    assert [r[2] for r in got] == [2700, 0, 15]


def test_no_rows_and_clashing_names(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    d = spark.createDataFrame([(1, "a b", 7, "k", 2, 5)], "doc_id long, text string, n_hit int, row string, got int, items int")
    r = D.find(d, none).collect()
    assert [(x.doc_id, x.text, x.n_hit, x.row, x.got, x.items, x.contaminated) for x in r] == [(1, "a b", 0, "k", 2, [], False)]
    b = spark.createDataFrame([(3, "a b", 1)], "item_id long, text string, item string")
    assert D.find(d.limit(0), b).collect() == []
    r = D.find(d, b).collect()
    assert [(x.n_hit, x.items, x.row, x.got) for x in r] == [(2, ["3"], "k", 2)]
