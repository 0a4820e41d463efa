import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from loadtide.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(PATH)
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Tables(PATH))


def same(encoder, library, texts):
    flat, at = encoder.encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for k, w in enumerate(want):
        assert flat[at[k] : at[k + 1]].tolist() == w, repr(texts[k][:80])


def test_every_character(encoder, library):
    skip = range(0xD800, 0xE000)
    chars = [chr(c) for c in range(1, 0x30000) if c not in skip]
    import unicodedata

    known = [c for c in chars if unicodedata.category(c) != "Cn"]  # not yet assigned in one of the two Unicode versions
    texts = [f"a{c}b {c} {c}{c}" for c in known]
    flat, at = encoder.encode(texts)
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    off = [f"{ord(known[k]):x}" for k, w in enumerate(want) if flat[at[k] : at[k + 1]].tolist() != w]
    assert not off, (len(off), off[:40])


def test_random_texts(encoder, library):
    rng = random.Random(3)
    alphabet = "aaaaabcdeeeeilnorstuAEI   \n\t'’\"!?.,-012 éÉßçÇñΣσςİıאבहि漢字가😀́‍\x1c\x85 "
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(3000)]
    texts += ["aaaaaaaaaaaaaaaaaaaaaaaa", "a" * 3001, "!!!!!!!!!!!!", "it's we'll I'VE 'tis", "x<|endoftext|>y <|startoftext|>", "<|EndOfText|> <|", ""]
    same(encoder, library, texts)


def test_long_word_and_memory(encoder, library, monkeypatch):
    rng = random.Random(4)
    same(encoder, library, ["".join(rng.choice("abcdefghij") for _ in range(20000))])
    monkeypatch.setattr(bpe, "MEMORY", 10)
    monkeypatch.setattr(bpe, "FLAT", 50)
    for k in range(5):
        same(encoder, library, [f"word{rng.random()} the other {k}" for _ in range(20)])


def test_rows(spark, library):
    rows = [(1, "Hello  World's\n2x"), (2, None), (3, ""), (None, "a<|endoftext|>b"), (1, "Hello  World's\n2x"), (5, "é ﬁ Å")]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "doc_id long, text string, ids int, _text string")
    out = bpe.encode(df, PATH)
    got = out.select("doc_id", "ids", bpe.decode(out, out["ids"], PATH).alias("back")).collect()
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((d, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(str, ((r[0], list(r[1]), r[2]) for r in got))) == sorted(map(str, want))
    assert bpe.encode(df.limit(0), PATH).count() == 0


def test_query(spark, library):
    from loadtide.llm.queries import op10_bpe

    d = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{d}/documents.parquet").collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in op10_bpe(spark, d).collect()}
    assert got.keys() == texts.keys()
    for k, t in texts.items():
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[k] == (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))


def test_long_chunks_are_not_remembered():
    path = public_tokenizers.path("word_bpe_49k.json")
    encoder = bpe.Encoder(bpe.Tables(path))
    texts = ["x" * 5000 + str(i) for i in range(30)] + ["short word " + "ab" * 40]
    lib = Tokenizer.from_file(path)
    for _ in range(2):
        flat, offsets = encoder.encode(texts)
        for t, a, b in zip(texts, offsets[:-1], offsets[1:]):
            assert flat[a:b].tolist() == lib.encode(t, add_special_tokens=False).ids
        assert max(map(len, encoder.seen)) <= bpe.LONG
