import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer
from tokenizers.models import Unigram

from loadtide.llm import viterbi as V

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces):
    """The tokenizers library's unigram model on the same pieces; id 0 is the unknown piece."""
    return Tokenizer(Unigram([("<unk>", 0.0), *pieces], unk_id=0, byte_fallback=False))


@pytest.fixture(scope="module")
def real():
    return [p for p in V.vocabulary(PATH) if V.MARK not in p[0].lstrip(V.MARK)]


def test_same_counts_as_the_library(real):
    rng = random.Random(2)
    counter, lib = V.Counter(real), library(real)
    letters = "etaoin shrdlu éß漢😀.,12AB  \n"
    for _ in range(800):
        text = V.marked("".join(rng.choice(letters) for _ in range(rng.randint(1, 80))))
        enc = lib.encode(text) if text else None
        score, n, unknown = counter.text(text)
        assert n == (len(enc.ids) if enc else 0), text
        assert unknown == (enc.ids.count(0) if enc else 0)


def test_ties_and_unknown_runs():
    rng = random.Random(3)
    for _ in range(60):
        pieces = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 4))) for _ in range(12)}
        vocab = [(p, float(-rng.randint(0, 3))) for p in sorted(pieces)]
        counter, lib = V.Counter(vocab), library(vocab)
        low = min(min(s for _, s in vocab), 0.0)
        if low != min(s for _, s in vocab):
            continue
        for _ in range(40):
            word = "".join(rng.choice("abcx") for _ in range(rng.randint(1, 14)))
            assert counter.word(word)[1] == len(lib.encode(word).ids), (vocab, word)


def test_both_ways_to_solve_a_word_agree(real):
    rng = random.Random(5)
    counter = V.Counter(real)
    for _ in range(2000):
        word = V.MARK + "".join(rng.choice("etaoinshrdlué'.") for _ in range(rng.randint(1, 25)))
        assert counter._known(word) == counter._any(word)


def best(word, vocab):
    """Highest score by trying every segmentation."""
    if not word:
        return 0.0
    low = min(vocab.values()) - V.UNKNOWN
    out = [vocab[word[:k]] + best(word[k:], vocab) for k in range(1, len(word) + 1) if word[:k] in vocab]
    return max(out + ([low + best(word[1:], vocab)] if word[0] not in vocab else []))


def test_score_is_the_best_of_all_segmentations():
    rng = random.Random(4)
    vocab = {"a": -2.0, "b": -3.5, "ab": -4.0, "ba": -1.25, "aab": -5.0, "bb": -2.5}
    counter = V.Counter(list(vocab.items()))
    for _ in range(100):
        word = "".join(rng.choice("abx") for _ in range(rng.randint(1, 9)))
        assert counter.word(word)[0] == best(word, vocab)


def test_rows(spark, monkeypatch):
    rows = [(1, "The  cat\nsat"), (2, None), (3, " "), (1, "The  cat\nsat"), (None, "x" * 100_000), (4, "")]
    df = spark.createDataFrame([(*r, 9, "s") for r in rows], "doc_id long, text string, n_tokens int, score string")
    got = sorted(map(tuple, V.count_tokens(df, PATH).collect()), key=str)
    assert len(got) == 6 and (2, 0, 0, 0.0) in got and (3, 0, 0, 0.0) in got and (4, 0, 0, 0.0) in got
    assert [r[1] for r in got if r[0] == 1] == [3, 3] or all(r[1] >= 3 for r in got if r[0] == 1)
    assert V.count_tokens(df.limit(0), PATH).count() == 0
    monkeypatch.setattr(V, "MEMORY", 1)
    counter = V.Counter(V.vocabulary(PATH))
    assert counter.text(V.marked("one two one two three")) == counter.text(V.marked("one two one two three"))


def test_long_words_are_not_remembered():
    counter = V.Counter([("▁a", -1.0), ("a", -2.0), ("ab", -2.5), ("▁", -3.0)])
    text = V.marked("a " + "ab" * 3000 + " a")
    assert counter.text(text) == V.Counter([("▁a", -1.0), ("a", -2.0), ("ab", -2.5), ("▁", -3.0)]).text(text)
    assert max(map(len, counter.seen)) <= V.LONG
