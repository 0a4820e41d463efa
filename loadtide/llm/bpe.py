"""Byte-pair encoding with word ends, by batched merge rounds in numpy, and decoding.

A text is cut at white space; distinct chunks are normalised, cut into words and encoded once per
batch, with a bounded memory of chunks seen before. The symbols of all new words lie in one flat array. Each
round looks up every adjacent pair by binary search over the sorted keys of the merge table, takes each
word's lowest rank and merges its places from left to right. Words without a pair are done.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from loadtide.llm.words import as_bytes, pieces

END = "</w>"
MEMORY = 100_000  # chunks remembered per task, then forgotten together
LONG = 64  # characters; longer chunks are forgotten after their batch
FLAT = 1 << 18  # symbols merged at a time, but for a longer word
_ODD_SPACE = regex.compile("[\x1c-\x1f]")  # str.split() takes these for white space, the tokenizer doesn't


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: itself, or one from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = [""] * 256
    for b in plain:
        out[b] = chr(b)
    rest = [b for b in range(256) if not out[b]]
    for k, b in enumerate(rest):
        out[b] = chr(256 + k)
    return out


class Tables:
    """A tokenizer file's vocabulary and merges as arrays.

    Read: BPE with end-of-word suffix over byte letters, normalisers NFC and lower-casing, one split pattern
    whose matches are the words, added tokens matched in the raw text. Anything else is refused.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        norms = [n["type"] for n in spec["normalizer"]["normalizers"]]
        split, byte_level = spec["pre_tokenizer"]["pretokenizers"]
        if (
            model["type"] != "BPE" or model["end_of_word_suffix"] != END or norms != ["NFC", "Replace", "Lowercase"]
            or not split["invert"] or byte_level["use_regex"] or spec["post_processor"] or spec["decoder"]
        ):
            raise ValueError(f"{path} isn't a word-end BPE tokenizer of the known form")
        vocab = model["vocab"]
        self.pattern = split["pattern"]["Regex"]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = np.empty(max([*vocab.values(), *self.added.values()]) + 1, object)
        self.tokens[:] = ""
        for t, i in [*vocab.items(), *self.added.items()]:
            self.tokens[i] = t
        letters = byte_letters()
        self.inner = np.array([vocab.get(c, -1) for c in letters], np.int64)
        self.last = np.array([vocab.get(c + END, -1) for c in letters], np.int64)
        n = len(self.tokens)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        keys = np.array([vocab[a] * n + vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys = keys[order]
        self.ranks = order.astype(np.int64)
        self.products = np.array([vocab[a + b] for a, b in pairs], np.int64)[order]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word (not empty), as 32-bit numbers."""
        out: list[bytes] = []
        lo = 0
        while lo < len(words):
            hi, size = lo, 0
            while hi < len(words) and (hi == lo or size + len(words[hi]) <= FLAT):
                size += len(words[hi])
                hi += 1
            out += self._merge(words[lo:hi])
            lo = hi
        return out

    def _merge(self, words: list[bytes]) -> list[bytes]:
        data = np.frombuffer(b"".join(words), np.uint8)
        lengths = np.array([len(w) for w in words])
        sym = self.inner[data]
        ends = np.cumsum(lengths) - 1
        sym[ends] = self.last[data[ends]]
        word = np.repeat(np.arange(len(words)), lengths)
        known = sym >= 0  # bytes outside the vocabulary have no token
        sym, word = sym[known], word[known]
        out = [b""] * len(words)
        none = len(self.keys)
        n = len(self.tokens)
        while len(sym):
            key = sym[:-1] * n + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), none - 1)
            rank = np.full(len(sym), none)
            rank[:-1] = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.ranks[at], none)
            first = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
            count = np.diff(np.concatenate((first, [len(sym)])))
            low = np.repeat(np.minimum.reduceat(rank, first), count)
            done = low == none
            over = done[first]
            if over.any():
                raw = sym.astype(np.int32).tobytes()
                start = first[over]
                for w, a, b in zip(word[start].tolist(), (4 * start).tolist(), (4 * (start + count[over])).tolist()):
                    out[w] = raw[a:b]
            hit = np.flatnonzero((rank == low) & ~done)
            # of adjacent places (a symbol paired with itself) every second one, from the left
            new_run = np.concatenate(([True], np.diff(hit) != 1)) if len(hit) else np.empty(0, bool)
            run = np.flatnonzero(new_run)
            within = np.arange(len(hit)) - np.repeat(run, np.diff(np.concatenate((run, [len(hit)]))))
            hit = hit[within % 2 == 0]
            sym[hit] = self.products[at[hit]]
            keep = ~done
            keep[hit + 1] = False
            sym, word = sym[keep], word[keep]
        return out


class Encoder:
    """Encodes texts with tables; keeps the ids of chunks seen before."""

    def __init__(self, tables: Tables):
        self.tables = tables
        self.words = regex.compile(tables.pattern)
        self.split = regex.compile("(" + "|".join(regex.escape(t) for t in tables.added) + ")") if tables.added else None
        self.marks = {t[:2] for t in tables.added}
        self._forget()

    def _forget(self) -> None:
        self.seen = {t: np.int32(i).tobytes() for t, i in self.tables.added.items()}

    def _cut(self, chunk: str) -> list[bytes]:
        if not chunk.isascii():
            chunk = unicodedata.normalize("NFC", chunk).replace("Σ", "σ")  # no final form of sigma
        return [w.encode() for w in self.words.findall(chunk.lower())]

    def _chunks(self, text: str) -> list[str]:
        if any(m in text for m in self.marks):
            out = []
            for part in self.split.split(text):
                out += [part] if part in self.tables.added else self._spaced(part)
            return out
        return self._spaced(text)

    @staticmethod
    def _spaced(text: str) -> list[str]:
        return regex.findall(r"[^\s\p{White_Space}]+|[\x1c-\x1f]+", text) if _ODD_SPACE.search(text) else text.split()

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Flat ids of all texts, and the offsets of each text among them."""
        if len(self.seen) > MEMORY:
            self._forget()
        cut = [self._chunks(t) for t in texts]
        new = {c for chunks in cut for c in chunks} - self.seen.keys()
        if new:
            parts = {c: self._cut(c) for c in new}
            words = list({w for ws in parts.values() for w in ws})
            ids = dict(zip(words, self.tables.merge(words)))
            for c, ws in parts.items():
                self.seen[c] = b"".join([ids[w] for w in ws])
        flat = [b"".join(map(self.seen.__getitem__, chunks)) for chunks in cut]
        for c in new:
            if len(c) > LONG:
                del self.seen[c]
        offsets = np.concatenate(([0], np.cumsum([len(f) // 4 for f in flat])))
        return np.frombuffer(b"".join(flat), np.int32), offsets.astype(np.int32)


def encode(docs: DataFrame, path: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The ``keep`` columns of ``docs`` and ``ids`` (array<int>): the tokens of the whole text, none added.

    Equal to the tokenizers library's ids for the file at ``path``, which the driver reads. Null and empty texts
    have no ids. Rows keep their number, repeated ones included; a kept column named ``ids`` is replaced.
    """
    spark = docs.sparkSession
    tables = spark.sparkContext.broadcast(Tables(path))  # as large as the vocabulary
    keep = tuple(c for c in keep if c != "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tables.value)
        for batch in batches:
            texts = as_bytes(batch.column(len(keep)))
            for lo, hi in pieces(texts):  # chunks of a quarter of a megabyte, or one longer text
                flat, offsets = encoder.encode([t.decode() for t in texts[lo:hi]])
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                own = [c.slice(lo, hi - lo) for c in batch.columns[: len(keep)]]
                yield pa.RecordBatch.from_arrays([*own, ids], names=[*keep, "ids"])

    picked = docs.select(*[F.col(f"`{c}`") for c in keep], F.col(text_col).cast("string").alias("_text"))
    fields = picked.schema.fields[: len(keep)]
    return picked.mapInArrow(run, StructType([*fields, StructField("ids", ArrayType(IntegerType()))]))


def decode(docs: DataFrame, ids: Column, path: str) -> Column:
    """The tokens' strings joined by one space, as a file without a decoder is decoded; special tokens stay.

    ``docs`` gives the session. Null ids give null, no ids an empty text.
    """
    tables = docs.sparkSession.sparkContext.broadcast(Tables(path))

    @arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        tokens = tables.value.tokens
        offsets = column.offsets.to_numpy()
        words = tokens[column.values.to_numpy()[offsets[0] : offsets[-1]]]
        offsets = offsets - offsets[0]
        gone = column.is_null().to_pylist()
        return pa.array(
            [None if g else " ".join(words[a:b]) for g, a, b in zip(gone, offsets[:-1], offsets[1:])], pa.string()
        )

    return run(ids)
