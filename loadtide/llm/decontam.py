"""Benchmark passages in documents, found by one Aho-Corasick automaton over words.

Items are cut into windows of consecutive words; an item of fewer words is one window. Each word of the items has a
number, written as two symbols of disjoint alphabets, so that a node has few branches and a match can't start inside a word. All
windows go into one automaton, and a text goes through it once: stretches of words that the items know, since a window
holds no other words. Matches are places of words; for the texts with any they are mapped to characters of the original.

The automaton grows with the items, not the documents. Items beyond ``block_words`` words are dealt to several automata of that size,
which read the documents one after the other; what they find in equal texts is joined by the text's digest.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from itertools import repeat

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from loadtide.llm.words import as_bytes
from loadtide.session import materialize

WINDOW = 10
BLOCK_WORDS = 200_000  # of items in one automaton, some 150 MB in a worker
STRETCH = 1000  # windows of a long item in one row
NAMES = ("n_words", "n_hit", "items", "spans", "contaminated")

_SYMBOL = 0x100
_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(text: bytes) -> list[bytes]:
    """Runs of ASCII letters and digits and of characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_TABLE).split()


class Windows:
    """The automaton over the windows of ``rows``: (item, its words joined by blanks, length of its windows)."""

    def __init__(self, rows: list[tuple[str | None, bytes, int]]):
        parts = [(item, text.split(), n) for item, text, n in rows]
        self.number = {w: i for i, w in enumerate(sorted({w for _, ws, _ in parts for w in ws}), 1)}
        self.base = int(len(self.number) ** 0.5) + 1
        self.automaton = ahocorasick.Automaton()
        self.windows: list[tuple[int, set]] = []
        for item, ws, n in parts:
            numbers = np.array([self.number[w] for w in ws], np.int64)
            symbols = self._symbols(numbers)
            for i in range(len(ws) - n + 1):
                key = symbols[2 * i : 2 * (i + n)]
                at = self.automaton.get(key, None)
                if at is None:
                    self.automaton.add_word(key, at := len(self.windows))
                    self.windows.append((n, set()))
                self.windows[at][1].add(item)
        self.shortest = min((n for n, _ in self.windows), default=0)
        if self.windows:
            self.automaton.make_automaton()

    def _symbols(self, numbers: np.ndarray) -> str:
        out = np.empty(2 * len(numbers), np.uint32)
        out[::2] = _SYMBOL + numbers // self.base
        out[1::2] = _SYMBOL + 2 * self.base + numbers % self.base
        return out.astype("<u4").tobytes().decode("utf-32-le")

    def find(self, text: bytes) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, hit stretches of words (in order, apart, end not included) and the items that occur."""
        own = words(text)
        if len(own) < self.shortest or not self.windows:
            return len(own), [], set()
        numbers = np.fromiter(map(self.number.get, own, repeat(0)), np.int64, len(own))
        edge = np.flatnonzero(np.diff(np.concatenate(([False], numbers > 0, [False]))))
        first, last = edge[::2], edge[1::2]
        long = last - first >= self.shortest
        spans: list[list[int]] = []
        items: set = set()
        for lo, hi in zip(first[long].tolist(), last[long].tolist()):
            got = []
            for at, which in self.automaton.iter(self._symbols(numbers[lo:hi])):
                n, here = self.windows[which]
                items |= here
                end = lo + at // 2 + 1
                got.append((end - n, end))
            for start, end in sorted(got):
                if spans and start <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], end)
                else:
                    spans.append([start, end])
        return len(own), [(a, b) for a, b in spans], items


def locate(text: str, spans: list[tuple[int, int]]) -> list[dict]:
    """Stretches of words as characters (code points) of the original text."""
    if not spans:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in spans]


def stretches(items: DataFrame, window: int, id_col: str, text_col: str) -> DataFrame:
    """(item, words, n, size): the items' words in rows of at most ``STRETCH`` windows of ``n`` words each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for item, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                ws = words(text)
                n = min(window, len(ws))
                for i in range(0, len(ws) - n + 1, STRETCH) if ws else ():
                    part = ws[i : i + STRETCH + n - 1]
                    out.append({"item": item, "words": b" ".join(part), "n": n, "size": len(part)})
            schema = pa.schema([("item", pa.string()), ("words", pa.binary()), ("n", pa.int32()), ("size", pa.int64())])
            yield pa.RecordBatch.from_pylist(out, schema)

    texts = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(cut, "item string, words binary, n int, size long").distinct()


_built: dict[str, Windows] = {}


def _of(name: str, rows: list) -> Windows:
    """One automaton per Python worker, kept for its next task."""
    if name not in _built:
        _built.clear()
        _built[name] = Windows(rows)
    return _built[name]


def _finder(sent):
    name = uuid.uuid4().hex

    @arrow_udf("n_words long, first array<long>, last array<long>, items array<string>")
    def run(column: pa.Array) -> pa.Array:
        own = _of(name, sent.value)
        found = [own.find(t) for t in as_bytes(column)]
        longs = pa.list_(pa.int64())
        return pa.StructArray.from_arrays(
            [
                pa.array([n for n, _, _ in found], pa.int64()),
                pa.array([[a for a, _ in s] for _, s, _ in found], longs),
                pa.array([[b for _, b in s] for _, s, _ in found], longs),
                pa.array([sorted(i for i in x if i is not None) for _, _, x in found], pa.list_(pa.string())),
            ],
            names=["n_words", "first", "last", "items"],
        )

    return run


def _places(text: pa.Array, first: pa.Array, last: pa.Array) -> pa.Array:
    spans = [
        locate(text[i].as_py(), list(zip(a, b))) if a else [] for i, (a, b) in enumerate(zip(first.to_pylist(), last.to_pylist()))
    ]
    return pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))


def find(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_words: int = BLOCK_WORDS,
    text_col: str = "text",
    id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """``docs`` with n_words, n_hit (words inside a window that occurs), items, spans and contaminated (n_hit > 0).

    ``items`` are the ids, as strings in order and once each, of the items any of whose windows occurs; ``spans`` the hit
    stretches as code points (from 0, end not included) of the text as it stands. Input columns of the five names are replaced, others
    kept. Every row of ``docs`` gives one row, repeated rows too. Null and empty texts have no words and are never hit. Items
    without words never occur; those of a null id hit words but are not named. Repeated items count once. Without
    items nothing is hit.
    """
    spark = docs.sparkSession
    rest = [c for c in docs.columns if c not in NAMES or c == text_col]
    parts = materialize(stretches(benchmark, window, id_col, item_text_col), "windows")
    blocks = -(-(parts.agg(F.sum("size")).first()[0] or 0) // block_words) or 1
    lane = F.pmod(F.xxhash64("item", "words"), F.lit(blocks))
    text = F.col(text_col).cast("string")
    h = F.struct(*[F.col(f"`{c}`") for c in rest]).alias("row")

    def sent(block: int):
        # about block_words words, whatever the benchmark's size
        rows = [(r["item"], bytes(r["words"]), r["n"]) for r in parts.where(lane == block).collect()]
        return spark.sparkContext.broadcast(rows)

    if blocks == 1:
        own = sent(0)
        met = docs.select(h, text.alias("text"), _finder(own)(text).alias("got"))
    else:
        met = _by_blocks(docs.select(h, text.alias("text")), sent, blocks)
    met = met.withColumn("spans", arrow_udf(_places, "array<struct<start: long, end: long>>")("text", "got.first", "got.last"))
    hit = F.aggregate(F.zip_with("got.first", "got.last", lambda a, b: b - a), F.lit(0).cast("long"), lambda s, x: s + x)
    out = met.select("row", F.col("got.n_words").alias("n"), hit.alias("hit"), F.array_sort("got.items").alias("items"), "spans")
    own = {"n_words": "n", "n_hit": "hit", "items": "items", "spans": "spans"}
    cols = [F.col("row")[c].alias(c) for c in rest if c != text_col or c not in NAMES]
    return out.select(*cols, *[F.col(v).alias(k) for k, v in own.items()], (F.col("hit") > 0).alias("contaminated"))


def _count(text: pa.Array) -> pa.Array:
    return pa.array([len(words(t)) for t in as_bytes(text)], pa.int64())


def _merged(starts: pa.Array, ends: pa.Array) -> pa.Array:
    first, last = [], []
    for a, b in zip(starts.to_pylist(), ends.to_pylist()):
        own: list[list[int]] = []
        for lo, hi in sorted(zip(a or [], b or [])):
            if own and lo <= own[-1][1]:
                own[-1][1] = max(own[-1][1], hi)
            else:
                own.append([lo, hi])
        first.append([x for x, _ in own])
        last.append([y for _, y in own])
    return pa.StructArray.from_arrays([pa.array(x, pa.list_(pa.int64())) for x in (first, last)], names=["first", "last"])


def _by_blocks(texts: DataFrame, sent, blocks: int) -> DataFrame:
    """As one automaton would find them: each block's finds per distinct text, joined to the rows by digest."""
    digest = F.sha2(F.col("text").cast("binary"), 256)
    found = []
    for block in range(blocks):
        own = sent(block)
        got = texts.select("text", _finder(own)(F.col("text")).alias("got"))
        got = got.where(F.size("got.first") > 0).select(digest.alias("d"), F.lit(block).alias("block"), "got.first", "got.last", "got.items")
        found.append(materialize(got.dropDuplicates(["d", "block"]), "windows-met"))
        own.unpersist()
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    # a text has at most one row per block
    every = every.groupBy("d").agg(*[F.flatten(F.collect_list(c)).alias(c) for c in ("first", "last", "items")])
    every = every.select("d", arrow_udf(_merged, "first array<long>, last array<long>")("first", "last").alias("s"), F.array_distinct("items").alias("items"))
    every = materialize(every, "windows-joined")
    met = texts.withColumn("n", arrow_udf(_count, "long")("text")).withColumn("d0", digest).join(every, F.col("d0") == F.col("d"), "left")
    none = F.array().cast("array<long>")
    got = F.struct(
        F.col("n").alias("n_words"), F.coalesce("s.first", none).alias("first"), F.coalesce("s.last", none).alias("last"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )
    return met.select("row", "text", got.alias("got"))
