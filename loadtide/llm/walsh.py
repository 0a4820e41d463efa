"""Vectors as four short codes, their nearest entries found through an integer Walsh-Hadamard transform.

A vector of whole numbers is cut into equal parts; each part's code is the index of the nearest entry of that place's codebook.
Parts and entries are filled up with zeros to a power of two, n, and transformed by additions and subtractions alone. The
transform multiplies every squared distance by n exactly, so distances can be summed up in the transformed numbers, in sequency order, a
few at a time: an entry whose sum has passed the distance of one known entry goes, without its other terms. Nothing is rounded.

The codebooks start from the rows of smallest ids and are refined by rounds of assignment and floored means. A round is one pass
in which every task sends one row of sums per used entry; the codebooks, a size fixed by the parameters, go to the tasks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from loadtide.llm.vectors import finite, whole
from loadtide.session import materialize

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
ROWS = 512
TERMS = 4
FEW_LABELS = 10_000


def sequency(n: int) -> np.ndarray:
    """Places of the naturally ordered transform by their number of sign changes; ``n`` is a power of two."""
    bits = n.bit_length() - 1
    gray = np.arange(n) ^ (np.arange(n) >> 1)
    out = np.zeros(n, np.int64)
    for b in range(bits):
        out |= ((gray >> b) & 1) << (bits - 1 - b)
    return out


def transform(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows in sequency order, filled up with zeros to a power of two."""
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    out = np.concatenate((x, np.zeros((len(x), n - x.shape[1]), x.dtype)), axis=1)
    half = 1
    while half < n:
        pair = out.reshape(len(x), -1, 2, half)
        out = np.stack((pair[:, :, 0] + pair[:, :, 1], pair[:, :, 0] - pair[:, :, 1]), axis=2).reshape(len(x), n)
        half *= 2
    return out[:, sequency(n)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the nearest entry (squared Euclidean distance, ties to the lower index) and that distance."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    n = 1 << max(0, x.shape[1] - 1).bit_length()
    if 4 * top * top * n * n >= 1 << 63:  # the sums need more than 64 bits
        x, entries = x.astype(object), entries.astype(object)
    t, own = transform(entries), np.empty(len(x), np.int64)
    distance = np.empty(len(x), x.dtype)
    for lo in range(0, len(x), ROWS):
        rows = transform(x[lo : lo + ROWS])
        sums = ((rows[:, None, :TERMS] - t[None, :, :TERMS]) ** 2).sum(axis=2)
        known = ((rows - t[sums.argmin(axis=1)]) ** 2).sum(axis=1)
        row, entry = np.nonzero(sums <= known[:, None])
        sums = sums[row, entry]
        for at in range(TERMS, n, TERMS):
            sums = sums + ((rows[row, at : at + TERMS] - t[entry, at : at + TERMS]) ** 2).sum(axis=1)
            left = sums <= known[row]
            row, entry, sums = row[left], entry[left], sums[left]
        # the known entry itself is never dropped, so every row has one; entries follow each other in order
        first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        least = np.minimum.reduceat(sums, first)
        best = np.flatnonzero(sums == least[row])
        best = best[np.unique(row[best], return_index=True)[1]]
        own[lo : lo + ROWS] = entry[best]
        distance[lo : lo + ROWS] = least // n
    return own, distance


def _cut(x: np.ndarray, parts: int) -> np.ndarray:
    return x.reshape(len(x), parts, x.shape[1] // parts)


def _mean(total: list[int], n: int) -> list[int]:
    return [t // n for t in total]


def compress(table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, list]:
    """(rows, codebooks) of ``table`` (vec_id, label, embedding).

    The rows have vec_id, label, code (two hex digits per part; as many as the largest index needs), error (squared distance to
    the entries, summed over the parts) and label_error (error summed over rows of an equal label, nulls together). ``codebooks`` is a list by
    part, entry and place of whole numbers.

    A component x counts as floor(scale * x). Vectors that are null or hold a null or non-finite component are left out; zero
    and empty vectors stay. A vector shorter than the longest, or not divisible into ``parts``, is filled up with zeros. Codebooks start from
    the ``entries`` rows of smallest vec_id, null last, repeated rows as often as they occur, rows of the same vec_id by their
    vectors; with fewer rows they are shorter. Equal entries: the first one is used. Without rows: no rows, empty codebooks. Other
    columns are ignored. A sum or an error beyond 64 bits is an error of the job.
    """
    spark = table.sparkSession
    kept = table.where(finite(F.col("embedding"))).select("vec_id", "label", "embedding")
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        rows = kept.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return rows.withColumn("label_error", F.col("error")), [[] for _ in range(parts)]
    size = max(1, -(-longest // parts))
    width = size * parts
    first = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding").limit(entries).select("embedding").toArrow()
    books = np.swapaxes(_cut(whole(first.column(0), scale, width), parts), 0, 1).tolist()
    digits = max(2, len(f"{entries - 1:x}"))

    def as_arrays(sent) -> list[np.ndarray]:
        big = max(abs(v) for book in sent for e in book for v in e) >= 1 << 62
        return [np.array(book, object if big else np.int64).reshape(-1, size) for book in sent]

    def assign(sent, column) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        x = _cut(whole(column, scale, width), parts)
        return x, [nearest(x[:, p], book) for p, book in enumerate(as_arrays(sent))]

    sums = ", ".join(f"s{i} long" for i in range(size))

    def sums_of(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            books = sent.value
            total = [[[0] * size for _ in book] for book in books]
            count = [[0] * len(book) for book in books]
            for batch in batches:
                x, found = assign(books, batch.column(0))
                for p, (own, _) in enumerate(found):
                    order = np.argsort(own, kind="stable")
                    used, at = np.unique(own[order], return_index=True)
                    added = np.add.reduceat(x[order, p], at, axis=0) if len(at) else x[:0, p]
                    for e, row, n in zip(used.tolist(), added.tolist(), np.diff(np.append(at, len(own))).tolist()):
                        total[p][e] = [a + b for a, b in zip(total[p][e], row)]
                        count[p][e] += n
            rows = [(p, e, n, *total[p][e]) for p, c in enumerate(count) for e, n in enumerate(c) if n]
            columns = list(zip(*rows)) or [[]] * (3 + size)
            types = [pa.int32(), pa.int32()] + [pa.int64()] * (1 + size)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["part", "entry", "n", *(f"s{i}" for i in range(size))])

        return run

    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(books)
        partial = kept.select("embedding").mapInArrow(sums_of(sent), f"part int, entry int, n long, {sums}")
        totals = partial.groupBy("part", "entry").agg(F.sum("n").alias("n"), *[F.sum(f"s{i}").alias(f"s{i}") for i in range(size)])
        # at most parts * entries rows, whatever the input
        for r in totals.collect():
            books[r["part"]][r["entry"]] = _mean(list(r[3:]), r["n"])

    sent = spark.sparkContext.broadcast(books)

    @arrow_udf("struct<code: string, error: long>")
    def coded(column: pa.Array) -> pa.Array:
        _, found = assign(sent.value, column)
        errors = [sum(e) for e in zip(*[d.tolist() for _, d in found])]
        codes = ["".join(f"{c:0{digits}x}" for c in own) for own in zip(*[o.tolist() for o, _ in found])]
        return pa.StructArray.from_arrays([pa.array(codes, pa.string()), pa.array(errors, pa.int64())], names=["code", "error"])

    rows = kept.select("vec_id", "label", coded("embedding").alias("c")).select("vec_id", "label", "c.code", "c.error")
    rows = materialize(rows, "codes")
    labels = materialize(rows.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), "label-errors")
    few = labels.limit(FEW_LABELS + 1).count() <= FEW_LABELS
    met = rows.join(F.broadcast(labels) if few else labels, F.col("label").eqNullSafe(F.col("of")))
    return met.select("vec_id", "label", "code", "error", "label_error"), books


def digest(books: list) -> str:
    """SHA-256 of all components in decimal, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for book in books for entry in book for v in entry).encode()).hexdigest()
