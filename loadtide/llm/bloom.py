"""A Bloom filter of ids, to let rows without a partner pass before a join.

The filter has at most ``LIMIT`` bits whatever the number of ids, so sending it to the tasks is bounded. It
never rejects an id that is in the set; rows that it lets through still need the exact join, so
results don't depend on it. Far above ``LIMIT`` / 8 ids it lets more and more rows through, and the join
does all the work.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from loadtide.llm.words import mix

LIMIT = 1 << 26
HASHES = 4


def _places(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    h = ids.astype(np.uint64)
    return [mix(h + np.uint64(k * 0x9E3779B97F4A7C15 % (1 << 64))) % np.uint64(bits) for k in range(1, HASHES + 1)]


def maybe_in(ids: DataFrame, count: int, column: Column) -> Column:
    """True where ``column`` (long) may be among the ``count`` ids of the one-column ``ids``, and where it is null."""
    bits = min(LIMIT, max(1 << 16, 1 << (16 * max(1, count)).bit_length()))

    def words(batches):
        held = np.zeros(bits, bool)
        for batch in batches:
            known = batch.column(0).drop_null().to_numpy()
            for at in _places(known, bits):
                held[at] = True
        packed = np.packbits(held).view(np.int64)
        some = np.flatnonzero(packed)
        for lo in range(0, len(some), 10_000):
            part = some[lo : lo + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), pa.array(packed[part])], names=["word", "bits"])

    found = ids.select(ids[0].cast("long").alias("id")).mapInArrow(words, "word int, bits long")
    rows = found.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()  # at most LIMIT / 64 rows
    table = np.zeros(bits // 64, np.int64)
    table[rows["word"].to_numpy()] = rows["bits"].to_numpy()
    shared = ids.sparkSession.sparkContext.broadcast(table)

    @arrow_udf("boolean")
    def test(values: pa.Array) -> pa.Array:
        held = shared.value.view(np.uint8)
        x = values.fill_null(0).to_numpy()
        hit = np.ones(len(x), bool)
        for at in _places(x, bits):
            hit &= (held[at >> np.uint64(3)] >> (np.uint8(7) - (at & np.uint64(7)).astype(np.uint8))) & np.uint8(1) > 0
        return pa.array(hit | np.asarray(values.is_null()))

    return test(column.cast("long"))
