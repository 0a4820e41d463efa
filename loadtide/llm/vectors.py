"""Checks and Arrow access shared by the operators on embeddings."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not all zero, no null and no non-finite component."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths, in double precision."""
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


def units(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1, free of overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def finite(vector: Column) -> Column:
    """Not null and without a null or non-finite component; zero and empty vectors are finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~odd, F.lit(False))


def whole(column, scale: int, width: int) -> np.ndarray:
    """floor(scale * x) of an Arrow list column's components, rows filled up with zeros to ``width``.

    ``scale`` is a power of two, so doubles hold the products. Components too large for 64 bits make an array of Python's whole numbers.
    """
    if hasattr(column, "combine_chunks"):
        column = column.combine_chunks()
    sizes = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    row = np.repeat(np.arange(len(column)), sizes)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    if np.abs(flat).max(initial=0) * scale < 2.0**62:
        out = np.zeros((len(column), width), np.int64)
        out[row, place] = np.floor(flat * scale)
    else:
        out = np.zeros((len(column), width), object)
        out[row, place] = [int(x) * scale if abs(x) >= 2.0**53 else int(np.floor(x * scale)) for x in flat.tolist()]
    return out
