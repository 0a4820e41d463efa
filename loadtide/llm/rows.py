"""Input rows carried as one column, so that an operator's own columns can't clash with theirs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROW = "row"


def packed(df: DataFrame, without: Sequence[str] = ()) -> Column:
    """All columns of ``df`` but ``without`` as the struct ``row``; an empty struct where none is left."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in without]
    return F.struct(*kept).alias(ROW)


def unpacked(df: DataFrame, like: DataFrame, without: Sequence[str] = ()) -> list[Column]:
    """The columns of ``like`` but ``without`` from the struct ``row`` of ``df``."""
    return [df[ROW].getField(c).alias(c) for c in like.columns if c not in without]
