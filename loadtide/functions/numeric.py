"""Small numeric expressions shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def per_hit(amount: Column, hits: Column) -> Column:
    """Amount per request, 0 for an idle bucket; an unknown amount stays unknown."""
    return F.when(hits > 0, amount / hits).otherwise(F.lit(0.0))


def dense_ratio(amount: Column, hits: Column) -> Column:
    """Ratio that is always a number: absent counts as 0 and the divisor is at least 1."""
    top = F.coalesce(amount.cast("double"), F.lit(0.0))
    return top / F.greatest(F.coalesce(hits.cast("double"), F.lit(0.0)), F.lit(1.0))


def finite_or_zero(value: Column) -> Column:
    """The value as a double, with everything that is not a finite number read as 0."""
    number = value.try_cast("double")
    usable = number.isNotNull() & ~F.isnan(number) & (F.abs(number) != F.lit(float("inf")))
    return F.when(usable, number).otherwise(F.lit(0.0))


def to_model_scale(target: str, value: Column) -> Column:
    """Byte sums are modelled on a log scale, counts as they are."""
    return F.log1p(F.greatest(value, F.lit(0.0))) if target == "bytes_sum" else value


def from_model_scale(target: str, value: Column) -> Column:
    raw = F.expm1(value) if target == "bytes_sum" else value
    return F.greatest(raw, F.lit(0.0))


def client_error(status: Column) -> Column:
    return status.between(400, 499)


def server_error(status: Column) -> Column:
    return status.between(500, 599)


def pearson(a: Column, b: Column) -> Column:
    """Correlation over rows where both are known, NULL if either does not vary.

    The built-in aggregate raises a division error on a constant column in ANSI mode.
    """
    a, b = a.cast("double"), b.cast("double")
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)
