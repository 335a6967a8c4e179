"""Numeric and calendar expressions that are safe under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


def rowwise_positive_mean(values: Sequence[Column]) -> Column:
    """Mean of the non-null positive values of a row, truncated to int; null when there is none."""
    total = count = None
    for value in values:
        used = F.when(value > 0, value).otherwise(0)
        one = F.when(value > 0, 1).otherwise(0)
        total = used if total is None else total + used
        count = one if count is None else count + one
    return F.try_divide(total.cast("double"), count).cast("int")


def safe_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio; null (not an error) for a zero denominator."""
    return F.try_divide(numerator, denominator)


def round_measure(value: Column, places: int | None = 2) -> Column:
    """Half-up rounding; ``places=None`` leaves the value exact."""
    return value if places is None else F.round(value, places)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def observed_or(value: Column, fallback: Column) -> Column:
    """The observed value, the fallback only where it is missing."""
    return F.coalesce(value, fallback)


def clamp_year(date: Column, last_year: int) -> Column:
    year = F.year(date)
    return F.when(year > last_year, last_year).otherwise(year)
