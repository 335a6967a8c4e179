"""Row predicates; all are pushed into the scan where the source allows it."""

from __future__ import annotations

import functools
import operator
from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, functions as F

from lakestrata.functions.codes import code_number


def all_present(*values: Column) -> Column:
    """True when no value is null."""
    return functools.reduce(operator.and_, [v.isNotNull() for v in values])


def not_sentinel(value: Column, sentinels: Sequence[Any]) -> Column:
    """False for sentinel codes and null."""
    return value.isNotNull() & ~value.isin(list(sentinels))


def strictly_between(value: Column, low: Any, high: Any) -> Column:
    return (value > low) & (value < high)


def within_dates(date: Column, first: str, last: str) -> Column:
    """Date window closed at both ends: midnight of ``last`` is inside."""
    return date.between(F.lit(first).cast("timestamp_ntz"), F.lit(last).cast("timestamp_ntz"))


def inside_dates(date: Column, after: str, before: str) -> Column:
    """Date window open at both ends."""
    return strictly_between(
        date, F.lit(after).cast("timestamp_ntz"), F.lit(before).cast("timestamp_ntz")
    )


def contains_none(text: Column, parts: Sequence[str]) -> Column:
    return functools.reduce(operator.and_, [~text.contains(p) for p in parts])


def code_in_scope(code: Column, below: int) -> Column:
    """Numeric codes under ``below``; codes with letters are out of scope."""
    return F.coalesce(code_number(code) < below, F.lit(False))


def code_sorts_before(code: Column, bound: str) -> Column:
    """Text comparison: right only while codes keep their leading zeros."""
    return code < F.lit(bound)


def is_number(text: Column) -> Column:
    return text.try_cast("double").isNotNull()
