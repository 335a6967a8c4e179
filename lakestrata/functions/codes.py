"""Geographic-style codes, composed keys and label splitting."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def zero_pad(code: Column, width: int) -> Column:
    """Restore leading zeros lost to integer inference.

    ``lpad`` alone would truncate a longer value, so those pass through.
    """
    text = code.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def composite_key(prefix: Column, number: Column, width: int) -> Column:
    """``prefix`` followed by ``number`` padded to ``width``; null when either is null."""
    return F.concat(prefix.cast("string"), zero_pad(number, width))


def code_prefix(code: Column, length: int) -> Column:
    return F.substring(code, 1, length)


def code_number(code: Column) -> Column:
    """Numeric value of a mixed code; null for codes such as ``2A``."""
    return code.try_cast("int")


def label_question(label: Column, separator: str = " - ") -> Column:
    """Part before the last separator; ``''`` when there is none."""
    return F.regexp_extract(label, f"(.*){separator}", 1)


def label_answer(label: Column, separator: str = " - ") -> Column:
    """Part after the first separator; ``''`` when there is none."""
    return F.regexp_extract(label, f"{separator}(.*)", 1)


def last_token(name: Column, separator: str = "_") -> Column:
    return F.substring_index(name, separator, -1)
