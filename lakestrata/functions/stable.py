"""Reproducible pseudo-randomness: functions of the row key, never of the partitioning."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, functions as F


def key_number(*keys: Column) -> Column:
    """A uniform 32-bit number derived from the key (first 8 hex digits of its md5)."""
    text = keys[0].cast("string") if len(keys) == 1 else F.concat_ws("|", *[k.cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def key_bucket(n: int, *keys: Column) -> Column:
    return (key_number(*keys) % n).cast("int")


def seeded_pick(options: Sequence[Any], *keys: Column) -> Column:
    """One of ``options``, chosen by the key: the same on every run and cluster."""
    return F.array(*[F.lit(o) for o in options])[key_bucket(len(options), *keys)]


def hash_split(*keys: Column, train: int = 60, val: int = 20) -> Column:
    """``train`` / ``val`` / ``test`` label by key; the shares are percentages."""
    bucket = key_bucket(100, *keys)
    return F.when(bucket < train, "train").when(bucket < train + val, "val").otherwise("test")
