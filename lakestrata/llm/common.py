"""What several corpus operators share: words, chunked Arrow reading, stored intermediates."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakestrata.session import ensure_checkpoint_dir

#: A word is a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Text handled by numpy at a time inside a task.
CHUNK_BYTES = 1 << 20


def spare(df: DataFrame, name: str) -> str:
    """``name``, or with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def named(columns: list[str]) -> list[Column]:
    """Columns by their literal names, dots and all."""
    return [F.col("`" + c.replace("`", "``") + "`") for c in columns]


def word_count(text: Column) -> Column:
    """Words of ``text``; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def utf8(text: Column) -> Column:
    """The bytes of a text; null counts as empty."""
    return F.encode(F.coalesce(text, F.lit("")), "UTF-8")


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared checkpoint folder, whatever executors are lost later."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def text_chunks(ids: list, texts: list[bytes | None], limit: int = CHUNK_BYTES) -> Iterator[tuple[list, list[bytes]]]:
    """Rows in order, cut where their texts reach ``limit`` bytes together."""
    part_ids, part, size = [], [], 0
    for i, text in zip(ids, texts):
        part_ids.append(i)
        part.append(text or b"")
        size += len(part[-1])
        if size >= limit:
            yield part_ids, part
            part_ids, part, size = [], [], 0
    if part:
        yield part_ids, part


def give_back() -> None:
    """Return to the system what earlier tasks of this worker have freed; called where a memory-hungry task begins."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads nearby values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_hashes(words: list[bytes], width: int, seed: int) -> np.ndarray:
    """XXH64 of every run of ``width`` words, joined by blanks; of all words if there are fewer."""
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    n = max(1, len(words) - width + 1)
    starts, stops = [0, *ends[: n - 1].tolist()], (ends[-n:] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], seed) for a, b in zip(starts, stops)), np.uint64, n)


def local_roots(n: int, left: np.ndarray, right: np.ndarray, label: np.ndarray | None = None) -> np.ndarray:
    """Smallest index reachable from each of ``n`` nodes over the links left–right, starting from earlier ``label``."""
    label = np.arange(n) if label is None else label
    while True:
        a, b = label[left], label[right]
        low, high = np.minimum(a, b), np.maximum(a, b)
        open_ = low != high
        if not open_.any():
            return label
        left, right = left[open_], right[open_]
        np.minimum.at(label, high[open_], low[open_])
        while True:
            jumped = label[label]
            if np.array_equal(jumped, label):
                break
            label = jumped
