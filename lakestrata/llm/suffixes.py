"""Suffix-array dedup: two-stage sorting of a shard's suffixes and their adjacent common prefixes."""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame

from lakestrata.llm.repeats import Row, Sent, Spec, repeated

_MASKS = np.array([0] + [(1 << 64) - (1 << (64 - 8 * k)) for k in range(1, 9)], np.uint64)


class _Text:
    """Concatenated segments, each closed by a zero byte, read in big-endian words of 8 bytes that end with the segment."""

    def __init__(self, texts: list[bytes]) -> None:
        sizes = np.array([len(t) + 1 for t in texts])
        self.begin = np.cumsum(sizes) - sizes
        self.end = self.begin + sizes
        self.data = np.frombuffer(b"\0".join([*texts, bytes(72)]), np.uint8)
        window = np.lib.stride_tricks.as_strided(self.data, (len(self.data) - 8, 8), (1, 1))
        self.words = np.ascontiguousarray(window).view(">u8").ravel().astype(np.uint64)
        self.owner = np.repeat(np.arange(len(texts)), sizes)

    def word(self, at: np.ndarray, k: int, depth: int) -> np.ndarray:
        """The ``k``-th word of the suffixes at ``at``, up to ``depth`` bytes of each."""
        left = np.minimum(self.end[self.owner[at]] - at, depth) - 8 * k
        return self.words[np.minimum(at + 8 * k, len(self.words) - 1)] & _MASKS[np.clip(left, 0, 8)]


def _sorted_directly(text: _Text, at: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their first ``depth`` bytes, word by word among those still alike; ties by place."""
    first = text.word(at, 0, depth)
    order = np.argsort(first, kind="stable")
    at, first = at[order], first[order]
    group = np.cumsum(np.append(False, first[1:] != first[:-1])) if len(at) else np.zeros(0, np.int64)
    for k in range(1, -(-depth // 8)):
        same = group[1:] == group[:-1]
        tied = np.flatnonzero(np.append(False, same) | np.append(same, False))
        if not len(tied):
            break
        word = text.word(at[tied], k, depth)
        order = np.lexsort((word, group[tied]))
        at[tied], word = at[tied][order], word[order]
        value = np.zeros(len(at), np.uint64)
        value[tied] = word
        group = np.cumsum(np.append(False, (group[1:] != group[:-1]) | (value[1:] != value[:-1])))
    return at


def suffix_array(texts: list[bytes], counts: np.ndarray, depth: int) -> tuple[np.ndarray, _Text]:
    """The first ``counts[i]`` suffixes of each text in order of their first ``depth`` bytes.

    Suffixes smaller than their successor are sorted directly. A suffix that is larger
    begins with a byte not below its successor's, so its rank follows from the successor's:
    buckets of first bytes are scanned upward, and each suffix met puts the larger one in
    front of it next in line in that one's bucket. Each text takes part up to the first
    smaller suffix behind those asked for, so that every larger one has its successor.
    """
    text = _Text(texts)
    data, n = text.data, int(text.end[-1])
    place = np.arange(n)
    differs = np.append(data[: n - 1] != data[1:n], True)
    differs[text.end - 1] = True
    turn = np.minimum.accumulate(np.where(differs, place, n)[::-1])[::-1]  # the next place unlike its successor
    larger = data[turn] > data[np.minimum(turn + 1, n - 1)]
    larger[text.end - 1] = False
    closing = np.zeros(n, bool)
    closing[text.end - 1] = True
    larger &= ~closing[turn]
    smaller_next = np.minimum.accumulate(np.where(larger, n, place)[::-1])[::-1]
    stop = smaller_next[text.begin + counts - 1] + 1
    step = np.zeros(n + 1, np.int64)
    step[text.begin] += 1
    step[stop] -= 1
    within = np.cumsum(step[:-1]) > 0

    direct = _sorted_directly(text, np.flatnonzero(within & ~larger), depth)
    direct_at = np.searchsorted(data[direct], np.arange(257))
    waiting: list[list[np.ndarray]] = [[] for _ in range(256)]
    inducing = np.append(False, (larger & within)[:-1])  # places whose predecessor is a larger suffix taking part
    inducing[text.begin] = False
    out = []

    def scan(found: np.ndarray, bucket: int) -> np.ndarray:
        """Queue the larger suffixes in front of those found; returns what joins the same bucket."""
        before = found[inducing[found]] - 1
        byte = data[before]
        order = np.argsort(byte, kind="stable")
        before, byte = before[order], byte[order]
        at = np.flatnonzero(np.append(True, byte[1:] != byte[:-1])) if len(byte) else []
        here = before[:0]
        for s, e in zip(at, np.append(at[1:], len(byte)) if len(at) else []):
            if byte[s] == bucket:
                here = before[s:e]
            else:
                waiting[byte[s]].append(before[s:e])
        return here

    for bucket in range(256):
        found = np.concatenate(waiting[bucket]) if waiting[bucket] else np.zeros(0, np.int64)
        while len(found):
            out.append(found)
            found = scan(found, bucket)
        found = direct[direct_at[bucket] : direct_at[bucket + 1]]
        out.append(found)
        scan(found, bucket)
    order = np.concatenate(out)
    return order[order - text.begin[text.owner[order]] < counts[text.owner[order]]], text


def common_prefixes(text: _Text, order: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that each suffix shares with the one before it in order, up to ``depth``."""
    length = np.zeros(len(order), np.int64)
    alike = np.arange(1, len(order))
    for k in range(-(-depth // 8)):
        differ = text.word(order[alike], k, depth) ^ text.word(order[alike - 1], k, depth)
        bits = np.zeros(len(alike), np.int64)
        rest = differ.copy()
        for shift in (32, 16, 8):
            empty = rest >> np.uint64(64 - shift) == 0
            bits[empty] += shift
            rest[empty] <<= np.uint64(shift)
        same = differ == 0
        length[alike] = np.where(same, min(depth, 8 * k + 8), 8 * k + bits // 8)
        alike = alike[same]
    return length


def matched(sent: Sent, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows of a shard's segments that also start in a document with a smaller id."""
    order, text = suffix_array(sent.texts, sent.count, window)
    group = np.cumsum(common_prefixes(text, order, window) < window) - 1
    which = text.owner[order]
    doc = sent.doc[which]
    least = np.full(int(group[-1]) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, doc)
    gone = doc > least[group]
    return which[gone], (order - text.begin[which])[gone]


def remove_repeats(docs: DataFrame, window: int = 50, keep_bytes: bool = False, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256[, kept])``: texts without the bytes of strings seen in documents of smaller ids.

    A string is ``window`` UTF-8 bytes inside one document; strings are judged on the input.
    Those that may repeat are gathered in shards by key (see ``repeats``), where a two-stage
    suffix array and its adjacent common prefixes tell which are equal. Copies of a segment
    stand in one place of the array, that of the smallest id.

    Null texts are empty; rows without an id come last; repeated rows and rows with equal
    ids never count as earlier than each other; other columns are ignored; an empty table
    gives an empty result.
    """
    if window < 24:
        raise ValueError("a window has 24 bytes or more")

    def finish(row: Row, gone: np.ndarray) -> tuple:
        data = np.frombuffer(row.text, np.uint8)
        kept = data[~gone].tobytes() if gone.any() else row.text
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        told = len(row.text), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()
        return (*told, kept) if keep_bytes else told

    columns = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept_sha256": "string"} | ({"kept": "binary"} if keep_bytes else {})
    return repeated(docs, Spec(False, window, 24, False), lambda sent: matched(sent, window), finish, columns, doc_id=doc_id, text=text, **options)
