"""Exact search for repeated windows of a corpus: what may repeat is narrowed by hashes, then shards compare the texts.

A window is a run of ``window`` symbols (bytes or words) of one document. Every window is
filed under the smallest hash among the runs of ``gram`` symbols inside it; neighbouring
windows filed under the same place make a segment, and equal windows always meet under the
same key. Documents are dealt to blocks by a hash of their id, keys to shards:

1. each block tells each shard its keys; the shard answers which occur more than once;
2. of those, the block tells the hashes of its segments, each once with its earliest place;
   the shard answers which are the earliest of their kind and which share their key with
   other segments;
3. a later copy of a segment is all repeated. The earliest one is sent in full where
   windows of different segments may be equal, and the operator's ``compare`` finds them.
   A key with more than ``HOT_SEGMENTS`` different segments, as a passage that many documents
   hold between different neighbours makes it, is parted: its windows are sent one by one, each
   different one once per block, to the shard of the window's own hash;
4. blocks receive the spans that are repeated.

Messages are packed arrays, one row per block and shard that have something to say, so
their size follows the text. A group of copies collapses to one entry per block in every
message, whatever its size. All passes read one shuffle of the documents. Blocks and shards
grow in number with the input, so a task's share stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import mix64, utf8

_PLACE = 20  # bits of a place inside a chunk
_CHUNK = 1 << _PLACE  # places of a chunk
_LAST = np.iinfo(np.int64).max  # the order of rows without an id
_FIRST, _SEND, _LATER, _PART = 1, 2, 3, 4
#: Different segments under one key that are compared in one place.
HOT_SEGMENTS = 2048


class Spec(NamedTuple):
    """What a window is; ``earlier_in_document``: whether an earlier start in the same document counts too."""

    words: bool
    window: int
    gram: int
    earlier_in_document: bool


class Row(NamedTuple):
    doc: int
    text: bytes
    symbols: object  # the bytes, or the list of words


class Segments(NamedTuple):
    row: np.ndarray
    pos: np.ndarray  # of the first window, in symbols of the row
    count: np.ndarray  # windows
    key: np.ndarray
    content: np.ndarray


def rows_of(block: pa.Table, spec: Spec) -> tuple[list[Row], np.ndarray]:
    """The different (id, text) rows of a block in order, and which of them each row of the table is."""
    docs = [_LAST if d is None else d for d in block.column("doc_id").to_pylist()]
    texts = block.column("text").to_pylist()
    order = sorted(range(len(docs)), key=lambda i: (docs[i], texts[i]))
    rows, which = [], np.zeros(len(docs), np.int64)
    for i in order:
        if not rows or (docs[i], texts[i]) != (rows[-1].doc, rows[-1].text):
            rows.append(Row(docs[i], texts[i], texts[i].split() if spec.words else texts[i]))
        which[i] = len(rows) - 1
    return rows, which


def _chunks(rows: list[Row], window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Pieces (row, start, stop) put together to chunks; long rows are cut with ``window - 1`` symbols of overlap."""
    held, size = [], 0
    for k, row in enumerate(rows):
        n, start = len(row.symbols), 0
        while n - start >= window:
            stop = min(n, start + (_CHUNK >> 2))
            if size + stop - start > _CHUNK:
                yield held
                held, size = [], 0
            held.append((k, start, stop))
            size += stop - start
            start = stop - window + 1 if stop < n else n
    if held:
        yield held


def _gram_hashes(pieces: list[tuple[int, int, int]], rows: list[Row], spec: Spec) -> np.ndarray:
    """A hash of the ``gram`` symbols from each place on; ``gram`` is 8 words or 24 bytes."""
    a, b = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
    if spec.words:
        digest = xxhash.xxh3_64_intdigest
        words = [w for k, s, e in pieces for w in rows[k].symbols[s:e]]
        h = np.fromiter(map(digest, words), np.uint64, len(words))
        for step in (1, 2, 4):
            h = np.concatenate([h, np.zeros(step, np.uint64)])
            h = h[:-step] * a + (h[step:] ^ (h[step:] >> np.uint64(29))) * b
        return mix64(h)
    data = np.frombuffer(b"".join(rows[k].symbols[s:e] for k, s, e in pieces) + bytes(32), np.uint8)
    eight = np.ascontiguousarray(np.lib.stride_tricks.as_strided(data, (len(data) - 8, 8), (1, 1))).view(np.uint64).ravel()
    n = len(data) - 32
    h = eight[:n] * a
    h ^= h >> np.uint64(31)
    h += eight[8 : n + 8] * b
    h ^= h >> np.uint64(29)
    h *= a
    h += eight[16 : n + 16]
    return mix64(h)


def segments(rows: list[Row], spec: Spec) -> Segments:
    """All segments of a block's rows."""
    inside = spec.window - spec.gram + 1  # grams of a window
    power = np.cumprod(np.full(_CHUNK + 1, 0x9E3779B97F4A7C15, np.uint64))
    inverse = np.cumprod(np.full(_CHUNK + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64), np.uint64))
    low = np.uint64((1 << _PLACE) - 1)
    parts = []
    for pieces in _chunks(rows, spec.window):
        h = _gram_hashes(pieces, rows, spec)
        least = (h & ~low) | np.arange(len(h), dtype=np.uint64)
        width = 1
        while width < inside:
            step = min(width, inside - width)
            least = np.minimum(least[:-step], least[step:])
            width += step
        sizes = np.array([e - s for _, s, e in pieces])
        begin = np.cumsum(sizes) - sizes
        change = np.empty(len(least), bool)
        change[0] = True
        np.not_equal(least[1:], least[:-1], out=change[1:])
        change[begin[begin < len(least)]] = True
        start = np.flatnonzero(change)
        piece = np.searchsorted(begin, start, "right") - 1
        stop = np.minimum(np.append(start[1:], len(least)), begin[piece] + sizes[piece] - spec.window + 1)
        good = stop > start
        start, stop, piece = start[good], stop[good], piece[good]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power[: len(h)])])
        content = mix64((total[stop + inside - 1] - total[start]) * inverse[start] + (stop - start).astype(np.uint64))
        row, base = np.array([k for k, _, _ in pieces]), np.array([s for _, s, _ in pieces])
        parts.append((row[piece], base[piece] + start - begin[piece], stop - start, mix64(least[start] >> np.uint64(_PLACE)), content))
    if not parts:
        return Segments(*(np.zeros(0, np.int64) for _ in range(3)), *(np.zeros(0, np.uint64) for _ in range(2)))
    return Segments(*(np.concatenate(x) for x in zip(*parts)))


def _shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    return ((key >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _cuts(shard: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Stretches of equal values of a sorted array."""
    at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
    for s, e in zip(at, np.append(at[1:], len(shard)) if len(at) else []):
        yield int(shard[s]), slice(int(s), int(e))


_MESSAGE = "target bigint, origin bigint, body binary"


def _messages(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.table({
        "target": pa.array([r[0] for r in rows], pa.int64()), "origin": pa.array([r[1] for r in rows], pa.int64()), "body": pa.array([r[2] for r in rows], pa.binary()),
    })


def _bodies(table: pa.Table) -> list[tuple[int, memoryview]]:
    """Messages of a group, by origin."""
    return sorted(zip(table.column("origin").to_pylist(), table.column("body").to_pylist()))


def _unique_keys(found: Segments) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a block in order, and how many segments each has."""
    return np.unique(found.key, return_counts=True)


def _tell_keys(block: pa.Table, spec: Spec, shards: int) -> pa.Table:
    keys, times = _unique_keys(segments(rows_of(block, spec)[0], spec))
    low, many = keys.astype(np.uint32), times > 1
    own = block.column("block")[0].as_py()
    return _messages([(t, own, low[at].tobytes() + np.packbits(many[at]).tobytes()) for t, at in _cuts(_shard_of(keys, shards))])


def _size_of_keys(body: bytes) -> int:
    """A body holds 4 bytes and one bit for each key."""
    return len(body) * 8 // 33


def _answer_keys(shard: pa.Table) -> pa.Table:
    own, told = shard.column("target")[0].as_py(), _bodies(shard)
    sizes = [_size_of_keys(b) for _, b in told]
    keys = np.concatenate([np.frombuffer(b, np.uint32, n) for (_, b), n in zip(told, sizes)])
    many = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8, -1, 4 * n), count=n) for (_, b), n in zip(told, sizes)]).astype(bool)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    many[order[1:][same]] = True
    many[order[:-1][same]] = True
    return _messages([(origin, own, np.packbits(m).tobytes()) for (origin, _), m in zip(told, np.split(many, np.cumsum(sizes)[:-1]))])


class _Entries(NamedTuple):
    """Different segments of a block under repeated keys, in order of key and content, with their earliest place."""

    key: np.ndarray
    content: np.ndarray
    doc: np.ndarray
    pos: np.ndarray
    of: np.ndarray  # the entry of each segment kept
    kept: np.ndarray  # the segments under repeated keys


def _entries(rows: list[Row], found: Segments, answers: list[tuple[int, bytes]], spec: Spec, shards: int) -> _Entries:
    keys, _ = _unique_keys(found)
    many = np.zeros(len(keys), bool)
    reply = dict(answers)
    for shard, at in _cuts(_shard_of(keys, shards)):
        many[at] = np.unpackbits(np.frombuffer(reply[shard], np.uint8), count=at.stop - at.start)
    kept = np.flatnonzero(many[np.searchsorted(keys, found.key)]) if len(keys) else np.zeros(0, np.int64)
    doc = np.array([r.doc for r in rows], np.int64)[found.row[kept]] if len(rows) else np.zeros(0, np.int64)
    pos = found.pos[kept] if spec.earlier_in_document else np.zeros(len(kept), np.int64)
    order = np.lexsort((pos, doc, found.content[kept], found.key[kept]))
    kept, doc, pos = kept[order], doc[order], pos[order]
    key, content = found.key[kept], found.content[kept]
    new = np.append(True, (key[1:] != key[:-1]) | (content[1:] != content[:-1])) if len(kept) else np.zeros(0, bool)
    return _Entries(key[new], content[new], doc[new], pos[new], np.cumsum(new) - 1, kept)


_ENTRY = np.dtype([("key", "<u4"), ("content", "<u8"), ("doc", "<i8"), ("pos", "<u4")])


def _tell_segments(block: pa.Table, answers: pa.Table, spec: Spec, shards: int) -> pa.Table:
    rows, _ = rows_of(block, spec)
    found = _entries(rows, segments(rows, spec), _bodies(answers), spec, shards)
    packed = np.empty(len(found.key), _ENTRY)
    packed["key"], packed["content"], packed["doc"], packed["pos"] = found.key.astype(np.uint32), found.content, found.doc, found.pos
    own = block.column("block")[0].as_py() if block.num_rows else 0
    return _messages([(t, own, packed[at].tobytes()) for t, at in _cuts(_shard_of(found.key, shards))])


def _answer_segments(shard: pa.Table) -> pa.Table:
    own, told = shard.column("target")[0].as_py(), _bodies(shard)
    parts = [np.frombuffer(b, _ENTRY) for _, b in told]
    x = np.concatenate(parts)
    order = np.lexsort((x["pos"], x["doc"], x["content"], x["key"]))
    key, content = x["key"][order], x["content"][order]
    new_key = np.append(True, key[1:] != key[:-1])
    new = new_key | np.append(True, content[1:] != content[:-1])
    different = np.add.reduceat(new.astype(np.int64), np.flatnonzero(new_key))[np.cumsum(new_key) - 1]
    state = np.empty(len(x), np.uint8)
    state[order] = np.where(~new, _LATER, np.where(different > HOT_SEGMENTS, _PART, np.where(different > 1, _SEND, _FIRST)))
    return _messages([(origin, own, s.tobytes()) for (origin, _), s in zip(told, np.split(state, np.cumsum([len(p) for p in parts])[:-1]))])


_SPAN = np.dtype([("row", "<u4"), ("start", "<i8"), ("stop", "<i8")])
_SENT = np.dtype([("row", "<u4"), ("doc", "<i8"), ("pos", "<i8"), ("count", "<u4"), ("size", "<u4")])


def _spans(row: np.ndarray, start: np.ndarray, stop: np.ndarray) -> bytes:
    packed = np.empty(len(row), _SPAN)
    packed["row"], packed["start"], packed["stop"] = row, start, stop
    return packed.tobytes()


def _send(block: pa.Table, answers: pa.Table, spec: Spec, shards: int) -> pa.Table:
    """Texts to shards; the spans already known come back to the block through a target below zero."""
    kinds = answers.column("kind").to_numpy() if answers.num_rows else np.zeros(0, np.int64)
    pick = lambda k: _bodies(answers.take(pa.array(np.flatnonzero(kinds == k))))
    rows, _ = rows_of(block, spec)
    found = segments(rows, spec)
    entry = _entries(rows, found, pick(0), spec, shards)
    shard = _shard_of(entry.key, shards)
    state, reply = np.zeros(len(entry.key), np.uint8), dict(pick(1))
    for t, at in _cuts(shard):
        state[at] = np.frombuffer(reply[t], np.uint8)
    row, pos, count = found.row[entry.kept], found.pos[entry.kept], found.count[entry.kept]
    doc = np.array([r.doc for r in rows], np.int64)[row] if len(rows) else np.zeros(0, np.int64)
    after = doc > entry.doc[entry.of]
    if spec.earlier_in_document:
        after |= (doc == entry.doc[entry.of]) & (pos > entry.pos[entry.of])
    gone = (state[entry.of] == _LATER) | after
    own = block.column("block")[0].as_py() if block.num_rows else 0
    # where only other documents count, all places of a segment in its earliest document are still open
    open_ = ~after & (doc == entry.doc[entry.of])
    at = np.flatnonzero(open_ & (state[entry.of] == _SEND))
    parted, again = _windows(rows, spec, *(x[open_ & (state[entry.of] == _PART)] for x in (row, doc, pos, count)))
    known = [(row[gone], pos[gone], pos[gone] + count[gone] + spec.window - 1), again]
    out = [(-1 - own, own, _spans(*(np.concatenate(x) for x in zip(*known))))] if any(len(x[0]) for x in known) else []
    sent = [(t, at[some], entry.key[entry.of[at[some]]]) for t, some in _cuts(shard[entry.of[at]])]
    for t, some, keys in sent:
        texts = [rows[r].symbols[p : p + c + spec.window - 1] for r, p, c in zip(row[some].tolist(), pos[some].tolist(), count[some].tolist())]
        texts = [b" ".join(x) for x in texts] if spec.words else texts
        out.append((t, own, _packed(row[some], doc[some], pos[some], count[some], keys, texts)))
    keys = np.array([p[0] for p in parted], np.uint64)
    order = np.argsort(keys, kind="stable")
    for t, some in _cuts(_shard_of(keys[order], shards)):
        mine = [parted[k] for k in order[some].tolist()]
        key, r, d, p, texts = zip(*mine)
        out.append((t, own, _packed(r, d, p, np.ones(len(mine)), np.array(key, np.uint64), list(texts))))
    return _messages(out)


def _packed(row, doc, pos, count, keys: np.ndarray, texts: list[bytes]) -> bytes:
    head = np.empty(len(texts), _SENT)
    head["row"], head["doc"], head["pos"], head["count"], head["size"] = row, doc, pos, count, [len(x) for x in texts]
    return np.uint32(len(texts)).tobytes() + head.tobytes() + keys.astype("<u8").tobytes() + b"".join(texts)


def _windows(rows: list[Row], spec: Spec, row: np.ndarray, doc: np.ndarray, pos: np.ndarray, count: np.ndarray) -> tuple[list[tuple], tuple]:
    """The windows of segments one by one: those that come first in the block (key, row, doc, pos, text), and the spans of those that come again."""
    first: dict[bytes, tuple[int, int]] = {}  # text → document, place
    sent, again = [], ([], [], [])
    for k in np.lexsort((pos, doc)).tolist():
        r, d = int(row[k]), int(doc[k])
        for p in range(int(pos[k]), int(pos[k] + count[k])):
            text = rows[r].symbols[p : p + spec.window]
            text = b" ".join(text) if spec.words else bytes(text)
            place = first.setdefault(text, (d, p))
            if place[0] < d or (spec.earlier_in_document and place < (d, p)):
                for out, value in zip(again, (r, p, p + spec.window)):
                    out.append(value)
            elif place == (d, p) or not spec.earlier_in_document:
                sent.append((xxhash.xxh3_64_intdigest(text), r, d, p, text))
    return sent, tuple(np.array(x, np.int64) for x in again)


class Sent(NamedTuple):
    """Segments sent to a shard: where from, and their texts."""

    origin: np.ndarray
    row: np.ndarray
    doc: np.ndarray
    pos: np.ndarray
    count: np.ndarray
    key: np.ndarray
    texts: list[bytes]


def _received(told: list[tuple[int, bytes]]) -> Sent:
    heads, keys, texts, origin = [], [], [], []
    for block, body in told:
        n = int(np.frombuffer(body, np.uint32, 1)[0])
        head = np.frombuffer(body, _SENT, n, 4)
        keys.append(np.frombuffer(body, "<u8", n, 4 + n * _SENT.itemsize))
        at = 4 + n * (_SENT.itemsize + 8)
        for size in head["size"].tolist():
            texts.append(body[at : at + size])
            at += size
        heads.append(head)
        origin.append(np.full(n, block))
    head = np.concatenate(heads)
    return Sent(np.concatenate(origin), *(head[c].astype(np.int64) for c in ("row", "doc", "pos", "count")), np.concatenate(keys), texts)


#: Segments of a shard → (segment, window) pairs that are repeated.
Compare = Callable[[Sent], tuple[np.ndarray, np.ndarray]]


def _compare(group: pa.Table, spec: Spec, compare: Compare) -> pa.Table:
    target, told = group.column("target")[0].as_py(), _bodies(group)
    if target < 0:
        return _messages([(-1 - target, target, body) for _, body in told])
    sent = _received(told)
    which, offset = compare(sent)
    order = np.argsort(sent.origin[which], kind="stable")
    which, offset = which[order], offset[order]
    start = sent.pos[which] + offset
    return _messages([
        (block, target, _spans(sent.row[which[at]], start[at], start[at] + spec.window)) for block, at in _cuts(sent.origin[which])
    ])


#: Row, and the mask of its symbols that are covered by repeated windows → the values told of it.
Finish = Callable[[Row, np.ndarray], tuple]


def _finish(block: pa.Table, spans: pa.Table, spec: Spec, finish: Finish, names: list[str], types: list) -> pa.Table:
    rows, which = rows_of(block, spec)
    bodies = [b for _, b in _bodies(spans)]
    x = np.frombuffer(b"".join(bodies), _SPAN)
    x = x[np.argsort(x["row"], kind="stable")]
    cut = np.searchsorted(x["row"], np.arange(len(rows) + 1))
    told = []
    for k, row in enumerate(rows):
        mine, n = x[cut[k] : cut[k + 1]], len(row.symbols)
        step = np.bincount(mine["start"], minlength=n + 1) - np.bincount(mine["stop"], minlength=n + 1)
        told.append(finish(row, np.cumsum(step[:-1]) > 0))
    columns = [pa.array([told[i][c] for i in which], t) for c, t in enumerate(types)]
    return pa.table({"doc_id": block.column("doc_id"), **dict(zip(names, columns))})


def repeated(
    docs: DataFrame, spec: Spec, compare: Compare, finish: Finish, columns: dict[str, str],
    block_bytes: int | None = None, shard_bytes: int = 4 << 20, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: ``doc_id`` (as bigint) and ``columns`` as ``finish`` tells them of the repeated symbols.

    Ids order the documents; rows without an id come after all others and are equal among
    themselves, as are rows with equal ids. ``block_bytes`` is 4 MB of text by default,
    and up to 32 MB for large inputs, where it keeps the number of messages down.
    """
    types = {"bigint": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, kinds = list(columns), [types[t] for t in columns.values()]
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), utf8(F.col(text)).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if block_bytes is None:
        block_bytes = min(32 << 20, max(4 << 20, total // 256))
    blocks, shards = max(1, -(-total // block_bytes)), max(1, -(-total // shard_bytes))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
    dealt = rows.groupBy("block")

    keys = dealt.applyInArrow(lambda block: _tell_keys(block, spec, shards), _MESSAGE)
    many = keys.groupBy("target").applyInArrow(_answer_keys, _MESSAGE)
    found = dealt.cogroup(many.groupBy("target")).applyInArrow(lambda block, answers: _tell_segments(block, answers, spec, shards), _MESSAGE)
    states = found.groupBy("target").applyInArrow(_answer_segments, _MESSAGE)
    answers = many.withColumn("kind", F.lit(0)).unionByName(states.withColumn("kind", F.lit(1)))
    sent = dealt.cogroup(answers.groupBy("target")).applyInArrow(lambda block, told: _send(block, told, spec, shards), _MESSAGE)
    spans = sent.groupBy("target").applyInArrow(lambda group: _compare(group, spec, compare), _MESSAGE)
    schema = ", ".join(["doc_id bigint", *(f"{n} {t}" for n, t in columns.items())])
    return dealt.cogroup(spans.groupBy("target")).applyInArrow(lambda block, told: _finish(block, told, spec, finish, names, kinds), schema)
