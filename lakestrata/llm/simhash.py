"""SimHash near-duplicates, linked through a hierarchical index in Gray order."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import local_roots, mix64, shingle_hashes, spare, stored, utf8
from lakestrata.llm.components import components

FANOUT = 16
_QUERIES = 512  # searched at a time
_PAIRS = 1 << 16  # confirmed at a time
_VOTES = 1 << 13  # shingles whose bits are summed at a time
_CONFIRM = 8  # 64-bit words of a confirming fingerprint


def majority(hashes: np.ndarray) -> int:
    """Each bit as most of the hashes have it, ties and none at all as 0; signed."""
    votes = np.zeros(64, np.int64)
    for k in range(0, len(hashes), _VOTES):
        votes += np.unpackbits(hashes[k : k + _VOTES].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return int(np.packbits(votes * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprint(text: bytes, width: int, seed: int) -> int:
    """SimHash over all word shingles, repeats included, of a text with A-Z in lower case; 0 without words."""
    return majority(shingle_hashes(text.lower().split(), width, seed))


def confirming(text: bytes, width: int, seed: int) -> bytes:
    """A longer SimHash over the shingles of ``width`` words: each hash is spread to ``_CONFIRM`` words."""
    hashes = shingle_hashes(text.lower().split(), width, seed)
    return np.array([majority(mix64(hashes + np.uint64(k))) for k in range(_CONFIRM)], np.int64).tobytes()


def fingerprints(docs: DataFrame, width: int, seed: int, confirm: int | None, doc_id: str, text: str) -> DataFrame:
    """``(doc_id, fp, wide)``: the fingerprint as a signed number, and a confirming one over ``confirm`` words (empty if not wanted)."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(1)]
            if confirm is None:
                fps, wide = [fingerprint(t, width, seed) for t in texts], [b""] * len(texts)
            else:
                fps = [majority(np.unique(shingle_hashes(t.lower().split(), width, seed))) for t in texts]
                wide = [confirming(t, confirm, seed) for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64()), pa.array(wide, pa.binary())], ["doc_id", "fp", "wide"])

    return docs.select(F.col(doc_id).alias("doc_id"), utf8(F.col(text)).alias("text")).mapInArrow(run, f"doc_id {kind}, fp bigint, wide binary")


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """Position of each code in Gray order."""
    rank = codes.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class GrayIndex:
    """Codes in Gray order under levels of ``FANOUT``-wide nodes.

    A node keeps the bits that all codes below it share and its ancestors don't yet; a
    search adds up the differences on those bits on its way down and drops a whole group
    once they exceed the radius.
    """

    def __init__(self, codes: np.ndarray) -> None:
        self.order = np.argsort(gray_rank(codes), kind="stable")
        self.codes = codes[self.order]
        value, shared = self.codes, np.full(len(codes), ~np.uint64(0))
        levels = [(value, shared)]
        while len(value) > 1:
            at = np.arange(0, len(value), FANOUT)
            ones, any_, common = np.bitwise_and.reduceat(value, at), np.bitwise_or.reduceat(value, at), np.bitwise_and.reduceat(shared, at)
            shared, value = common & ~(ones ^ any_), ones
            levels.append((value, shared))
        self.levels = []
        for k, (value, shared) in enumerate(levels):
            above = levels[k + 1][1][np.arange(len(value)) // FANOUT] if k + 1 < len(levels) else np.uint64(0)
            self.levels.append((value, shared & ~above))

    def groups(self, radius: int, linked=None) -> np.ndarray:
        """For each code, in Gray order, the first position its group reaches by links within ``radius`` bits.

        ``linked(left, right)`` may refuse links between positions of the given codes. What
        is already in one group with a query isn't searched again, so that a large group
        of near copies costs little more than its size.
        """
        n = len(self.codes)
        label = np.arange(n)
        for start in range(0, n, _QUERIES):
            query = np.arange(start, min(start + _QUERIES, n))
            node, spent = np.zeros(len(query), np.int64), np.zeros(len(query), np.uint8)
            low, high = [label], [label]
            while len(low[-1]) > 1:
                at = np.arange(0, len(low[-1]), FANOUT)
                low.append(np.minimum.reduceat(low[-1], at))
                high.append(np.maximum.reduceat(high[-1], at))
            for depth in range(len(self.levels) - 1, -1, -1):
                value, mask = self.levels[depth]
                spent = spent + np.bitwise_count((self.codes[query] ^ value[node]) & mask[node])
                joined = (low[depth][node] == label[query]) & (high[depth][node] == label[query])
                near = (spent <= radius) & ~joined & ((node + 1) * FANOUT**depth > query)
                query, node, spent = query[near], node[near], spent[near]
                if depth:
                    query, spent = np.repeat(query, FANOUT), np.repeat(spent, FANOUT)
                    node = (node[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                    real = node < len(self.levels[depth - 1][0])
                    query, node, spent = query[real], node[real], spent[real]
            if linked is not None:
                good = np.zeros(len(query), bool)
                for k in range(0, len(query), _PAIRS):
                    good[k : k + _PAIRS] = linked(self.order[query[k : k + _PAIRS]], self.order[node[k : k + _PAIRS]])
                query, node = query[good], node[good]
            label = local_roots(n, query, node, label)
        return label


def _shard_keys(count: int, radius: int, shard_rows: int) -> list:
    """Keys of a fingerprint such that two within ``radius`` bits share one: they agree on ``g`` of ``radius + g`` blocks of bits.

    One block is enough until its values would leave shards of more than ``shard_rows``;
    then two or three must agree. A single block gives only as many leading bits as needed.
    """
    need = max(0, math.ceil(math.log2(max(1, count) / shard_rows)))
    for agree in (1, 2, 3):
        edges = np.linspace(0, 64, radius + agree + 1).astype(int)
        if agree * int(np.diff(edges).min()) >= need or agree == 3:
            break
    keys = []
    for k, chosen in enumerate(combinations(range(radius + agree), agree)):
        bits = []
        for block in chosen:
            high, size = int(edges[block + 1]), int(edges[block + 1] - edges[block])
            used = min(need, size) if agree == 1 else size
            bits.append(F.shiftrightunsigned("fp", high - used).bitwiseAND((1 << used) - 1))
        keys.append(F.struct(F.lit(k).alias("block"), F.xxhash64(*bits).alias("lead")))
    return keys


def near_groups(
    docs: DataFrame, radius: int = 2, width: int = 3, seed: int = 42, shard_rows: int = 1024, confirm: tuple[int, int] | None = None,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, fp, wide, component_id)``: documents linked by fingerprints within ``radius`` bits.

    Equal fingerprints collapse before the search, so copies cost one row. Fingerprints
    within the radius agree on a block of bits (see :func:`_shard_keys`); a shard holds
    those that agree there and searches itself with a :class:`GrayIndex`. It returns a
    spanning forest, not its pairs, and the forests are joined by :func:`components`.
    All links are found.

    With ``confirm = (words, bits)`` the fingerprint is taken over distinct shingles, and a
    link also needs a longer fingerprint (512 bits, over shingles of ``words`` words,
    repeats included) within ``bits`` bits.

    A text of fewer than ``width`` words is one shingle; null, empty or blank texts have
    fingerprint 0, linked like any other. Repeated rows link to each other; rows with a
    null id get the component of their fingerprint. Other columns are ignored.
    """
    rows = stored(fingerprints(docs, width, seed, confirm[0] if confirm else None, doc_id, text))
    distinct = stored(rows.groupBy("fp", "wide").agg(F.min("doc_id").alias("first")))
    roots = components(gray_links(distinct, radius, shard_rows, confirm))
    named = distinct.join(roots, distinct["first"] == roots["node"], "left").select("fp", "wide", F.coalesce("component", "first").alias("component_id"))
    return rows.join(named, ["fp", "wide"]).select("doc_id", "fp", "wide", "component_id")


def gray_links(distinct: DataFrame, radius: int, shard_rows: int = 1024, confirm: tuple[int, int] | None = None) -> DataFrame:
    """``(a, b)``: spanning forests of the stored ``(fp, wide, first)`` by links within ``radius`` bits, see :func:`near_groups`."""
    kind = distinct.schema["first"].dataType.simpleString()
    keys = _shard_keys(distinct.count(), radius, shard_rows)

    def search(shard: pa.Table) -> pa.Table:
        first, codes = shard.column("first").combine_chunks(), shard.column("fp").to_numpy().view(np.uint64)
        linked = None
        if confirm:
            wide = np.frombuffer(b"".join(shard.column("wide").to_pylist()), np.uint64).reshape(len(codes), -1)
            linked = lambda i, j: np.bitwise_count(wide[i] ^ wide[j]).sum(1, dtype=np.int64) <= confirm[1]
        index = GrayIndex(codes)
        label = index.groups(radius, linked)
        child = np.flatnonzero(label != np.arange(len(codes)))
        return pa.table({"a": first.take(pa.array(index.order[child])), "b": first.take(pa.array(index.order[label[child]]))})

    return (
        distinct.where("first is not null").select("fp", "wide", "first", F.explode(F.array(*keys)).alias("key")).select("fp", "wide", "first", "key.*")
        .groupBy("block", "lead").applyInArrow(search, f"a {kind}, b {kind}")
    )


def fp_hex(fp):
    """A signed 64-bit fingerprint as 16 lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def deduplicate(docs: DataFrame, shingle: int = 5, share: tuple[int, int] = (4, 5), doc_id: str = "doc_id", **options) -> DataFrame:
    """One document of each group of near copies: the one with the smallest id.

    Near copies share ``share`` or more of their different shingles of ``shingle`` words
    (see :func:`lakestrata.llm.near_texts.near_texts`). Rows with a null id stay, and so do
    all rows that share the smallest id of a group.
    """
    from lakestrata.llm.near_texts import near_texts  # which builds on this module

    groups = near_texts(docs, width=shingle, share=share, doc_id=doc_id, **options)
    mark = spare(docs, "gone")
    gone = groups.where("doc_id <> component_id").select(F.col("doc_id").alias(mark)).distinct()
    return docs.join(gone, docs[doc_id] == gone[mark], "left_anti")
