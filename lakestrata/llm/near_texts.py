"""Near copies by the exact Jaccard similarity of distinct word shingles; SimHash groups and MinHash bands say where to look."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from lakestrata.llm.common import give_back, mix64, shingle_hashes, stored, utf8
from lakestrata.llm.components import components
from lakestrata.llm.simhash import gray_links, majority

#: A pair at the bound of 0.8 shares none of 40 bands of 5 minima in 13 of 100 million cases, more similar ones less often.
BANDS, MINIMA = 40, 5
_RNG = np.random.default_rng(5)
_XOR = _RNG.integers(0, 1 << 64, BANDS * MINIMA, dtype=np.uint64)
_ODD = _RNG.integers(0, 1 << 64, BANDS * MINIMA, dtype=np.uint64) | np.uint64(1)
_STEP = 1 << 12  # shingles of a text that are permuted at a time
_FLAT = 1 << 20  # shingles that are looked up at a time
_BINS = 1024  # bits of a parity map


def shingle_set(text: bytes, width: int, seed: int) -> np.ndarray:
    """The different shingles of a text with A-Z in lower case, by hash and in order."""
    return np.unique(shingle_hashes(text.lower().split(), width, seed))


def bands(shingles: np.ndarray) -> np.ndarray:
    """A key for each band of minima; one key of its own for no shingles."""
    if not len(shingles):
        return np.zeros(1, np.int64)
    least = np.full(BANDS * MINIMA, ~np.uint64(0))
    for k in range(0, len(shingles), _STEP):
        least = np.minimum(least, ((shingles[k : k + _STEP, None] ^ _XOR) * _ODD).min(0))
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for minima in least.reshape(BANDS, MINIMA).T:
        key = mix64(key ^ minima) * np.uint64(0x9E3779B97F4A7C15)
    return key.view(np.int64)


def links(sets: list[np.ndarray], share: tuple[int, int]) -> np.ndarray:
    """For each of some sorted sets the first one it reaches by links of a Jaccard similarity of ``share`` or more.

    Two sets of ``s`` elements in all differ in at most ``s * (q - p) / (q + p)`` of them if
    their similarity is ``p / q``. The parities of their elements in ``_BINS`` bins can't
    differ in more bins than that, which parts most pairs; the others are counted. Pairs
    that are already joined aren't looked at.
    """
    p, q = share
    n, size = len(sets), np.array([len(s) for s in sets])
    odd = np.array([np.packbits(np.bincount((s % np.uint64(_BINS)).astype(np.int64), minlength=_BINS).astype(np.uint8) & 1).view(np.uint64) for s in sets])
    label = np.arange(n)
    for i in range(n - 1):
        rest = np.flatnonzero(label[i + 1 :] != label[i]) + i + 1
        bound = (size[i] + size[rest]) * (q - p)
        rest = rest[(np.abs(size[rest] - size[i]) * (q + p) <= bound)]
        bound = (size[i] + size[rest]) * (q - p)
        rest = rest[np.bitwise_count(odd[rest] ^ odd[i]).sum(1, dtype=np.int64) * (q + p) <= bound]
        part = np.cumsum(size[rest]) // _FLAT
        for k in np.unique(part).tolist():
            some = rest[part == k]
            flat = np.concatenate([sets[j] for j in some.tolist()])
            at = np.searchsorted(sets[i], flat)
            equal = sets[i][np.minimum(at, size[i] - 1)] == flat if size[i] else np.zeros(len(flat), bool)
            upto = np.append(0, np.cumsum(equal))
            stop = np.cumsum(size[some])
            both = upto[stop] - upto[stop - size[some]]
            joined = np.unique(label[some[both * q >= p * (size[i] + size[some] - both)]])
            if len(joined):
                joined = np.append(joined, label[i])
                label[np.isin(label, joined)] = joined.min()
    return label


def near_texts(
    docs: DataFrame, width: int = 5, share: tuple[int, int] = (4, 5), seed: int = 42, part_rows: int = 4096, part_bytes: int = 16 << 20,
    radius: int = 3, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """``(doc_id, component_id)``: documents linked by a Jaccard similarity of ``share`` or more over different shingles of ``width`` words.

    Texts with the same shingles are one. Those whose SimHash fingerprints over the
    different shingles lie within ``radius`` bits are a unit, found in Gray order by
    :func:`lakestrata.llm.simhash.gray_links`. A pair at the bound may lie further apart
    (10 bits of 64 on average at 0.8), so units that share a band of MinHash minima hang
    on the smallest id there as well; in the components this makes, every pair that isn't joined
    yet is decided on the shingles themselves (64-bit hashes), so no link is made below
    the bound. A component above ``part_rows`` texts or ``part_bytes`` of hashes is cut
    to parts, and every two parts meet in a task of their own.

    A text of fewer than ``width`` words is one shingle; null, empty or blank texts have
    none and link to each other. Rows with a null id get the component of their text.
    Other columns are ignored.
    """
    kind = docs.schema[doc_id].dataType.simpleString()
    texts = docs.select(F.col(doc_id).alias("doc_id"), utf8(F.col(text)).alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            sets = [shingle_set(t.as_py(), width, seed) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()), pa.array([len(s) for s in sets], pa.int64()),
                pa.array([majority(s) for s in sets], pa.int64()), pa.array([bands(s) for s in sets], pa.list_(pa.int64())),
            ], ["doc_id", "digest", "n", "fp", "bands"])

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            sets = [shingle_set(t.as_py(), width, seed).tobytes() for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([xxhash.xxh3_128_digest(s) for s in sets], pa.binary()), pa.array(sets, pa.binary())], ["first", "digest", "shingles"])

    def search(tile: pa.Table) -> pa.Table:
        first = tile.column("first").combine_chunks()
        label = links([np.frombuffer(s, np.uint64) for s in tile.column("shingles").to_pylist()], share)
        child = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"a": first.take(pa.array(child)), "b": first.take(pa.array(label[child]))})

    rows = stored(texts.mapInArrow(sketch, f"doc_id {kind}, digest binary, n bigint, fp bigint, bands array<bigint>"))
    distinct = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.min("n").alias("n"), F.min("fp").alias("fp"))
    prints = stored(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("first")).withColumn("wide", F.lit(b"")))
    close = components(gray_links(prints, radius))
    units = stored(prints.join(close, prints["first"] == close["node"], "left").select("fp", F.coalesce("component", "first").alias("unit")))
    met = rows.where("doc_id is not null").join(units, "fp").select("unit", F.explode("bands").alias("band"))
    low = met.groupBy("band").agg(F.min("unit").alias("low"), F.max("unit").alias("high")).where("low <> high").select("band", "low")
    loose = components(met.join(low, "band").where("unit <> low").select(F.col("unit").alias("a"), F.col("low").alias("b")))
    placed = units.join(loose, units["unit"] == loose["node"], "left").select("fp", F.coalesce("component", "unit").alias("component"))
    members = stored(distinct.where("first is not null").join(placed, "fp").select("digest", "first", "n", "component"))
    sizes = (
        members.groupBy("component").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("hashes")).where("texts > 1")
        .select("component", F.greatest(F.ceil(F.col("texts") / part_rows), F.ceil(F.col("hashes") * 8 / part_bytes)).alias("parts"))
    )
    open_ = members.join(sizes, "component")
    wanted = open_.select(F.col("first").alias("doc_id")).distinct()
    sets = texts.join(wanted, "doc_id", "left_semi").mapInArrow(expand, f"first {kind}, digest binary, shingles binary").dropDuplicates(["digest"])
    part = F.pmod(F.xxhash64("digest"), F.col("parts"))
    others = F.when(F.col("parts") == 1, F.array(F.lit(0).cast("bigint"))).otherwise(F.array_remove(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1), part))
    tiles = (
        open_.select("component", "digest", "first", part.alias("mine"), F.explode(others).alias("other"))
        .select("component", "digest", "first", F.least("mine", "other").alias("low"), F.greatest("mine", "other").alias("high"))
        .join(sets.select("digest", "shingles"), "digest").select("component", "low", "high", "first", "shingles")
    )
    roots = components(tiles.groupBy("component", "low", "high").applyInArrow(search, f"a {kind}, b {kind}"))
    named = distinct.join(roots, distinct["first"] == roots["node"], "left").select("digest", F.coalesce("component", "first").alias("component_id"))
    return rows.join(named, "digest").select("doc_id", "component_id")
