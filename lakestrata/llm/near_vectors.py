"""Near-duplicate embeddings by int8 tile products with error bounds, verified in double precision."""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.llm.common import local_roots, stored
from lakestrata.llm.components import components

MAX_CELLS = 512  # cells of the sphere; what is sent to tasks has this many rows, squared for pairs of cells
SLAB_TILES = 8  # tiles of a stored row at most
SLAB_BYTES = 4 << 20  # of the vectors in a stored row at most
HELD, SPREAD = 4, 8  # slabs of a partition at most, a task sees two; partitions wanted before they hold more than one
_PART = 512  # about as many vectors are a neighbourhood within a slab
_ROWS, _COLUMNS = 256, 2048  # of a tile multiplied at a time
_PAIRS = 1 << 20  # links gathered before they are joined up
_SLACK = 1e-6  # of angles, for rounding


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in double precision, whatever their magnitude."""
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(1, keepdims=True))


def quantised(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, scale and error (length of what the codes miss) of unit vectors."""
    scale = np.abs(unit).max(1) / 127
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    return codes, scale, np.sqrt(((unit - codes * scale[:, None]) ** 2).sum(1)) + 1e-12


class Slab(NamedTuple):
    """Unit vectors and their neighbourhoods, which follow one another."""

    unit: np.ndarray
    about: np.ndarray  # what the int8 codes stand for, in single precision
    error: np.ndarray  # how far that is from the unit vectors
    ends: np.ndarray  # neighbourhood k holds the vectors from ends[k] to ends[k + 1]
    centers: np.ndarray
    radii: np.ndarray  # the largest angle to the center


def slab_of(rows: np.ndarray, ends: np.ndarray) -> Slab:
    unit = unit_rows(rows.astype(np.float64))
    codes, scale, error = quantised(unit)
    sums = np.add.reduceat(unit, ends[:-1])
    # vectors that cancel out have any center
    centers = np.where(np.abs(sums).max(1, keepdims=True) > 1e-9, sums, unit[ends[:-1]])
    centers = unit_rows(centers)
    angles = np.arccos(np.clip((unit * np.repeat(centers, np.diff(ends), 0)).sum(1), -1, 1))
    return Slab(unit, (codes * scale[:, None]).astype(np.float32), error, ends, centers, np.maximum.reduceat(angles, ends[:-1]))


def neighbourhoods(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order in which rows near each other follow one another, and where their neighbourhoods end."""
    unit = unit_rows(rows.astype(np.float64))
    pivots = unit[np.linspace(0, len(unit) - 1, -(-len(unit) // _PART)).astype(np.int64)]
    nearest = (unit @ pivots.T).argmax(1)
    sizes = np.bincount(nearest)
    return np.argsort(nearest, kind="stable"), np.cumsum([0, *sizes[sizes > 0]])


def _stretches(near: np.ndarray, ends: np.ndarray) -> Iterator[tuple[int, int]]:
    """First and last bounds of the neighbourhoods picked, those that follow one another as one."""
    edges = np.flatnonzero(np.diff(near.astype(np.int8), prepend=0, append=0))
    for low, high in zip(edges[::2], edges[1::2]):
        yield int(ends[low]), int(ends[high])


def tile_links(a: Slab, b: Slab, bound: float, most_alone: float = 0.05) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of rows of two slabs with a cosine of ``bound`` or more, by tiles.

    With x = sx·cx + ex the product x·y differs from sx·sy·(cx·cy) by at most
    |ex| + |ey| + |ex||ey|, which two more columns of the single-precision product add; a
    slack covers its rounding. Only pairs that the bound leaves open either way are
    multiplied again in full, one by one up to a share of ``most_alone`` of a tile.
    Neighbourhoods whose angle, less both radii, exceeds the angle of ``bound`` are not
    multiplied.
    """
    slack = 1e-5 + 2e-7 * a.unit.shape[1]
    left = np.column_stack([a.about, a.error, np.ones(len(a.about))]).astype(np.float32)
    right = np.column_stack([b.about, 1 + b.error, b.error]).astype(np.float32)
    apart = np.arccos(np.clip(a.centers @ b.centers.T, -1, 1)) - a.radii[:, None] - b.radii
    near = apart <= math.acos(max(-1.0, min(1.0, bound))) + _SLACK
    product, least = np.empty(_ROWS * _COLUMNS, np.float32), np.float32(bound - slack)
    for k in range(len(near)):
        for start in range(a.ends[k], a.ends[k + 1], _ROWS):
            part = left[start : min(start + _ROWS, a.ends[k + 1])]
            for low, high in _stretches(near[k], b.ends):
                for at in range(low, high, _COLUMNS):
                    other = right[at : min(at + _COLUMNS, high)]
                    most = np.matmul(part, other.T, out=product[: len(part) * len(other)].reshape(len(part), len(other)))
                    open_ = most >= least
                    if not open_.any():
                        continue
                    i, j = np.nonzero(open_)
                    i, j, most = start + i, at + j, most[i, j]
                    error = a.error[i] * (1 + b.error[j]) + b.error[j]
                    keep = most - 2 * error >= bound + slack
                    rest = np.flatnonzero(~keep)
                    if len(rest) > most_alone * len(part) * len(other):
                        # so many that the product of all is cheaper; it decides but where its own rounding might
                        full = (a.unit[start : start + len(part)] @ b.unit[at : at + len(other)].T)[i[rest] - start, j[rest] - at]
                        keep[rest] = full >= bound
                        rest = rest[np.abs(full - bound) < 1e-9]
                    for n in range(0, len(rest), 1 << 12):
                        some = rest[n : n + (1 << 12)]
                        keep[some] = np.einsum("ij,ij->i", a.unit[i[some]], b.unit[j[some]]) >= bound
                    yield i[keep], j[keep]


def _usable(vector: Column) -> Column:
    return (
        vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )


def _hash(vector: str, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), F.col(vector))


def near_vectors(
    rows: DataFrame, bound: float = 0.95, tile_rows: int = 2048, vec_id: str = "vec_id", embedding: str = "embedding", sample_rows: int = MAX_CELLS,
) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)``: vectors linked by a cosine of ``bound`` or more in double precision.

    Equal vectors collapse first and are counted back, so a vector that a third of all rows
    hold is compared once. The rest is cut into cells around at most ``sample_rows`` sampled
    vectors (never more than ``MAX_CELLS``), and cells that lie near each other into slabs of
    about ``SLAB_TILES`` tiles of ``tile_rows``, each stored once as one row. Two slabs without
    cells, and in them two neighbourhoods, whose angle, less both radii, can hold a link are
    not compared; all others are multiplied by tiles as int8 with rigorous error bounds, see
    :func:`tile_links`. Nothing is missed: the sample decides the cost only. A task reads the
    stored slabs of two partitions, so no vector is copied for those that it meets, and
    returns how many links each vector has and a spanning forest, never its pairs.

    On vectors spread evenly the cells exclude little and the work is every tile against
    every other, as exactness then demands; clustered vectors keep to their neighbourhood.

    Vectors that are null, empty, zero or hold null or non-finite components have no links,
    also not to their copies. Vectors of different lengths never link. Rows with equal ids
    or a null id are rows of their own; ids stand for components by their smallest.
    """
    kind = rows.schema[vec_id].dataType.simpleString()
    # single precision stays as it is: cosines are those of the same numbers in double precision
    real = "float" if rows.schema[embedding].dataType.simpleString() == "array<float>" else "double"
    rows = rows.select(F.col(vec_id).alias("vec_id"), F.col(embedding).cast(f"array<{real}>").alias("v"))
    good = rows.where(_usable(F.col("v")))
    # -0.0 and 0.0 are one value.
    plain = F.transform("v", lambda x: x + F.lit(0.0).cast(real))
    good = good.select("vec_id", plain.alias("v"))
    distinct = stored(good.groupBy("v").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("copies")).withColumn("width", F.size("v")))
    # a hash that no two of the vectors share stands for the vector
    for seed in itertools.count():
        keyed = distinct.withColumn("key", _hash("v", seed))
        if not keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
            distinct = keyed
            break
    widths = [(r["width"], r["n"]) for r in distinct.groupBy("width").agg(F.count(F.lit(1)).alias("n")).limit(1001).collect()]
    if len(widths) > 1000:
        raise ValueError("more than 1000 different lengths of vectors")
    edges = None
    for width, n in sorted(widths):
        found = _linked(distinct.where(F.col("width") == width), n, width, bound, tile_rows, min(sample_rows, MAX_CELLS), kind, real)
        edges = found if edges is None else edges.unionByName(found)
    if edges is None:
        return rows.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    edges = stored(edges)
    counts = edges.where("links > 0").groupBy("key").agg(F.sum("links").alias("links"))
    roots = components(edges.where("other is not null").select("first", "other"), "first", "other")
    named = (
        distinct.join(counts, "key", "left").join(roots, distinct["first"] == roots["node"], "left")
        .select("key", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "first").alias("component_id"))
    )
    linked = good.select("vec_id", _hash("v", seed).alias("key")).join(named, "key").select("vec_id", "n_links", "component_id")
    bad = rows.where(~F.coalesce(_usable(F.col("v")), F.lit(False))).select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(bad).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def _chain(between: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The cells used, each followed by the one nearest to it of those left."""
    left, out = used.copy(), [int(np.flatnonzero(used)[0])]
    left[out[0]] = False
    while left.any():
        out.append(int(np.where(left, between[out[-1]], np.inf).argmin()))
        left[out[-1]] = False
    return np.array(out)


def _linked(distinct: DataFrame, n: int, width: int, bound: float, tile_rows: int, cells: int, kind: str, real: str) -> DataFrame:
    """Link counts ``(key, links)`` and forest edges ``(first, other)`` of distinct vectors of one length."""
    cells = max(1, min(cells, n // tile_rows))
    pivots = unit_rows(np.array([r["v"] for r in distinct.orderBy("key").select("v").limit(cells).collect()], np.float64))
    of_vector = np.float32 if real == "float" else np.float64

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy().reshape(len(column), width)

    def nearest(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The cell of each vector, and the angle to its pivot."""
        found = [(np.zeros(0, np.int64), np.zeros(0))]
        for at in range(0, len(column), 4096):
            cosine = unit_rows(matrix(column.slice(at, 4096)).astype(np.float64)) @ pivots.T
            cell = cosine.argmax(1)
            found.append((cell, np.arccos(np.clip(cosine[np.arange(len(cell)), cell], -1, 1))))
        return tuple(map(np.concatenate, zip(*found)))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, reach = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
        for batch in batches:
            cell, angle = nearest(batch.column(0))
            count += np.bincount(cell, minlength=len(pivots))
            np.maximum.at(reach, cell, angle)
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(count[used]), pa.array(reach[used])], ["cell", "n", "r"])

    size, reach = np.zeros(len(pivots), np.int64), np.zeros(len(pivots))
    for r in distinct.select("v").mapInArrow(measure, "cell int, n bigint, r double").groupBy("cell").agg(F.sum("n").alias("n"), F.max("r").alias("r")).collect():
        size[r["cell"]], reach[r["cell"]] = r["n"], r["r"]
    between, theta = np.arccos(np.clip(pivots @ pivots.T, -1, 1)), math.acos(max(-1.0, min(1.0, bound))) + _SLACK
    near = (between - reach[:, None] - reach <= theta) & (size > 0) & (size[:, None] > 0)  # cells that may link
    # along a chain of the cells each vector has a place, by its key within its cell; places are cut into slabs
    chain = _chain(between, size > 0)
    begin = np.zeros(len(pivots), np.int64)
    begin[chain] = np.cumsum(size[chain]) - size[chain]
    per = max(1, min(SLAB_TILES * tile_rows, SLAB_BYTES // (width * np.dtype(of_vector).itemsize)))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, _ = nearest(batch.column(0))
            share = (batch.column(3).to_numpy().view(np.uint64) >> np.uint64(11)) / float(1 << 53)
            slab = (begin[cell] + np.minimum((share * size[cell]).astype(np.int64), size[cell] - 1)) // per
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(slab.astype(np.int32))], ["v", "first", "copies", "key", "slab"])

    names = ["slab", "cells", "near", "ends", "v", "first", "copies", "key"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        group = pa.Table.from_batches(batches).combine_chunks()
        slabs = group["slab"].to_numpy()
        for slab in np.unique(slabs).tolist():
            some = group.filter(pa.array(slabs == slab)).sort_by("key").combine_chunks()
            order, ends = neighbourhoods(matrix(some["v"].chunk(0)))
            some = some.take(pa.array(order)).combine_chunks()
            own = (size > 0) & (begin < (slab + 1) * per) & (begin + size > slab * per)
            row = [
                slab, np.flatnonzero(own), np.flatnonzero(near[own].any(0)), ends, matrix(some["v"].chunk(0)).tobytes(),
                some["first"].chunk(0), some["copies"].to_numpy(), some["key"].to_numpy(),
            ]
            kinds = [pa.int32(), *[pa.list_(pa.int32())] * 3, pa.binary(), None, *[pa.list_(pa.int64())] * 2]
            lists = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) if t is None else pa.array([x], t) for x, t in zip(row, kinds)]
            yield pa.RecordBatch.from_arrays(lists, names)

    slabs = -(-n // per)
    held = min(HELD, -(-slabs // SPREAD))
    dealt = distinct.select("v", "first", "copies", "key").mapInArrow(deal, f"v array<{real}>, first {kind}, copies bigint, key bigint, slab int")
    kinds = ["int", *["array<int>"] * 3, "binary", f"array<{kind}>", *["array<bigint>"] * 2]
    schema = ", ".join(f"{name} {t}" for name, t in zip(names, kinds))
    packed = stored(dealt.repartitionById(-(-slabs // held), F.floor(F.col("slab") / held).cast("int")).mapInArrow(pack, schema))
    one, two = (packed.select(*(F.col(name).alias(side + name) for name in names)) for side in ("a_", "b_"))
    # two slabs meet once, half of them in each order, which keeps tasks even
    once = F.when((F.col("a_slab") + F.col("b_slab")) % 2 == 0, F.col("a_slab") <= F.col("b_slab")).otherwise(F.col("a_slab") > F.col("b_slab"))
    met = one.join(two.hint("shuffle_replicate_nl"), once & F.arrays_overlap("a_near", "b_cells"))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple] = {}  # slab → where its vectors begin, the vectors, their copies
        ids, keys, total = [], [], 0
        links, label = np.zeros(0, np.int64), np.zeros(0, np.int64)

        def side(batch: pa.RecordBatch, i: int, prefix: str) -> tuple:
            nonlocal total, links, label
            get = lambda name: batch.column(prefix + name)[i]
            slab = get("slab").as_py()
            if slab not in seen:
                rows = np.frombuffer(get("v").as_py(), of_vector).reshape(-1, width)
                seen[slab] = total, slab_of(rows, get("ends").values.to_numpy().astype(np.int64)), get("copies").values.to_numpy().copy()
                ids.append(get("first").values.take(pa.array(np.arange(len(rows)))))  # a slice would keep the batch
                keys.append(get("key").values.to_numpy().copy())
                links, label = np.append(links, np.zeros(len(rows), np.int64)), np.append(label, np.arange(total, total + len(rows)))
                total += len(rows)
            return seen[slab]

        def join_up(found: list[tuple[np.ndarray, np.ndarray]]) -> None:
            nonlocal label
            if found:
                label = local_roots(total, *map(np.concatenate, zip(*found)), label)

        for batch in batches:
            for row in range(batch.num_rows):
                (at, a, ca), (bt, b, cb) = side(batch, row, "a_"), side(batch, row, "b_")
                found, pairs = [], 0
                for i, j in tile_links(a, b, bound):
                    if at == bt:
                        i, j = i[i != j], j[i != j]
                    links[at : at + len(ca)] += np.bincount(i, cb[j], len(ca)).astype(np.int64)
                    if at != bt:
                        links[bt : bt + len(cb)] += np.bincount(j, ca[i], len(cb)).astype(np.int64)
                    found.append((at + i, bt + j))
                    pairs += len(i)
                    if pairs >= _PAIRS:
                        join_up(found)
                        found, pairs = [], 0
                join_up(found)
        if not total:
            return
        rows = np.flatnonzero((links > 0) | (label != np.arange(total)))
        first, key = pa.concat_arrays(ids), np.concatenate(keys)
        for at in range(0, len(rows), 1 << 15):
            some = rows[at : at + (1 << 15)]
            other = first.take(pa.array(label[some], mask=label[some] == some))
            yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(links[some]), first.take(pa.array(some)), other], ["key", "links", "first", "other"])

    return met.mapInArrow(multiply, f"key bigint, links bigint, first {kind}, other {kind}")
