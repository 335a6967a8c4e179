"""Exact top-k search by inner product: M-trees of paged metric nodes, searched best first."""

from __future__ import annotations

import heapq
import io
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from lakestrata.llm.common import stored

PAGE = 512  # vectors of a leaf page
FAN = 32  # children of an inner page at most
SAMPLE_BYTES = 16 << 20  # of the sampled pivots that place vectors in cells, all together
_EXACT = 1 << 53  # sums of products below this are exact in double precision
_LONG = (1 << 63) - 1


class Tree(NamedTuple):
    """Pages of entries: children with center and covering radius, or vectors where the page is a leaf. Page 0 is the root."""

    center: np.ndarray  # of the root
    radius: np.ndarray  # of the root, one number
    first: np.ndarray  # entries of page i are first[i] to first[i + 1]
    leaf: np.ndarray  # whether a page holds vectors
    entries: np.ndarray  # centers and vectors, a row each
    radii: np.ndarray  # covering radius of each child; zero for vectors
    away: np.ndarray  # distance of each entry to the center of its page
    child: np.ndarray  # the page of a child, the id of a vector

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **self._asdict())
        return out.getvalue()


def tree_of(data: bytes) -> Tree:
    held = np.load(io.BytesIO(data), allow_pickle=False)
    return Tree(*(held[name] for name in Tree._fields))


def distances(rows: np.ndarray, center: np.ndarray) -> np.ndarray:
    return np.sqrt(((rows - center) ** 2).sum(1))


def build(rows: np.ndarray, ids: np.ndarray) -> Tree:
    """Load a tree top down: rows are dealt to the nearest of up to ``FAN`` of them, far from each other, until a page holds them."""
    pages: list[tuple] = []

    def page(some: np.ndarray, middle: np.ndarray) -> int:
        own, number = rows[some], len(pages)
        pages.append(())
        if len(some) <= PAGE:
            pages[number] = True, own, np.zeros(len(some)), distances(own, middle), ids[some]
            return number
        # farthest-first pivots out of evenly spaced rows
        pool = own[np.linspace(0, len(own) - 1, min(len(own), 16 * FAN)).astype(np.int64)]
        wanted, pivots = min(FAN, -(-len(some) // (PAGE // 2))), [pool[0]]
        gap = distances(pool, pool[0])
        while len(pivots) < wanted and gap.max() > 0:
            pivots.append(pool[gap.argmax()])
            gap = np.minimum(gap, distances(pool, pivots[-1]))
        grid = np.array(pivots)
        nearest = ((grid * grid).sum(1) - 2 * (own @ grid.T)).argmin(1)
        if len(np.unique(nearest)) == 1:  # rows that nothing tells apart
            nearest = np.arange(len(own)) * wanted // len(own)
        groups = [np.flatnonzero(nearest == k) for k in np.unique(nearest)]
        centers = np.array([own[g].mean(0) for g in groups])
        radii = np.array([distances(own[g], c).max() for g, c in zip(groups, centers)])
        children = np.array([page(some[g], c) for g, c in zip(groups, centers)], np.int64)
        pages[number] = False, centers, radii, distances(centers, middle), children
        return number

    with np.errstate(all="ignore"):
        center = rows.mean(0)
        page(np.arange(len(rows)), center)
        radius = distances(rows, center).max()
    leaf, entries, radii, away, child = zip(*pages)
    first = np.cumsum([0, *map(len, child)])
    return Tree(center, np.array(radius), first, np.array(leaf), np.concatenate(entries), np.concatenate(radii), np.concatenate(away), np.concatenate(child))


def bound(values: np.ndarray) -> np.ndarray:
    """Upper bounds; one that can't be told excludes nothing."""
    return np.where(np.isnan(values), np.inf, values)


def scores_of(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Whole-number inner products, exact however large; they end at the long's ends."""
    most = float(np.abs(rows).max(initial=0.0)) * float(np.abs(query).max(initial=0.0)) * max(1, len(query))
    if most < _EXACT:
        return (rows @ query).astype(np.int64)
    whole = [int(x) for x in query.tolist()]
    return np.array([max(-_LONG, min(_LONG, sum(int(a) * b for a, b in zip(row, whole)))) for row in rows.tolist()], np.int64)


def search(tree: Tree, query: np.ndarray, k: int, at_least: int | None = None) -> list[tuple[int, int]]:
    """The ``k`` best (score, id) under a tree, higher first, ties by the smaller id; scores below ``at_least`` may be left out.

    A node with center c and radius r holds no product above q·c + |q|·r. The queue has the
    nodes by that bound. A child whose stored distance to its page's center already rules
    it out, q·page + |q|·(distance + radius), is dropped without a product of its own;
    vectors of a leaf likewise.
    """
    best: list[tuple[int, int]] = []  # heap of (score, -id)
    floor = float("-inf") if at_least is None else float(at_least)
    with np.errstate(all="ignore"):
        length = float(np.sqrt(query @ query))
        # above the rounding error of all products and distances below
        margin = 1e-9 * (1.0 + length * (float(np.sqrt(tree.center @ tree.center)) + float(tree.radius)))
        margin = margin if np.isfinite(margin) else np.inf
        product = float(tree.center @ query)
        queue, turn = [(-float(bound(product + length * tree.radius)), 0, product, 0)], 1
        while queue:
            reach, _, product, page = heapq.heappop(queue)
            if -reach + margin < floor:
                break
            part = slice(int(tree.first[page]), int(tree.first[page + 1]))
            outer = bound(product + length * (tree.away[part] + tree.radii[part]))
            near = np.flatnonzero(outer + margin >= floor)
            if not len(near):
                continue
            rows, child = tree.entries[part], tree.child[part]
            if len(near) < len(rows):
                rows, child = rows[near], child[near]
            if not tree.leaf[page]:
                inner = rows @ query
                for number, p, b in zip(child.tolist(), inner.tolist(), bound(inner + length * tree.radii[part][near]).tolist()):
                    if b + margin >= floor:
                        heapq.heappush(queue, (-b, turn, p, number))
                        turn += 1
                continue
            scores = scores_of(rows, query)
            order = np.flatnonzero(scores >= floor)
            if len(order) > k:  # ties with the k-th stay, their ids decide
                order = order[scores[order] >= -np.partition(-scores[order], k - 1)[k - 1]]
            for i, score in zip(child[order].tolist(), scores[order].tolist()):
                if len(best) < k:
                    heapq.heappush(best, (score, -i))
                elif (score, -i) > best[0]:
                    heapq.heapreplace(best, (score, -i))
            if len(best) == k:
                floor = max(floor, float(best[0][0]))
    return [(s, -i) for s, i in sorted(best, reverse=True)]


def whole_numbers(vector: Column, scale: float) -> Column:
    """floor(``scale`` · x) of each component in double precision; null where the vector, a component or a non-finite one forbids it."""
    scaled = F.transform(vector, lambda x: x.cast("double") * F.lit(scale))
    usable = F.forall(scaled, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    # doubles of that size are whole; adding 0.0 makes -0.0 and 0.0 one value
    whole = F.transform(scaled, lambda y: F.when(F.abs(y) < float(1 << 60), F.floor(y).cast("double")).otherwise(y) + F.lit(0.0))
    return F.when(vector.isNotNull() & usable, whole)


def _matrix(column: pa.ChunkedArray | pa.Array, rows: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


class Cells(NamedTuple):
    """Where the vectors of one length lie."""

    pivots: np.ndarray
    reach: np.ndarray  # of each cell, from its pivot
    tiles: np.ndarray  # of each cell; none where it is empty

    def nearest(self, rows: np.ndarray) -> np.ndarray:
        with np.errstate(all="ignore"):
            return ((self.pivots * self.pivots).sum(1) - 2 * (rows @ self.pivots.T)).argmin(1)


class Index(NamedTuple):
    """Trees by (width, cell, tile), one stored row each, and the cells of each width."""

    trees: DataFrame
    cells: dict[int, Cells]


def build_index(vectors: DataFrame, tile_rows: int = 4096, sample_bytes: int = SAMPLE_BYTES) -> Index:
    """Index every row of ``vectors`` (``id bigint, v array<double>``).

    Vectors go to the nearest of sampled pivots, about one per ``tile_rows`` vectors and
    ``sample_bytes`` of them at most; the sample decides the cost only. A cell with more
    than ``tile_rows`` vectors is cut into tiles by a hash of the id, and each tile has a
    tree of its own, built in a task and stored as one row. Vectors of different lengths
    are indexed apart.
    """
    spark = vectors.sparkSession
    sized = vectors.select("id", "v", F.size("v").alias("width"))
    widths = {r["width"]: r["n"] for r in sized.groupBy("width").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = sample_bytes // max(1, len(widths))
    wanted = {w: min(-(-n // tile_rows), share // (8 * max(1, w))) for w, n in widths.items()}
    rates = spark.createDataFrame([(w, (m + 8 * m**0.5 + 8) / widths[w]) for w, m in wanted.items() if m], "width int, rate double")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(12), "id", "v"), 11) / float(1 << 53)
    drawn: dict[int, list] = {}
    for r in sized.join(F.broadcast(rates), "width").where(draw < F.col("rate")).select("width", "v", draw.alias("draw")).collect():
        drawn.setdefault(r["width"], []).append((r["draw"], r["v"]))
    # the origin is the pivot where none is drawn
    chosen = {w: [v for _, v in sorted(drawn.get(w, []))[: wanted[w]]] or [[0.0] * w] for w in widths}
    places = {w: Cells(np.array(rows, np.float64).reshape(len(rows), w), np.zeros(0), np.zeros(0)) for w, rows in chosen.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            width = batch.column(2).to_numpy()
            cell = np.zeros(len(width), np.int32)
            for w in np.unique(width).tolist():
                some = np.flatnonzero(width == w)
                for at in range(0, len(some) if w else 0, 1024):
                    part = some[at : at + 1024]
                    cell[part] = places[w].nearest(_matrix(batch.column(1).take(pa.array(part)), len(part)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["id", "v", "width", "cell"])

    placed = stored(sized.mapInArrow(place, "id bigint, v array<double>, width int, cell int"))
    tiles = {(r["width"], r["cell"]): -(-r["n"] // tile_rows) for r in placed.groupBy("width", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = spark.createDataFrame([(w, c, t) for (w, c), t in tiles.items()], "width int, cell int, tiles int")

    def plant(group: pa.Table) -> pa.Table:
        group = group.sort_by("id")
        w, cell = group["width"][0].as_py(), group["cell"][0].as_py()
        tree = build(_matrix(group["v"], group.num_rows), group["id"].to_numpy())
        with np.errstate(all="ignore"):
            reach = distances(tree.center[None], places[w].pivots[cell])[0] + tree.radius
        return pa.table({
            **{name: group[name].slice(0, 1) for name in ("width", "cell", "tile")},
            "reach": pa.array([float(bound(reach))]), "tree": pa.array([tree.to_bytes()], pa.binary()),
        })

    dealt = placed.join(F.broadcast(counts), ["width", "cell"]).withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int"))
    trees = stored(dealt.groupBy("width", "cell", "tile").applyInArrow(plant, "width int, cell int, tile int, reach double, tree binary"))
    cells = {w: Cells(c.pivots, np.zeros(len(c.pivots)), np.zeros(len(c.pivots), np.int64)) for w, c in places.items()}
    for r in trees.groupBy("width", "cell").agg(F.max("reach").alias("reach")).collect():
        cells[r["width"]].reach[r["cell"]] = r["reach"]
        cells[r["width"]].tiles[r["cell"]] = tiles[r["width"], r["cell"]]
    return Index(trees, cells)


def _searched(index: Index, asked: DataFrame, k: int, slice_rows: int) -> DataFrame:
    """``asked`` (name, v, width, cell, at_least) against all tiles of the cell named: ``(name, score, id)``, ``k`` best per tile."""
    load = {(r["width"], r["cell"]): -(-r["n"] // slice_rows) for r in asked.groupBy("width", "cell").agg(F.count(F.lit(1)).alias("n")).collect()}
    slices = asked.sparkSession.createDataFrame([(w, c, s) for (w, c), s in load.items()], "width int, cell int, slices int")
    # a cell that many queries ask is searched in several tasks, each with its share of them
    trees = index.trees.join(F.broadcast(slices), ["width", "cell"]).withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    tiles = index.trees.sparkSession.createDataFrame(
        [(w, c, t, load[w, c]) for w, held in index.cells.items() for c, t in enumerate(held.tiles.tolist()) if t and load.get((w, c))], "width int, cell int, tiles int, slices int"
    )
    sent = (
        asked.join(F.broadcast(tiles), ["width", "cell"]).withColumn("slice", F.pmod(F.xxhash64("name"), F.col("slices")).cast("int"))
        .withColumn("tile", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    )
    by = ("width", "cell", "tile", "slice")

    def ask(shelf: pa.Table, queries: pa.Table) -> pa.Table:
        names, scores, ids = [], [], []
        if shelf.num_rows and queries.num_rows:
            tree = tree_of(shelf.column("tree")[0].as_py())
            rows = _matrix(queries.column("v"), queries.num_rows)
            for name, row, least in zip(queries.column("name").to_pylist(), rows, queries.column("at_least").to_pylist()):
                for score, i in search(tree, row, k, least):
                    names.append(name)
                    scores.append(score)
                    ids.append(i)
        return pa.table({"name": pa.array(names, pa.int64()), "score": pa.array(scores, pa.int64()), "id": pa.array(ids, pa.int64())})

    return trees.select(*by, "tree").groupBy(*by).cogroup(sent.select(*by, "name", "v", "at_least").groupBy(*by)).applyInArrow(ask, "name bigint, score bigint, id bigint")


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of each name, by score, then smaller id; most go before the shuffle."""
    order = Window.partitionBy("name").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    rows: DataFrame, queries: Column, k: int = 5, scale: float = 256.0, vec_id: str = "vec_id", embedding: str = "embedding", tile_rows: int = 4096, slice_rows: int = 4096,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` highest whole-number inner products of every row that ``queries`` picks, against all rows.

    Components become floor(``scale`` · x); the score is the inner product of these, ties go
    to the smaller id, and a row never answers its own query. Copies of a vector score
    alike, so at most ``k + 1`` of them, with the smallest ids, enter the index, whatever
    number there is; equal queries are searched once. Every query first asks the cell it
    lies in; its ``k``-th score there rules out the cells whose pivot and radius
    can't reach it, and the others are asked with that score to beat. Nothing is missed.

    On vectors spread evenly in many dimensions hardly any cell is ruled out, and the work
    is every query against every tile, as exactness then demands; clustered vectors keep
    to their neighbourhood.

    Vectors that are null, hold null or non-finite components, or leave the range of doubles
    when scaled take no part, nor do rows without an id; vectors of different lengths never
    answer each other, and empty ones score 0 among themselves. Repeated rows count once.
    Rows of one id with different vectors are rows of their own; none answers another one of
    them with the very score that the query's own row has. Scores end at the ends of a long.
    Other columns are ignored; an empty table or no query gives an empty result.
    """
    kind = rows.schema[vec_id].dataType.simpleString()
    plain = rows.select(
        F.col(vec_id).cast("bigint").alias("id"), whole_numbers(F.col(embedding), scale).alias("v"), F.coalesce(queries, F.lit(False)).alias("asks")
    ).where("id is not null and v is not null")
    good = stored(plain.groupBy("id", "v").agg(F.max("asks").alias("asks")))
    copy = F.row_number().over(Window.partitionBy("v").orderBy("id"))
    index = build_index(good.select("id", "v", copy.alias("copy")).where(F.col("copy") <= k + 1).select("id", "v"), tile_rows)
    cells = index.cells
    asking = good.where("asks").select("id", "v")
    different = asking.select("v").distinct().select(F.monotonically_increasing_id().alias("name"), "v")

    def home(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                some = batch.slice(at, 1024)
                vectors = [np.array(v, np.float64) for v in some.column(1).to_pylist()]
                place = [int(cells[len(v)].nearest(v[None])[0]) for v in vectors]
                own = [int(scores_of(v[None], v)[0]) for v in vectors]
                yield pa.RecordBatch.from_arrays(
                    [*some.columns, pa.array([len(v) for v in vectors], pa.int32()), pa.array(place, pa.int32()), pa.nulls(len(own), pa.int64()), pa.array(own, pa.int64())],
                    ["name", "v", "width", "cell", "at_least", "own"],
                )

    asked = "name bigint, v array<double>, width int, cell int, at_least bigint"
    # the numbers of monotonically_increasing_id hold from here on, as they are stored
    at_home = stored(different.mapInArrow(home, asked + ", own bigint"))
    near = stored(_best(_searched(index, at_home, k + 1, slice_rows), k + 1).drop("rank"))
    bar = near.groupBy("name").agg(F.min("score").alias("bar"), F.count(F.lit(1)).alias("n")).where(F.col("n") > k)
    known = at_home.join(bar.select("name", "bar"), "name", "left").select("name", "v", "width", "cell", "bar")

    def elsewhere(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64)
                asks, told = [], []
                for j, (v, cell, least) in enumerate(zip(*(some.column(c).to_pylist() for c in (1, 3, 4)))):
                    held, row = cells[len(v)], np.array(v, np.float64)
                    with np.errstate(all="ignore"):
                        length = float(np.sqrt(row @ row))
                        margin = 1e-9 * (1.0 + length * (np.sqrt((held.pivots * held.pivots).sum(1)) + held.reach))
                        most = bound(held.pivots @ row + length * held.reach + margin)
                    open_ = (held.tiles > 0) & (most >= (-np.inf if least is None else least))
                    open_[cell] = False
                    told.append(np.flatnonzero(open_))
                    asks.append(np.full(len(told[-1]), j))
                take, there = pa.array(np.concatenate(asks)), pa.array(np.concatenate(told).astype(np.int32))
                yield pa.RecordBatch.from_arrays([*(some.column(c).take(take) for c in range(3)), there, some.column(4).take(take)], ["name", "v", "width", "cell", "at_least"])

    far = stored(known.mapInArrow(elsewhere, asked))
    best = _best(near.unionByName(_searched(index, far, k + 1, slice_rows)), k + 1).drop("rank")
    named = asking.join(at_home.select("name", "v", "own"), "v").select(F.col("id").alias("query_id"), "name", "own")
    answers = named.join(best, "name").where((F.col("query_id") != F.col("id")) | (F.col("score") != F.col("own")))
    order = Window.partitionBy("query_id", "name").orderBy(F.desc("score"), "id")
    return (
        answers.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        .select(F.col("query_id").cast(kind), "rank", F.col("id").cast(kind).alias("vec_id"), "score")
    )
