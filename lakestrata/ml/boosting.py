"""Multi-class boosted trees: one softmax model over binned features, grown from summed histograms."""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.functions import pandas_udf

from lakestrata.session import cut_lineage

# Task functions travel with their code, so executors need no copy of this module on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Gradients are summed as whole numbers of this part, so sums don't depend on the order of rows.
SCALE = 1 << 24


class Tree(NamedTuple):
    """A complete binary tree: the children of node i are 2i + 1 and 2i + 2. A node without a feature (-1) ends the way."""

    feature: np.ndarray
    cut: np.ndarray  # rows in a bin up to this one go left
    value: np.ndarray

    def places(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """The node of each row after ``levels`` steps from the root."""
        at = np.zeros(len(bins), np.int64)
        for _ in range(levels):
            feature = self.feature[at]
            inner = feature >= 0
            right = bins[np.arange(len(bins)), np.maximum(feature, 0)] > self.cut[at]
            at = np.where(inner, 2 * at + 1 + right, at)
        return at


class Trees(NamedTuple):
    """A fitted model: bin edges per feature, the classes' start scores, and per round one tree for each class."""

    edges: list[np.ndarray]
    base: np.ndarray
    rounds: list[list[Tree]]
    depth: int

    def bins(self, features: np.ndarray) -> np.ndarray:
        """The number of edges below each value."""
        if not self.edges:
            return np.zeros((len(features), 0), np.uint8)
        return np.stack([np.searchsorted(e, features[:, f], "left") for f, e in enumerate(self.edges)], 1).astype(np.uint8)

    def add_scores(self, scores: np.ndarray, bins: np.ndarray, first: int = 0) -> np.ndarray:
        for trees in self.rounds[first:]:
            for k, tree in enumerate(trees):
                scores[:, k] += tree.value[tree.places(bins, self.depth)]
        return scores

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        return softmax(self.add_scores(np.tile(self.base, (len(features), 1)), self.bins(features)))

    def to_json(self) -> str:
        return json.dumps({
            "edges": [e.tolist() for e in self.edges], "base": self.base.tolist(), "depth": self.depth,
            "rounds": [[[t.feature.tolist(), t.cut.tolist(), t.value.tolist()] for t in trees] for trees in self.rounds],
        })


def trees_of(text: str) -> Trees:
    held = json.loads(text)
    rounds = [[Tree(np.array(f, np.int64), np.array(c, np.int64), np.array(v)) for f, c, v in trees] for trees in held["rounds"]]
    return Trees([np.array(e) for e in held["edges"]], np.array(held["base"]), rounds, held["depth"])


def softmax(scores: np.ndarray) -> np.ndarray:
    odds = np.exp(scores - scores.max(1, keepdims=True))
    return odds / odds.sum(1, keepdims=True)


def gradients(scores: np.ndarray, label: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Gradient and curvature of the log loss of ``n`` equal rows each, as whole numbers of ``SCALE``."""
    p = softmax(scores)
    wrong = p.copy()
    wrong[np.arange(len(label)), label] -= 1
    return (np.rint(wrong * SCALE) * n[:, None]).astype(np.int64), (np.rint(p * (1 - p) * SCALE) * n[:, None]).astype(np.int64)


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, l2: float, min_rows: int) -> tuple[int, int] | None:
    """The (feature, bin) that gains most from sums by (feature, bin) of a node; the first of equal ones, none without gain."""
    left_g, left_h, left_n = (np.cumsum(x, 1)[:, :-1] for x in (g, h, n))
    all_g, all_h, all_n = g[0].sum(), h[0].sum(), n[0].sum()

    def worth(grad, curve):
        return (grad / SCALE) ** 2 / (curve / SCALE + l2 + 1e-12)

    gain = worth(left_g, left_h) + worth(all_g - left_g, all_h - left_h) - worth(all_g, all_h)
    gain = np.where((left_n >= min_rows) & (all_n - left_n >= min_rows), gain, 0)
    at = int(gain.argmax()) if gain.size else 0
    return divmod(at, gain.shape[1]) if gain.size and gain.flat[at] > 1e-9 else None


def held_rows(batch: pa.RecordBatch, width: int, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Bins and scores of stored rows; no method, as tasks can't load the class without the package."""
    bins = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8).reshape(-1, width)
    return bins, np.frombuffer(b"".join(batch.column(3).to_pylist()), np.float64).reshape(-1, classes).copy()


class SoftmaxBooster:
    """Fits :class:`SoftmaxBoosterModel` on a vector column ``features`` and labels 0, 1, … in ``label``.

    Each feature is cut into at most ``maxBins`` bins (255 at most), at the midpoints of its
    values where they are that few, at quantiles otherwise. Rows equal in all bins and the
    label become one row with a count, held once in the shared checkpoint folder. A level of
    all trees of a round takes one pass: tasks sum gradients and curvatures per (class, node,
    feature, bin), Spark adds the sums up, and the driver, which sees nothing but these sums
    (classes · 2^depth · features · bins rows at most), picks the splits. Sums are whole
    numbers, so a run repeats exactly whatever the partitioning. Every ``refresh`` rounds the
    rows' scores are stored anew, so that a pass never replays more trees than that.

    Classes without a row are never predicted. No row, or one class only, gives a model that
    answers with the class frequencies.
    """

    def __init__(
        self, label: str = "label", features: str = "features", maxIter: int = 100, stepSize: float = 0.1, maxDepth: int = 5,
        maxBins: int = 255, minInstancesPerNode: int = 20, l2: float = 0.0, refresh: int = 10,
    ) -> None:
        if not 2 <= maxBins <= 255:
            raise ValueError("maxBins is 2 to 255")
        self.label, self.features, self.rounds, self.step, self.depth = label, features, maxIter, stepSize, maxDepth
        self.bins, self.min_rows, self.l2, self.refresh = maxBins, minInstancesPerNode, l2, refresh

    def edges(self, rows: DataFrame, width: int) -> list[np.ndarray]:
        """Cuts per feature of ``x array<double>``."""
        at = [F.col("x")[i] for i in range(width)]
        about = rows.agg(*[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(at)]).first()
        few = [i for i in range(width) if about[i] <= 2 * self.bins]
        many = [i for i in range(width) if about[i] > 2 * self.bins]
        values: dict[int, list[float]] = {i: [] for i in range(width)}
        if few:
            listed = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), at[i].alias("v")) for i in few])).alias("e")
            for r in rows.select(listed).select("e.*").distinct().collect():
                values[r["i"]].append(r["v"])
        shares = [k / self.bins for k in range(1, self.bins)]
        if many:
            found = rows.agg(*[F.percentile_approx(at[i], shares, 10_000).alias(f"q{i}") for i in many]).first()
            for k, i in enumerate(many):
                values[i] = found[k]
        out = []
        for i in range(width):
            own = np.unique(np.array(values[i], np.float64))
            if len(own) > self.bins:
                own = own[np.unique(np.linspace(0, len(own) - 1, self.bins).astype(int))]
            out.append((own[1:] + own[:-1]) / 2)
        return out

    def fit(self, df: DataFrame) -> "SoftmaxBoosterModel":
        spark = df.sparkSession
        rows = cut_lineage(df.select(vector_to_array(self.features).alias("x"), F.col(self.label).cast("int").alias("y")).where("y is not null"))
        counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
        classes = max(counts, default=0) + 1
        total = sum(counts.values())
        base = np.log(np.maximum([counts.get(k, 0) / max(1, total) for k in range(classes)], 1e-300))
        first = rows.first()
        width = len(first["x"]) if first else 0
        model = Trees(self.edges(rows, width) if total else [], base, [], self.depth)
        if len(counts) < 2:
            return SoftmaxBoosterModel(model.to_json(), self.features)
        cells = max(map(len, model.edges)) + 1

        def binned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = batch.column(0).flatten().to_numpy().reshape(batch.num_rows, width)
                yield pa.RecordBatch.from_arrays([pa.array([b.tobytes() for b in model.bins(x)], pa.binary()), batch.column(1)], ["bins", "y"])

        start = base.tobytes()
        grouped = rows.mapInArrow(binned, "bins binary, y int").groupBy("bins", "y").agg(F.count(F.lit(1)).alias("n"))
        state = cut_lineage(grouped.withColumn("scores", F.lit(start)))
        done: list[list[Tree]] = []
        kept = 0  # rounds that the stored scores hold
        for _ in range(self.rounds):
            trees = self._round(spark, state, model._replace(rounds=done[kept:]), width, cells, classes)
            done.append(trees)
            if len(done) - kept >= self.refresh and len(done) < self.rounds:
                state = cut_lineage(self._rescored(state, model._replace(rounds=done[kept:]), width, classes))
                kept = len(done)
        return SoftmaxBoosterModel(model._replace(rounds=done).to_json(), self.features)

    def _rescored(self, state: DataFrame, model: Trees, width: int, classes: int) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bins, scores = held_rows(batch, width, classes)
                scores = model.add_scores(scores, bins)
                yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([s.tobytes() for s in scores], pa.binary())], ["bins", "y", "n", "scores"])

        return state.mapInArrow(run, "bins binary, y int, n bigint, scores binary")

    def _round(self, spark, state: DataFrame, model: Trees, width: int, cells: int, classes: int) -> list[Tree]:
        size = 2 ** (self.depth + 1) - 1
        grown = [Tree(np.full(size, -1), np.zeros(size, np.int64), np.zeros(size)) for _ in range(classes)]
        open_ = [[0] for _ in range(classes)]
        for level in range(self.depth):
            low, nodes = 2**level - 1, 2**level

            def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                held = np.zeros((3, classes * nodes * width * cells), np.int64)
                for batch in batches:
                    for begin in range(0, batch.num_rows, 1 << 14):
                        some = batch.slice(begin, 1 << 14)
                        bins, scores = held_rows(some, width, classes)
                        label, n = some.column(1).to_numpy(), some.column(2).to_numpy()
                        g, h = gradients(model.add_scores(scores, bins), label, n)
                        for k, tree in enumerate(grown):
                            at = tree.places(bins, level) - low
                            on = np.flatnonzero(at >= 0)  # others ended further up
                            cell = (((k * nodes + at[on])[:, None] * width + np.arange(width)) * cells + bins[on]).ravel()
                            for row, values in enumerate((g[on, k], h[on, k], n[on])):
                                np.add.at(held[row], cell, np.repeat(values, width))
                used = np.flatnonzero(held[2])
                yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(x[used]) for x in held)], ["cell", "g", "h", "n"])

            added = state.mapInArrow(sums, "cell bigint, g bigint, h bigint, n bigint").groupBy("cell").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))
            table = added.toPandas()
            held = np.zeros((3, classes * nodes * width * cells), np.int64)
            for row, name in enumerate("ghn"):
                held[row, table["cell"]] = table[name]
            held = held.reshape(3, classes, nodes, width, cells)
            for k, tree in enumerate(grown):
                going = []
                for node in open_[k]:
                    g, h, n = held[:, k, node - low]
                    if level == 0:
                        tree.value[0] = self._leaf(g[0].sum(), h[0].sum())
                    split = best_split(g, h, n, self.l2, self.min_rows)
                    if split is None:
                        continue
                    feature, cut = split
                    tree.feature[node], tree.cut[node] = feature, cut
                    for child, side in ((2 * node + 1, slice(0, cut + 1)), (2 * node + 2, slice(cut + 1, None))):
                        tree.value[child] = self._leaf(g[feature, side].sum(), h[feature, side].sum())
                        going.append(child)
                open_[k] = going
            if not any(open_):
                break
        return grown

    def _leaf(self, g: int, h: int) -> float:
        return float(-self.step * (g / SCALE) / (h / SCALE + self.l2 + 1e-12))


class SoftmaxBoosterModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``probability`` (vector) and ``prediction`` (the first of the likeliest classes); saved as its trees in text."""

    trees = Param(Params._dummy(), "trees", "the fitted trees as JSON", TypeConverters.toString)
    featuresCol = Param(Params._dummy(), "featuresCol", "the vector column", TypeConverters.toString)

    @keyword_only
    def _given(self, trees: str | None = None, featuresCol: str | None = None) -> None:
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def __init__(self, trees: str | None = None, features: str | None = None) -> None:
        super().__init__()
        self._given(trees=trees, featuresCol=features)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        model = trees_of(self.getOrDefault(self.trees))

        @pandas_udf("array<double>")
        def likely(x: pd.Series) -> pd.Series:
            if not len(x):
                return pd.Series([], dtype=object)
            return pd.Series(list(model.probabilities(np.stack(x.to_numpy()))))

        told = dataset.withColumn("_likely", likely(vector_to_array(self.getOrDefault(self.featuresCol))))
        return told.withColumns({
            "probability": array_to_vector("_likely"),
            "prediction": (F.array_position("_likely", F.array_max("_likely")) - 1).cast("double"),
        }).drop("_likely")
