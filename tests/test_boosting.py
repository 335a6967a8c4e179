"""Softmax boosting against a plain version that loops over rows, features and cuts."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lakestrata.ml import boosting, models

SCALE = boosting.SCALE


def plain_cuts(values: list[float]) -> list[float]:
    own = sorted(set(values))
    return [(a + b) / 2 for a, b in zip(own, own[1:])]


def plain_probabilities(x, y, rounds, step, depth, min_rows, l2, asked):
    """Class probabilities of ``asked`` rows by boosting on ``x``, ``y``, straight from the definition."""
    classes, width = max(y) + 1, len(x[0])
    cuts = [plain_cuts([r[f] for r in x]) for f in range(width)]
    base = [math.log(max(sum(v == k for v in y) / len(y), 1e-300)) for k in range(classes)]
    scores, told = [list(base) for _ in x], [list(base) for _ in asked]

    def odds(s):
        e = np.exp(np.array(s) - max(s))
        return e / e.sum()

    def grow(rows, ahead, k, g, h, level):
        """Value added to each row under a node."""
        def value(some):
            return -step * (sum(g[i] for i in some) / SCALE) / (sum(h[i] for i in some) / SCALE + l2 + 1e-12)

        def worth(some):
            return (sum(g[i] for i in some) / SCALE) ** 2 / (sum(h[i] for i in some) / SCALE + l2 + 1e-12)

        best = None
        if level < depth:
            for f in range(width):
                for c in cuts[f]:
                    left, right = [i for i in rows if x[i][f] <= c], [i for i in rows if x[i][f] > c]
                    if len(left) >= min_rows and len(right) >= min_rows:
                        gain = worth(left) + worth(right) - worth(rows)
                        if gain > 1e-9 and (best is None or gain > best[0]):
                            best = gain, f, c, left, right
        if best is None:
            for i in rows:
                scores[i][k] += value(rows)
            for i in ahead:
                told[i][k] += value(rows)
            return
        _, f, c, left, right = best
        grow(left, [i for i in ahead if asked[i][f] <= c], k, g, h, level + 1)
        grow(right, [i for i in ahead if asked[i][f] > c], k, g, h, level + 1)

    for _ in range(rounds):
        p = [odds(s) for s in scores]
        for k in range(classes):
            g = [int(np.rint((p[i][k] - (y[i] == k)) * SCALE)) for i in range(len(x))]
            h = [int(np.rint(p[i][k] * (1 - p[i][k]) * SCALE)) for i in range(len(x))]
            grow(list(range(len(x))), list(range(len(asked))), k, g, h, 0)
    return np.array([odds(s) for s in told])


@pytest.mark.parametrize("seed,refresh,l2,min_rows", [(0, 10, 0.0, 1), (1, 1, 0.2, 3), (2, 2, 1.0, 5)])
def test_equals_the_plain_version(spark, seed, refresh, l2, min_rows):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, 9, 150), rng.integers(0, 5, 150), rng.integers(0, 2, 150)], 1).astype(float)
    y = ((x[:, 0] > 4).astype(int) + (x[:, 1] > 2) + (rng.random(150) < 0.1)).clip(0, 2)
    asked = np.concatenate([x[:20], rng.uniform(-2, 11, (20, 3))])
    want = plain_probabilities(x.tolist(), y.tolist(), 4, 0.3, 3, min_rows, l2, asked.tolist())
    assemble = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform
    frame = assemble(spark.createDataFrame([(*map(float, r), int(k)) for r, k in zip(x, y)], "a double, b double, c double, label int"))
    model = boosting.SoftmaxBooster(maxIter=4, stepSize=0.3, maxDepth=3, minInstancesPerNode=min_rows, l2=l2, refresh=refresh).fit(frame.repartition(5))
    ahead = assemble(spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(asked)], "i int, a double, b double, c double"))
    got = {r.i: (r.probability.toArray(), r.prediction) for r in model.transform(ahead).select("i", "probability", "prediction").collect()}
    assert np.allclose([got[i][0] for i in range(len(asked))], want, atol=1e-9)
    assert [got[i][1] for i in range(len(asked))] == np.argmax(want, 1).tolist()
    again = boosting.SoftmaxBooster(maxIter=4, stepSize=0.3, maxDepth=3, minInstancesPerNode=min_rows, l2=l2, refresh=3).fit(frame.coalesce(1))
    assert again.getOrDefault(again.trees) == model.getOrDefault(model.trees)


def test_many_values_are_cut_at_quantiles(spark):
    frame = spark.range(4000).select((F.col("id") * 7919 % 4001 / 4001.0).alias("a")).withColumn("label", (F.col("a") * 3).cast("int"))
    frame = VectorAssembler(inputCols=["a"], outputCol="features").transform(frame)
    model = boosting.SoftmaxBooster(maxIter=5, stepSize=0.5, maxDepth=3, maxBins=64).fit(frame)
    assert len(boosting.trees_of(model.getOrDefault(model.trees)).edges[0]) <= 63
    assert model.transform(frame).where(F.col("label") == F.col("prediction")).count() > 3800


def test_stored_model_in_a_pipeline(spark, tmp_path):
    frame = spark.range(300).select(F.col("id"), (F.col("id") % 10).alias("v"), F.lit("x").alias("w")).withColumn("t", F.when(F.col("id") % 3 != 0, (F.col("v") > 3).cast("int") + (F.col("v") > 6).cast("int") + 1))
    fitted = models.train_classifier(frame, "t", ["v"], ["w"], models.boosted_classes("label", maxIter=5, stepSize=0.5, minInstancesPerNode=1), first_class=1)
    fitted.write().overwrite().save(str(tmp_path / "model"))
    loaded = PipelineModel.load(str(tmp_path / "model"))
    told = models.predict(loaded, frame, ["v"], "told", first_class=1)
    assert told.where("told <> cast(v > 3 as int) + cast(v > 6 as int) + 1").count() == 0
    assert told.columns == [*frame.columns, "told"]


def test_one_class_or_none(spark):
    frame = VectorAssembler(inputCols=["a"], outputCol="features").transform(spark.range(9).select(F.col("id").cast("double").alias("a"), F.lit(0).alias("label")))
    assert {r.prediction for r in boosting.SoftmaxBooster().fit(frame).transform(frame).collect()} == {0.0}
    assert {r.prediction for r in boosting.SoftmaxBooster().fit(frame.limit(0)).transform(frame).collect()} == {0.0}


def test_cross_fitting_never_asks_a_model_about_its_own_rows(spark):
    frame = spark.range(200).select("id", F.lit(1.0).alias("v")).withColumn("t", F.when(F.col("id") % 4 != 0, F.lit(1)))
    seen = []

    def fit(rows):
        seen.append({r.id for r in rows.collect()})
        return models.train_classifier(rows, "t", ["v"], [], models.boosted_classes("label", maxIter=1))

    found = models.cross_fitted(frame, "t", "id", fit, ["v"], "told", folds=4)
    assert found.count() == 200 and len(seen) == 4
    everything = set(range(200))
    assert set().union(*(everything - s for s in seen)) == everything and sum(len(everything - s) for s in seen) == 200
