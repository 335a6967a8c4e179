"""Models on learnable data: seeds fixed, better than the majority, observed values untouched."""

from __future__ import annotations

import math

import fixtures as fx
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from lakestrata.functions.stable import hash_split, key_bucket
from lakestrata.ml import evaluate, features, models
from lakestrata.plans import codes, run
from lakestrata.sources.files import Lake

SMALL = {
    "surface": {"maxIter": 5, "maxDepth": 3}, "production": {"numTrees": 10, "maxDepth": 4},
    "consumption": {"numTrees": 10, "maxDepth": 5}, "emission": {"numTrees": 10, "maxDepth": 5},
}
BOOST = {"maxIter": 8, "maxDepth": 4, "seed": 3}


@pytest.fixture(scope="module")
def learnable(spark):
    """Class 1..3 follows x, group says nothing; a seventh of the targets is missing."""
    return spark.range(800).select(
        "id", (F.col("id") % 30).cast("double").alias("x"), (F.col("id") % 4).cast("string").alias("group"),
        F.when(F.col("id") % 7 == 0, None).otherwise(F.when(F.col("id") % 30 < 15, 1).when(F.col("id") % 30 < 24, 2).otherwise(3))
        .alias("target"),
        F.when(F.col("id") % 30 < 15, 1).when(F.col("id") % 30 < 24, 2).otherwise(3).alias("truth"),
    )


@pytest.mark.parametrize("kind", ["forest", "boost"])
def test_imputation_learns_and_never_overwrites(spark, learnable, kind):
    balanced = kind == "forest"
    estimator = (
        models.balanced_forest("label", numTrees=10, maxDepth=5) if balanced
        else models.boosted_classes("label", maxIter=5, maxDepth=3)
    )
    odd = learnable.withColumn("target", F.when(F.col("id") == 1, 3).otherwise(F.col("target")))
    model = models.train_classifier(odd, "target", ["x"], ["group"], estimator, first_class=1, balanced=balanced)
    got = models.impute_target(odd, model, "target", ["x"], first_class=1)
    assert got.columns == odd.columns
    rows = {r.id: r for r in got.collect()}
    assert rows[1].target == 3 and len(rows) == 800
    filled = [r for r in rows.values() if r.id % 7 == 0]
    assert sum(r.target == r.truth for r in filled) / len(filled) > 0.95


def test_class_weights_sum_to_the_rows(spark, learnable):
    weighted = features.with_class_weights(learnable.where("target IS NOT NULL"), "target")
    assert abs(weighted.agg(F.sum("weight")).first()[0] - weighted.count()) < 1e-6


def test_split_by_target(spark, learnable):
    known, unknown = features.split_by_target(learnable, "target", drop=["truth"])
    assert known.count() + unknown.count() == 800 and "truth" not in known.columns
    assert unknown.where("target IS NOT NULL").count() == 0


def test_early_stopping_and_importance(spark, learnable):
    # A tenth of the labels is wrong, so the validation loss turns up again.
    wrong = key_bucket(10, F.col("id")) == 0
    binary = learnable.withColumn("y", F.when(wrong, F.col("x") <= 12).otherwise(F.col("x") > 12).cast("int"))
    binary = binary.withColumn("part", hash_split(F.col("id"), F.lit("part")))
    flagged = binary.withColumn("is_validation", F.col("part") == "val")
    model = models.train_classifier(
        flagged, "y", ["x"], ["group"], models.boosted_binary("label", "is_validation", maxIter=40, maxDepth=4, stepSize=0.7, seed=1),
        standardise=True,
    )
    assert model.stages[-1].getNumTrees < 40
    scored = models.predict(model, binary, ["x"], "y_hat")
    assert evaluate.micro_f1(scored, "y", "y_hat").first().micro_f1 > 0.85
    ranked = models.feature_importance(model, model.transform(features.coerce_numbers(binary, ["x"])))
    assert abs(ranked.agg(F.sum("importance")).first()[0] - 1) < 1e-6
    assert ranked.orderBy(F.desc("importance")).first().importance > 0.3


def test_coercion_makes_text_null(spark):
    df = spark.createDataFrame([("1.5",), ("x",), (None,)], "v string")
    assert [r.v for r in features.coerce_numbers(df, ["v"]).collect()] == [1.5, None, None]


def test_roc_is_monotone_and_ends_at_one(spark, learnable):
    scored = learnable.select((F.col("truth") > 1).cast("int").alias("y"), (F.col("x") / 30).alias("score"))
    points = evaluate.binned_roc_points(scored, "y", "score", bins=10).orderBy(F.desc("threshold")).collect()
    assert points[-1].recall == points[-1].false_positive_rate == 1.0
    assert all(a.tp <= b.tp and a.fp <= b.fp for a, b in zip(points, points[1:]))


def test_confusion_shares_sum_to_one(spark, learnable):
    pairs = learnable.select("truth", F.when(F.col("id") % 2 == 0, F.col("truth")).otherwise(1).alias("p"))
    shares = evaluate.confusion_matrix(pairs, "truth", "p").groupBy("truth").agg(F.round(F.sum("share"), 9)).collect()
    assert all(r[1] == 1.0 for r in shares)


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    """All layers built end to end on the fixture lake."""
    lake = Lake(spark, str(tmp_path_factory.mktemp("lake")))
    for name, df in fx.whole_lake(spark).items():
        lake.write(df, "Datalake", name)
    run.build_intermediate(lake)
    run.build_silver(lake, SMALL)
    run.build_model(lake, BOOST)
    run.build_gold(lake)
    return lake


def test_layers_are_complete(lake):
    audit = {r.table_name: r.n_rows for r in run.audit(lake, {
        "Intermediate": ("Dictionary", "Answer", "Owner", "Housing", codes.WORKS_TABLE, "Municipality", "Weather"),
        "Silver": ("Municipality", "Municipality_info", "Weather", "Owner", "DPE", "Housing"),
        "Model": ("training_surf", "predicting_surf", "training_prod", "predicting_prod", "training_dpe_cat",
                  "training_renov_no_diff", "predicted_renov", "survey_features", "retrofit_quality"),
        "Gold": ("Municipality", codes.WORKS_TABLE, "dpe", "scored"),
    }).collect()}
    assert all(n > 0 for n in audit.values()), audit


def test_imputed_housing(lake):
    clean = {r.id_owner: r for r in lake.read("Silver", "Housing_clean").collect()}
    imputed = lake.read("Silver", "Housing").collect()
    assert imputed and all(r.surface and r.heating_production for r in imputed)
    assert all(r.DPE_consumption is not None and r.GES_emission is not None for r in imputed)
    assert any(clean[r.id_owner].surface is None for r in imputed)
    for r in imputed:
        before = clean[r.id_owner]
        assert before.surface in (None, r.surface) and before.heating_production in (None, r.heating_production)
    assert all(1 <= r.surface <= 3 and 1 <= r.heating_production <= 6 for r in imputed)


def test_scores_and_serving_tables(lake):
    predicted = lake.read("Model", "predicted_renov")
    assert predicted.columns == ["id_dpe", *codes.RETROFIT_FEATURES, "has_to_renov"]
    assert {r[0] for r in predicted.select("has_to_renov").distinct().collect()} <= {0, 1}
    assert lake.read("Model", "training_renov_no_diff").columns == [*codes.RETROFIT_FEATURES, "has_done_renov"]
    segments = lake.read("Gold", "dpe")
    assert segments.agg(F.sum("count")).first()[0] == predicted.count()
    assert {r[0] for r in lake.read("Gold", codes.WORKS_TABLE).select("renov_type").distinct().collect()} <= set(
        codes.RETROFIT_LABELS.values())
    years = {r[0] for r in lake.read("Silver", "Weather").select("department_number").distinct().collect()}
    assert years == {"01", "02", "03", "04"}


def test_stored_model_scores_alike(lake):
    before = sorted(map(tuple, lake.read("Model", "predicted_renov").select("id_dpe", "has_to_renov").collect()))
    assert sorted(map(tuple, run.score_certificates(lake).select("id_dpe", "has_to_renov").collect())) == before


def test_quality_is_told_per_part(lake):
    rows = lake.read("Model", "retrofit_quality").collect()
    assert rows and {r.part for r in rows} <= {"train", "val", "test"} and all(0 <= r.accuracy <= 1 for r in rows)


def test_ranking_metrics(spark):
    rows = [(1, 0.9), (1, 0.6), (0, 0.6), (0, 0.2), (1, 0.2), (None, 0.5), (1, None)]
    found = evaluate.ranking_metrics(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()
    assert found.roc_auc == pytest.approx((2 + 1.5 + 0.5) / 6)
    assert found.average_precision == pytest.approx((1 / 1 + 2 / 3 + 3 / 5) / 3)
    assert found.log_loss == pytest.approx(-sum(map(math.log, (0.9, 0.6, 1 - 0.6, 1 - 0.2, 0.2))) / 5)
    with pytest.raises(Exception, match="outside"):
        evaluate.roc_points(spark.createDataFrame([(1, 1.5)], "y int, s double"), "y", "s").collect()


def test_a_whole_quarter_of_the_parts_is_imputed(spark):
    rows = contract.queries()["op_impute_boosted"](spark, contract.SMOKE_DIR).collect()
    assert {r.p_partkey for r in rows if not r.known} == {r.p_partkey for r in rows if r.p_partkey % 4 == 2}
