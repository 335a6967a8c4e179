"""Classifiers, model imputation and batch scoring."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from lakestrata.functions.measures import observed_or
from lakestrata.functions.stable import key_bucket
from lakestrata.ml.boosting import SoftmaxBooster
from lakestrata.ml.features import coerce_numbers, feature_stages, with_class_weights
from lakestrata.session import cut_lineage

# The tuned settings of each model. A tree depth over 30 is not available in Spark.
CONSUMPTION_FOREST = {"maxDepth": 30, "numTrees": 112}
EMISSION_FOREST = {"maxDepth": 27, "numTrees": 134}
PRODUCTION_FOREST = {"maxDepth": 19, "numTrees": 171}
SURFACE_BOOST = {"maxIter": 241, "stepSize": 0.03542260908465626, "l2": 0.17592525267734538}
RETROFIT_BOOST = {
    "maxIter": 254, "stepSize": 0.6660996028542977, "maxDepth": 6, "maxBins": 39,
    "minInstancesPerNode": 96, "subsamplingRate": 0.7940010712056597,
    "featureSubsetStrategy": "0.46238671840939966", "seed": 815171646,
}

#: Parameters that name a column a classifier is fitted on.
_READ = ("featuresCol", "labelCol", "weightCol", "validationIndicatorCol")


def balanced_forest(label: str, seed: int = 0, **params: Any) -> RandomForestClassifier:
    """Random forest on ``features`` with the class weights of ``with_class_weights``."""
    return RandomForestClassifier(labelCol=label, featuresCol="features", weightCol="weight", seed=seed, **params)


def boosted_classes(label: str, **params: Any) -> SoftmaxBooster:
    """Multi-class boosted trees: one softmax model for all classes."""
    return SoftmaxBooster(label, "features", **params)


def boosted_binary(label: str, validation: str | None = None, **params: Any) -> GBTClassifier:
    """Binary boosted trees; rows flagged in ``validation`` decide when to stop early."""
    booster = GBTClassifier(labelCol=label, featuresCol="features", **params)
    return booster.setValidationIndicatorCol(validation) if validation else booster


def train_classifier(
    df: DataFrame, target: str, numeric: Sequence[str], one_hot: Sequence[str], estimator, first_class: int = 0,
    balanced: bool = False, standardise: bool = False, prepare_on: str | None = None,
) -> PipelineModel:
    """Fit preprocessing and classifier on the labelled rows; labels are shifted to start at 0.

    ``prepare_on`` is a condition: means, scales and code lists are then learned from
    those rows alone. A fit passes over its rows many times, so what it reads of them is
    prepared once and stored in the checkpoint folder.
    """
    labelled = coerce_numbers(df.where(F.col(target).isNotNull()), numeric)
    labelled = labelled.withColumn("label", F.col(target).cast("double") - first_class)
    if balanced:
        labelled = with_class_weights(labelled, "label")
    known = labelled.where(prepare_on) if prepare_on else labelled
    prepared = Pipeline(stages=feature_stages(numeric, one_hot, standardise)).fit(known)
    return PipelineModel(stages=[*prepared.stages, estimator.fit(cut_lineage(_needed(prepared.transform(labelled), estimator)))])


def _needed(prepared: DataFrame, estimator) -> DataFrame:
    """The columns that an estimator reads."""
    if isinstance(estimator, SoftmaxBooster):
        return prepared.select(estimator.features, estimator.label)
    named = (estimator.getOrDefault(p) for p in estimator.params if p.name in _READ and estimator.isDefined(p))
    return prepared.select(*[c for c in named if c])


def predict(
    model: PipelineModel, df: DataFrame, numeric: Sequence[str], output: str, first_class: int = 0,
    score: str | None = None,
) -> DataFrame:
    """The rows with the predicted class; every input column stays, so no join back by id is needed.

    ``score`` names a column for the probability of the second class.
    """
    scored = model.transform(coerce_numbers(df.withColumns({f"_in_{c}": F.col(c) for c in numeric}), numeric))
    return scored.select(
        *[F.col(f"_in_{c}").alias(c) if c in numeric else F.col(c) for c in df.columns],
        (F.col("prediction") + first_class).cast("int").alias(output),
        *([vector_to_array("probability")[1].alias(score)] if score else []),
    )


def impute_target(
    df: DataFrame, model: PipelineModel, target: str, numeric: Sequence[str], first_class: int = 0
) -> DataFrame:
    """Predict for every row, use the prediction only where the target is missing."""
    scored = predict(model, df, numeric, "_predicted", first_class)
    return scored.withColumn(target, observed_or(F.col(target), F.col("_predicted"))).drop("_predicted")


def cross_fitted(
    df: DataFrame, target: str, key: str, fit: Callable[[DataFrame], PipelineModel], numeric: Sequence[str], output: str,
    folds: int = 3, first_class: int = 0,
) -> DataFrame:
    """Every row with a prediction by a model that never saw it, as ``output``.

    Rows are dealt to ``folds`` by a hash of ``key``, so rows of one key stay together and a
    rerun deals alike; the rows of a fold are predicted by the model ``fit`` makes of the
    other folds. Rows without the target are never fitted on, so the models of all folds
    are new to them; they are predicted by that of their own fold too.
    """
    if folds < 2:
        raise ValueError("folds are two or more")
    dealt = df.withColumn("_fold", key_bucket(folds, F.coalesce(F.col(key).cast("string"), F.lit(""))))
    out = None
    for fold in range(folds):
        model = fit(dealt.where(F.col("_fold") != fold).drop("_fold"))
        rows = predict(model, dealt.where(F.col("_fold") == fold).drop("_fold"), numeric, output, first_class)
        out = rows if out is None else out.unionByName(rows)
    return out


def feature_importance(model: PipelineModel, sample: DataFrame) -> DataFrame:
    """(feature, importance) of the fitted tree model; names come from the vector's metadata."""
    trees = model.stages[-1]
    metadata: Mapping = sample.schema["features"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {a["idx"]: a["name"] for group in metadata.values() for a in group}
    weights = trees.featureImportances.toArray()
    rows = [(names.get(i, str(i)), float(w)) for i, w in enumerate(weights)]
    return sample.sparkSession.createDataFrame(rows, "feature string, importance double")
