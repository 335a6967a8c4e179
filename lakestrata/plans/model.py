"""Model layer: feature sets, imputation of the survey dwellings, retrofit scores."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window, functions as F

from lakestrata.functions.codes import code_number
from lakestrata.functions.stable import hash_split
from lakestrata.ml import evaluate, models
from lakestrata.ml.features import split_by_target
from lakestrata.operators import joins
from lakestrata.plans import codes
from lakestrata.session import cut_lineage

SURVEY_NUMERIC = [c for c in codes.SURVEY_FEATURES if c not in codes.SURVEY_ONE_HOT]
CERTIFICATE_NUMERIC = [c for c in codes.CERTIFICATE_FEATURES if c not in codes.CERTIFICATE_ONE_HOT]


def area_years(facts: DataFrame, geography: DataFrame, weather: DataFrame | None = None) -> DataFrame:
    """Everything known about an area in a year, joined once at that small grain.

    With ``weather``, the measures of the year and the two before it are attached;
    an area-year without all three is absent.
    """
    areas = facts.join(geography.select("id_municipality", "department_number"), ["id_municipality"], "inner")
    if weather is None:
        return areas
    panel = weather.withColumn("department_number", code_number(F.col("department_number")))
    return joins.lag_join(
        areas.withColumnRenamed("year", "at_year"), panel,
        {"department_number": "department_number", "at_year": "year"}, "department_number", "year",
        codes.YEARLY_MEASURES,
    ).withColumnRenamed("at_year", "year")


def _placed(dwellings: DataFrame, date: str, areas: DataFrame) -> DataFrame:
    """Dwellings with the facts of their area in their year: one join for the large side."""
    return joins.panel_lookup(dwellings, areas, {"id_municipality": "id_municipality", date: "year"})


def survey_features(owners: DataFrame, housing: DataFrame, facts: DataFrame, geography: DataFrame) -> DataFrame:
    """One row per respondent: household, dwelling and area features; dwelling columns ride along."""
    people = owners.drop("has_done_renov")
    return _placed(people.join(housing, ["id_owner"], "inner"), "first_date_renov", area_years(facts, geography))


def survey_feature_sets(frame: DataFrame) -> dict[str, DataFrame]:
    """Training (target known) and predicting (target missing) sets for surface and heating production.

    ``frame`` is the stored :func:`survey_features` of the dwellings before imputation,
    where targets are still missing.
    """
    frame = frame.select(*codes.SURVEY_FEATURES, "surface", "heating_production")
    surface = split_by_target(frame, "surface", drop=["heating_production"])
    production = split_by_target(frame, "heating_production", drop=["surface"])
    return {
        "training_surf": surface[0], "predicting_surf": surface[1],
        "training_prod": production[0], "predicting_prod": production[1],
    }


def certificate_feature_set(certificates: DataFrame) -> DataFrame:
    return certificates.select(*codes.CERTIFICATE_FEATURES, "GES_emission", "DPE_consumption")


#: target -> (name of its settings, numeric features, one-hot features, first class)
IMPUTED = {
    "surface": ("surface", SURVEY_NUMERIC, codes.SURVEY_ONE_HOT, 1),
    "heating_production": ("production", SURVEY_NUMERIC, codes.SURVEY_ONE_HOT, 1),
    "DPE_consumption": ("consumption", CERTIFICATE_NUMERIC, codes.CERTIFICATE_ONE_HOT, 0),
    "GES_emission": ("emission", CERTIFICATE_NUMERIC, codes.CERTIFICATE_ONE_HOT, 0),
}


def with_part(df: DataFrame) -> DataFrame:
    """Rows with the part of the split they belong to; equal rows share it."""
    return df.withColumn("part", hash_split(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])))


def fit_imputer(target: str, rows: DataFrame, settings: Mapping[str, Mapping[str, Any]] | None = None) -> PipelineModel:
    """The model of one target; ``settings`` overrides the fixed settings per model name."""
    chosen = {
        "surface": models.SURFACE_BOOST, "production": models.PRODUCTION_FOREST,
        "consumption": models.CONSUMPTION_FOREST, "emission": models.EMISSION_FOREST, **(settings or {}),
    }
    name, numeric, one_hot, first = IMPUTED[target]
    boosted = target == "surface"
    make = models.boosted_classes if boosted else models.balanced_forest
    return models.train_classifier(rows, target, numeric, one_hot, make("label", **chosen[name]), first_class=first, balanced=not boosted)


def fit_imputers(
    frame: DataFrame, certificates: DataFrame, settings: Mapping[str, Mapping[str, Any]] | None = None,
) -> dict[str, PipelineModel]:
    """Models of the four targets, the first two from the survey frame, the grades from the certificate set.

    Both inputs should be stored, as every fit reads them several times.
    """
    return {target: fit_imputer(target, frame if first else certificates, settings) for target, (_, _, _, first) in IMPUTED.items()}


def housing_imputed(
    frame: DataFrame, fitted: Mapping[str, PipelineModel], columns: list[str],
    settings: Mapping[str, Mapping[str, Any]] | None = None, folds: int = 2,
) -> DataFrame:
    """Surveyed dwellings with surface and heating completed, then grades predicted from certificates.

    Observed values are never replaced. Surface and heating are cross-fitted: a dwelling's
    value comes from a model of the other ``folds``, none of whose rows share its owner.
    The grades' models saw certificates only; they read the completed heating. With
    ``folds=0`` the given models predict all dwellings.
    """
    completed = frame
    for target in ("surface", "heating_production"):
        if folds:
            told = models.cross_fitted(
                completed, target, "id_owner", lambda rows, target=target: fit_imputer(target, rows, settings), SURVEY_NUMERIC, "_predicted", folds, 1
            )
            # stored, as the fits of the next target pass over the told values many times
            completed = cut_lineage(told.withColumn(target, F.coalesce(target, "_predicted")).drop("_predicted"))
        else:
            completed = models.impute_target(completed, fitted[target], target, SURVEY_NUMERIC, first_class=1)
    completed = completed.drop("DPE_consumption", "GES_emission")
    for target in ("DPE_consumption", "GES_emission"):
        completed = models.predict(fitted[target], completed, CERTIFICATE_NUMERIC, target)
    return completed.select(*columns).distinct()


def imputer_quality(
    frame: DataFrame, certificates: DataFrame, settings: Mapping[str, Mapping[str, Any]] | None = None,
) -> DataFrame:
    """(target, actual, predicted, count, share, micro_f1) on a part that models of the same settings never saw."""
    seen, known = with_part(frame), with_part(certificates)
    trial = fit_imputers(seen.where("part <> 'test'"), known.where("part <> 'test'"), settings)
    everything = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    found = None
    for target, (_, numeric, _, first) in IMPUTED.items():
        held = (seen if first else known).where("part = 'test'").where(F.col(target).isNotNull())
        held = held.withColumn("actual", F.col(target).cast("int"))
        scored = models.predict(trial[target], held, numeric, "predicted", first).select("actual", "predicted")
        cells = evaluate.confusion_matrix(scored, "actual", "predicted")
        right = F.sum(F.when(F.col("actual") == F.col("predicted"), F.col("count")).otherwise(0))
        # One row per pair of classes from here on.
        rows = cells.withColumn("micro_f1", right.over(everything) / F.sum("count").over(everything)).withColumn("target", F.lit(target))
        found = rows if found is None else found.unionByName(rows)
    return found


def retrofit_training(housing: DataFrame, facts: DataFrame, geography: DataFrame, weather: DataFrame) -> DataFrame:
    """id_owner, the 23 features and whether works were done."""
    placed = _placed(housing, "first_date_renov", area_years(facts, geography, weather))
    return placed.select("id_owner", *codes.RETROFIT_FEATURES, "has_done_renov")


def retrofit_scoring(certificates: DataFrame, facts: DataFrame, geography: DataFrame, weather: DataFrame) -> DataFrame:
    """id_dpe, the 23 features and the still empty score."""
    placed = _placed(certificates, "dpe_date", area_years(facts, geography, weather))
    return placed.select("id_dpe", *[
        F.col(c).cast("int") if c in ("DPE_consumption", "GES_emission") else F.col(c)
        for c in codes.RETROFIT_FEATURES
    ], "has_to_renov")


def train_retrofit(training: DataFrame, settings: Mapping[str, Any] | None = None) -> PipelineModel:
    """Boosted trees on the training part, stopping early on the validation part; the test part is held out.

    Means, scales and code lists come from the training part alone.
    """
    split = training.withColumn("part", hash_split(F.col("id_owner"))).where("part <> 'test'")
    flagged = split.withColumn("is_validation", F.col("part") == "val")
    return models.train_classifier(
        flagged, "has_done_renov", codes.RETROFIT_FEATURES, codes.RETROFIT_ONE_HOT,
        models.boosted_binary("label", "is_validation", **(settings or models.RETROFIT_BOOST)), standardise=True,
        prepare_on="not is_validation",
    )


def retrofit_quality(training: DataFrame, model: PipelineModel) -> DataFrame:
    """Metrics per part; only the test part was never seen."""
    scored = models.predict(
        model, training.withColumn("part", hash_split(F.col("id_owner"))), codes.RETROFIT_FEATURES, "predicted", score="score"
    )
    ranked = None
    for part in ("train", "val", "test"):
        rows = evaluate.ranking_metrics(scored.where(F.col("part") == part), "has_done_renov", "score").withColumn("part", F.lit(part))
        ranked = rows if ranked is None else ranked.unionByName(rows)
    return evaluate.binary_metrics(scored, "has_done_renov", "predicted", "part").join(ranked, "part", "left")


def predicted_renov(scoring: DataFrame, model: PipelineModel) -> DataFrame:
    return models.predict(model, scoring.drop("has_to_renov"), codes.RETROFIT_FEATURES, "has_to_renov")
