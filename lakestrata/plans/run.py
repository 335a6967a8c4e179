"""Run order: every table is written before the next reads it, so no plan is computed twice."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Observation, functions as F

from lakestrata.operators.aggregate import row_audit
from lakestrata.plans import codes, gold, intermediate, model, raw, silver
from lakestrata.sources.documents import housing_table
from lakestrata.sources.files import Lake, read_broken_records, read_delimited


MALFORMED = "_malformed"


def build_raw(lake: Lake, paths: Mapping[str, str], broken: tuple[str, ...] = ()) -> DataFrame:
    """Ingest every listed file into Datalake: table name -> path.

    Delimited tables are those of ``raw.RAW_FILES``; the ones named in ``broken`` have their
    records stitched first. ``codebook`` is delimited text of text columns,
    ``neighbouring_dep`` adjacency text, ``housings`` a parquet table of a code and an XML
    text per municipality. Lines that didn't fit their types stay in the column
    ``_malformed`` of their table; the result (also stored as ``Datalake.ingest_audit``)
    counts rows and such lines per table, taken while the table is written.
    """
    spark, counts = lake.spark, []
    for name, path in paths.items():
        if name == "neighbouring_dep":
            df = raw.neighbour_edges(spark.read.text(path))
        elif name == "housings":
            df = housing_table(spark.read.parquet(path), codes.DOCUMENT_CODE, codes.DOCUMENT_TEXT)
        elif name == "codebook":
            df = read_delimited(spark, path, raw.file_schema(spark, path, ";", {}), ";", malformed=MALFORMED)
        elif name in broken:
            sep, types = raw.RAW_FILES[name]
            df = read_broken_records(spark, path, types, sep, malformed=MALFORMED).distinct()
        else:
            df = raw.read_raw(spark, name, path, MALFORMED)
        bad = F.count(MALFORMED) if MALFORMED in df.columns else F.lit(0).cast("bigint")
        n_rows, n_malformed = write_counted(lake, df, "Datalake", name, F.count(F.lit(1)), bad)
        counts.append((name, n_rows, n_malformed))
    return lake.write(spark.createDataFrame(counts, "table_name string, n_rows bigint, n_malformed bigint"), "Datalake", "ingest_audit")


def write_counted(lake: Lake, df: DataFrame, layer: str, name: str, *metrics: Column) -> list[int]:
    """Write a table and return aggregates of its rows, taken by the write itself: no second scan."""
    seen = Observation(f"{layer}.{name}")
    keys = [codes.BUCKET_KEYS[name]] if name in codes.BUCKET_KEYS else []
    observed = df.observe(seen, *[metric.alias(f"m{i}") for i, metric in enumerate(metrics)])
    lake.write(observed, layer, name, bucket_by=[k for k in keys if k in df.columns])
    return [seen.get[f"m{i}"] for i in range(len(metrics))]


def build_intermediate(lake: Lake) -> None:
    raw = {name: lake.read("Datalake", name) for name in (
        "tremi", "codebook", "code_commune", "pop_commune_2016", "pop_department_2016", "former_new_region",
        "development_licence", "construction_licence_2016", "destruction_licence", "elec", "dpe_france_2012",
        "weather", "neighbouring_dep",
    )}
    dictionary = lake.write(intermediate.answer_dictionary(raw["codebook"]), "Intermediate", "Dictionary")
    lake.write(intermediate.answers(raw["tremi"], dictionary), "Intermediate", "Answer")
    lake.write(intermediate.owners_raw(raw["tremi"]), "Intermediate", "Owner")
    lake.write(intermediate.housing_raw(raw["tremi"]), "Intermediate", "Housing")
    lake.write(intermediate.works_raw(raw["tremi"]), "Intermediate", codes.WORKS_TABLE)
    lake.write(intermediate.municipality_profile(
        raw["code_commune"], raw["pop_commune_2016"], raw["pop_department_2016"], raw["former_new_region"],
        raw["development_licence"], raw["construction_licence_2016"], raw["destruction_licence"], raw["elec"],
        raw["dpe_france_2012"],
    ), "Intermediate", "Municipality")
    lake.write(intermediate.weather_monthly(raw["weather"], raw["neighbouring_dep"]), "Intermediate", "Weather")


def build_silver(lake: Lake, settings: Mapping[str, Mapping[str, Any]] | None = None, folds: int = 2) -> None:
    """Silver tables; the missing targets of a dwelling come from models of the other ``folds``."""
    raw = {name: lake.read("Datalake", name) for name in (
        "pop_commune_2016", "pop_commune_2020", "code_commune", "construction_licence_2016",
        "construction_licence_2023", "destruction_licence", "development_licence", "dpe_france_2021", "weather",
        "neighbouring_dep",
    )}
    owners_raw, housing_raw, works, profile = (
        lake.read("Intermediate", name) for name in ("Owner", "Housing", codes.WORKS_TABLE, "Municipality")
    )
    geography = lake.write(silver.postal_geography(profile), "Silver", "Municipality")
    facts = lake.write(silver.municipality_year_facts(
        raw["pop_commune_2016"], raw["pop_commune_2020"], raw["code_commune"], raw["construction_licence_2016"],
        raw["construction_licence_2023"], raw["destruction_licence"], raw["development_licence"], geography,
    ), "Silver", "Municipality_info")
    lake.write(silver.weather_yearly(raw["weather"], raw["neighbouring_dep"]), "Silver", "Weather")
    owners = lake.write(silver.owners_clean(owners_raw, housing_raw), "Silver", "Owner")
    certificates = lake.write(silver.certificates_clean(raw["dpe_france_2021"], geography), "Silver", "DPE")
    # Kept beside the imputed table: the feature sets need the missing targets.
    clean = lake.write(silver.housing_clean(housing_raw, owners_raw, works, geography), "Silver", "Housing_clean")
    frame = lake.write(model.survey_features(owners, clean, facts, geography), "Model", "survey_features")
    grades = lake.write(model.certificate_feature_set(certificates), "Model", "training_dpe_cat")
    fitted = model.fit_imputers(frame, grades, settings)
    for target, one in fitted.items():
        one.write().overwrite().save(lake.model_path(target))
    lake.write(model.housing_imputed(frame, fitted, clean.columns, settings, folds), "Silver", "Housing")


def evaluate_imputers(lake: Lake, settings: Mapping[str, Mapping[str, Any]] | None = None) -> DataFrame:
    """Held-out quality of the four imputers, written to Model; doubles the cost of fitting them."""
    frame, grades = lake.read("Model", "survey_features"), lake.read("Model", "training_dpe_cat")
    return lake.write(model.imputer_quality(frame, grades, settings), "Model", "imputer_quality")


def build_model(lake: Lake, boost: Mapping[str, Any] | None = None) -> PipelineModel:
    housing, facts, geography, weather, certificates = (
        lake.read("Silver", name) for name in ("Housing", "Municipality_info", "Municipality", "Weather", "DPE")
    )
    for name, frame in model.survey_feature_sets(lake.read("Model", "survey_features")).items():
        lake.write(frame, "Model", name)
    training = lake.write(model.retrofit_training(housing, facts, geography, weather), "Model", "training_renov")
    lake.write(training.drop("id_owner"), "Model", "training_renov_no_diff")
    fitted = model.train_retrofit(training, boost)
    fitted.write().overwrite().save(lake.model_path("retrofit"))
    lake.write(model.retrofit_quality(training, fitted), "Model", "retrofit_quality")
    score_certificates(lake, fitted)
    return fitted


def score_certificates(lake: Lake, fitted: PipelineModel | None = None) -> DataFrame:
    """Scores of all certificates, by the stored model unless one is given."""
    certificates, facts, geography, weather = (
        lake.read("Silver", name) for name in ("DPE", "Municipality_info", "Municipality", "Weather")
    )
    fitted = fitted or PipelineModel.load(lake.model_path("retrofit"))
    scoring = model.retrofit_scoring(certificates, facts, geography, weather)
    return lake.write(model.predicted_renov(scoring, fitted), "Model", "predicted_renov", bucket_by=[codes.BUCKET_KEYS["predicted_renov"]])


def build_gold(lake: Lake) -> None:
    municipalities = lake.write(
        gold.gold_municipality(lake.read("Intermediate", "Municipality"), lake.read("Datalake", "housings")),
        "Gold", "Municipality",
    )
    # The join of the two largest tables is stored once and read by both serving tables.
    scored = lake.write(gold.scored_certificates(
        lake.read("Datalake", "dpe_france_2021"), lake.read("Model", "predicted_renov"), municipalities
    ), "Gold", "scored")
    lake.write(gold.gold_retrofit(scored), "Gold", codes.WORKS_TABLE)
    lake.write(gold.gold_segments(scored), "Gold", "dpe")


def audit(lake: Lake, tables: Mapping[str, tuple[str, ...]]) -> DataFrame:
    """Row counts of the listed layer tables, as one query."""
    return row_audit({f"{layer}.{name}": lake.read(layer, name) for layer, names in tables.items() for name in names})
