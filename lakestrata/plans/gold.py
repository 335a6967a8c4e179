"""Gold layer: tables a dashboard reads as they are."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from lakestrata.functions import measures, predicates, recode
from lakestrata.functions.codes import zero_pad
from lakestrata.operators import aggregate, joins, reshape
from lakestrata.operators.ids import distinct_with_id
from lakestrata.plans import codes

SEGMENTS = [
    "id_municipality", "type", "construction_date", "heating_production", "surface", "DPE_consumption",
    "GES_emission", "has_to_renov",
]


def gold_municipality(profile: DataFrame, housings: DataFrame) -> DataFrame:
    """Mainland municipalities with their number of houses and apartments."""
    inside = predicates.code_in_scope(F.col("department_number"), codes.OVERSEAS_FROM)
    places = profile.where(inside).select(
        "insee_code", "municipality_name", F.col("department_number").cast("string").alias("department_number"),
        "department_name", recode.replace_value(F.col("new_region_name"), *codes.REGION_SHORT).alias("new_region_name"),
        "new_region_number",
    )
    counts = housings.select(
        zero_pad(F.col("Code_commune_INSEE"), 5).alias("insee_code"), F.col("houses").alias("n_houses"),
        F.col("apartments").alias("n_apartments"),
    )
    return distinct_with_id(joins.attach_dimensions(places, (counts, ["insee_code"])), "id_municipality")


def scored_certificates(
    certificates: DataFrame, predicted: DataFrame, municipalities: DataFrame, good_from: int = 2
) -> DataFrame:
    """Scored certificates with retrofit flags and display labels.

    ``good_from`` is the insulation quality from which a flag is set.
    """
    def quality(part: str):
        return recode.label_to_ordinal(F.col(f"`Qualité_isolation_{part}`"), codes.QUALITY_LABELS)

    ceiling = measures.rowwise_positive_mean([
        quality("plancher_haut_toit_terrase"), quality("plancher_haut_comble_aménagé"),
        quality("plancher_haut_comble_perdu"),
    ])
    parts = {
        "renov_shell": quality("enveloppe"), "renov_walls": quality("murs"), "renov_carpentry": quality("menuiseries"),
        "renov_flooring": quality("plancher_bas"), "renov_ceiling": ceiling,
    }
    # Flags are made before the joins, so three small integers travel instead of seven texts.
    flagged = certificates.select(
        F.col("`N°DPE`").alias("id_dpe"), F.col("`Code_INSEE_(BAN)`").alias("insee_code"),
        F.col("`Type_bâtiment`").alias("type"),
        *[recode.threshold_flag(value, good_from).alias(name) for name, value in parts.items()],
    )
    scores = predicted.select(
        "id_dpe", "surface", "construction_date", "heating_production", "DPE_consumption", "GES_emission",
        "has_to_renov",
    )
    placed = joins.attach_dimensions(
        flagged, (scores, ["id_dpe"]), (municipalities.select("insee_code", "id_municipality"), ["insee_code"])
    )
    energy = recode.rule_flag(
        F.col("heating_production"), [2], [1, 3], [F.col("DPE_consumption"), F.col("GES_emission")], 4
    )
    labels: Mapping[str, Mapping[int, str]] = {
        "heating_production": codes.HEATING_LABELS, "DPE_consumption": codes.GRADE_LABELS,
        "GES_emission": codes.GRADE_LABELS, "surface": codes.SURFACE_LABELS,
        "construction_date": codes.CONSTRUCTION_LABELS,
    }
    return placed.select(
        "id_dpe", "id_municipality", "type", "has_to_renov", energy.alias("renov_energy"), *parts,
        *[recode.decode_label(F.col(c), names).alias(c) for c, names in labels.items()],
    )


def gold_retrofit(scored: DataFrame, labels: Mapping[str, str] = codes.RETROFIT_LABELS) -> DataFrame:
    """(id_dpe, id_municipality, renov_type), one row per flag that is set."""
    return reshape.flags_to_rows(scored, ["id_dpe", "id_municipality"], labels, "renov_type")


def gold_segments(scored: DataFrame) -> DataFrame:
    return aggregate.segment_counts(scored, SEGMENTS)
