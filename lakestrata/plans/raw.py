"""Raw layer: typed ingest of the source files."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakestrata.functions import predicates
from lakestrata.operators.reshape import edge_list_from_text
from lakestrata.plans import codes
from lakestrata.sources.files import clean_headers, read_delimited, rename_columns

_SURVEY_INTS = {
    **{c: "int" for c in (*codes.OWNER_COLUMNS, *codes.DWELLING_COLUMNS, *codes.MULTI_CHOICE_COLUMNS)},
    **{q.format(n): "int" for n in codes.WORK_TYPES for q in codes.WORK_QUESTIONS.values()},
}

# Table -> (separator, columns that are not text). Every code is text, so no leading zero is lost.
RAW_FILES: dict[str, tuple[str, Mapping[str, str]]] = {
    "pop_commune_2016": (";", {"PMUN": "int"}),
    "pop_commune_2020": (";", {"PMUN": "int"}),
    "pop_department_2016": (";", {}),
    "construction_licence_2016": (";", {"NB_LGT_TOT_CREES": "int", "DATE_REELLE_AUTORISATION": "date"}),
    "construction_licence_2023": (";", {"NB_LGT_TOT_CREES": "int", "DATE_REELLE_AUTORISATION": "date"}),
    "tremi": (";", _SURVEY_INTS),
    "former_new_region": (";", {}),
    "code_commune": (";", {}),
    "elec": (";", {
        "Année": "int", "Consommation Résidentiel  (MWh)": "double", "Nombre de points Résidentiel": "int",
    }),
    "weather": (";", {"Date": "timestamp", **{c: "double" for c in codes.WEATHER_COLUMNS}}),
    "dpe_france_2012": (",", {"date_etablissement_dpe": "date"}),
    "dpe_france_2021": (",", {
        "Date_établissement_DPE": "date", "Année_construction": "int", "Surface_habitable_logement": "double",
        "Emission_GES_5_usages_par_m²": "double", "Conso_5_usages/m²_é_finale": "double",
        "Emission_GES_5_usages": "double",
    }),
    "development_licence": (";", {"DATE_REELLE_AUTORISATION": "date"}),
    "destruction_licence": (";", {"DATE_REELLE_AUTORISATION": "date"}),
}


def file_schema(spark: SparkSession, path: str, sep: str, types: Mapping[str, str]) -> str:
    """Schema in file order from the header line alone; columns not listed are text."""
    names = spark.read.option("sep", sep).option("header", True).csv(path).columns
    return ", ".join(f"`{n}` {types.get(n.replace(',', ''), 'string')}" for n in names)


def read_raw(spark: SparkSession, name: str, path: str, malformed: str | None = None) -> DataFrame:
    """One raw table by its name; certificate tables lose whole-row repeats."""
    sep, types = RAW_FILES[name]
    df = read_delimited(spark, path, file_schema(spark, path, sep, types), sep, malformed=malformed)
    if name == "weather":
        df = clean_headers(df, ",")
    if name == "code_commune":
        df = rename_columns(df, {"#Code_commune_INSEE": "Code_commune_INSEE"})
    return df.distinct() if "dpe" in name else df


def neighbour_edges(lines: DataFrame) -> DataFrame:
    """Adjacency text to department edges."""
    return edge_list_from_text(lines)


def mainland_municipalities(code_commune: DataFrame) -> DataFrame:
    """Ordered municipality codes without Corsica and the overseas departments."""
    code = F.col("Code_commune_INSEE")
    kept = predicates.contains_none(code, codes.CORSICA) & predicates.code_sorts_before(
        code, f"{codes.OVERSEAS_FROM}000"
    )
    return code_commune.select(code).where(kept).orderBy(code)
