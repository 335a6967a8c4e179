"""Silver layer: cleaned, recoded and completed tables."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions import measures, predicates, recode
from lakestrata.functions.codes import code_number, composite_key, zero_pad
from lakestrata.functions.stable import seeded_pick
from lakestrata.operators import aggregate, joins
from lakestrata.operators.ids import distinct_with_id
from lakestrata.operators.neighbour import fill_to_fixpoint
from lakestrata.plans import codes
from lakestrata.plans.intermediate import department_edges

FACT_MEASURES = [
    "population", "n_construction_licence", "n_new_buildings", "n_destruction_licence", "n_development_licence",
]


def weather_yearly(weather: DataFrame, neighbouring_dep: DataFrame, last_year: int = 2022) -> DataFrame:
    """Mainland department × year averages, completed from neighbours until nothing reachable is missing."""
    shown = {name: c for c, name in codes.WEATHER_COLUMNS.items()}
    stations = weather.where(F.col("Date") < F.lit(datetime.date(last_year + 1, 1, 1))).select(
        zero_pad(F.col(f"`{codes.WEATHER_DEPARTMENT}`"), 2).alias("department_number"), F.year("Date").alias("year"),
        *[F.col(f"`{shown[m]}`").alias(m) for m in codes.YEARLY_MEASURES],
    )
    inside = predicates.code_in_scope(F.col("department_number"), codes.OVERSEAS_FROM)
    observed = aggregate.group_averages(stations.where(inside), ["department_number", "year"], codes.YEARLY_MEASURES)
    return fill_to_fixpoint(
        observed, department_edges(neighbouring_dep), "department_number", ["year"], codes.YEARLY_MEASURES
    )


def postal_geography(profile: DataFrame) -> DataFrame:
    """Mainland geography at postal-code grain."""
    rows = profile.select(
        "postal_code", code_number(F.col("department_number")).alias("department_number"), "department_name",
        "former_region_name", "former_region_number", "new_region_name", "new_region_number",
    ).where("department_number IS NOT NULL")
    return distinct_with_id(rows, "id_municipality")


def _licence_years(licences: DataFrame, name: str) -> DataFrame:
    return aggregate.event_counts(
        licences.select(F.col("COMM").alias("insee_code"), "DATE_REELLE_AUTORISATION"),
        "insee_code", "DATE_REELLE_AUTORISATION", counts={name: "insee_code"},
    )


def _construction_years(licences: DataFrame, before_year: int | None) -> DataFrame:
    return aggregate.event_counts(
        licences.select(F.col("COMM").alias("insee_code"), "NB_LGT_TOT_CREES", "DATE_REELLE_AUTORISATION"),
        "insee_code", "DATE_REELLE_AUTORISATION", sums={"n_new_buildings": "NB_LGT_TOT_CREES"},
        counts={"n_construction_licence": "NB_LGT_TOT_CREES"}, before_year=before_year,
    )


def population_panel(pop_commune_2016: DataFrame, pop_commune_2020: DataFrame, code_commune: DataFrame) -> DataFrame:
    """Municipality × postal code × year; each census is carried over the years it stands for."""
    code_2020 = composite_key(F.col("CODDEP"), F.col("CODCOM"), 3)
    newer = pop_commune_2020.select(code_2020.alias("insee_code"), F.col("PMUN").cast("bigint").alias("population"))
    older = pop_commune_2016.select(F.col("DEPCOM").alias("insee_code"), F.col("PMUN").cast("bigint").alias("population"))
    places = code_commune.select(
        F.col("Code_commune_INSEE").alias("insee_code"), zero_pad(F.col("Code_postal"), 5).alias("postal_code")
    ).distinct()
    # Repeats go and places come at municipality grain; the years are expanded last, in the row's task.
    newer, older = (joins.attach_dimensions(people.distinct(), (places, ["insee_code"])) for people in (newer, older))
    return aggregate.union_vintages(joins.year_panel(newer, 2019, 2022), joins.year_panel(older, 2012, 2018))


def municipality_year_facts(
    pop_commune_2016: DataFrame, pop_commune_2020: DataFrame, code_commune: DataFrame,
    construction_licence_2016: DataFrame, construction_licence_2023: DataFrame, destruction_licence: DataFrame,
    development_licence: DataFrame, geography: DataFrame, merge_vintages: bool = False, before_year: int = 2023,
) -> DataFrame:
    """Postal area × year facts. A municipality counts once for each of its postal codes.

    A year found in both construction files gives two rows, and so counts its
    population twice, unless ``merge_vintages`` adds them up first.
    """
    construction = aggregate.union_vintages(
        _construction_years(construction_licence_2016, None),
        _construction_years(construction_licence_2023, before_year),
    )
    if merge_vintages:
        construction = aggregate.roll_up(
            construction, ["insee_code", "year"], ["n_new_buildings", "n_construction_licence"]
        )
    else:
        # Equal rows of both files count once; the panel itself then has no repeats to look for.
        construction = construction.distinct()
    facts = joins.zero_filled(
        population_panel(pop_commune_2016, pop_commune_2020, code_commune), ["insee_code", "year"], construction,
        _licence_years(destruction_licence, "n_destruction_licence"),
        _licence_years(development_licence, "n_development_licence"), fill=FACT_MEASURES,
    )
    postal = aggregate.roll_up(facts, ["postal_code", "year"], FACT_MEASURES)
    inside = predicates.code_in_scope(F.col("postal_code"), codes.OVERSEAS_FROM * 1000)
    ids = geography.select("id_municipality", "postal_code")
    return joins.attach_dimensions(postal.where(inside), (ids, ["postal_code"])).select(
        "year", *FACT_MEASURES, "id_municipality"
    ).distinct()


def occupation_code(work_state: Column, job: Column) -> Column:
    """Job + 5 for the working, work state - 2 for the others (and for a missing job or job 11)."""
    return F.when(work_state.isin(1, 2) & (job != 11), job + 5).otherwise(work_state - 2)


def complete_respondents(owners: DataFrame) -> DataFrame:
    """Respondents who gave their household size, age and income."""
    return owners.where(
        predicates.not_sentinel(F.col("nb_persons_home"), codes.PERSONS_SENTINELS)
        & predicates.all_present(F.col("age"))
        & predicates.not_sentinel(F.col("income"), codes.INCOME_SENTINELS)
    )


def owners_clean(owners: DataFrame, housing: DataFrame) -> DataFrame:
    """Complete respondents who live in a house or an apartment."""
    dwellers = housing.where(F.col("type").isin(codes.DWELLING_TYPES))
    return joins.having_id_in(complete_respondents(owners), dwellers, "id_owner").select(
        "id_owner", recode.flag_other(F.col("gender"), 1).alias("gender"), "age",
        occupation_code(F.col("work_state"), F.col("job")).alias("occupation"),
        recode.flag_other(F.col("home_state"), 1).alias("home_state"),
        recode.flag_other(F.col("has_done_renov"), 1).alias("has_done_renov"), "nb_persons_home", "income",
    )


def _certificate_gate() -> Column:
    """Complete certificates with plausible values; shifted rows fail the type tests."""
    needed = [
        "Surface_habitable_logement", "Code_postal_(BAN)", "Code_INSEE_(BAN)", "Année_construction",
        "Conso_5_usages_é_finale", "Emission_GES_5_usages", "Type_installation_ECS",
        "Type_énergie_principale_chauffage", "Type_émetteur_installation_chauffage_n°1",
        "Type_générateur_n°1_installation_n°1",
    ]
    return (
        predicates.all_present(*[F.col(f"`{c}`") for c in needed])
        & F.col("`Type_énergie_principale_chauffage`").isin(codes.KNOWN_ENERGY)
        & F.col("`Type_énergie_générateur_ECS_n°1`").isin(codes.KNOWN_ENERGY)
        & ~predicates.is_number(F.col("`Type_installation_chauffage_n°1`").cast("string"))
        & predicates.is_number(F.col("`Conso_5_usages_é_finale`").cast("string"))
        & (F.col("`Type_bâtiment`") != "immeuble")
        & predicates.inside_dates(F.col("`Date_établissement_DPE`"), "2014-01-01", "2024-01-01")
        & predicates.strictly_between(F.col("`Année_construction`"), 1700, 2024)
        & (F.col("`Emission_GES_5_usages_par_m²`") < 200)
        & (F.col("`Conso_5_usages/m²_é_finale`") < 700)
    )


def certificates_clean(certificates: DataFrame, geography: DataFrame) -> DataFrame:
    """Certificates in the codes of the survey, placed in a postal area."""
    energy = F.col("`Type_énergie_principale_chauffage`")
    coded = certificates.where(_certificate_gate()).select(
        zero_pad(F.col("`Code_postal_(BAN)`"), 5).alias("postal_code"),
        F.col("`N°DPE`").alias("id_dpe"),
        measures.clamp_year(F.col("`Date_établissement_DPE`"), 2022).alias("dpe_date"),
        recode.flag_other(F.col("`Type_bâtiment`"), "maison").alias("type"),
        recode.bin_left_closed(F.col("`Année_construction`"), codes.CONSTRUCTION_BOUNDS).alias("construction_date"),
        recode.nested_recode(
            F.col("`Type_installation_chauffage`"), {"individuel": 0, "collectif": 1},
            F.col("`Type_installation_chauffage_n°1`"), {"installation individuelle": 0}, 1,
        ).alias("heating_system"),
        recode.classify_members(
            energy, {1: codes.GAS, 2: codes.POLLUTING_GAS, 3: codes.WOOD_COAL, 4: codes.OTHER_ENERGY},
            codes.ELECTRICITY, F.col("`Type_générateur_n°1_installation_n°1`"), codes.HEAT_PUMP_MARKERS, 5, 6,
        ).alias("heating_production"),
        recode.nested_recode(
            F.col("`Type_installation_ECS_(général)`"), {"individuel": 0, "collectif": 1},
            F.col("Type_installation_ECS"), {"installation individuelle": 0}, 1,
        ).alias("hot_water_system"),
        recode.bin_left_closed(F.col("Surface_habitable_logement"), codes.SURFACE_BOUNDS).alias("surface"),
        recode.bin_right_closed(F.col("`Conso_5_usages/m²_é_finale`"), codes.CONSUMPTION_BOUNDS)
        .cast("double").alias("DPE_consumption"),
        recode.bin_right_closed(F.col("`Emission_GES_5_usages_par_m²`"), codes.EMISSION_BOUNDS)
        .cast("double").alias("GES_emission"),
    )
    placed = joins.attach_dimensions(coded, (geography.select("id_municipality", "postal_code"), ["postal_code"]))
    return placed.select(
        "id_dpe", "dpe_date", "id_municipality", "type", "construction_date", "heating_system", "heating_production",
        "hot_water_system", "surface", "DPE_consumption", "GES_emission",
        recode.typed_null("string").alias("has_to_renov"),
    )


def housing_clean(housing: DataFrame, owners: DataFrame, works: DataFrame, geography: DataFrame) -> DataFrame:
    """Surveyed dwellings of complete respondents, recoded; nothing is imputed yet.

    A respondent without works gets one of the survey years, picked by id.
    """
    works = aggregate.first_event(works, "id_owner", "start_date", "first_date_renov")
    kept = housing.where(F.col("type").isin(codes.DWELLING_TYPES))
    dwellings = joins.having_id_in(kept, complete_respondents(owners), "id_owner").join(works, ["id_owner"], "left")
    placed = joins.attach_dimensions(dwellings, (geography.select("id_municipality", "postal_code"), ["postal_code"]))
    one_two = {1: 0, 2: 1}
    return placed.select(
        "id_owner", "id_municipality", recode.recode(F.col("type"), one_two).alias("type"), "construction_date",
        recode.recode(F.col("heating_system"), one_two).alias("heating_system"),
        recode.recode_groups(F.col("heating_production"), codes.HEATING_SOURCES).alias("heating_production"),
        recode.recode(F.col("hot_water_system"), one_two).alias("hot_water_system"),
        recode.bin_left_closed(F.col("surface"), codes.SURFACE_BOUNDS).alias("surface"),
        recode.recode(F.col("has_done_renov"), one_two).alias("has_done_renov"),
        F.when(F.col("has_done_renov") == 1, seeded_pick(codes.RETROFIT_YEARS, F.col("id_owner")))
        .otherwise(F.col("first_date_renov") + codes.FIRST_RETROFIT_YEAR_BASE).alias("first_date_renov"),
        recode.typed_null("string").alias("DPE_consumption"), recode.typed_null("string").alias("GES_emission"),
    )
