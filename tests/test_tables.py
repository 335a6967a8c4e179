"""Table builders on hand-made rows, with the expected rows written out."""

from __future__ import annotations

from datetime import date as D

import fixtures as fx
import pytest
from pyspark.sql import functions as F

from lakestrata.plans import codes, gold, intermediate, model, silver


def dicts(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_dictionary_collapses_yes_no_questions(spark):
    schema = {"Name": "string", "VARNUM": "int", "LABEL": "string", **{f"_{n}": "string" for n in codes.CODEBOOK_ANSWERS}}
    yes_no = {"_1": "Oui", "_0": "Non", "_99": "NSP"}
    book = fx.frame(spark, schema, [
        {"Name": "main_q2_1", "VARNUM": 1, "LABEL": "Why - comfort", **yes_no},
        {"Name": "main_q2_2", "VARNUM": 2, "LABEL": "Why - cost - rent", **yes_no},
        {"Name": "f_3", "VARNUM": 3, "LABEL": "Variable filtre - x", "_1": "Oui"},
        {"Name": "main_rs1", "VARNUM": 4, "LABEL": "Sex", "_1": "M", "_2": "F"},
        {"Name": "main_q9_1", "VARNUM": 5, "LABEL": "How - often", "_1": "a", "_2": "b", "_3": "c", "_4": "d", "_5": "e"},
    ])
    got = intermediate.answer_dictionary(book)
    assert dicts(got, "column_name", "answer_char", "answer_number", "question") == [
        ("f_3", "Oui", "1", "Variable filtre - x"),
        ("main_q2_1", "comfort", "1", "Why"), ("main_q2_2", "cost - rent", "2", "Why - cost"),
        *[("main_q9_1", a, str(i), "How - often") for i, a in enumerate("abcde", start=1)],
        ("main_rs1", "F", "2", "Sex"), ("main_rs1", "M", "1", "Sex"),
    ]
    ticked = fx.survey(spark, {"Respondent_Serial": 1, "main_q2_1": 1, "main_q2_2": 0, "main_q3_1": 1},
                       {"Respondent_Serial": 2, "main_q2_2": 1, "main_q2_1": None})
    pairs = intermediate.answers(ticked, got).join(got, ["id_answer"])
    # main_q3_1 is not in the code book: no orphan answer.
    assert dicts(pairs, "id_owner", "column_name") == [(1, "main_q2_1"), (2, "main_q2_2")]


def test_works_of_a_respondent(spark):
    answers = fx.survey(
        spark, {"Respondent_Serial": 1},
        {"Respondent_Serial": 2, "main_Q5_41": 2, "main_Q6_41": 3},
        {"Respondent_Serial": 3, "main_Q5_11": 1, "main_Q18_11": 7, "main_Q20_11": 900, "main_Q5_56": 2, "main_Q5_21": 3},
    )
    got = intermediate.works_raw(answers.union(answers))
    assert dicts(got, "id_owner", "work_type", "work_type_number", "start_date", "end_date", "done_by", "amount") == [
        (2, "opening_common_areas", 41, 2, 3, None, None),
        (3, "air_consitioning_system", 56, 2, None, None, None),
        (3, "ext_wall_with_insulation", 21, 3, None, None, None),
        (3, "roof_with_insulation", 11, 1, None, 7, 900),
    ]
    assert sorted(r.id_renov for r in got.collect()) == [0, 1, 2, 3]


def test_housing_raw_restores_the_postal_code(spark):
    got = intermediate.housing_raw(fx.survey(spark, {"Respondent_Serial": 1}, {"Respondent_Serial": 2, "cd_postal": 75001}))
    assert dicts(got, "id_owner", "postal_code", "surface") == [(1, "01000", 80), (2, "75001", 80)]


def test_owners_clean(spark):
    answers = fx.survey(
        spark, {"Respondent_Serial": 1}, {"Respondent_Serial": 1}, {"Respondent_Serial": 2, "main_RS182": 10},
        {"Respondent_Serial": 3, "main_RS182": None}, {"Respondent_Serial": 4, "main_RS102": 99},
        {"Respondent_Serial": 5, "main_rs2_c": None}, {"Respondent_Serial": 6, "main_Q101": 3},
        {"Respondent_Serial": 7, "main_rs6": 11, "main_rs1": None, "main_q100_2": 2, "main_Q1_97": None},
        {"Respondent_Serial": 8, "main_rs5": 5, "main_Q101": 2},
    )
    got = silver.owners_clean(intermediate.owners_raw(answers), intermediate.housing_raw(answers))
    assert dicts(got, "id_owner", "gender", "occupation", "home_state", "has_done_renov") == [
        (1, 0, 8, 0, 0), (7, 1, -1, 1, 1), (8, 0, 3, 0, 0)]


def profile_of(spark, **changes):
    tables = {
        "code_commune": fx.frame(spark, {"Code_commune_INSEE": "string", "Code_postal": "int"},
                                 [("01001", 1000), ("01001", 1010), ("01002", 1000), ("2A004", 20000), ("01001", 1000)]),
        "pop_commune_2016": fx.frame(spark, {"DEPCOM": "string", "COM": "string", "PMUN": "int"},
                                     [("01001", "Ay", 10), ("01002", "Be", 20), ("2A004", "Co", 30)]),
        "pop_department_2016": fx.frame(spark, {"CODDEP": "string", "DEP": "string"}, [("01", "Ain"), ("2A", "Corse")]),
        "former_new_region": fx.frame(
            spark, {"Nouveau Code": "int", "Nouveau Nom": "string", "Anciens Code": "int", "Anciens Nom": "string"},
            [(53, "Bretagne", 1, "Old")]),
        "development_licence": fx.frame(spark, {"REG": "int", "DEP": "string", **fx.LICENCE}, [
            (1, "01", "01001", D(2017, 1, 1)), (1, "01", "01001", D(2017, 1, 2)), (1, "2A", None, D(2015, 1, 1))]),
        "construction_licence_2016": fx.frame(spark, fx.CONSTRUCTION, [
            ("01001", D(2014, 1, 1), 3), ("01001", D(2015, 1, 1), None), ("01001", D(2013, 12, 31), 9)]),
        "destruction_licence": fx.frame(spark, fx.LICENCE, [("01002", D(2016, 6, 1))]),
        "elec": fx.frame(
            spark, {"Année": "int", "Filière": "string", "Consommation Résidentiel  (MWh)": "double",
                    "Nombre de points Résidentiel": "int", "Code Commune": "string"},
            [(2015, "Electricité", 10.0, 3, "01001"), (2015, "Electricité", 10.0, 0, "01001"),
             (2015, "Gaz", 99.0, 1, "01001"), (2017, "Electricité", 99.0, 1, "01001")]),
        "dpe_france_2012": fx.frame(
            spark, {"date_etablissement_dpe": "date", "classe_consommation_energie": "string",
                    "classe_estimation_ges": "string", "code_insee_commune_actualise": "string"},
            [(D(2015, 1, 1), "A", "B", "01001"), (D(2015, 1, 1), "C", "Z", "01001"), (D(2015, 1, 1), "N", "A", "01001"),
             (D(2013, 1, 1), "G", "G", "01001")]),
        **changes,
    }
    return intermediate.municipality_profile(**tables)


def test_municipality_profile(spark):
    got = profile_of(spark)
    assert dicts(got, "insee_code", "postal_code", "department_number", "n_development_licence",
                 "n_construction_licence", "n_destruction_licence", "n_dpe", "avg_dpe", "avg_ges",
                 "consumption_by_residence") == [
        ("01001", "01000", "01", 1, 3, 0, 2, 2.0, 1.0, 3.33), ("01001", "01010", "01", 1, 3, 0, 2, 2.0, 1.0, 3.33),
        ("01002", "01000", "01", 0, 0, 1, 0, None, None, None), ("2A004", "20000", "2A", 0, 0, 0, 0, None, None, None)]
    area = silver.postal_geography(got)
    assert dicts(area, "postal_code", "department_number", "new_region_name") == [
        ("01000", 1, "Bretagne"), ("01010", 1, "Bretagne")]
    housings = fx.frame(spark, {"Code_commune_INSEE": "string", "houses": "int", "apartments": "int"},
                        [("01001", 5, 6), ("2A004", 1, 1)])
    # One row per postal code collapses: the gold table has no postal code.
    assert dicts(gold.gold_municipality(got, housings), "insee_code", "new_region_name", "n_houses", "n_apartments") == [
        ("01001", "BZH", 5, 6)]


def test_weather_monthly_fills_one_hop_only(spark):
    got = intermediate.weather_monthly(
        fx.weather(spark, ("1", D(2020, 1, 5), 1.0), ("1", D(2020, 1, 6), 2.005), ("2A", D(2020, 1, 1), 7.0),
                   (None, D(2020, 1, 1), 9.0)),
        fx.neighbours(spark, {1: [2], 2: [1, 3], 3: [2]}),
    )
    assert dicts(got, "department_number", "year", "month", "humidity", "altitude") == [
        ("01", 2020, 1, 1.5, 1.5), ("02", 2020, 1, 1.5, 1.5), ("2A", 2020, 1, 7.0, 7.0)]


def test_weather_yearly_reaches_every_connected_department(spark):
    got = silver.weather_yearly(
        fx.weather(spark, ("01", D(2020, 1, 5), 1.25), ("01", D(2023, 1, 5), 8.0), ("2A", D(2020, 1, 1), 7.0),
                   ("97", D(2020, 1, 1), 7.0), ("05", D(2020, 1, 1), None), ("06", D(2020, 2, 1), 3.0)),
        fx.neighbours(spark, {1: [2], 2: [1, 3], 3: [2, 6], 4: [8], 5: [6], 6: [3, 5], 8: [4]}),
    )
    # 02 and 03 are one hop from an observed department, 05 had a null measure; 04 and 08 only see each other.
    assert dicts(got, "department_number", "year", "humidity") == [
        ("01", 2020, 1.25), ("02", 2020, 1.25), ("03", 2020, 3.0), ("05", 2020, 3.0), ("06", 2020, 3.0)]


def test_municipality_year_facts(spark):
    places = fx.frame(spark, {"Code_commune_INSEE": "string", "Code_postal": "int"},
                      [("01004", 1000), ("01004", 1010), ("01045", 1000), ("2A456", 20000)])
    old = fx.frame(spark, {"DEPCOM": "string", "COM": "string", "PMUN": "int"}, [("01004", "a", 10), ("01045", "b", 20)])
    new = fx.frame(spark, {"CODDEP": "string", "CODCOM": "int", "PMUN": "int"}, [("01", 4, 11), ("01", 45, 22), ("2A", 456, 9)])
    built_old = fx.frame(spark, fx.CONSTRUCTION, [("01004", D(2014, 5, 1), 3), ("01004", D(2014, 6, 1), None), ("01045", D(2016, 1, 1), 1)])
    built_new = fx.frame(spark, fx.CONSTRUCTION, [("01045", D(2016, 2, 1), 5), ("01004", D(2023, 1, 1), 7)])
    gone = fx.frame(spark, fx.LICENCE, [("01045", D(2014, 1, 1)), (None, D(2014, 1, 1))])
    grown = fx.frame(spark, fx.LICENCE, [("01004", D(2022, 1, 1))])
    area = fx.geography(spark, (7, "01000", 1), (8, "01010", 1))

    def facts(**kw):
        got = silver.municipality_year_facts(old, new, places, built_old, built_new, gone, grown, area, **kw)
        return {(r.id_municipality, r.year): r for r in got.collect()}

    rows = facts()
    assert sorted(rows) == [(i, y) for i in (7, 8) for y in range(2012, 2023)]
    # 01004 counts in both of its postal codes.
    assert rows[7, 2012].population == 30 and rows[8, 2012].population == 10 and rows[7, 2020].population == 33
    r = rows[7, 2014]
    assert (r.n_construction_licence, r.n_new_buildings, r.n_destruction_licence, r.n_development_licence) == (1, 3, 1, 0)
    assert rows[8, 2022].n_development_licence == 1 and rows[7, 2013].n_new_buildings == 0
    # 2016 is in both construction files: 01045 comes twice, unless the vintages are merged.
    assert rows[7, 2016].population == 50 and rows[7, 2016].n_new_buildings == 6
    assert facts(merge_vintages=True)[7, 2016].population == 30


BOUNDS = [
    ("Année_construction", [1948, 1949, 1974, 1975, 1982, 1990, 2001, 2012], "construction_date", [1, 2, 2, 3, 4, 5, 6, 7]),
    ("Surface_habitable_logement", [69.9, 70.0, 114.9, 115.0], "surface", [1, 2, 2, 3]),
    ("Conso_5_usages/m²_é_finale", [50.0, 50.1, 90.0, 150.0, 230.0, 330.0, 450.0, 450.1], "DPE_consumption", [0, 1, 1, 2, 3, 4, 5, 6]),
    ("Emission_GES_5_usages_par_m²", [5.0, 5.1, 10.0, 20.0, 35.0, 55.0, 80.0, 80.1], "GES_emission", [0, 1, 1, 2, 3, 4, 5, 6]),
    ("Type_énergie_principale_chauffage", ["Gaz naturel", "GPL", "Charbon", "Réseau de Froid Urbain", "Électricité"],
     "heating_production", [1, 2, 3, 4, 6]),
    ("Date_établissement_DPE", [D(2014, 1, 2), D(2023, 12, 31), D(2022, 1, 1)], "dpe_date", [2014, 2022, 2022]),
]


@pytest.mark.parametrize("column,inputs,output,expected", BOUNDS, ids=[b[2] for b in BOUNDS])
def test_certificate_class_bounds(spark, column, inputs, output, expected):
    got = silver.certificates_clean(fx.certificates(spark, *[{column: v} for v in inputs]), fx.geography(spark, (1, "01000", 1)))
    assert {r.id_dpe: r[output] for r in got.collect()} == {f"d{i}": e for i, e in enumerate(expected)}


def test_certificate_fallbacks_and_heat_pumps(spark):
    got = silver.certificates_clean(fx.certificates(
        spark,
        {"Type_installation_chauffage": "mixte", "Type_installation_ECS_(général)": None},
        {"Type_installation_chauffage": None, "Type_installation_chauffage_n°1": "autre", "Type_installation_ECS": "autre",
         "Type_installation_ECS_(général)": "mixte"},
        {"Type_installation_chauffage": "collectif", "Type_bâtiment": "appartement",
         "Type_énergie_principale_chauffage": "Électricité", "Type_générateur_n°1_installation_n°1": "PAC air/air"},
    ), fx.geography(spark, (1, "01000", 1)))
    assert dicts(got, "id_dpe", "heating_system", "hot_water_system", "type", "heating_production") == [
        ("d0", 0, 0, 0, 1), ("d1", 1, 1, 0, 1), ("d2", 1, 0, 1, 5)]


REJECTED = [
    {"Type_installation_chauffage_n°1": "12.5"}, {"Type_installation_chauffage_n°1": None, "Type_bâtiment": "immeuble"},
    {"Conso_5_usages_é_finale": "text"}, {"Type_énergie_principale_chauffage": "Solaire"},
    {"Type_énergie_générateur_ECS_n°1": None}, {"Surface_habitable_logement": None}, {"Année_construction": 1700},
    {"Année_construction": 2024}, {"Date_établissement_DPE": D(2014, 1, 1)}, {"Date_établissement_DPE": D(2024, 1, 1)},
    {"Emission_GES_5_usages_par_m²": 200.0}, {"Conso_5_usages/m²_é_finale": 700.0}, {"Code_INSEE_(BAN)": None},
    {"Emission_GES_5_usages_par_m²": None}, {"Code_postal_(BAN)": 2000},
]


def test_certificate_gate_rejects(spark):
    kept = {"Type_installation_chauffage_n°1": None}
    got = silver.certificates_clean(fx.certificates(spark, kept, *REJECTED), fx.geography(spark, (1, "01000", 1)))
    assert [r.id_dpe for r in got.collect()] == ["d0"]


def test_housing_clean(spark):
    answers = fx.survey(
        spark, {"Respondent_Serial": 1}, {"Respondent_Serial": 2, "main_Q1_97": 2, "main_Q5_11": 3, "main_Q5_21": 2},
        {"Respondent_Serial": 3, "main_Q101": 3}, {"Respondent_Serial": 4, "main_Q32": 12, "main_q41_c": None, "main_Q103": 3},
        {"Respondent_Serial": 5, "cd_postal": 99000}, {"Respondent_Serial": 6, "main_RS182": 99},
    )
    got = silver.housing_clean(
        intermediate.housing_raw(answers), intermediate.owners_raw(answers), intermediate.works_raw(answers),
        fx.geography(spark, (1, "01000", 1)),
    )
    rows = {r.id_owner: r for r in got.collect()}
    assert sorted(rows) == [1, 2, 4]
    assert rows[1].first_date_renov in codes.RETROFIT_YEARS and rows[1].has_done_renov == 0
    assert rows[2].first_date_renov == 2015 and rows[2].has_done_renov == 1
    assert (rows[1].heating_production, rows[1].surface, rows[1].hot_water_system) == (1, 2, 1)
    assert (rows[4].heating_production, rows[4].surface, rows[4].heating_system) == (None, None, None)
    assert {r.id_owner: r.first_date_renov for r in got.repartition(3).collect()} == {
        k: r.first_date_renov for k, r in rows.items()}


FACTS = {"year": "int", **{m: "bigint" for m in silver.FACT_MEASURES}, "id_municipality": "bigint"}


def test_scoring_set_needs_three_years_of_weather(spark):
    area = fx.geography(spark, (1, "01000", 1), (2, "02000", 2))
    certificates = silver.certificates_clean(fx.certificates(
        spark, {}, {"Code_postal_(BAN)": 2000}, {"Date_établissement_DPE": D(2021, 1, 1)}), area)
    facts = fx.frame(spark, FACTS, [(y, 100 + y, 1, 2, 3, 4, i) for y in (2021, 2022) for i in (1, 2)])
    weather = fx.frame(
        spark, {"department_number": "string", "year": "int", "wind_speed": "double", "humidity": "double", "temp_degree": "double"},
        [("01", y, y - 2000.0, y - 1000.0, 1.0) for y in (2020, 2021, 2022)] + [("02", y, 1.0, 1.0, 1.0) for y in (2020, 2022)])
    got = model.retrofit_scoring(certificates, facts, area, weather)
    assert dicts(got, "id_dpe", "wind_speed_0", "wind_speed_1", "wind_speed_2", "humidity_2", "population",
                 "department_number", "DPE_consumption") == [("d0", 22.0, 21.0, 20.0, 1020.0, 2122, 1, 2)]
    assert got.columns == ["id_dpe", *codes.RETROFIT_FEATURES, "has_to_renov"]


def test_gold_flags_and_segments(spark):
    towns = fx.frame(spark, {"insee_code": "string", "id_municipality": "bigint"}, [("01001", 4)])
    raw = fx.certificates(
        spark, {}, {"Qualité_isolation_plancher_haut_toit_terrase": "insuffisante",
                    "Qualité_isolation_plancher_haut_comble_aménagé": "moyenne",
                    "Qualité_isolation_menuiseries": "inconnue"},
        {"Code_INSEE_(BAN)": "99999"}, {})
    scores = fx.frame(
        spark, {"id_dpe": "string", "surface": "int", "construction_date": "int", "heating_production": "int",
                "DPE_consumption": "int", "GES_emission": "int", "has_to_renov": "int"},
        [("d0", 1, 1, 2, 0, 0, 1), ("d1", 3, 9, 1, 3, 3, 0), ("d2", 1, 1, 1, 1, 1, 1)])
    scored = gold.scored_certificates(raw, scores, towns)
    # d0: walls poor, ceiling mean 2.5 -> 2; d1: ceiling mean 1.5 -> 1; d2 has no known town; d3 has no score.
    assert dicts(gold.gold_retrofit(scored), "id_dpe", "id_municipality", "renov_type") == [
        ("d0", 4, "plafond"), ("d0", 4, "toiture"), ("d0", 4, "énergie")]
    assert dicts(gold.gold_segments(scored), "type", "construction_date", "heating_production", "surface",
                 "DPE_consumption", "has_to_renov", "count") == [
        ("maison", "9", "Gaz", ">115 m²", "D", 0, 1), ("maison", "<1948", "fioul, GPL, propane, butane", "<70 m²", "A", 1, 1)]
    assert gold.gold_segments(scored).agg(F.sum("count")).first()[0] == scored.count() == 2
