"""Raw tables with the columns of the source files: small, with every edge the builders must handle."""

from __future__ import annotations

import datetime
import random

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from lakestrata.plans import codes

D = datetime.date
CERTIFICATE_SCHEMA = {
    "N°DPE": "string", "Date_établissement_DPE": "date", "Année_construction": "int", "Type_bâtiment": "string",
    "Type_installation_chauffage": "string", "Type_installation_chauffage_n°1": "string",
    "Type_installation_ECS_(général)": "string", "Surface_habitable_logement": "double", "Code_postal_(BAN)": "int",
    "Type_installation_ECS": "string", "Type_énergie_principale_chauffage": "string",
    "Type_générateur_n°1_installation_n°1": "string", "Emission_GES_5_usages_par_m²": "double",
    "Conso_5_usages/m²_é_finale": "double", "Code_INSEE_(BAN)": "string", "Conso_5_usages_é_finale": "string",
    "Emission_GES_5_usages": "double", "Type_émetteur_installation_chauffage_n°1": "string",
    "Type_énergie_générateur_ECS_n°1": "string", "Qualité_isolation_enveloppe": "string",
    "Qualité_isolation_menuiseries": "string", "Qualité_isolation_murs": "string",
    "Qualité_isolation_plancher_bas": "string", "Qualité_isolation_plancher_haut_toit_terrase": "string",
    "Qualité_isolation_plancher_haut_comble_aménagé": "string", "Qualité_isolation_plancher_haut_comble_perdu": "string",
}
CERTIFICATE = {
    "N°DPE": "d0", "Date_établissement_DPE": D(2022, 3, 1), "Année_construction": 1980, "Type_bâtiment": "maison",
    "Type_installation_chauffage": "individuel", "Type_installation_chauffage_n°1": "installation individuelle",
    "Type_installation_ECS_(général)": "individuel", "Surface_habitable_logement": 80.0, "Code_postal_(BAN)": 1000,
    "Type_installation_ECS": "installation individuelle", "Type_énergie_principale_chauffage": "Gaz naturel",
    "Type_générateur_n°1_installation_n°1": "chaudière", "Emission_GES_5_usages_par_m²": 12.0,
    "Conso_5_usages/m²_é_finale": 120.0, "Code_INSEE_(BAN)": "01001", "Conso_5_usages_é_finale": "9600",
    "Emission_GES_5_usages": 900.0, "Type_émetteur_installation_chauffage_n°1": "radiateur",
    "Type_énergie_générateur_ECS_n°1": "Gaz naturel", "Qualité_isolation_enveloppe": "bonne",
    "Qualité_isolation_menuiseries": "bonne", "Qualité_isolation_murs": "insuffisante",
    "Qualité_isolation_plancher_bas": None, "Qualité_isolation_plancher_haut_toit_terrase": "moyenne",
    "Qualité_isolation_plancher_haut_comble_aménagé": "bonne", "Qualité_isolation_plancher_haut_comble_perdu": None,
}


def frame(spark: SparkSession, schema: dict[str, str], rows: list) -> DataFrame:
    ddl = StructType.fromDDL(", ".join(f"`{n}` {t}" for n, t in schema.items()))
    listed = [tuple(r.get(n) for n in schema) if isinstance(r, dict) else r for r in rows]
    return spark.createDataFrame(listed, ddl)


def certificates(spark: SparkSession, *changes: dict) -> DataFrame:
    """One certificate per dict of changed columns."""
    rows = [{**CERTIFICATE, "N°DPE": f"d{i}", **change} for i, change in enumerate(changes)]
    return frame(spark, CERTIFICATE_SCHEMA, rows)


SURVEY_COLUMNS = list(dict.fromkeys([
    *codes.OWNER_COLUMNS, "cd_postal", *codes.DWELLING_COLUMNS,
    *[q.format(n) for n in codes.WORK_TYPES for f, q in codes.WORK_QUESTIONS.items()
      if f not in codes.WORK_NOT_ASKED.get(n, ())],
    *codes.MULTI_CHOICE_COLUMNS,
]))
RESPONDENT = {
    "main_rs1": 1, "main_rs2_c": 40, "main_rs5": 1, "main_rs6": 3, "main_q100_2": 1, "main_Q1_97": 1, "main_RS102": 2,
    "main_RS182": 5, "cd_postal": 1000, "main_Q101": 1, "main_Q102": 3, "main_Q103": 1, "main_Q104": 2, "main_Q32": 9,
    "main_q41_c": 80,
}


def survey(spark: SparkSession, *respondents: dict) -> DataFrame:
    return frame(spark, {c: "int" for c in SURVEY_COLUMNS}, [{**RESPONDENT, **r} for r in respondents])


def geography(spark: SparkSession, *rows: tuple) -> DataFrame:
    """(id_municipality, postal_code, department_number)."""
    return frame(spark, {"id_municipality": "bigint", "postal_code": "string", "department_number": "int"}, list(rows))


LICENCE = {"COMM": "string", "DATE_REELLE_AUTORISATION": "date"}
CONSTRUCTION = {**LICENCE, "NB_LGT_TOT_CREES": "int"}
WEATHER = {codes.WEATHER_DEPARTMENT: "string", "Date": "timestamp", **{c: "double" for c in codes.WEATHER_COLUMNS}}
NEIGHBOURS = {"Departement": "int", **{c: "int" for c in codes.NEIGHBOUR_COLUMNS}}


def weather(spark: SparkSession, *rows: tuple) -> DataFrame:
    """(department, date, value): every measure takes the value."""
    stamped = [(d, datetime.datetime.combine(day, datetime.time(12)), *[v] * len(codes.WEATHER_COLUMNS)) for d, day, v in rows]
    return frame(spark, WEATHER, stamped)


def neighbours(spark: SparkSession, table: dict[int, list[int]]) -> DataFrame:
    width = len(codes.NEIGHBOUR_COLUMNS)
    return frame(spark, NEIGHBOURS, [(d, *(near + [None] * width)[:width]) for d, near in table.items()])


def whole_lake(spark: SparkSession, seed: int = 1) -> dict[str, DataFrame]:
    """A consistent set of all raw tables, big enough to train small models on."""
    rnd = random.Random(seed)
    departments = ["01", "02", "03", "04"]
    places = [(f"{d}{i:03d}", int(d) * 1000 + 100 * (i % 5)) for d in departments for i in range(1, 11)]
    insee = [p for p, _ in places]
    days = [D(y, m, 1) for y in range(2012, 2023) for m in (1, 5, 9)]
    energies = codes.KNOWN_ENERGY
    respondents = []
    for i in range(300):
        done = rnd.choice([1, 2])
        surface = rnd.choice([50, 90, 140])
        row = {
            "Respondent_Serial": i, "main_rs1": rnd.choice([1, 2]), "main_rs2_c": rnd.randrange(20, 80),
            "main_rs5": rnd.randrange(1, 8), "main_rs6": rnd.randrange(1, 11), "main_q100_2": rnd.choice([1, 2]),
            "main_Q1_97": done, "main_RS102": rnd.randrange(1, 6), "main_RS182": rnd.randrange(1, 10),
            "cd_postal": rnd.choice(places)[1], "main_Q101": 1 if surface > 100 else 2, "main_Q102": rnd.randrange(1, 8),
            "main_Q103": rnd.choice([1, 2]), "main_Q104": rnd.choice([1, 2]),
            "main_Q32": rnd.choice([1, 3, 6, 8, 9, 11, 12]), "main_q41_c": rnd.choice([surface, surface, None]),
            **{c: rnd.choice([0, 1, None]) for c in codes.MULTI_CHOICE_COLUMNS},
        }
        if done == 2:
            row["main_Q5_11"] = rnd.randrange(1, 4)
        respondents.append(row)
    changes = []
    for i in range(400):
        energy = rnd.choice(energies)
        use = 60.0 * (energies.index(energy) % 6) + rnd.randrange(30)
        place = rnd.choice(places)
        changes.append({
            "N°DPE": f"c{i}", "Date_établissement_DPE": D(rnd.choice([2021, 2022, 2023]), rnd.randrange(1, 13), 2),
            "Année_construction": rnd.randrange(1800, 2022), "Type_bâtiment": rnd.choice(["maison", "appartement"]),
            "Surface_habitable_logement": float(rnd.randrange(20, 200)), "Code_postal_(BAN)": place[1],
            "Type_énergie_principale_chauffage": energy, "Emission_GES_5_usages_par_m²": use / 5,
            "Conso_5_usages/m²_é_finale": use, "Code_INSEE_(BAN)": place[0],
            "Qualité_isolation_murs": rnd.choice([*codes.QUALITY_LABELS, None]),
        })
    licences = [(rnd.choice(insee), rnd.choice(days)) for _ in range(300)]
    return {
        "tremi": survey(spark, *respondents),
        "codebook": frame(
            spark, {"Name": "string", "VARNUM": "int", "LABEL": "string", **{f"_{n}": "string" for n in codes.CODEBOOK_ANSWERS}},
            [{"Name": c, "VARNUM": i, "LABEL": f"Question {c[:8]} - choice {c[-2:]}", "_1": "Oui", "_0": "Non"}
             for i, c in enumerate(codes.MULTI_CHOICE_COLUMNS)],
        ),
        "code_commune": frame(spark, {"Code_commune_INSEE": "string", "Code_postal": "int"}, places),
        "pop_commune_2016": frame(spark, {"DEPCOM": "string", "COM": "string", "PMUN": "int"},
                                  [(p, f"Town {p}", 100 + i) for i, p in enumerate(insee)]),
        "pop_commune_2020": frame(spark, {"CODDEP": "string", "CODCOM": "int", "PMUN": "int"},
                                  [(p[:2], int(p[2:]), 120 + i) for i, p in enumerate(insee)]),
        "pop_department_2016": frame(spark, {"CODDEP": "string", "DEP": "string"}, [(d, f"Dept {d}") for d in departments]),
        "former_new_region": frame(
            spark, {"Nouveau Code": "int", "Nouveau Nom": "string", "Anciens Code": "int", "Anciens Nom": "string"},
            [(10, "Bretagne", 1, "Old one"), (10, "Bretagne", 2, "Old two")]),
        "development_licence": frame(
            spark, {"REG": "int", "DEP": "string", **LICENCE},
            [(1 + int(p[:2]) % 2, p[:2], p, day) for p, day in licences] + [(1, "01", None, D(2015, 1, 1))]),
        "destruction_licence": frame(spark, LICENCE, licences[:100]),
        "construction_licence_2016": frame(spark, CONSTRUCTION, [(p, D(2014 + i % 3, 1, 1), i % 4) for i, p in enumerate(insee)]),
        "construction_licence_2023": frame(spark, CONSTRUCTION, [(p, D(2021 + i % 3, 1, 1), i % 4) for i, p in enumerate(insee)]),
        "elec": frame(
            spark, {"Année": "int", "Filière": "string", "Consommation Résidentiel  (MWh)": "double",
                    "Nombre de points Résidentiel": "int", "Code Commune": "string"},
            [(2015, "Electricité", 12.0, 4, p) for p in insee]),
        "dpe_france_2012": frame(
            spark, {"date_etablissement_dpe": "date", "classe_consommation_energie": "string",
                    "classe_estimation_ges": "string", "code_insee_commune_actualise": "string"},
            [(D(2015, 1, 1), rnd.choice("ABCDEFG"), rnd.choice("ABCDEFG"), p) for p in insee for _ in range(3)]),
        "dpe_france_2021": certificates(spark, *changes),
        "weather": weather(spark, *[(d, day, rnd.randrange(100) / 4) for d in ("01", "02") for day in days]),
        "neighbouring_dep": neighbours(spark, {1: [2], 2: [1, 3], 3: [2, 4], 4: [3]}),
        "housings": frame(spark, {"Code_commune_INSEE": "string", "houses": "int", "apartments": "int"},
                          [(p, i, 2 * i) for i, p in enumerate(insee)]),
    }
