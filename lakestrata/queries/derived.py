"""Raw tables in the shape of the source files, derived row by row from the driver tables.

Each is one ``SELECT`` of plain expressions that Spark and the oracle both read,
so the table builders run over data that grows with the driver tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from lakestrata.plans import codes
from lakestrata.queries.registry import Source


def _dept(k: str) -> str:
    return f"CASE WHEN {k} % 25 = 19 THEN '2A' ELSE lpad(CAST({k} % 25 + 1 AS STRING), 2, '0') END"


def _pad(code: str, width: int) -> str:
    text = f"CAST({code} AS STRING)"
    return f"CASE WHEN length({text}) < {width} THEN lpad({text}, {width}, '0') ELSE {text} END"


def place(k: str) -> str:
    return f"(({_dept(k)}) || ({_pad(k, 3)}))"


def postal(k: str, variant: str) -> str:
    return f"CAST(({k} % 25 + 1) * 1000 + {variant} AS INT)"


# One year for every ship year 1995-2001, spread over 2012-2022.
_SHIFT = "year(l_shipdate) + 17 + CASE WHEN l_linestatus = 'O' THEN 4 ELSE 0 END"
# Weather reaches two years behind the works and up to the certificates.
_WEATHER_YEAR = "year(o_orderdate) + 17 + CASE WHEN o_orderkey % 2 = 0 THEN 4 ELSE 0 END"
LICENCE_DATE = f"make_date(CAST({_SHIFT} AS INT), CAST(month(l_shipdate) AS INT), 1)"

_SURVEY = {
    "Respondent_Serial": "o_orderkey", "cd_postal": postal("o_custkey", "o_orderkey % 7 * 10"),
    "main_rs1": "CASE WHEN o_orderpriority <> '5-LOW' THEN 1 + o_orderkey % 2 END",
    "main_rs2_c": "CASE WHEN o_totalprice < 450000 THEN 20 + o_custkey % 60 END",
    "main_rs5": "1 + o_orderkey % 7", "main_rs6": "CASE WHEN o_orderstatus <> 'P' THEN o_custkey % 12 END",
    "main_q100_2": "1 + o_custkey % 3", "main_Q44": "1990 + o_custkey % 27",
    "main_Q1_97": "1 + (o_orderkey + o_custkey) % 2",
    "main_RS102": "CASE WHEN o_custkey % 11 = 0 THEN 99 ELSE 1 + o_custkey % 6 END",
    "main_RS182": "CASE WHEN o_orderpriority = '2-HIGH' THEN 99 ELSE 1 + o_orderkey % 11 END",
    "main_Q73": "o_custkey % 5000", "main_Q75": "o_custkey % 7000", "main_Q76": "o_orderkey % 20",
    "main_q77": "o_orderkey % 4",
    "main_Q101": "1 + o_orderkey % 3", "main_Q102": "1 + o_custkey % 7", "main_Q103": "1 + o_orderkey % 2",
    "main_Q104": "1 + o_custkey % 2",
    "main_Q32": "1 + o_custkey % 12", "main_Q34": "1 + o_orderkey % 5",
    "main_q41_c": "CASE WHEN o_orderstatus <> 'F' THEN 40 + o_custkey % 120 END",
    "main_Q43": "1 + o_custkey % 8", "main_Q52": "1 + o_orderkey % 4", "main_Q53": "1 + o_custkey % 4",
    "main_Q38": "1 + o_orderkey % 3", "main_Q39": "1 + o_custkey % 9", "main_Q40": "o_orderkey % 9",
}
for _number in codes.WORK_TYPES:
    _asked = [q for f, q in codes.WORK_QUESTIONS.items() if f not in codes.WORK_NOT_ASKED.get(_number, ())]
    for _i, _question in enumerate(_asked):
        _SURVEY[_question.format(_number)] = (
            f"CASE WHEN (o_orderkey + o_custkey * {_number}) % 9 = 0 AND (o_orderkey + o_custkey) % 2 = 1 "
            f"THEN 1 + (o_custkey + {_i}) % 3 END"
        )
for _i, _column in enumerate(codes.MULTI_CHOICE_COLUMNS):
    _SURVEY[_column] = (
        f"CASE (o_custkey + {_i + 1} * o_orderkey) % 5 WHEN 0 THEN 1 WHEN 4 THEN NULL ELSE 0 END"
    )


def _select(columns: dict[str, str], rest: str) -> str:
    return "SELECT " + ", ".join(f"{expr} AS {name}" for name, expr in columns.items()) + f" {rest}"


_SURVEY_SELECT = _select({c: f"CAST({e} AS INT)" for c, e in _SURVEY.items()}, "FROM {orders}")

# (column name in the file, plain name in SQL) of the certificate columns that are read.
CERTIFICATE_COLUMNS = {
    "N°DPE": "number", "Date_établissement_DPE": "made_on", "Année_construction": "built",
    "Type_bâtiment": "building", "Type_installation_chauffage": "heating",
    "Type_installation_chauffage_n°1": "heating_1", "Type_installation_ECS_(général)": "water",
    "Surface_habitable_logement": "area", "Code_postal_(BAN)": "postal", "Type_installation_ECS": "water_1",
    "Type_énergie_principale_chauffage": "energy", "Type_générateur_n°1_installation_n°1": "generator",
    "Emission_GES_5_usages_par_m²": "ges", "Conso_5_usages/m²_é_finale": "conso", "Code_INSEE_(BAN)": "insee",
    "Conso_5_usages_é_finale": "conso_total", "Emission_GES_5_usages": "ges_total",
    "Type_émetteur_installation_chauffage_n°1": "emitter", "Type_énergie_générateur_ECS_n°1": "water_energy",
    "Qualité_isolation_enveloppe": "q_shell", "Qualité_isolation_menuiseries": "q_carpentry",
    "Qualité_isolation_murs": "q_walls", "Qualité_isolation_plancher_bas": "q_floor",
    "Qualité_isolation_plancher_haut_toit_terrase": "q_terrace",
    "Qualité_isolation_plancher_haut_comble_aménagé": "q_attic",
    "Qualité_isolation_plancher_haut_comble_perdu": "q_unused",
}


def _quality(number: str) -> str:
    labels = " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(codes.QUALITY_LABELS))
    return f"CASE {number} % 7 {labels} WHEN 4 THEN 'inconnue' WHEN 5 THEN '2' END"


_ENERGIES = " ".join(
    f"WHEN {i} THEN '{name.replace(chr(39), chr(39) * 2)}'" for i, name in enumerate([*codes.KNOWN_ENERGY, "Solaire"])
)
_ENERGY_COUNT = len(codes.KNOWN_ENERGY) + 1
_CERTIFICATES = _select({
    "number": "CAST(l_orderkey AS STRING) || '-' || CAST(l_partkey AS STRING) || '-' || CAST(l_suppkey AS STRING)"
              " || '-' || CAST(l_linenumber AS STRING)",
    "made_on": "make_date(CAST(year(l_shipdate) + 22 AS INT), CAST(month(l_shipdate) AS INT), 3)",
    "built": "CAST(1690 + l_partkey % 340 AS INT)",
    "building": "CASE WHEN l_returnflag = 'R' THEN 'maison' WHEN l_linenumber = 7 THEN 'immeuble' ELSE 'appartement' END",
    "heating": "CASE WHEN l_tax < 0.03 THEN 'individuel' WHEN l_tax < 0.06 THEN 'collectif' ELSE 'mixte' END",
    "heating_1": "CASE WHEN l_quantity = 50 THEN '12.5' WHEN l_linestatus = 'O' THEN 'installation individuelle' "
                 "ELSE 'installation collective' END",
    "water": "CASE WHEN l_discount < 0.04 THEN 'individuel' WHEN l_discount < 0.08 THEN 'collectif' END",
    "area": "CASE WHEN l_quantity > 1 THEN l_quantity * 3 END", "postal": postal("l_suppkey", "l_suppkey % 7 * 10"),
    "water_1": "CASE WHEN l_linestatus = 'F' THEN 'installation individuelle' ELSE 'autre' END",
    "energy": f"CASE l_partkey % {_ENERGY_COUNT} {_ENERGIES} END",
    "generator": "CASE l_linenumber WHEN 1 THEN 'PAC air/eau' WHEN 2 THEN 'une pompe à chaleur' WHEN 3 THEN NULL "
                 "ELSE 'chaudière' END",
    "ges": "l_tax * 100 * 5", "conso": "l_quantity * 10 + l_linenumber * 30", "insee": place("l_suppkey"),
    "conso_total": "CASE WHEN l_quantity = 49 THEN 'x' ELSE '120.5' END", "ges_total": "l_quantity",
    "emitter": "'radiateur'", "water_energy": f"CASE l_orderkey % {_ENERGY_COUNT} {_ENERGIES} END",
    "q_shell": _quality("l_orderkey"), "q_carpentry": _quality("l_partkey"),
    "q_walls": _quality("(l_orderkey + l_linenumber)"), "q_floor": _quality("(l_partkey + l_linenumber)"),
    "q_terrace": _quality("(l_orderkey + l_partkey)"), "q_attic": _quality("(l_suppkey + l_partkey)"),
    "q_unused": _quality("(l_suppkey + l_orderkey)"),
}, "FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_quantity, l_discount, l_tax,"
   " l_returnflag, l_linestatus FROM {lineitem})")


def _licence(flag: str, columns: str = "") -> str:
    return f"SELECT {place('l_suppkey')} AS comm, {LICENCE_DATE} AS day{columns} FROM {{lineitem}} WHERE {flag}"


_DWELLINGS = ", CASE WHEN l_quantity <> 13 THEN CAST(floor(l_quantity) AS INT) END AS dwellings"

# A ring region by region: the departments of the region without stations lie side by side.
_POSITION = "({n}.n_regionkey * 5 + floor({n}.n_nationkey / 5))"
_RING = " UNION ALL ".join(
    "SELECT a.n_nationkey AS src, b.n_nationkey AS dst FROM {nation} a JOIN {nation} b "
    f"ON {_POSITION.format(n='b')} = ({_POSITION.format(n='a')} + {step}) % 25" for step in (1, 24)
)

RAW_SQL: dict[str, str] = {
    "survey": f"SELECT * FROM ({_SURVEY_SELECT}) AS s UNION ALL SELECT * FROM ({_SURVEY_SELECT} WHERE o_orderstatus = 'P') AS r",
    "certificates": _CERTIFICATES,
    "code_commune": f"SELECT {place('s_suppkey')} AS insee, {postal('s_suppkey', 's_suppkey % 7 * 10')} AS postal "
                    "FROM {supplier} UNION ALL "
                    f"SELECT {place('s_suppkey')}, {postal('s_suppkey', '500')} FROM {{supplier}} WHERE s_acctbal > 5000",
    "pop_commune_2016": f"SELECT {place('s_suppkey')} AS insee, s_name AS name, CAST(100 + s_suppkey * 7 AS INT) AS people "
                        "FROM {supplier} WHERE s_acctbal < 9000",
    "pop_commune_2020": f"SELECT {_dept('s_suppkey')} AS dept, CAST(s_suppkey AS INT) AS number, "
                        "CAST(120 + s_suppkey * 7 AS INT) AS people FROM {supplier}",
    "pop_department_2016": f"SELECT {_dept('n_nationkey')} AS dept, n_name AS name FROM {{nation}}",
    "former_new_region": "SELECT r_regionkey + 20 AS new_code, CASE WHEN r_name = 'ASIA' THEN 'Bretagne' ELSE r_name END "
                         "AS new_name, r_regionkey AS old_code, r_name || ' A' AS old_name FROM {region} UNION ALL "
                         "SELECT r_regionkey + 20, CASE WHEN r_name = 'ASIA' THEN 'Bretagne' ELSE r_name END, "
                         "r_regionkey + 5, r_name || ' B' FROM {region}",
    "development_licence": _licence(
        "l_returnflag = 'R'", f", CAST(l_suppkey % 25 % 10 AS INT) AS region, {_dept('l_suppkey')} AS dept"),
    "destruction_licence": _licence("l_returnflag = 'A' AND l_tax > 0.05"),
    "construction_licence_2016": _licence("l_returnflag = 'A'", _DWELLINGS),
    "construction_licence_2023": _licence("l_returnflag = 'N'", _DWELLINGS),
    "elec": f"SELECT {place('l_suppkey')} AS insee, CAST({_SHIFT} AS INT) AS year, "
            "CASE WHEN l_linenumber < 6 THEN 'Electricité' ELSE 'Gaz' END AS kind, "
            "CAST(floor(l_extendedprice) AS DOUBLE) AS used, CAST(floor(l_quantity - 1) AS INT) AS points FROM {lineitem}",
    "dpe_france_2012": f"SELECT {place('l_suppkey')} AS insee, {LICENCE_DATE} AS day, "
                       "substr('ABCDEFGNZ', CAST(l_linenumber + 2 AS INT), 1) AS energy, "
                       "substr('ABCDEFGN', CAST(l_linenumber AS INT), 1) AS gas FROM {lineitem}",
    "weather": "SELECT CASE WHEN c_nationkey = 20 THEN '2A' ELSE CAST(c_nationkey + 1 AS STRING) END AS dept, "
               f"make_date(CAST({_WEATHER_YEAR} AS INT), CAST(month(o_orderdate) AS INT), 1) AS day, "
               "CAST(o_custkey % 360 AS DOUBLE) AS wind_direction, CAST(o_orderkey % 20 AS DOUBLE) AS wind_speed, "
               "CAST(270 + o_custkey % 30 AS DOUBLE) AS temp_kelvin, CAST(40 + o_orderkey % 60 AS DOUBLE) AS humidity, "
               "CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderkey % 2000 AS DOUBLE) END AS heigh_clouds, "
               "CAST(o_custkey % 30 AS DOUBLE) AS temp_degree, CAST(c_nationkey * 10 AS DOUBLE) AS altitude "
               "FROM {orders} JOIN {customer} ON o_custkey = c_custkey JOIN {nation} ON c_nationkey = n_nationkey "
               "WHERE n_regionkey <> 2",
    "neighbours": "SELECT CAST(src + 1 AS INT) AS src, CAST(dst + 1 AS INT) AS dst FROM (" + _RING + ") AS ring",
    "housings": f"SELECT {place('s_suppkey')} AS insee, CAST(s_suppkey % 90 AS INT) AS houses, "
                "CAST(s_suppkey % 70 AS INT) AS apartments FROM {supplier} WHERE s_acctbal > 0",
}

# Names of the columns in the source files, in the order of the SELECT lists above.
FILE_COLUMNS: dict[str, list[str]] = {
    "certificates": [next(f for f, plain in CERTIFICATE_COLUMNS.items() if plain == name) for name in (
        "number", "made_on", "built", "building", "heating", "heating_1", "water", "area", "postal", "water_1",
        "energy", "generator", "ges", "conso", "insee", "conso_total", "ges_total", "emitter", "water_energy",
        "q_shell", "q_carpentry", "q_walls", "q_floor", "q_terrace", "q_attic", "q_unused")],
    "code_commune": ["Code_commune_INSEE", "Code_postal"],
    "pop_commune_2016": ["DEPCOM", "COM", "PMUN"],
    "pop_commune_2020": ["CODDEP", "CODCOM", "PMUN"],
    "pop_department_2016": ["CODDEP", "DEP"],
    "former_new_region": ["Nouveau Code", "Nouveau Nom", "Anciens Code", "Anciens Nom"],
    "development_licence": ["COMM", "DATE_REELLE_AUTORISATION", "REG", "DEP"],
    "destruction_licence": ["COMM", "DATE_REELLE_AUTORISATION"],
    "construction_licence_2016": ["COMM", "DATE_REELLE_AUTORISATION", "NB_LGT_TOT_CREES"],
    "construction_licence_2023": ["COMM", "DATE_REELLE_AUTORISATION", "NB_LGT_TOT_CREES"],
    "elec": ["Code Commune", "Année", "Filière", "Consommation Résidentiel  (MWh)", "Nombre de points Résidentiel"],
    "dpe_france_2012": [
        "code_insee_commune_actualise", "date_etablissement_dpe", "classe_consommation_energie", "classe_estimation_ges",
    ],
    "weather": [codes.WEATHER_DEPARTMENT, "Date", *codes.WEATHER_COLUMNS],
    "housings": ["Code_commune_INSEE", "houses", "apartments"],
}

_TABLES = ("orders", "customer", "lineitem", "supplier", "nation", "region")


def raw(src: Source, name: str) -> DataFrame:
    """The derived raw table with the column names of the source file."""
    sql = RAW_SQL[name]
    df = src.spark.sql(sql, **{t: getattr(src, t) for t in _TABLES if f"{{{t}}}" in sql})
    return df.toDF(*FILE_COLUMNS[name]) if name in FILE_COLUMNS else df


def oracle(body: str, *names: str) -> str:
    """Oracle SQL over the derived raw tables it names."""
    ctes = ", ".join(f"raw_{n} AS ({RAW_SQL[n].format(**{t: t for t in _TABLES})})" for n in names)
    return f"WITH {ctes}{body}" if body.startswith(",") else f"WITH {ctes} {body}"
