"""The table builders over raw tables derived from the driver tables.

Minted ids are arbitrary by nature: they are dropped, or shown as the natural
key they stand for, before the comparison. A table that several others read is
stored once, as the layer run does by writing it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestrata.plans import codes, gold, intermediate, model, raw as raw_layer, run, silver
from lakestrata.queries.derived import oracle, raw
from lakestrata.queries.registry import Source, query
from lakestrata.session import cut_lineage, shared_folder
from lakestrata.sources.files import Lake


def _rounded(value: str) -> str:
    """Half-up on the decimal digits of the double."""
    return f"CAST(round(CAST(CAST({value} AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE)"


def _pad5(code: str) -> str:
    return f"CASE WHEN length({code}::VARCHAR) < 5 THEN lpad({code}::VARCHAR, 5, '0') ELSE {code}::VARCHAR END"


def _bins(value: str, bounds: list[int], closed: str, first: int) -> str:
    """CASE for class bounds; ``closed`` is the comparison that keeps a value in the class below the bound."""
    cases = " ".join(f"WHEN {value} {closed} {b} THEN {first + i}" for i, b in enumerate(bounds))
    return f"CASE WHEN {value} IS NULL THEN NULL {cases} ELSE {first + len(bounds)} END"


def _in(values) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


# --- survey ------------------------------------------------------------------------------------

_OWNER_SQL = "SELECT DISTINCT " + ", ".join(f"{c} AS {n}" for c, n in codes.OWNER_COLUMNS.items()) + " FROM raw_survey"


@query("table_owners_raw", oracle(_OWNER_SQL, "survey"))
def owners_raw(src: Source) -> DataFrame:
    return intermediate.owners_raw(raw(src, "survey"))


_HOUSING_SQL = (
    f"SELECT DISTINCT Respondent_Serial AS id_owner, {_pad5('cd_postal')} AS postal_code, "
    + ", ".join(f"{c} AS {n}" for c, n in codes.DWELLING_COLUMNS.items()) + " FROM raw_survey"
)


@query("table_housing_raw", oracle(_HOUSING_SQL, "survey"))
def housing_raw(src: Source) -> DataFrame:
    return intermediate.housing_raw(raw(src, "survey")).drop("id_housing")


def _work(number: int, name: str) -> str:
    absent = codes.WORK_NOT_ASKED.get(number, ())
    fields = ", ".join(
        f"NULL::INTEGER AS {field}" if field in absent else f"{question.format(number)} AS {field}"
        for field, question in codes.WORK_QUESTIONS.items()
    )
    return f"SELECT Respondent_Serial AS id_owner, '{name}' AS work_type, {number} AS work_type_number, {fields} FROM raw_survey"


_WORKS_SQL = "SELECT DISTINCT * FROM (" + " UNION ALL ".join(
    _work(number, name) for number, name in codes.WORK_TYPES.items()
) + ") WHERE start_date IS NOT NULL"


@query("table_works_raw", oracle(_WORKS_SQL, "survey"))
def works_raw(src: Source) -> DataFrame:
    return intermediate.works_raw(raw(src, "survey")).drop("id_renov")


def _book(parts: DataFrame) -> DataFrame:
    """Variables (name, varnum, n, answer, label) as a wide code book with n answers each."""
    return parts.select(
        F.col("name").alias("Name"), F.col("varnum").alias("VARNUM"), F.col("label").alias("LABEL"),
        *[F.when(F.col("n") > i, F.col("answer")).alias(f"_{n}") for i, n in enumerate(codes.CODEBOOK_ANSWERS)],
    )


_NAMES = {i: c for i, c in enumerate(codes.MULTI_CHOICE_COLUMNS, start=1)}
_LABEL = """CASE p_type WHEN 'ECONOMY' THEN p_name WHEN 'SMALL' THEN 'Variable filtre - ' || p_name
            ELSE p_type || ' - ' || p_name || ' - ' || p_brand END"""
_PICK = "CASE {} " + " ".join(f"WHEN {i} THEN '{c}'" for i, c in _NAMES.items()) + " END"
# Both engines read these: a variable per part, and a variable per part size.
_PART_BOOK = f"""SELECT {_PICK.format(f'p_partkey % {len(_NAMES)} + 1')} AS name, p_partkey AS varnum, p_size % 8 AS n,
                 'answer ' || p_type AS answer, {_LABEL} AS label FROM {{part}}"""
_SIZE_BOOK = f"""SELECT {_PICK.format('p_size')} AS name, p_size AS varnum, p_size % 8 AS n,
                 'answer ' || min(p_type) AS answer, min({_LABEL}) AS label FROM {{part}} GROUP BY p_size"""


def _dictionary_sql(book: str) -> str:
    return f"""
    WITH book AS ({book.format(part='part')}),
    long AS (SELECT *, i AS number, regexp_extract(label, '(.*) - ', 1) AS q, regexp_extract(label, ' - (.*)', 1) AS a
             FROM book, generate_series(0, 7) AS t(i) WHERE i < n)
    SELECT DISTINCT name AS column_name, varnum,
           CASE WHEN q NOT IN ('', 'Variable filtre', 'BLOCS Travaux') AND n <= 3 THEN a ELSE answer END AS answer_char,
           CASE WHEN q NOT IN ('', 'Variable filtre', 'BLOCS Travaux') AND n <= 3
                THEN reverse(split_part(reverse(name), '_', 1)) ELSE number::VARCHAR END AS answer_number,
           CASE WHEN q NOT IN ('', 'Variable filtre', 'BLOCS Travaux') AND n <= 3 THEN q ELSE label END AS question
    FROM long"""


@query("table_answer_dictionary", _dictionary_sql(_PART_BOOK))
def answer_dictionary(src: Source) -> DataFrame:
    return intermediate.answer_dictionary(_book(src.spark.sql(_PART_BOOK, part=src.part))).drop("id_answer")


_TICKED_SQL = " UNION ".join(
    f"SELECT Respondent_Serial AS id_owner, '{c}' AS column_name FROM raw_survey WHERE {c} = 1"
    for c in codes.MULTI_CHOICE_COLUMNS
)


@query("table_answers", oracle(f"""
    , ticked AS ({_TICKED_SQL}), dictionary AS ({_dictionary_sql(_SIZE_BOOK)})
    SELECT column_name, answer_number, count(*) AS n_owners, sum(id_owner)::BIGINT AS owner_sum
    FROM ticked JOIN dictionary USING (column_name) GROUP BY column_name, answer_number
""".strip(), "survey"))
def answers(src: Source) -> DataFrame:
    """Associations counted per answer: the ids themselves are arbitrary."""
    dictionary = cut_lineage(intermediate.answer_dictionary(_book(src.spark.sql(_SIZE_BOOK, part=src.part))))
    pairs = intermediate.answers(raw(src, "survey"), dictionary)
    return pairs.join(dictionary.select("id_answer", "column_name", "answer_number"), ["id_answer"]).groupBy(
        "column_name", "answer_number"
    ).agg(F.count(F.lit(1)).alias("n_owners"), F.sum(F.col("id_owner").cast("bigint")).alias("owner_sum"))


_COMPLETE = "nb_persons_home <> 99 AND age IS NOT NULL AND income NOT IN (10, 11, 99)"
_OWNERS_CLEAN_SQL = f"""
    , o AS ({_OWNER_SQL}), h AS ({_HOUSING_SQL})
    SELECT id_owner, CASE WHEN gender = 1 THEN 0 ELSE 1 END AS gender, age,
           CASE WHEN work_state IN (1, 2) AND job <> 11 THEN job + 5 ELSE work_state - 2 END AS occupation,
           CASE WHEN home_state = 1 THEN 0 ELSE 1 END AS home_state,
           CASE WHEN has_done_renov = 1 THEN 0 ELSE 1 END AS has_done_renov, nb_persons_home, income
    FROM o WHERE {_COMPLETE} AND id_owner IN (SELECT id_owner FROM h WHERE type IN (1, 2))"""


@query("table_owners_clean", oracle(_OWNERS_CLEAN_SQL.strip(), "survey"))
def owners_clean(src: Source) -> DataFrame:
    survey = raw(src, "survey")
    return silver.owners_clean(intermediate.owners_raw(survey), intermediate.housing_raw(survey))


# --- geography and yearly facts ------------------------------------------------------------------

PROFILE_TABLES = (
    "code_commune", "pop_commune_2016", "pop_department_2016", "former_new_region", "development_licence",
    "construction_licence_2016", "destruction_licence", "elec", "dpe_france_2012",
)


def _grade(column: str) -> str:
    return "CASE " + column + " " + " ".join(
        f"WHEN '{g}' THEN {i}.0::DOUBLE" for i, g in enumerate(codes.GRADES, start=1)
    ) + " ELSE 0.0::DOUBLE END"


_WINDOW = "day BETWEEN DATE '2014-01-01' AND DATE '2017-01-01'"
_PROFILE_SQL = f"""
    profile AS (
    SELECT DISTINCT {_pad5('c.postal')} AS postal_code, c.insee AS insee_code, p.name AS municipality_name,
        d.dept AS department_number, d.name AS department_name, r.old_name AS former_region_name,
        r.old_code AS former_region_number, r.new_name AS new_region_name, r.new_code AS new_region_number,
        p.people AS population, coalesce(dev.n, 0) AS n_development_licence,
        coalesce(con.n, 0)::BIGINT AS n_construction_licence, coalesce(des.n, 0) AS n_destruction_licence,
        coalesce(g.n, 0) AS n_dpe, g.avg_dpe, g.avg_ges, e.consumption_by_residence
    FROM raw_code_commune c
    JOIN raw_pop_commune_2016 p ON p.insee = c.insee
    LEFT JOIN (SELECT insee, {_rounded(f"avg({_grade('energy')})")} AS avg_dpe,
                      {_rounded(f"avg({_grade('gas')})")} AS avg_ges, count(insee) AS n
               FROM raw_dpe_france_2012 WHERE {_WINDOW} AND energy <> 'N' AND gas <> 'N' GROUP BY insee) g
           ON g.insee = c.insee
    LEFT JOIN (SELECT insee, {_rounded('avg(used / nullif(points, 0))')} AS consumption_by_residence
               FROM raw_elec WHERE year BETWEEN 2014 AND 2016 AND kind = 'Electricité' AND points <> 0
               GROUP BY insee) e ON e.insee = c.insee
    LEFT JOIN (SELECT comm, sum(dwellings) AS n FROM raw_construction_licence_2016 WHERE {_WINDOW} GROUP BY comm) con
           ON con.comm = c.insee
    LEFT JOIN (SELECT comm, count(comm) AS n FROM raw_destruction_licence WHERE {_WINDOW} GROUP BY comm) des
           ON des.comm = c.insee
    LEFT JOIN (SELECT comm, count(comm) AS n FROM raw_development_licence WHERE {_WINDOW} GROUP BY comm) dev
           ON dev.comm = c.insee
    JOIN (SELECT DISTINCT region, dept FROM raw_development_licence) l ON l.dept = substr(p.insee, 1, 2)
    JOIN raw_pop_department_2016 d ON d.dept = l.dept
    JOIN raw_former_new_region r ON r.old_code = l.region)"""


def _profile(src: Source) -> DataFrame:
    return intermediate.municipality_profile(*[raw(src, name) for name in PROFILE_TABLES])


AREA_COLUMNS = (
    "postal_code", "insee_code", "municipality_name", "department_number", "department_name", "former_region_name",
    "former_region_number", "new_region_name", "new_region_number",
)


def _areas(src: Source) -> DataFrame:
    """The areas of the profile without ids and facts, for tables that read neither."""
    return intermediate.municipalities(*[raw(src, name) for name in PROFILE_TABLES]).select(*AREA_COLUMNS).distinct()


@query("table_municipality_profile", oracle(
    f", {_PROFILE_SQL} SELECT * REPLACE (round(consumption_by_residence, 1) AS consumption_by_residence) FROM profile",
    *PROFILE_TABLES,
))
def municipality_profile(src: Source) -> DataFrame:
    # One digit less is compared for the mean of ratios, whose last bits depend on the summation order.
    return _profile(src).drop("id_municipality").withColumn(
        "consumption_by_residence", F.round("consumption_by_residence", 1)
    )


# Only the tables that decide which areas exist; the joined facts never drop a row.
GEOGRAPHY_TABLES = PROFILE_TABLES
_GEOGRAPHY_SQL = f"""{_PROFILE_SQL},
    geography AS (SELECT DISTINCT postal_code, CAST(department_number AS INTEGER) AS department_number, department_name,
        former_region_name, former_region_number, new_region_name, new_region_number
        FROM profile WHERE department_number <> '2A')"""


def _geography(src: Source) -> DataFrame:
    return cut_lineage(silver.postal_geography(_areas(src)))


@query("table_postal_geography", oracle(f", {_GEOGRAPHY_SQL} SELECT * FROM geography", *GEOGRAPHY_TABLES))
def postal_geography(src: Source) -> DataFrame:
    return silver.postal_geography(_profile(src)).drop("id_municipality")


FACT_TABLES = ("pop_commune_2020", "construction_licence_2023")


def _facts(src: Source, geography: DataFrame) -> DataFrame:
    t = {name: raw(src, name) for name in (
        "pop_commune_2016", "pop_commune_2020", "code_commune", "construction_licence_2016",
        "construction_licence_2023", "destruction_licence", "development_licence",
    )}
    return silver.municipality_year_facts(
        t["pop_commune_2016"], t["pop_commune_2020"], t["code_commune"], t["construction_licence_2016"],
        t["construction_licence_2023"], t["destruction_licence"], t["development_licence"], geography,
    )


_FACTS_SQL = f"""{_GEOGRAPHY_SQL},
    people AS (
        SELECT insee, people, y AS year FROM raw_pop_commune_2016, generate_series(2012, 2018) AS t(y)
        UNION ALL
        SELECT dept || CASE WHEN length(number::VARCHAR) < 3 THEN lpad(number::VARCHAR, 3, '0') ELSE number::VARCHAR END,
               people, y FROM raw_pop_commune_2020, generate_series(2019, 2022) AS t(y)),
    built AS (SELECT comm, year(day) AS year, sum(dwellings) AS n_new, count(dwellings) AS n_con
              FROM raw_construction_licence_2016 GROUP BY 1, 2
              UNION ALL
              SELECT comm, year(day), sum(dwellings), count(dwellings)
              FROM raw_construction_licence_2023 WHERE year(day) < 2023 GROUP BY 1, 2),
    des AS (SELECT comm, year(day) AS year, count(comm) AS n_des FROM raw_destruction_licence GROUP BY 1, 2),
    dev AS (SELECT comm, year(day) AS year, count(comm) AS n_dev FROM raw_development_licence GROUP BY 1, 2),
    fact_rows AS (SELECT DISTINCT {_pad5('c.postal')} AS postal_code, p.insee, p.year, people,
                         coalesce(n_con, 0) AS n_con, coalesce(n_new, 0) AS n_new, coalesce(n_des, 0) AS n_des,
                         coalesce(n_dev, 0) AS n_dev
                  FROM people p JOIN raw_code_commune c ON c.insee = p.insee
                  LEFT JOIN built b ON b.comm = p.insee AND b.year = p.year
                  LEFT JOIN des ON des.comm = p.insee AND des.year = p.year
                  LEFT JOIN dev ON dev.comm = p.insee AND dev.year = p.year),
    facts AS (SELECT DISTINCT postal_code, year::INTEGER AS year, sum(people)::BIGINT AS population,
                     sum(n_con)::BIGINT AS n_construction_licence, sum(n_new)::BIGINT AS n_new_buildings,
                     sum(n_des)::BIGINT AS n_destruction_licence, sum(n_dev)::BIGINT AS n_development_licence
              FROM fact_rows WHERE CAST(postal_code AS INTEGER) < 96000 GROUP BY postal_code, year)"""


@query("table_municipality_year_facts", oracle(
    f", {_FACTS_SQL} SELECT facts.*, department_number, former_region_number FROM facts JOIN geography USING (postal_code)",
    *PROFILE_TABLES, *FACT_TABLES,
))
def municipality_year_facts(src: Source) -> DataFrame:
    geography = _geography(src)
    names = geography.select("id_municipality", "postal_code", "department_number", "former_region_number")
    return _facts(src, geography).join(names, ["id_municipality"]).drop("id_municipality")


@query("table_mainland_municipalities", oracle("""
    SELECT insee AS Code_commune_INSEE FROM raw_code_commune
    WHERE NOT contains(insee, '2A') AND NOT contains(insee, '2B') AND insee < '96000' ORDER BY insee
""".strip(), "code_commune"))
def mainland_municipalities(src: Source) -> DataFrame:
    return raw_layer.mainland_municipalities(raw(src, "code_commune"))


# --- weather -----------------------------------------------------------------------------------------

def _station_sql(keys: str, measures: list[str], where: str) -> str:
    means = ", ".join(f"{_rounded(f'avg({m})')} AS {m}" for m in measures)
    return f"SELECT lpad(dept, 2, '0') AS department_number, {keys}, {means} FROM raw_weather {where} GROUP BY ALL"


def _fill_sql(k: int, periods: list[str], measures: list[str]) -> str:
    means = ", ".join(f"{_rounded(f'avg({m})')}" for m in measures)
    same = " AND ".join(f"x.{p} = f{k - 1}.{p}" for p in periods)
    return f"""f{k} AS MATERIALIZED (SELECT * FROM f{k - 1} UNION ALL
        SELECT lpad(src::VARCHAR, 2, '0'), {', '.join(periods)}, {means}
        FROM raw_neighbours JOIN f{k - 1} ON lpad(dst::VARCHAR, 2, '0') = department_number
        WHERE NOT EXISTS (SELECT 1 FROM f{k - 1} x WHERE x.department_number = lpad(src::VARCHAR, 2, '0') AND {same})
        GROUP BY src, {', '.join(periods)})"""


_MONTHLY = list(codes.WEATHER_COLUMNS.values())


@query("table_weather_monthly", oracle(f"""
    , f0 AS ({_station_sql('year(day)::INTEGER AS year, month(day)::INTEGER AS month', _MONTHLY, '')}),
    {_fill_sql(1, ['year', 'month'], _MONTHLY)} SELECT * FROM f1
""".strip(), "weather", "neighbours"))
def weather_monthly(src: Source) -> DataFrame:
    return intermediate.weather_monthly(raw(src, "weather"), raw(src, "neighbours"))


_YEARLY_SQL = f"""
    f0 AS MATERIALIZED ({_station_sql('year(day)::INTEGER AS year', codes.YEARLY_MEASURES,
                         "WHERE TRY_CAST(dept AS INTEGER) < 96 AND year(day) < 2023")}),
    {', '.join(_fill_sql(k, ['year'], codes.YEARLY_MEASURES) for k in range(1, 14))}"""


@query("table_weather_yearly", oracle(f", {_YEARLY_SQL} SELECT * FROM f13", "weather", "neighbours"))
def weather_yearly(src: Source) -> DataFrame:
    return silver.weather_yearly(raw(src, "weather"), raw(src, "neighbours"))


# --- certificates and dwellings ------------------------------------------------------------------------

_GATE_SQL = f"""area IS NOT NULL AND postal IS NOT NULL AND insee IS NOT NULL AND built IS NOT NULL
    AND conso_total IS NOT NULL AND ges_total IS NOT NULL AND water_1 IS NOT NULL AND energy IS NOT NULL
    AND emitter IS NOT NULL AND generator IS NOT NULL AND energy IN {_in(codes.KNOWN_ENERGY)}
    AND water_energy IN {_in(codes.KNOWN_ENERGY)} AND TRY_CAST(heating_1 AS DOUBLE) IS NULL
    AND TRY_CAST(conso_total AS DOUBLE) IS NOT NULL AND building <> 'immeuble'
    AND made_on > DATE '2014-01-01' AND made_on < DATE '2024-01-01' AND built > 1700 AND built < 2024
    AND ges < 200 AND conso < 700"""
_CERTIFICATES_SQL = f"""
    certificates AS (
    SELECT number AS id_dpe, least(year(made_on), 2022)::INTEGER AS dpe_date, {_pad5('postal')} AS postal_code,
        CASE WHEN building = 'maison' THEN 0 ELSE 1 END AS type,
        {_bins('built', codes.CONSTRUCTION_BOUNDS, '<', 1)} AS construction_date,
        CASE WHEN heating = 'individuel' THEN 0 WHEN heating = 'collectif' THEN 1
             WHEN heating_1 = 'installation individuelle' THEN 0 ELSE 1 END AS heating_system,
        CASE WHEN energy IN {_in(codes.GAS)} THEN 1 WHEN energy IN {_in(codes.POLLUTING_GAS)} THEN 2
             WHEN energy IN {_in(codes.WOOD_COAL)} THEN 3 WHEN energy IN {_in(codes.OTHER_ENERGY)} THEN 4
             WHEN contains(generator, 'PAC') OR contains(generator, 'pompe à chaleur') THEN 5 ELSE 6 END
             AS heating_production,
        CASE WHEN water = 'individuel' THEN 0 WHEN water = 'collectif' THEN 1
             WHEN water_1 = 'installation individuelle' THEN 0 ELSE 1 END AS hot_water_system,
        {_bins('area', codes.SURFACE_BOUNDS, '<', 1)} AS surface,
        CAST({_bins('conso', codes.CONSUMPTION_BOUNDS, '<=', 0)} AS DOUBLE) AS "DPE_consumption",
        CAST({_bins('ges', codes.EMISSION_BOUNDS, '<=', 0)} AS DOUBLE) AS "GES_emission",
        NULL::VARCHAR AS has_to_renov
    FROM raw_certificates WHERE {_GATE_SQL})"""


def _certificates(src: Source, geography: DataFrame) -> DataFrame:
    return silver.certificates_clean(raw(src, "certificates"), geography)


def _by_postal(df: DataFrame, geography: DataFrame) -> DataFrame:
    """Show the area's natural key instead of its minted id."""
    keys = geography.select("id_municipality", "postal_code", "department_number", "former_region_number")
    return df.join(keys, ["id_municipality"]).drop("id_municipality")


@query("table_certificates_clean", oracle(f"""
    , {_GEOGRAPHY_SQL}, {_CERTIFICATES_SQL}
    SELECT certificates.*, department_number, former_region_number FROM certificates JOIN geography USING (postal_code)
""".strip(), *GEOGRAPHY_TABLES, "certificates"))
def certificates_clean(src: Source) -> DataFrame:
    geography = _geography(src)
    return _by_postal(_certificates(src, geography), geography)


@query("table_certificate_features", oracle(f"""
    , {_GEOGRAPHY_SQL}, {_CERTIFICATES_SQL}
    SELECT {', '.join(codes.CERTIFICATE_FEATURES)}, "GES_emission", "DPE_consumption" FROM certificates JOIN geography USING (postal_code)
""".strip(), *GEOGRAPHY_TABLES, "certificates"))
def certificate_features(src: Source) -> DataFrame:
    geography = _geography(src)
    return model.certificate_feature_set(_by_postal(_certificates(src, geography), geography))


_CLEAN_HOUSING_SQL = f"""
    o AS ({_OWNER_SQL}), h AS ({_HOUSING_SQL}), w AS ({_WORKS_SQL}),
    housing AS (
    SELECT h.id_owner, postal_code, CASE type WHEN 1 THEN 0 WHEN 2 THEN 1 END AS type, construction_date,
        CASE heating_system WHEN 1 THEN 0 WHEN 2 THEN 1 END AS heating_system,
        CASE WHEN heating_production IN (1, 2) THEN 6 WHEN heating_production IN (3, 4, 5) THEN 5
             WHEN heating_production IN (6, 7) THEN 3 WHEN heating_production IN (8, 10) THEN 2
             WHEN heating_production = 9 THEN 1 WHEN heating_production = 11 THEN 4 END AS heating_production,
        CASE hot_water_system WHEN 1 THEN 0 WHEN 2 THEN 1 END AS hot_water_system,
        {_bins('surface', codes.SURFACE_BOUNDS, '<', 1)} AS surface,
        CASE has_done_renov WHEN 1 THEN 0 WHEN 2 THEN 1 END AS has_done_renov,
        (CASE WHEN has_done_renov = 1
              THEN 2014 + CAST('0x' || substr(md5(h.id_owner::VARCHAR), 1, 8) AS BIGINT) % 3
              ELSE first_start + 2013 END)::INTEGER AS first_date_renov,
        NULL::VARCHAR AS "DPE_consumption", NULL::VARCHAR AS "GES_emission"
    FROM h LEFT JOIN (SELECT id_owner, min(start_date) AS first_start FROM w GROUP BY id_owner) f USING (id_owner)
    WHERE type IN (1, 2) AND h.id_owner IN (SELECT id_owner FROM o WHERE {_COMPLETE}))"""


def _survey_tables(src: Source) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Dwellings, respondents and works of the survey, the first two stored as several tables read them.

    No table that reads them shows the ids of dwellings and works, so none are minted.
    """
    survey = raw(src, "survey")
    return (
        cut_lineage(intermediate.dwellings(survey)), cut_lineage(intermediate.owners_raw(survey)),
        intermediate.works(survey),
    )


@query("table_housing_clean", oracle(f"""
    , {_GEOGRAPHY_SQL}, {_CLEAN_HOUSING_SQL}
    SELECT housing.*, department_number, former_region_number FROM housing JOIN geography USING (postal_code)
""".strip(), *GEOGRAPHY_TABLES, "survey"))
def housing_clean(src: Source) -> DataFrame:
    geography = _geography(src)
    return _by_postal(silver.housing_clean(*_survey_tables(src), geography), geography)


# --- feature sets --------------------------------------------------------------------------------------

@query("table_survey_feature_sets", oracle(f"""
    , {_FACTS_SQL}, {_CLEAN_HOUSING_SQL},
    frame AS (
        SELECT CASE WHEN o.gender = 1 THEN 0 ELSE 1 END AS gender, o.age,
               CASE WHEN work_state IN (1, 2) AND job <> 11 THEN job + 5 ELSE work_state - 2 END AS occupation,
               CASE WHEN home_state = 1 THEN 0 ELSE 1 END AS home_state, nb_persons_home, income, housing.type,
               housing.construction_date, housing.heating_system, population, n_development_licence,
               n_construction_licence, n_new_buildings, n_destruction_licence, geography.department_number,
               surface, heating_production
        FROM o JOIN housing USING (id_owner) JOIN geography USING (postal_code)
        JOIN facts ON facts.postal_code = housing.postal_code AND facts.year = housing.first_date_renov)
    SELECT CASE WHEN surface IS NULL THEN 'predicting_surf' ELSE 'training_surf' END AS set_name,
           * EXCLUDE (surface, heating_production), surface AS target FROM frame
    UNION ALL
    SELECT CASE WHEN heating_production IS NULL THEN 'predicting_prod' ELSE 'training_prod' END,
           * EXCLUDE (surface, heating_production), heating_production FROM frame
""".strip(), *PROFILE_TABLES, *FACT_TABLES, "survey"))
def survey_feature_sets(src: Source) -> DataFrame:
    geography = _geography(src)
    dwellings, respondents, works = _survey_tables(src)
    owners = cut_lineage(silver.owners_clean(respondents, dwellings))
    housing = cut_lineage(silver.housing_clean(dwellings, respondents, works, geography))
    frame = cut_lineage(model.survey_features(owners, housing, cut_lineage(_facts(src, geography)), geography))
    sets = model.survey_feature_sets(frame)
    stacked = [
        frame.withColumnRenamed("surface" if name.endswith("surf") else "heating_production", "target")
        .withColumn("set_name", F.lit(name)) for name, frame in sets.items()
    ]
    out = stacked[0]
    for frame in stacked[1:]:
        out = out.unionByName(frame)
    return out


_SCORING_SQL = f"""{_FACTS_SQL}, {_CERTIFICATES_SQL}, {_YEARLY_SQL},
    wx AS (SELECT CAST(department_number AS INTEGER) AS d, year AS y, wind_speed, humidity, temp_degree FROM f13),
    scoring AS (
    SELECT id_dpe, c.type, construction_date, surface, heating_system, hot_water_system, heating_production,
           "DPE_consumption"::INTEGER AS "DPE_consumption", "GES_emission"::INTEGER AS "GES_emission",
           {', '.join(f'w{k}.{m} AS {m}_{k}' for k in range(3) for m in ('humidity', 'wind_speed', 'temp_degree'))},
           population, n_development_licence, n_construction_licence, n_destruction_licence, n_new_buildings,
           g.department_number, has_to_renov
    FROM certificates c JOIN geography g USING (postal_code)
    JOIN facts f ON f.postal_code = c.postal_code AND f.year = c.dpe_date
    JOIN wx w0 ON w0.d = g.department_number AND w0.y = c.dpe_date
    JOIN wx w1 ON w1.d = g.department_number AND w1.y = c.dpe_date - 1
    JOIN wx w2 ON w2.d = g.department_number AND w2.y = c.dpe_date - 2)"""
SCORING_TABLES = (*PROFILE_TABLES, *FACT_TABLES, "certificates", "weather", "neighbours")


def _scoring(src: Source) -> DataFrame:
    geography = _geography(src)
    return model.retrofit_scoring(
        _certificates(src, geography), _facts(src, geography), geography,
        silver.weather_yearly(raw(src, "weather"), raw(src, "neighbours")),
    )


@query("table_retrofit_scoring_set", oracle(f", {_SCORING_SQL} SELECT * FROM scoring", *SCORING_TABLES))
def retrofit_scoring_set(src: Source) -> DataFrame:
    return _scoring(src)


# --- imputed dwellings, retrofit training and predictions ----------------------------------------------
# Targets are rules of the features, hidden from a share of the dwellings: models that find the rules give the oracle's rows.

_RULE_SURFACE = "CASE WHEN {type} = 0 THEN 1 ELSE 3 END"
_RULE_HEATING = "CASE WHEN {gender} = 0 THEN 1 ELSE 6 END"
_PLAIN = {c: c for c in ("type", "gender")}
_RULE_EMISSION = "CASE {h} WHEN 1 THEN 2 WHEN 2 THEN 5 WHEN 3 THEN 1 WHEN 4 THEN 3 WHEN 5 THEN 0 ELSE 4 END"
_SMALL_MODELS = {
    "surface": {"maxIter": 3, "stepSize": 1.0, "maxDepth": 2, "minInstancesPerNode": 1},
    **{name: {"numTrees": 3, "maxDepth": 6, "featureSubsetStrategy": "all", "maxBins": 128} for name in ("production", "consumption", "emission")},
}
_SMALL_BOOST = {"maxIter": 3, "maxDepth": 3, "seed": 1}


def _imputed_housing(src: Source, geography: DataFrame, facts: DataFrame, certificates: DataFrame | None = None) -> DataFrame:
    """Dwellings whose surface and heating are known of three in four, completed by cross-fitted models, with grades."""
    dwellings, respondents, works = _survey_tables(src)
    owners = cut_lineage(silver.owners_clean(respondents, dwellings))
    clean = silver.housing_clean(dwellings, respondents, works, geography)
    frame = model.survey_features(owners, clean, facts, geography)
    frame = cut_lineage(frame.withColumns({
        "surface": F.when(F.col("id_owner") % 4 != 1, F.expr(_RULE_SURFACE.format(**_PLAIN))),
        "heating_production": F.when(F.col("id_owner") % 4 != 3, F.expr(_RULE_HEATING.format(**_PLAIN))),
    }))
    certificates = _certificates(src, geography) if certificates is None else certificates
    grades = cut_lineage(model.certificate_feature_set(certificates).withColumns({
        "DPE_consumption": F.col("type") * 2 + F.col("hot_water_system"), "GES_emission": F.expr(_RULE_EMISSION.format(h="heating_production")),
    }))
    fitted = {t: model.fit_imputer(t, grades, _SMALL_MODELS) for t in ("DPE_consumption", "GES_emission")}
    return cut_lineage(model.housing_imputed(frame, fitted, clean.columns, _SMALL_MODELS))


_CODED = {
    "type": "housing.type", "gender": "(CASE WHEN o.gender = 1 THEN 0 ELSE 1 END)",
}
_IMPUTED_SQL = f"""{_FACTS_SQL}, {_CLEAN_HOUSING_SQL},
    imputed AS (
        SELECT DISTINCT housing.id_owner, housing.postal_code, housing.type, housing.construction_date, housing.heating_system,
               {_RULE_HEATING.format(**_CODED)} AS heating_production, housing.hot_water_system,
               {_RULE_SURFACE.format(**_CODED)} AS surface, housing.has_done_renov, housing.first_date_renov,
               housing.type * 2 + housing.hot_water_system AS "DPE_consumption",
               {_RULE_EMISSION.format(h='(' + _RULE_HEATING.format(**_CODED) + ')')} AS "GES_emission",
               geography.department_number, geography.former_region_number
        FROM o JOIN housing USING (id_owner) JOIN geography USING (postal_code)
        JOIN facts ON facts.postal_code = housing.postal_code AND facts.year = housing.first_date_renov)"""
IMPUTED_TABLES = (*PROFILE_TABLES, *FACT_TABLES, "survey")


@query("table_housing_imputed", oracle(f", {_IMPUTED_SQL} SELECT * FROM imputed", *IMPUTED_TABLES))
def housing_imputed(src: Source) -> DataFrame:
    geography = _geography(src)
    return _by_postal(_imputed_housing(src, geography, cut_lineage(_facts(src, geography))), geography)


_TRAINING_SQL = f"""{_IMPUTED_SQL}, {_YEARLY_SQL},
    wx AS (SELECT CAST(department_number AS INTEGER) AS d, year AS y, wind_speed, humidity, temp_degree FROM f13)
    SELECT h.id_owner, h.type, construction_date, surface, heating_system, hot_water_system, heating_production, "DPE_consumption", "GES_emission",
           {', '.join(f'w{k}.{m} AS {m}_{k}' for k in range(3) for m in ('humidity', 'wind_speed', 'temp_degree'))},
           population, n_development_licence, n_construction_licence, n_destruction_licence, n_new_buildings,
           h.department_number, has_done_renov
    FROM imputed h JOIN facts f ON f.postal_code = h.postal_code AND f.year = h.first_date_renov
    JOIN wx w0 ON w0.d = h.department_number AND w0.y = h.first_date_renov
    JOIN wx w1 ON w1.d = h.department_number AND w1.y = h.first_date_renov - 1
    JOIN wx w2 ON w2.d = h.department_number AND w2.y = h.first_date_renov - 2"""


def _training(src: Source, geography: DataFrame, facts: DataFrame, weather: DataFrame, certificates: DataFrame | None = None) -> DataFrame:
    return model.retrofit_training(_imputed_housing(src, geography, facts, certificates), facts, geography, weather)


@query("table_retrofit_training", oracle(f", {_TRAINING_SQL}", *IMPUTED_TABLES, "weather", "neighbours"))
def retrofit_training(src: Source) -> DataFrame:
    geography = _geography(src)
    weather = cut_lineage(silver.weather_yearly(raw(src, "weather"), raw(src, "neighbours")))
    return _training(src, geography, cut_lineage(_facts(src, geography)), weather)


@query("table_predicted_renov", oracle(
    f", {_SCORING_SQL} SELECT * REPLACE ((hot_water_system = 1)::INTEGER AS has_to_renov) FROM scoring", *SCORING_TABLES))
def predicted_renov(src: Source) -> DataFrame:
    """A model learned where dwellings with shared hot water were retrofitted, stored below a lake, loaded again and asked about all certificates."""
    geography = _geography(src)
    lake = Lake(src.spark, shared_folder(src.spark, "lake"), buckets=8)
    weather = silver.weather_yearly(raw(src, "weather"), raw(src, "neighbours"))
    stored = {
        "Municipality_info": _facts(src, geography), "Weather": weather, "DPE": _certificates(src, geography),
    }
    facts, weather = (lake.write(stored[name], "Silver", name) for name in ("Municipality_info", "Weather"))
    lake.write(geography, "Silver", "Municipality")
    certificates = lake.write(stored["DPE"], "Silver", "DPE")
    training = cut_lineage(_training(src, geography, facts, weather, certificates).withColumn("has_done_renov", (F.col("hot_water_system") == 1).cast("int")))
    model.train_retrofit(training, _SMALL_BOOST).write().overwrite().save(lake.model_path("retrofit"))
    return run.score_certificates(lake)


# --- gold ------------------------------------------------------------------------------------------------

_GOLD_MUNICIPALITY_SQL = f"""{_PROFILE_SQL},
    places AS (SELECT DISTINCT insee_code, municipality_name, department_number, department_name,
                      CASE WHEN new_region_name = 'Bretagne' THEN 'BZH' ELSE new_region_name END AS new_region_name,
                      new_region_number, houses AS n_houses, apartments AS n_apartments
               FROM profile JOIN raw_housings ON insee = insee_code WHERE department_number <> '2A')"""


@query("table_gold_municipality", oracle(
    f", {_GOLD_MUNICIPALITY_SQL} SELECT * FROM places", *PROFILE_TABLES, "housings"))
def gold_municipality(src: Source) -> DataFrame:
    return gold.gold_municipality(_profile(src), raw(src, "housings")).drop("id_municipality")


def _rule_scored(src: Source) -> tuple[DataFrame, DataFrame]:
    """Certificates with a rule in place of the model's score, and the municipalities."""
    areas = cut_lineage(_areas(src))
    predicted = _certificates(src, silver.postal_geography(areas)).withColumn(
        "has_to_renov", (F.col("surface") == 1).cast("int")
    )
    municipalities = cut_lineage(gold.gold_municipality(areas, raw(src, "housings")))
    return gold.scored_certificates(raw(src, "certificates"), predicted, municipalities), municipalities


def _flag(part: str) -> str:
    return f"CASE WHEN {part} IN ('moyenne', 'bonne', 'très bonne', '2') THEN 1 ELSE 0 END"


def _number(part: str) -> str:
    labels = " ".join(f"WHEN '{label}' THEN {i}" for i, label in enumerate(codes.QUALITY_LABELS, start=1))
    return f"CASE {part} {labels} WHEN '2' THEN 2 END"


def _label(column: str, labels: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in labels.items()) + " END"


_SCORED_SQL = f"""{_GEOGRAPHY_SQL}, {_CERTIFICATES_SQL}, {_GOLD_MUNICIPALITY_SQL.replace(_PROFILE_SQL, '').lstrip().lstrip(',')},
    ceilings AS (SELECT number, insee, building, q_walls, q_carpentry, q_floor,
        list_filter([{_number('q_terrace')}, {_number('q_attic')}, {_number('q_unused')}], lambda x: x > 0) AS q
        FROM raw_certificates),
    scored AS (
    SELECT c.id_dpe, p.insee_code, building AS type, c.surface = 1 AS small, {_flag('q_walls')} AS walls,
           {_flag('q_carpentry')} AS carpentry, {_flag('q_floor')} AS floor,
           CASE WHEN len(q) > 0 AND floor(list_sum(q)::DOUBLE / len(q)) >= 2 THEN 1 ELSE 0 END AS ceiling,
           CASE WHEN heating_production = 2 THEN 1 WHEN heating_production IN (1, 3)
                AND ("DPE_consumption" >= 4 OR "GES_emission" >= 4) THEN 1 ELSE 0 END AS energy,
           {_label('heating_production', codes.HEATING_LABELS)} AS heating_production,
           {_label('"DPE_consumption"', codes.GRADE_LABELS)} AS "DPE_consumption",
           {_label('"GES_emission"', codes.GRADE_LABELS)} AS "GES_emission",
           {_label('surface', codes.SURFACE_LABELS)} AS surface,
           {_label('construction_date', codes.CONSTRUCTION_LABELS)} AS construction_date
    FROM certificates c JOIN geography g USING (postal_code) JOIN ceilings q ON q.number = c.id_dpe
    JOIN places p ON p.insee_code = q.insee)"""
GOLD_TABLES = (*PROFILE_TABLES, "certificates", "housings")


@query("table_gold_retrofit", oracle(f", {_SCORED_SQL} " + " UNION ALL ".join(
    f"SELECT id_dpe, insee_code, '{label}' AS renov_type FROM scored WHERE {flag} = 1"
    for flag, label in (("walls", "murs"), ("carpentry", "toiture"), ("floor", "plancher"), ("ceiling", "plafond"),
                        ("energy", "énergie"))
), *GOLD_TABLES))
def gold_retrofit(src: Source) -> DataFrame:
    scored, municipalities = _rule_scored(src)
    rows = gold.gold_retrofit(scored)
    return rows.join(municipalities.select("id_municipality", "insee_code"), ["id_municipality"]).drop("id_municipality")


@query("table_gold_segments", oracle(f""", {_SCORED_SQL}
    SELECT insee_code, type, construction_date, heating_production, surface, "DPE_consumption", "GES_emission",
           small::INTEGER AS has_to_renov, count(*) AS count FROM scored GROUP BY ALL
""", *GOLD_TABLES))
def gold_segments(src: Source) -> DataFrame:
    scored, municipalities = _rule_scored(src)
    rows = gold.gold_segments(scored)
    return rows.join(municipalities.select("id_municipality", "insee_code"), ["id_municipality"]).drop("id_municipality")
