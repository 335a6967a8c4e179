"""Intermediate layer: the survey in relational form, municipality profiles, monthly weather."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakestrata.functions import measures, predicates, recode
from lakestrata.functions.codes import code_number, code_prefix, label_answer, label_question, last_token, zero_pad
from lakestrata.operators import aggregate, joins, reshape
from lakestrata.operators.ids import distinct_with_id
from lakestrata.operators.neighbour import fill_once
from lakestrata.plans import codes


def answer_dictionary(codebook: DataFrame) -> DataFrame:
    """One row per answer; a yes/no/NA variable of a multi-choice question is itself one answer."""
    answers = reshape.unpivot(
        codebook, ["Name", "VARNUM", "LABEL"], {f"_{n}": str(n) for n in codes.CODEBOOK_ANSWERS},
        "answer_number", "answer",
    )
    parts = codebook.select(
        "VARNUM", label_answer(F.col("LABEL")).alias("part_answer"), label_question(F.col("LABEL")).alias("part_question"),
        last_token(F.col("Name")).alias("part_number"),
    )
    joined = aggregate.attach_group_size(answers, "VARNUM", "n_answers").join(parts, ["VARNUM"], "inner")
    collapses = ~F.col("part_question").isin(codes.CODEBOOK_SINGLE) & (F.col("n_answers") <= 3)

    def part_or(part: str, whole: str) -> Column:
        return F.when(collapses, F.col(part)).otherwise(F.col(whole))

    rows = joined.select(
        F.col("Name").alias("column_name"), F.col("VARNUM").alias("varnum"),
        part_or("part_answer", "answer").alias("answer_char"),
        part_or("part_number", "answer_number").alias("answer_number"),
        part_or("part_question", "LABEL").alias("question"),
    )
    return distinct_with_id(rows, "id_answer")


def answers(survey: DataFrame, dictionary: DataFrame) -> DataFrame:
    """(id_owner, id_answer) of every ticked multi-choice column."""
    ticked = reshape.unpivot_flags(
        survey.withColumnRenamed("Respondent_Serial", "id_owner"), ["id_owner"], codes.MULTI_CHOICE_COLUMNS
    )
    return joins.answer_association(ticked, dictionary, "column_name", ["id_owner", "id_answer"])


def owners_raw(survey: DataFrame) -> DataFrame:
    return survey.select(*[F.col(c).alias(name) for c, name in codes.OWNER_COLUMNS.items()]).distinct()


def dwellings(survey: DataFrame) -> DataFrame:
    """The dwellings of the survey, each once and without an id."""
    return survey.select(
        F.col("Respondent_Serial").alias("id_owner"), zero_pad(F.col("cd_postal"), 5).alias("postal_code"),
        *[F.col(c).alias(name) for c, name in codes.DWELLING_COLUMNS.items()],
    ).distinct()


def housing_raw(survey: DataFrame) -> DataFrame:
    return distinct_with_id(dwellings(survey), "id_housing")


def works(survey: DataFrame) -> DataFrame:
    """The works with a start date, as often as the survey has them and without an id."""
    def record(number: int, name: str) -> dict[str, Column]:
        absent = codes.WORK_NOT_ASKED.get(number, ())
        return {
            "work_type": F.lit(name), "work_type_number": F.lit(number),
            **{
                field: recode.typed_null("int") if field in absent else F.col(question.format(number)).cast("int")
                for field, question in codes.WORK_QUESTIONS.items()
            },
        }

    return reshape.unpivot_records(
        survey.withColumnRenamed("Respondent_Serial", "id_owner"), ["id_owner"],
        [record(number, name) for number, name in codes.WORK_TYPES.items()], "start_date",
    )


def works_raw(survey: DataFrame) -> DataFrame:
    """One row per work with a start date."""
    return distinct_with_id(works(survey), "id_renov")


def _licences(licences: DataFrame, name: str, dwellings: str | None = None) -> DataFrame:
    """Licences of 2014-2016 per municipality: their number, or the sum of a dwelling column."""
    inside = licences.where(predicates.within_dates(F.col("DATE_REELLE_AUTORISATION"), "2014-01-01", "2017-01-01"))
    measure = F.sum(dwellings) if dwellings else F.count("COMM")
    return inside.groupBy(F.col("COMM").alias("insee_code")).agg(measure.alias(name))


def _grades(certificates: DataFrame) -> DataFrame:
    energy, gas = F.col("classe_consommation_energie"), F.col("classe_estimation_ges")
    dated = predicates.within_dates(F.col("date_etablissement_dpe"), "2014-01-01", "2017-01-01")
    graded = certificates.where(dated & (energy != "N") & (gas != "N")).select(
        F.col("code_insee_commune_actualise").alias("insee_code"),
        recode.grade_to_number(energy, codes.GRADES).alias("dpe"), recode.grade_to_number(gas, codes.GRADES).alias("ges"),
    )
    return aggregate.measure_of_groups(
        graded, ["insee_code"], avg_dpe=measures.round_measure(F.avg("dpe")),
        avg_ges=measures.round_measure(F.avg("ges")), n_dpe=F.count("insee_code"),
    )


def _consumption(elec: DataFrame) -> DataFrame:
    ratio = measures.safe_ratio(F.col("Consommation Résidentiel  (MWh)"), F.col("Nombre de points Résidentiel"))
    used = elec.where(F.col("Année").between(2014, 2016) & (F.col("Filière") == "Electricité")).select(
        F.col("Code Commune").alias("insee_code"), ratio.alias("consumption_by_residence")
    )
    return aggregate.group_averages(
        used.where("consumption_by_residence IS NOT NULL"), ["insee_code"], ["consumption_by_residence"]
    )


def municipalities(
    code_commune: DataFrame, pop_commune_2016: DataFrame, pop_department_2016: DataFrame,
    former_new_region: DataFrame, development_licence: DataFrame, construction_licence_2016: DataFrame,
    destruction_licence: DataFrame, elec: DataFrame, dpe_france_2012: DataFrame,
) -> DataFrame:
    """Municipality × postal code with 2014-2016 facts, each fact reduced to a row per municipality first; no ids.

    The facts are joined last: where only the areas are read of the distinct rows, Spark
    leaves the facts' joins, and with them the scans of their files, out of the plan.
    """
    regions = joins.geo_hierarchy(
        development_licence.select(code_number(F.col("REG")).alias("former_region_number"),
                                   F.col("DEP").alias("department_number")),
        pop_department_2016.select(F.col("CODDEP").alias("department_number"), F.col("DEP").alias("department_name")),
        former_new_region.select(
            code_number(F.col("Nouveau Code")).alias("new_region_number"), F.col("Nouveau Nom").alias("new_region_name"),
            code_number(F.col("Anciens Code")).alias("former_region_number"),
            F.col("Anciens Nom").alias("former_region_name"),
        ),
        "department_number", "former_region_number",
    )
    places = code_commune.select(
        F.col("Code_commune_INSEE").alias("insee_code"), zero_pad(F.col("Code_postal"), 5).alias("postal_code")
    )
    people = pop_commune_2016.select(
        F.col("DEPCOM").alias("insee_code"), F.col("COM").alias("municipality_name"), F.col("PMUN").alias("population"),
        code_prefix(F.col("DEPCOM"), 2).alias("department_number"),
    )
    profile = joins.zero_filled(
        places.join(people, ["insee_code"], "left").join(regions, ["department_number"], "inner"), ["insee_code"], _grades(dpe_france_2012), _consumption(elec),
        _licences(construction_licence_2016, "n_construction_licence", "NB_LGT_TOT_CREES"),
        _licences(destruction_licence, "n_destruction_licence"),
        _licences(development_licence, "n_development_licence"),
        fill=["n_development_licence", "n_destruction_licence", "n_construction_licence", "n_dpe"],
    )
    return profile.select(
        "postal_code", "insee_code", "municipality_name", "department_number", "department_name",
        "former_region_name", "former_region_number", "new_region_name", "new_region_number", "population",
        "n_development_licence", "n_construction_licence", "n_destruction_licence", "n_dpe", "avg_dpe", "avg_ges",
        "consumption_by_residence",
    )


def municipality_profile(*raw: DataFrame, **named: DataFrame) -> DataFrame:
    """The rows of :func:`municipalities`, which takes the same tables, each once and with an id."""
    return distinct_with_id(municipalities(*raw, **named), "id_municipality")


def department_edges(neighbouring_dep: DataFrame) -> DataFrame:
    """Edges (src, dst) of padded department codes, from the adjacency table or an edge list."""
    edges = neighbouring_dep
    if "src" not in edges.columns:
        edges = reshape.edge_list(edges, "Departement", codes.NEIGHBOUR_COLUMNS)
    return edges.select(zero_pad(F.col("src"), 2).alias("src"), zero_pad(F.col("dst"), 2).alias("dst"))


def _station_rows(weather: DataFrame) -> DataFrame:
    return weather.select(
        zero_pad(F.col(f"`{codes.WEATHER_DEPARTMENT}`"), 2).alias("department_number"),
        F.year("Date").alias("year"), F.month("Date").alias("month"),
        *[F.col(f"`{c}`").alias(name) for c, name in codes.WEATHER_COLUMNS.items()],
    )


def weather_monthly(weather: DataFrame, neighbouring_dep: DataFrame) -> DataFrame:
    """Department × month averages; a department without stations gets its neighbours' mean."""
    names = list(codes.WEATHER_COLUMNS.values())
    observed = aggregate.group_averages(_station_rows(weather), ["department_number", "year", "month"], names)
    return fill_once(observed, department_edges(neighbouring_dep), "department_number", ["year", "month"], names)
