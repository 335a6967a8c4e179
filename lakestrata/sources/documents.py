"""Values out of semi-structured documents, with built-in parsers instead of a per-row UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Element names and the measure counted in a dwelling document.
CELL_SCHEMA = (
    "Cellule array<struct<Mesure:string,Modalite:array<struct<_code:string,_VALUE:string>>,Valeur:string>>"
)
DWELLING_MEASURE = "Nombre de logements"
HOUSE_CODE = "1"


def dwelling_counts(xml: Column) -> Column:
    """struct(houses, apartments) of one document.

    Cells of another measure are passed over; code 1 counts houses, any other
    apartments; the last cell of a kind wins. Reading stops at the first cell that
    cannot be understood; an unreadable document gives (0, 0).
    """
    cells = F.coalesce(
        F.from_xml(xml, CELL_SCHEMA, {"mode": "PERMISSIVE"})["Cellule"],
        F.array().cast("array<struct<Mesure:string,Modalite:array<struct<_code:string,_VALUE:string>>,Valeur:string>>"),
    )

    def read(acc: Column, cell: Column) -> Column:
        counts = cell["Mesure"] == DWELLING_MEASURE
        # `.cast` of a finite double truncates toward zero.
        number = cell["Valeur"].try_cast("double").try_cast("int")
        modality = F.try_element_at(cell["Modalite"], F.lit(1))
        broken = (
            acc["broken"] | cell["Mesure"].isNull()
            | (counts & (modality.isNull() | number.isNull()))
        )
        use = ~broken & counts
        is_house = F.coalesce(modality["_code"] == HOUSE_CODE, F.lit(False))
        return F.struct(
            F.when(use & is_house, number).otherwise(acc["houses"]).alias("houses"),
            F.when(use & ~is_house, number).otherwise(acc["apartments"]).alias("apartments"),
            broken.alias("broken"),
        )

    initial = F.struct(F.lit(0).alias("houses"), F.lit(0).alias("apartments"), F.lit(False).alias("broken"))
    return F.aggregate(
        cells, initial, read,
        lambda acc: F.struct(acc["houses"].alias("houses"), acc["apartments"].alias("apartments")),
    )


def housing_table(documents: DataFrame, code: str, xml: str) -> DataFrame:
    """(code, houses, apartments) from one document per municipality."""
    return documents.select(F.col(code), dwelling_counts(F.col(xml)).alias("g")).select(code, "g.*")


def html_title(html: Column) -> Column:
    return F.regexp_extract(html, "<title>([^<]*)</title>", 1)


def html_language(html: Column) -> Column:
    return F.regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1)
