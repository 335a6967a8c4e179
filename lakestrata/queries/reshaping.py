"""Unpivots, code books, adjacency and record repair."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestrata.operators import joins, reshape
from lakestrata.operators.stitch import stitch_records
from lakestrata.queries.registry import Source, query, sql_pad
from lakestrata.sources import documents

_LINE_ID = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate"]
_LINE_KEY = ", ".join(_LINE_ID)
MEASURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")


@query("op_unpivot_values", " UNION ALL ".join(
    f"SELECT {_LINE_KEY}, '{m}' AS measure, {m} AS value FROM lineitem WHERE {m} <> 0" for m in MEASURES
))
def unpivot_values(src: Source) -> DataFrame:
    masked = src.lineitem.select(*_LINE_ID, *[F.nullif(F.col(m), F.lit(0.0)).alias(m) for m in MEASURES])
    return reshape.unpivot(masked, _LINE_ID, MEASURES, "measure", "value")


def _order_flags(src: Source) -> DataFrame:
    """Wide 0/1 answers of a customer's order: one column per question."""
    return src.orders.select(
        "o_custkey",
        (F.col("o_orderstatus") == "F").cast("int").alias("q1_1"), (F.col("o_orderstatus") == "O").cast("int").alias("q1_2"),
        (F.col("o_totalprice") > 300000).cast("int").alias("q2_1"),
        F.when(F.col("o_orderpriority") != "5-LOW", (F.col("o_orderpriority") == "1-URGENT").cast("int")).alias("q2_2"),
    )


_FLAG_SQL = {
    "q1_1": "o_orderstatus = 'F'", "q1_2": "o_orderstatus = 'O'",
    "q2_1": "o_totalprice > 300000", "q2_2": "o_orderpriority = '1-URGENT'",
}
_FLAGS = " UNION ".join(
    f"SELECT o_custkey, '{name}' AS column_name FROM orders WHERE {test}" for name, test in _FLAG_SQL.items()
)


@query("op_unpivot_flags", _FLAGS)
def unpivot_flags(src: Source) -> DataFrame:
    return reshape.unpivot_flags(_order_flags(src), ["o_custkey"], list(_FLAG_SQL))


@query("op_answer_association", f"""
    WITH d AS (SELECT DISTINCT 'q' || CASE WHEN p_size < 25 THEN 1 ELSE 2 END || '_' ||
                      CASE WHEN p_retailprice < 1000 THEN 1 ELSE 2 END AS column_name, p_type AS id_answer FROM part)
    SELECT o_custkey, id_answer FROM ({_FLAGS}) JOIN d USING (column_name)
""")
def answer_association(src: Source) -> DataFrame:
    dictionary = src.part.select(
        F.concat(
            F.lit("q"), F.when(F.col("p_size") < 25, "1").otherwise("2"), F.lit("_"),
            F.when(F.col("p_retailprice") < 1000, "1").otherwise("2"),
        ).alias("column_name"), F.col("p_type").alias("id_answer"),
    ).distinct()
    answers = reshape.unpivot_flags(_order_flags(src), ["o_custkey"], list(_FLAG_SQL))
    return joins.answer_association(answers, dictionary, "column_name", ["o_custkey", "id_answer"])


@query("op_unpivot_records", f"""
    SELECT DISTINCT * FROM (
      SELECT l_orderkey, 'shipping' AS work_type, 11 AS work_type_number, l_quantity AS start_value,
             l_tax AS end_value, l_returnflag AS done_by FROM lineitem
      UNION ALL
      SELECT l_orderkey, 'discount', 12, nullif(l_discount, 0), NULL, l_linestatus FROM lineitem
      UNION ALL
      SELECT l_orderkey, 'returned', 41, CASE WHEN l_returnflag = 'R' THEN l_extendedprice END, l_tax, NULL
      FROM lineitem) WHERE start_value IS NOT NULL
""")
def unpivot_records(src: Source) -> DataFrame:
    def record(name: str, number: int, start, end, by) -> dict:
        return {"work_type": F.lit(name), "work_type_number": F.lit(number), "start_value": start,
                "end_value": end, "done_by": by}

    return reshape.unpivot_records(src.lineitem, ["l_orderkey"], [
        record("shipping", 11, F.col("l_quantity"), F.col("l_tax"), F.col("l_returnflag")),
        record("discount", 12, F.nullif(F.col("l_discount"), F.lit(0.0)), F.lit(None).cast("double"),
               F.col("l_linestatus")),
        record("returned", 41, F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")), F.col("l_tax"),
               F.lit(None).cast("string")),
    ], "start_value")


@query("op_flags_to_rows", f"""
    SELECT {_LINE_KEY}, 'walls' AS kind FROM lineitem WHERE l_quantity >= 25
    UNION ALL SELECT {_LINE_KEY}, 'roof' FROM lineitem WHERE l_returnflag = 'R'
    UNION ALL SELECT {_LINE_KEY}, 'énergie' FROM lineitem WHERE l_tax >= 0.05
""")
def flags_to_rows(src: Source) -> DataFrame:
    flagged = src.lineitem.select(
        *_LINE_ID, (F.col("l_quantity") >= 25).cast("int").alias("f1"),
        (F.col("l_returnflag") == "R").cast("int").alias("f2"), (F.col("l_tax") >= 0.05).cast("int").alias("f3"),
    )
    return reshape.flags_to_rows(flagged, _LINE_ID, {"f1": "walls", "f2": "roof", "f3": "énergie"}, "kind")


@query("op_edge_list", """
    SELECT p_partkey AS src, dst FROM (
      SELECT p_partkey, p_partkey + 1 AS dst FROM part
      UNION ALL SELECT p_partkey, CASE WHEN p_size < 25 THEN p_partkey + p_size END FROM part
      UNION ALL SELECT p_partkey, CASE WHEN p_type = 'SMALL' THEN p_partkey + 7 END FROM part) WHERE dst IS NOT NULL
""")
def edge_list(src: Source) -> DataFrame:
    slots = src.part.select(
        "p_partkey", (F.col("p_partkey") + 1).alias("v1"),
        F.when(F.col("p_size") < 25, F.col("p_partkey") + F.col("p_size")).alias("v2"),
        F.when(F.col("p_type") == "SMALL", F.col("p_partkey") + 7).alias("v3"),
    )
    return reshape.edge_list(slots, "p_partkey", ["v1", "v2", "v3"])


@query("op_edge_list_from_text", """
    WITH p AS (SELECT p_partkey, p_size FROM part WHERE p_type <> 'SMALL')
    SELECT CAST(p_partkey AS INTEGER) AS src, CAST(p_partkey + 1 AS INTEGER) AS dst FROM p
    UNION ALL SELECT CAST(p_partkey AS INTEGER), p_size FROM p
    UNION ALL SELECT CAST(p_partkey AS INTEGER), p_size + 3 FROM p WHERE p_size >= 25
""")
def edge_list_from_text(src: Source) -> DataFrame:
    part = F.col("p_partkey").cast("string")
    lines = src.part.select(F.concat(
        part, F.lit(": "), (F.col("p_partkey") + 1).cast("string"), F.lit(" | "),
        # A code with a letter spoils its whole line.
        F.when(F.col("p_type") == "SMALL", F.lit("2A")).otherwise(F.col("p_size").cast("string")),
        F.when(F.col("p_size") >= 25, F.concat(F.lit(", "), (F.col("p_size") + 3).cast("string"))).otherwise(""),
    ).alias("value"))
    return reshape.edge_list_from_text(lines)


_FIELDS = 41


@query("op_stitch_records", f"""
    WITH RECURSIVE l AS (
        SELECT conv_id, turn, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i
        FROM conversations WHERE length(text) > 0),
    r AS (
        SELECT conv_id, i, turn AS record_start, text AS record,
               length(text) - length(replace(text, ',', '')) AS seps FROM l WHERE i = 1
        UNION ALL
        SELECT l.conv_id, l.i, CASE WHEN r.seps >= {_FIELDS - 1} THEN l.turn ELSE r.record_start END,
               g.glued, length(g.glued) - length(replace(g.glued, ',', ''))
        FROM r JOIN l ON l.conv_id = r.conv_id AND l.i = r.i + 1,
             LATERAL (SELECT CASE WHEN r.seps >= {_FIELDS - 1} THEN l.text
                                  ELSE substr(r.record, 1, length(r.record) - 1) || l.text END AS glued) g)
    SELECT conv_id, record_start, arg_max(record, i) AS record FROM r GROUP BY conv_id, record_start
""")
def stitch(src: Source) -> DataFrame:
    return stitch_records(src.conversations, "conv_id", "turn", "text", min_fields=_FIELDS)


@query("op_html_field_extract", """
    SELECT page_id, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title,
           regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1) AS lang
    FROM pages
""")
def html_field_extract(src: Source) -> DataFrame:
    return src.pages.select(
        "page_id", documents.html_title(F.col("html")).alias("title"),
        documents.html_language(F.col("html")).alias("lang"),
    )


@query("op_document_counts", f"""
    SELECT {sql_pad('c_custkey', 5)} AS code,
           CASE WHEN c_mktsegment = 'MACHINERY' THEN 0 ELSE c_nationkey * 10 END AS houses,
           CASE WHEN c_mktsegment IN ('MACHINERY', 'FURNITURE') THEN 0 ELSE CAST(floor(abs(c_acctbal)) AS INTEGER) END
             AS apartments
    FROM customer
""")
def document_counts(src: Source) -> DataFrame:
    """Counts out of one XML document per customer; broken documents and cells included."""
    def cell(measure: str, code: str, value) -> object:
        return F.concat(
            F.lit(f"<Cellule><Modalite code='{code}'/><Mesure>{measure}</Mesure><Valeur>"), value,
            F.lit("</Valeur></Cellule>"),
        )

    amount = F.abs("c_acctbal")
    text = F.concat(F.floor(amount).cast("string"), F.lit("."), (F.floor(amount * 100) % 100).cast("string"))
    xml = F.concat(
        F.when(F.col("c_mktsegment") == "MACHINERY", "<Donnees").otherwise("<Donnees>"),
        cell("Surface", "1", F.lit("77")),
        cell(documents.DWELLING_MEASURE, "1", (F.col("c_nationkey") * 10).cast("string")),
        cell(documents.DWELLING_MEASURE, "2", F.when(F.col("c_mktsegment") == "FURNITURE", "none").otherwise(text)),
        F.lit("</Donnees>"),
    )
    from lakestrata.functions.codes import zero_pad
    named = src.customer.select(zero_pad(F.col("c_custkey"), 5).alias("code"), xml.alias("xml"))
    return documents.housing_table(named, "code", "xml")
