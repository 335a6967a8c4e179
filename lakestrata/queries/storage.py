"""Writing tables and reading them back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from lakestrata.queries.registry import Source, query
from lakestrata.session import cut_lineage, shared_folder
from lakestrata.sources.files import LAYERS, Lake, clean_headers, create_layers, read_broken_records, read_delimited


@query("op_delimited_round_trip", """
    SELECT CASE WHEN length(o_orderkey::VARCHAR) < 8 THEN lpad(o_orderkey::VARCHAR, 8, '0') ELSE o_orderkey::VARCHAR END AS code, o_orderstatus AS status, o_orderpriority AS priority,
           o_orderdate::DATE AS day, NULL::VARCHAR AS malformed FROM orders
""")
def delimited_round_trip(src: Source) -> DataFrame:
    """Orders as delimited text, read with their types: codes keep their zeros, no line is malformed."""
    key = F.col("o_orderkey").cast("string")
    rows = src.orders.select(
        F.when(F.length(key) < 8, F.lpad(key, 8, "0")).otherwise(key).alias("code"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"), F.to_date("o_orderdate").alias("day"),
    )
    path = shared_folder(src.spark, "delimited")
    rows.write.option("sep", ";").option("header", True).csv(path)
    return read_delimited(src.spark, path, "code string, status string, priority string, day date", ";", malformed="malformed")


@query("op_layer_round_trip", "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'")
def layer_round_trip(src: Source) -> DataFrame:
    """A layer table stored by status: a filter on the status reads its folder only."""
    lake = Lake(src.spark, shared_folder(src.spark, "lake"))
    stored = lake.write(src.orders.select("o_orderkey", "o_custkey", "o_orderstatus"), "Silver", "Orders", ["o_orderstatus"])
    return stored.where("o_orderstatus = 'F'")


@query("op_clean_headers", """
    SELECT c_custkey AS "custkey raw", c_name AS "name plain", c_mktsegment AS segment FROM customer
""")
def cleaned_headers(src: Source) -> DataFrame:
    """A file whose header has commas in its names, read without them."""
    path = shared_folder(src.spark, "headers")
    named = src.customer.select(F.col("c_custkey").alias("custkey, raw"), F.col("c_name").alias("name, plain"), F.col("c_mktsegment").alias("segment"))
    named.write.option("sep", ";").option("header", True).csv(path)
    return clean_headers(read_delimited(src.spark, path, "`custkey, raw` bigint, `name, plain` string, segment string", ";"), ",")


@query("op_layer_namespaces", "SELECT lower(['Datalake', 'Intermediate', 'Silver', 'Model', 'Gold'][n_regionkey + 1]) AS layer, n_nationkey, n_name FROM nation")
def layer_namespaces(src: Source) -> DataFrame:
    """Every layer is a namespace of the catalog: a table of nations in each, told back with the layer's name."""
    create_layers(src.spark)
    lake, name, out = Lake(src.spark), f"nations_{uuid.uuid4().hex}", None
    for number, layer in enumerate(LAYERS):
        told = lake.write(src.nation.where(F.col("n_regionkey") == number).select("n_nationkey", "n_name"), layer, name)
        rows = told.select(F.lit(layer.lower()).alias("layer"), "n_nationkey", "n_name")
        out = rows if out is None else out.unionByName(rows)
    kept = cut_lineage(out)
    for layer in LAYERS:
        src.spark.sql(f"DROP TABLE {layer}.{name}")
    return kept


@query("op_bucketed_join", """
    SELECT l_orderkey, l_linenumber, o_orderstatus FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
def bucketed_join(src: Source) -> DataFrame:
    """Two tables stored by the key they are joined on, so that no row is shuffled for the join."""
    lake = Lake(src.spark, shared_folder(src.spark, "lake"), buckets=8)
    lines = lake.write(src.lineitem.select("l_orderkey", "l_linenumber"), "Silver", "Lines", bucket_by=["l_orderkey"])
    orders = lake.write(src.orders.select("o_orderkey", "o_orderstatus"), "Silver", "Orders", bucket_by=["o_orderkey"])
    return lines.join(orders.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey")).select("l_orderkey", "l_linenumber", "o_orderstatus")


_BROKEN_HEADER = "number,customer,status,cents,day,priority"


@query("table_broken_records", """
    SELECT o_orderkey AS number, o_custkey AS customer, o_orderstatus AS status, CAST(round(o_totalprice * 100) AS BIGINT) AS cents,
           o_orderdate::DATE AS day, o_orderpriority AS priority FROM orders
""")
def broken_records(src: Source) -> DataFrame:
    """Orders in files of record lines, two in three broken over two or three lines with a stray character at each break."""
    fields = [
        F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").cast("string"), F.to_date("o_orderdate").cast("string"), F.col("o_orderpriority"),
    ]
    turn, torn = F.col("o_orderkey") % 3, F.lit("_\n")
    line = F.concat(
        fields[0], F.lit(","), fields[1], F.when(turn > 0, torn).otherwise(F.lit("")), F.lit(","), fields[2], F.lit(","),
        fields[3], F.when(turn > 1, torn).otherwise(F.lit("")), F.lit(","), fields[4], F.lit(","), fields[5],
    )
    # every file begins with the header
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    path = shared_folder(src.spark, "records")
    rows = src.orders.select("o_orderkey", line.alias("line")).repartition(4, "o_orderkey")
    rows.select(F.when(first, F.concat(F.lit(_BROKEN_HEADER + "\n"), F.col("line"))).otherwise(F.col("line")).alias("value")).write.option("lineSep", "\n").text(path)
    types = {"number": "bigint", "customer": "bigint", "cents": "bigint", "day": "date"}
    return read_broken_records(src.spark, path, types, min_fields=6)
