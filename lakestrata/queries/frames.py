"""Joins, aggregates, set operations and the neighbour fill."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestrata.functions import recode
from lakestrata.operators import aggregate, joins
from lakestrata.operators.neighbour import fill_once, fill_to_fixpoint
from lakestrata.queries.registry import Source, cents, query, sql_cents
from lakestrata.queries.scalars import PRIORITIES


@query("op_inner_join_dims", f"""
    SELECT r_name, n_name, sum({sql_cents('l_extendedprice')})::BIGINT AS cents, count(*) AS n_lines
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name, n_name
""")
def inner_join_dims(src: Source) -> DataFrame:
    # Aggregated to supplier grain first: the dimension joins then touch one row per supplier.
    per_supplier = src.lineitem.groupBy("l_suppkey").agg(
        F.sum(cents(F.col("l_extendedprice"))).alias("cents"), F.count(F.lit(1)).alias("n_lines")
    ).withColumnRenamed("l_suppkey", "s_suppkey")
    joined = joins.attach_dimensions(
        per_supplier,
        (src.supplier.select("s_suppkey", F.col("s_nationkey").alias("n_nationkey")), ["s_suppkey"]),
        (src.nation.select("n_nationkey", "n_name", F.col("n_regionkey").alias("r_regionkey")), ["n_nationkey"]),
        (src.region, ["r_regionkey"]),
    )
    return joined.groupBy("r_name", "n_name").agg(F.sum("cents").alias("cents"), F.sum("n_lines").alias("n_lines"))


@query("op_geo_hierarchy", """
    SELECT DISTINCT n_nationkey, n_name, r_regionkey, r_name FROM customer
    JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def geo_hierarchy(src: Source) -> DataFrame:
    region_of = src.nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
    links = src.customer.select("c_nationkey").join(region_of, ["c_nationkey"]).select(
        F.col("c_nationkey").alias("n_nationkey"), F.col("n_regionkey").alias("r_regionkey")
    )
    return joins.geo_hierarchy(
        links, src.nation.select("n_nationkey", "n_name"), src.region, "n_nationkey", "r_regionkey"
    ).select("n_nationkey", "n_name", "r_regionkey", "r_name")


@query("op_entity_year_panel", """
    SELECT s_suppkey, CAST(y AS INTEGER) AS year FROM supplier, generate_series(1995, 2001) AS t(y)
""")
def entity_year_panel(src: Source) -> DataFrame:
    return joins.year_panel(src.supplier.select("s_suppkey"), 1995, 2001)


def _line_counts(src: Source) -> DataFrame:
    return aggregate.event_counts(
        src.lineitem.select(F.col("l_suppkey").alias("s_suppkey"), "l_shipdate",
                            F.col("l_quantity").cast("bigint").alias("quantity"),
                            F.when(F.col("l_returnflag") == "R", 1).alias("returned")),
        "s_suppkey", "l_shipdate", sums={"n_units": "quantity"},
        counts={"n_lines": "s_suppkey", "n_returned": "returned"}, before_year=2001,
    )


_LINE_COUNTS = """
    SELECT l_suppkey AS s_suppkey, CAST(year(l_shipdate) AS INTEGER) AS year,
           sum(CAST(l_quantity AS BIGINT))::BIGINT AS n_units, count(l_suppkey) AS n_lines,
           count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS n_returned
    FROM lineitem WHERE year(l_shipdate) < 2001 GROUP BY ALL
"""


@query("op_event_counts_by_year", _LINE_COUNTS)
def event_counts_by_year(src: Source) -> DataFrame:
    return _line_counts(src)


def supplier_year_facts(src: Source) -> DataFrame:
    """Supplier × year with zero-filled line counts: the municipality-year shape."""
    panel = joins.year_panel(src.supplier.select("s_suppkey", "s_nationkey"), 1995, 2003)
    return joins.zero_filled(
        panel, ["s_suppkey", "year"], _line_counts(src), fill=["n_units", "n_lines", "n_returned"]
    )


_SUPPLIER_FACTS = f"""
    SELECT s_suppkey, s_nationkey, CAST(y AS INTEGER) AS year, coalesce(n_units, 0)::BIGINT AS n_units,
           coalesce(n_lines, 0) AS n_lines, coalesce(n_returned, 0) AS n_returned
    FROM (SELECT s_suppkey, s_nationkey, y FROM supplier, generate_series(1995, 2003) AS t(y)) p
    LEFT JOIN ({_LINE_COUNTS}) f USING (s_suppkey) WHERE f.year = y
    UNION ALL
    SELECT s_suppkey, s_nationkey, CAST(y AS INTEGER), 0, 0, 0
    FROM supplier, generate_series(1995, 2003) AS t(y)
    WHERE NOT EXISTS (SELECT 1 FROM ({_LINE_COUNTS}) f WHERE f.s_suppkey = supplier.s_suppkey AND f.year = y)
"""


@query("op_left_join_zero_fill", _SUPPLIER_FACTS)
def left_join_zero_fill(src: Source) -> DataFrame:
    return supplier_year_facts(src)


@query("op_two_level_rollup", f"""
    SELECT n_name, year, sum(n_units)::BIGINT AS n_units, sum(n_lines)::BIGINT AS n_lines,
           sum(n_returned)::BIGINT AS n_returned
    FROM ({_SUPPLIER_FACTS}) JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name, year
""")
def two_level_rollup(src: Source) -> DataFrame:
    measures = ["n_units", "n_lines", "n_returned"]
    rolled = aggregate.roll_up(supplier_year_facts(src), ["s_nationkey", "year"], measures)
    names = src.nation.select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    return joins.attach_dimensions(rolled, (names, ["s_nationkey"])).select("n_name", "year", *measures)


@query("op_missing_combinations", """
    SELECT c_custkey, CAST(y AS INTEGER) AS year FROM customer, generate_series(1995, 2001) AS t(y)
    WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND year(o_orderdate) = y)
""")
def missing_combinations(src: Source) -> DataFrame:
    panel = joins.year_panel(src.customer.select("c_custkey"), 1995, 2001)
    observed = src.orders.select(F.col("o_custkey").alias("c_custkey"), F.year("o_orderdate").alias("year"))
    return joins.missing_rows(panel, observed, ["c_custkey", "year"])


@query("op_semi_gate", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM lineitem
    WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')
""")
def semi_gate(src: Source) -> DataFrame:
    gate = src.orders.where("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("l_orderkey"))
    lines = src.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate")
    return joins.having_id_in(lines, gate, "l_orderkey")


def _nation_year_revenue(src: Source) -> DataFrame:
    per_customer = src.orders.groupBy("o_custkey", F.year("o_orderdate").alias("year")).agg(
        F.sum(cents(F.col("o_totalprice"))).alias("cents"), F.count(F.lit(1)).alias("n")
    ).withColumnRenamed("o_custkey", "c_custkey")
    return (
        per_customer.join(src.customer.select("c_custkey", "c_nationkey"), ["c_custkey"])
        .groupBy("c_nationkey", "year").agg(F.sum("cents").alias("revenue"), F.sum("n").alias("n_orders"))
    )


_NATION_YEAR = f"""
    SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year, sum({sql_cents('o_totalprice')})::BIGINT AS revenue,
           count(*) AS n_orders
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL
"""


def _orders_of_nation(src: Source) -> DataFrame:
    nation_of = src.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    return src.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("order_year")).join(
        nation_of, ["o_custkey"]
    ).drop("o_custkey")


@query("op_panel_join", f"""
    SELECT o_orderkey, c.c_nationkey AS nation, p.year AS order_year, p.revenue, p.n_orders
    FROM orders JOIN customer c ON o_custkey = c_custkey
    JOIN ({_NATION_YEAR}) p ON p.c_nationkey = c.c_nationkey AND p.year = year(o_orderdate)
""")
def panel_join(src: Source) -> DataFrame:
    return joins.panel_lookup(
        _orders_of_nation(src), _nation_year_revenue(src), {"nation": "c_nationkey", "order_year": "year"}
    )


@query("op_lag_join", f"""
    WITH p AS ({_NATION_YEAR})
    SELECT o_orderkey, c.c_nationkey AS nation, p0.year AS order_year, p0.revenue AS revenue_0,
           p1.revenue AS revenue_1, p2.revenue AS revenue_2
    FROM orders JOIN customer c ON o_custkey = c_custkey
    JOIN p p0 ON p0.c_nationkey = c.c_nationkey AND p0.year = year(o_orderdate)
    JOIN p p1 ON p1.c_nationkey = c.c_nationkey AND p1.year + 1 = year(o_orderdate)
    JOIN p p2 ON p2.c_nationkey = c.c_nationkey AND p2.year + 2 = year(o_orderdate)
""")
def lag_join(src: Source) -> DataFrame:
    return joins.lag_join(
        _orders_of_nation(src), _nation_year_revenue(src), {"nation": "c_nationkey", "order_year": "year"},
        "c_nationkey", "year", ["revenue"],
    )


@query("op_first_event", """
    SELECT o_custkey, min(o_orderdate) AS first_order FROM orders GROUP BY o_custkey
""")
def first_event(src: Source) -> DataFrame:
    return aggregate.first_event(src.orders, "o_custkey", "o_orderdate", "first_order")


@query("op_group_averages", f"""
    SELECT user_id, CAST(month(ts) AS INTEGER) AS month,
           CAST(round(CAST(CAST(avg({sql_cents('value')}) AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS value_cents,
           CAST(round(CAST(CAST(avg(length(props)) AS VARCHAR) AS DECIMAL(38, 18)), 2) AS DOUBLE) AS props_length
    FROM events GROUP BY ALL
""")
def group_averages(src: Source) -> DataFrame:
    measured = src.events.select(
        "user_id", F.month("ts").alias("month"), cents(F.col("value")).alias("value_cents"),
        F.length("props").alias("props_length"),
    )
    return aggregate.group_averages(measured, ["user_id", "month"], ["value_cents", "props_length"])


@query("op_grade_averages", """
    SELECT c_nationkey, avg(CAST(substr(o_orderpriority, 1, 1) AS DOUBLE)) AS avg_grade,
           avg(CASE o_orderstatus WHEN 'F' THEN 1.0::DOUBLE WHEN 'O' THEN 2.0::DOUBLE ELSE 0.0::DOUBLE END)
             AS avg_status, count(c_nationkey) AS n_orders
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey
""")
def grade_averages(src: Source) -> DataFrame:
    nation_of = src.customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    graded = src.orders.select(
        "o_custkey", recode.grade_to_number(F.col("o_orderpriority"), PRIORITIES).alias("grade"),
        recode.grade_to_number(F.col("o_orderstatus"), ["F", "O"]).alias("status"),
    ).join(nation_of, ["o_custkey"])
    return aggregate.measure_of_groups(
        graded, ["c_nationkey"], avg_grade=F.avg("grade"), avg_status=F.avg("status"), n_orders=F.count("c_nationkey")
    )


@query("op_segment_counts", """
    SELECT l_returnflag, l_linestatus, l_linenumber, CAST(year(l_shipdate) AS INTEGER) AS year,
           CASE WHEN l_quantity < 10 THEN 1 WHEN l_quantity < 25 THEN 2 ELSE 3 END AS quantity_class,
           l_discount + 0 AS discount, l_tax + 0 AS tax, CAST(month(l_shipdate) AS INTEGER) AS month,
           count(*) AS count
    FROM lineitem GROUP BY ALL
""")
def segment_counts(src: Source) -> DataFrame:
    dims = src.lineitem.select(
        "l_returnflag", "l_linestatus", "l_linenumber", F.year("l_shipdate").alias("year"),
        recode.bin_left_closed(F.col("l_quantity"), [10, 25]).alias("quantity_class"),
        (F.col("l_discount") + 0).alias("discount"), (F.col("l_tax") + 0).alias("tax"),
        F.month("l_shipdate").alias("month"),
    )
    return aggregate.segment_counts(dims, dims.columns)


@query("op_group_size_attach", """
    SELECT o_orderkey, o_custkey, count(*) OVER (PARTITION BY o_custkey) AS n_orders FROM orders
""")
def group_size_attach(src: Source) -> DataFrame:
    return aggregate.attach_group_size(src.orders.select("o_orderkey", "o_custkey"), "o_custkey", "n_orders").select(
        "o_orderkey", "o_custkey", "n_orders"
    )


@query("op_distinct_rows", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def distinct_rows(src: Source) -> DataFrame:
    return aggregate.drop_repeats(src.lineitem, ["l_orderkey", "l_linenumber"])


@query("op_row_audit", """
    SELECT 'lineitem' AS table_name, count(*) AS n_rows FROM lineitem
    UNION ALL SELECT 'lineitem_keys', count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)
    UNION ALL SELECT 'orders', count(*) FROM orders
    UNION ALL SELECT 'documents', count(*) FROM documents
""")
def row_audit(src: Source) -> DataFrame:
    return aggregate.row_audit({
        "lineitem": src.lineitem,
        "lineitem_keys": aggregate.drop_repeats(src.lineitem, ["l_orderkey", "l_linenumber"]),
        "orders": src.orders, "documents": src.documents,
    })


@query("op_ordered_listing", """
    SELECT c_nationkey, c_mktsegment, c_custkey FROM customer ORDER BY c_nationkey, c_mktsegment, c_custkey
""")
def ordered_listing(src: Source) -> DataFrame:
    columns = ["c_nationkey", "c_mktsegment", "c_custkey"]
    return src.customer.select(*columns).orderBy(*columns)


@query("op_union_vintages", """
    SELECT o_custkey, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS n_orders,
           CASE WHEN o_orderdate < TIMESTAMP '1998-07-01' THEN 'old' ELSE 'new' END AS vintage
    FROM orders GROUP BY ALL
""")
def union_vintages(src: Source) -> DataFrame:
    cut = F.lit("1998-07-01").cast("timestamp_ntz")

    def vintage(kept: DataFrame, name: str) -> DataFrame:
        return aggregate.event_counts(kept, "o_custkey", "o_orderdate", counts={"n_orders": "o_orderkey"}).withColumn(
            "vintage", F.lit(name)
        )

    return aggregate.union_vintages(
        vintage(src.orders.where(F.col("o_orderdate") < cut), "old"),
        vintage(src.orders.where(F.col("o_orderdate") >= cut), "new"),
    )


# Region 2 has no stations. Around the first ring its nations lie apart, so one pass reaches them; around the
# second they lie side by side, so the values come in over several passes. No nation is further than 12 steps
# from another: the 13 passes of the oracle include one without effect.
def _station_days(src: Source) -> DataFrame:
    equipped = src.nation.where("n_regionkey <> 2").select(F.col("n_nationkey").alias("station"))
    return (
        src.events.groupBy((F.col("user_id") % 25).cast("int").alias("station"), F.to_date("ts").alias("day"))
        .agg(F.sum(cents(F.col("value"))).alias("s"), F.count(F.lit(1)).alias("n"), F.min("event_id").alias("low"))
        .join(equipped, ["station"])
        .select("station", "day", (F.col("s") / F.col("n")).alias("value"), F.col("low").cast("double").alias("low"))
    )


# Position of a nation in each ring: by its key, or region by region.
_BY_KEY = "{n}.n_nationkey"
_BY_REGION = "({n}.n_regionkey * 5 + floor({n}.n_nationkey / 5))"


def ring_sql(position: str) -> str:
    """Each nation with the ones before and after it; the same text for both engines."""
    here, there = position.format(n="a"), position.format(n="b")
    return " UNION ALL ".join(
        f"SELECT a.n_nationkey AS src, b.n_nationkey AS dst FROM {{nation}} a JOIN {{nation}} b ON {there} = ({here} + {step}) % 25"
        for step in (1, 24)
    )


def _ring(src: Source, position: str) -> DataFrame:
    return src.spark.sql(ring_sql(position), nation=src.nation)


def _sql_stations(position: str) -> str:
    return f"""
    ring AS ({ring_sql(position).format(nation='nation')}),
    f0 AS MATERIALIZED (SELECT CAST(user_id % 25 AS INTEGER) AS station, CAST(ts AS DATE) AS day,
                  sum({sql_cents('value')})::DOUBLE / count(*) AS value, min(event_id)::DOUBLE AS low
           FROM events JOIN nation ON n_nationkey = user_id % 25 WHERE n_regionkey <> 2 GROUP BY 1, 2)"""


def _sql_pass(k: int) -> str:
    """One synchronous pass over everything known, as plain SQL."""
    return f"""
    f{k} AS MATERIALIZED (SELECT * FROM f{k - 1} UNION ALL
           SELECT src, day, avg(value), avg(low) FROM ring JOIN f{k - 1} ON dst = station
           WHERE NOT EXISTS (SELECT 1 FROM f{k - 1} x WHERE x.station = src AND x.day = f{k - 1}.day)
           GROUP BY src, day)"""


@query("op_neighbour_fill_once", f"""
    WITH {_sql_stations(_BY_KEY)}, {_sql_pass(1)} SELECT station, day, value, low FROM f1
""")
def neighbour_fill_once(src: Source) -> DataFrame:
    return fill_once(_station_days(src), _ring(src, _BY_KEY), "station", ["day"], ["value", "low"], places=None)


@query("op_neighbour_fill_fix", f"""
    WITH {_sql_stations(_BY_REGION)}, {', '.join(_sql_pass(k) for k in range(1, 14))}
    SELECT station, day, value, low FROM f13
""")
def neighbour_fill_fix(src: Source) -> DataFrame:
    return fill_to_fixpoint(
        _station_days(src), _ring(src, _BY_REGION), "station", ["day"], ["value", "low"], places=None
    )
