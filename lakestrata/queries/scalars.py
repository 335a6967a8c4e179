"""Projections, scalar expressions and filters."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakestrata.functions import codes, measures, predicates, recode, stable
from lakestrata.operators.ids import dense_id
from lakestrata.plans.silver import occupation_code
from lakestrata.queries.registry import Source, query, sql_key_number, sql_pad
from lakestrata.sources.files import rename_columns

PRIORITIES = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query("op_rename_columns", """
    SELECT p_partkey AS part_id, p_size AS size, p_name AS label FROM part
""")
def rename(src: Source) -> DataFrame:
    named = rename_columns(src.part, {"p_partkey": "part_id", "p_name": "label", "p_size": "size"})
    return named.drop("p_brand", "p_type", "p_retailprice").select("part_id", "size", "label")


@query("op_lateral_alias", """
    SELECT p_partkey, CASE WHEN p_size < 25 THEN 1 ELSE 2 END AS size_class,
           CASE WHEN p_size < 25 THEN 1 ELSE 2 END * 10 AS size_points,
           p_size + 1 AS p_size, p_size * 2 AS double_size
    FROM part
""")
def lateral_alias(src: Source) -> DataFrame:
    # `size_points` reads the new column; `double_size` reads the p_size of the input, which wins over the new one.
    return src.part.select("p_partkey", "p_size").withColumns({
        "size_class": F.when(F.col("p_size") < 25, 1).otherwise(2),
        "size_points": F.col("size_class") * 10,
        "p_size": F.col("p_size") + 1,
        "double_size": F.col("p_size") * 2,
    })


@query("op_typed_null", """
    SELECT o_orderkey, CAST(NULL AS VARCHAR) AS remark, CAST(NULL AS DOUBLE) AS score FROM orders
""")
def typed_null(src: Source) -> DataFrame:
    return src.orders.select(
        "o_orderkey", recode.typed_null("string").alias("remark"), recode.typed_null("double").alias("score")
    )


@query("op_zero_pad", f"""
    SELECT c_custkey, {sql_pad('c_custkey', 5)} AS code5, {sql_pad('c_custkey', 3)} AS code3,
           {sql_pad('c_nationkey', 2)} AS code2
    FROM customer
""")
def zero_pad(src: Source) -> DataFrame:
    return src.customer.select(
        "c_custkey", codes.zero_pad(F.col("c_custkey"), 5).alias("code5"),
        codes.zero_pad(F.col("c_custkey"), 3).alias("code3"), codes.zero_pad(F.col("c_nationkey"), 2).alias("code2"),
    )


_SUPPLIER_CODE = f"({sql_pad('s_nationkey', 2)}) || ({sql_pad('s_suppkey', 3)})"


@query("op_composite_key", f"SELECT s_suppkey, {_SUPPLIER_CODE} AS supplier_code FROM supplier")
def composite_key(src: Source) -> DataFrame:
    return src.supplier.select("s_suppkey", codes.composite_key(
        codes.zero_pad(F.col("s_nationkey"), 2), F.col("s_suppkey"), 3
    ).alias("supplier_code"))


@query("op_code_prefix", f"SELECT s_suppkey, substr({_SUPPLIER_CODE}, 1, 2) AS nation_code FROM supplier")
def code_prefix(src: Source) -> DataFrame:
    code = codes.composite_key(codes.zero_pad(F.col("s_nationkey"), 2), F.col("s_suppkey"), 3)
    return src.supplier.select("s_suppkey", codes.code_prefix(code, 2).alias("nation_code"))


@query("op_recode_map", """
    SELECT p_partkey,
           CASE WHEN p_size IN (1, 2, 3) THEN 6 WHEN p_size IN (4, 5) THEN 5 WHEN p_size = 11 THEN 4 END AS size_code,
           CASE p_type WHEN 'ECONOMY' THEN 0 WHEN 'SMALL' THEN 1 END AS type_code
    FROM part
""")
def recode_map(src: Source) -> DataFrame:
    return src.part.select(
        "p_partkey",
        recode.recode_groups(F.col("p_size"), {6: [1, 2, 3], 5: [4, 5], 4: [11]}).alias("size_code"),
        recode.recode(F.col("p_type"), {"ECONOMY": 0, "SMALL": 1}).alias("type_code"),
    )


@query("op_recode_default", """
    SELECT o_orderkey,
           CASE WHEN o_totalprice > 400000 THEN 1 WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS open_flag,
           CASE WHEN o_orderpriority = '5-LOW' THEN 'LOW' ELSE o_orderpriority END AS priority
    FROM orders
""")
def recode_default(src: Source) -> DataFrame:
    status = F.when(F.col("o_totalprice") > 400000, None).otherwise(F.col("o_orderstatus"))
    return src.orders.select(
        "o_orderkey", recode.flag_other(status, "F", null_as=1).alias("open_flag"),
        recode.replace_value(F.col("o_orderpriority"), "5-LOW", "LOW").alias("priority"),
    )


@query("op_grade_to_number", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 1.0::DOUBLE WHEN '2-HIGH' THEN 2.0::DOUBLE
           WHEN '3-MEDIUM' THEN 3.0::DOUBLE WHEN '4-NOT SPECIFIED' THEN 4.0::DOUBLE ELSE 0.0::DOUBLE END AS grade
    FROM orders
""")
def grade_to_number(src: Source) -> DataFrame:
    return src.orders.select(
        "o_orderkey", recode.grade_to_number(F.col("o_orderpriority"), PRIORITIES[:4]).alias("grade")
    )


@query("op_bin_left_closed", """
    WITH p AS (SELECT p_partkey, p_size, CASE WHEN p_type <> 'ECONOMY' THEN p_retailprice END AS price FROM part)
    SELECT p_partkey,
           CASE WHEN p_size < 10 THEN 1 WHEN p_size < 25 THEN 2 WHEN p_size < 40 THEN 3 WHEN p_size >= 40 THEN 4 END
             AS size_class,
           CASE WHEN price < 950 THEN 1 WHEN price < 1000 THEN 2 WHEN price >= 1000 THEN 3 END AS price_class
    FROM p
""")
def bin_left_closed(src: Source) -> DataFrame:
    price = F.when(F.col("p_type") != "ECONOMY", F.col("p_retailprice"))
    return src.part.select(
        "p_partkey", recode.bin_left_closed(F.col("p_size"), [10, 25, 40]).alias("size_class"),
        recode.bin_left_closed(price, [950, 1000]).alias("price_class"),
    )


@query("op_bin_right_closed", """
    SELECT event_id, CASE WHEN event_type = 'error' THEN 9 WHEN value <= 5 THEN 0 WHEN value <= 10 THEN 1
           WHEN value <= 20 THEN 2 WHEN value <= 35 THEN 3 WHEN value <= 55 THEN 4 WHEN value <= 80 THEN 5
           ELSE 6 END AS value_class
    FROM events
""")
def bin_right_closed(src: Source) -> DataFrame:
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return src.events.select(
        "event_id", recode.bin_right_closed(value, [5, 10, 20, 35, 55, 80], null_as=9).alias("value_class")
    )


@query("op_decode_labels", """
    SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 25 THEN 'medium' WHEN p_size < 40 THEN '3'
           ELSE '4' END AS size_label
    FROM part
""")
def decode_labels(src: Source) -> DataFrame:
    size_class = recode.bin_left_closed(F.col("p_size"), [10, 25, 40])
    return src.part.select("p_partkey", recode.decode_label(size_class, {1: "small", 2: "medium"}).alias("size_label"))


_SHORT_PRIORITY = "CASE WHEN o_orderstatus = 'F' THEN substr(o_orderpriority, 1, 1) ELSE o_orderpriority END"


@query("op_label_to_ordinal", f"""
    WITH o AS (SELECT o_orderkey, {_SHORT_PRIORITY} AS label FROM orders)
    SELECT o_orderkey, CASE label WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2 WHEN '3-MEDIUM' THEN 3
           ELSE TRY_CAST(label AS INTEGER) END AS ordinal
    FROM o
""")
def label_to_ordinal(src: Source) -> DataFrame:
    label = F.when(F.col("o_orderstatus") == "F", F.substring("o_orderpriority", 1, 1)).otherwise(
        F.col("o_orderpriority")
    )
    return src.orders.select("o_orderkey", recode.label_to_ordinal(label, PRIORITIES[:3]).alias("ordinal"))


@query("op_rowwise_mean", """
    WITH l AS (
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_quantity AS a,
               CASE WHEN l_returnflag = 'N' THEN l_discount * 100 END AS b,
               CASE WHEN l_linestatus = 'O' THEN l_tax * 100 END AS c FROM lineitem)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
           CAST(trunc((CASE WHEN a > 0 THEN a ELSE 0 END + CASE WHEN b > 0 THEN b ELSE 0 END
                 + CASE WHEN c > 0 THEN c ELSE 0 END)
                / nullif((CASE WHEN a > 0 THEN 1 ELSE 0 END) + (CASE WHEN b > 0 THEN 1 ELSE 0 END)
                 + (CASE WHEN c > 0 THEN 1 ELSE 0 END), 0)) AS INTEGER) AS mean_positive
    FROM l
""")
def rowwise_mean(src: Source) -> DataFrame:
    return src.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        measures.rowwise_positive_mean([
            F.col("l_quantity"), F.when(F.col("l_returnflag") == "N", F.col("l_discount") * 100),
            F.when(F.col("l_linestatus") == "O", F.col("l_tax") * 100),
        ]).alias("mean_positive"),
    )


@query("op_threshold_flag", """
    SELECT o_orderkey, CASE WHEN o_orderpriority IN ('2-HIGH', '3-MEDIUM') THEN 1 ELSE 0 END AS flag FROM orders
""")
def threshold_flag(src: Source) -> DataFrame:
    ordinal = recode.label_to_ordinal(F.col("o_orderpriority"), PRIORITIES[:3])
    return src.orders.select("o_orderkey", recode.threshold_flag(ordinal, 2).alias("flag"))


@query("op_rule_flag", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
           CASE WHEN l_returnflag = 'R' THEN 1
                WHEN l_returnflag = 'A' AND (l_quantity >= 40 OR l_extendedprice / 1000 >= 40) THEN 1 ELSE 0 END AS flag
    FROM lineitem
""")
def rule_flag(src: Source) -> DataFrame:
    return src.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        recode.rule_flag(
            F.col("l_returnflag"), ["R"], ["A"], [F.col("l_quantity"), F.col("l_extendedprice") / 1000], 40
        ).alias("flag"),
    )


@query("op_nested_recode", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderstatus = 'O' THEN 1
                            WHEN o_orderpriority = '5-LOW' THEN 0 ELSE 1 END AS code
    FROM orders
""")
def nested_recode(src: Source) -> DataFrame:
    return src.orders.select("o_orderkey", recode.nested_recode(
        F.col("o_orderstatus"), {"F": 0, "O": 1}, F.col("o_orderpriority"), {"5-LOW": 0}, 1
    ).alias("code"))


@query("op_classify_membership", """
    SELECT p_partkey, CASE WHEN p_type IN ('ECONOMY', 'PROMO') THEN 1 WHEN p_type = 'SMALL' THEN 2
           WHEN p_type IN ('STANDARD', 'LARGE', 'MEDIUM') THEN
             CASE WHEN contains(p_name, 'red') OR contains(p_name, 'ring') THEN 5 ELSE 6 END END AS class
    FROM part
""")
def classify_membership(src: Source) -> DataFrame:
    return src.part.select("p_partkey", recode.classify_members(
        F.col("p_type"), {1: ["ECONOMY", "PROMO"], 2: ["SMALL"]},
        ["STANDARD", "LARGE", "MEDIUM"], F.col("p_name"), ["red", "ring"], 5, 6,
    ).alias("class"))


@query("op_derived_code", """
    SELECT c_custkey, CASE WHEN c_nationkey IN (1, 2) AND c_custkey % 13 <> 11 THEN c_custkey % 13 + 5
                           ELSE c_nationkey - 2 END AS occupation
    FROM customer
""")
def derived_code(src: Source) -> DataFrame:
    return src.customer.select(
        "c_custkey", occupation_code(F.col("c_nationkey"), F.col("c_custkey") % 13).alias("occupation")
    )


@query("op_split_label", """
    WITH p AS (SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' THEN p_name
                      ELSE p_type || ' - ' || p_name || ' - ' || p_brand END AS label FROM part)
    SELECT p_partkey, regexp_extract(label, '(.*) - ', 1) AS question, regexp_extract(label, ' - (.*)', 1) AS answer
    FROM p
""")
def split_label(src: Source) -> DataFrame:
    label = F.when(F.col("p_type") == "ECONOMY", F.col("p_name")).otherwise(
        F.concat_ws(" - ", "p_type", "p_name", "p_brand")
    )
    return src.part.select(
        "p_partkey", codes.label_question(label).alias("question"), codes.label_answer(label).alias("answer")
    )


@query("op_last_token", """
    SELECT p_partkey, reverse(split_part(reverse(p_brand), '#', 1)) AS brand_no,
           reverse(split_part(reverse(p_name), ' ', 1)) AS kind
    FROM part
""")
def last_token(src: Source) -> DataFrame:
    return src.part.select(
        "p_partkey", codes.last_token(F.col("p_brand"), "#").alias("brand_no"),
        codes.last_token(F.col("p_name"), " ").alias("kind"),
    )


@query("op_year_month", """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
    FROM orders
""")
def year_month(src: Source) -> DataFrame:
    return src.orders.select("o_orderkey", F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))


@query("op_clamp_year", """
    SELECT o_orderkey, CAST(least(year(o_orderdate), 2000) AS INTEGER) AS year FROM orders
""")
def clamp_year(src: Source) -> DataFrame:
    return src.orders.select("o_orderkey", measures.clamp_year(F.col("o_orderdate"), 2000).alias("year"))


@query("op_date_window", """
    SELECT o_orderkey, o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-12-31' AS strictly_inside
    FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-01-01'
""")
def date_window(src: Source) -> DataFrame:
    date = F.col("o_orderdate")
    return src.orders.where(predicates.within_dates(date, "1996-01-01", "1999-01-01")).select(
        "o_orderkey", predicates.inside_dates(date, "1996-01-01", "1998-12-31").alias("strictly_inside")
    )


@query("op_safe_ratio", """
    SELECT l_suppkey, avg(CAST(floor(l_extendedprice / nullif(l_discount, 0)) AS BIGINT)) AS avg_ratio
    FROM lineitem WHERE l_discount <> 0 GROUP BY l_suppkey
""")
def safe_ratio(src: Source) -> DataFrame:
    # Whole units make the mean independent of the summation order.
    ratio = F.floor(measures.safe_ratio(F.col("l_extendedprice"), F.col("l_discount"))).cast("bigint")
    return (
        src.lineitem.select("l_suppkey", ratio.alias("ratio")).where("ratio IS NOT NULL")
        .groupBy("l_suppkey").agg(F.avg("ratio").alias("avg_ratio"))
    )


@query("op_round_measures", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, CAST(round(CAST(CAST(
        l_extendedprice * (1 - l_discount) AS VARCHAR) AS DECIMAL(38, 15)), 2) AS DOUBLE) AS net
    FROM lineitem
""")
def round_measures(src: Source) -> DataFrame:
    return src.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        measures.round_measure(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net"),
    )


@query("op_coalesce_columns", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate,
           coalesce(nullif(l_discount, 0), l_tax) AS rate FROM lineitem
""")
def coalesce_columns(src: Source) -> DataFrame:
    return src.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        measures.observed_or(F.nullif(F.col("l_discount"), F.lit(0.0)), F.col("l_tax")).alias("rate"),
    )


@query("op_seeded_pick", f"""
    SELECT c_custkey, CAST(2014 + {sql_key_number('c_custkey')} % 3 AS INTEGER) AS picked FROM customer
""")
def seeded_pick(src: Source) -> DataFrame:
    return src.customer.select("c_custkey", stable.seeded_pick([2014, 2015, 2016], F.col("c_custkey")).alias("picked"))


@query("op_hash_split", f"""
    SELECT o_orderkey, CASE WHEN {sql_key_number('o_orderkey')} % 100 < 60 THEN 'train'
                            WHEN {sql_key_number('o_orderkey')} % 100 < 80 THEN 'val' ELSE 'test' END AS part
    FROM orders
""")
def hash_split(src: Source) -> DataFrame:
    return src.orders.select("o_orderkey", stable.hash_split(F.col("o_orderkey")).alias("part"))


@query("op_dense_id", f"""
    SELECT row_number() OVER (ORDER BY {sql_key_number('o_orderkey')} % 4096, o_orderkey) - 1 AS order_id, o_orderkey
    FROM orders
""")
def dense_ids(src: Source) -> DataFrame:
    return dense_id(
        src.orders.select("o_orderkey"), "order_id", ["o_orderkey"], bucket=stable.key_bucket(4096, F.col("o_orderkey"))
    )


@query("op_complete_rows", """
    SELECT o_orderkey, o_custkey FROM orders
    WHERE o_orderstatus <> 'P' AND o_totalprice <= 400000 AND o_orderpriority <> '4-NOT SPECIFIED'
""")
def complete_rows(src: Source) -> DataFrame:
    gaps = src.orders.select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        F.when(F.col("o_totalprice") <= 400000, F.col("o_totalprice")).alias("price"),
        F.when(F.col("o_orderpriority") != "4-NOT SPECIFIED", F.col("o_orderpriority")).alias("priority"),
    )
    gated = gaps.where(predicates.all_present(F.col("status"), F.col("price")))
    return gated.dropna("any").select("o_orderkey", "o_custkey")


@query("op_exclude_sentinels", """
    SELECT p_partkey, p_size FROM part WHERE p_size NOT IN (10, 11, 49) AND p_type <> 'ECONOMY'
""")
def exclude_sentinels(src: Source) -> DataFrame:
    masked = F.when(F.col("p_type") != "ECONOMY", F.col("p_size"))
    return src.part.where(predicates.not_sentinel(masked, [10, 11, 49])).select("p_partkey", "p_size")


@query("op_range_filter", """
    SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 50000 AND o_totalprice < 150000
""")
def range_filter(src: Source) -> DataFrame:
    return src.orders.where(predicates.strictly_between(F.col("o_totalprice"), 50000, 150000)).select(
        "o_orderkey", "o_totalprice"
    )


@query("op_not_contains", """
    SELECT p_partkey, p_name FROM part WHERE NOT contains(p_name, 'red') AND NOT contains(p_name, 'bolt')
""")
def not_contains(src: Source) -> DataFrame:
    return src.part.where(predicates.contains_none(F.col("p_name"), ["red", "bolt"])).select("p_partkey", "p_name")


_MIXED_CODE = f"CASE WHEN p_type = 'SMALL' THEN '2' || substr(p_type, 1, 1) ELSE {sql_pad('p_size', 2)} END"


@query("op_code_scope", f"""
    WITH p AS (SELECT p_partkey, {_MIXED_CODE} AS code FROM part)
    SELECT p_partkey, code, TRY_CAST(code AS INTEGER) AS number FROM p WHERE TRY_CAST(code AS INTEGER) < 30
""")
def code_scope(src: Source) -> DataFrame:
    code = F.when(F.col("p_type") == "SMALL", F.concat(F.lit("2"), F.substring("p_type", 1, 1))).otherwise(
        codes.zero_pad(F.col("p_size"), 2)
    )
    return src.part.select("p_partkey", code.alias("code")).where(predicates.code_in_scope(F.col("code"), 30)).select(
        "p_partkey", "code", codes.code_number(F.col("code")).alias("number")
    )


@query("op_code_bound", f"""
    SELECT c_custkey, {sql_pad('c_nationkey', 2)} AS code FROM customer WHERE {sql_pad('c_nationkey', 2)} < '13'
""")
def code_bound(src: Source) -> DataFrame:
    coded = src.customer.select("c_custkey", codes.zero_pad(F.col("c_nationkey"), 2).alias("code"))
    return coded.where(predicates.code_sorts_before(F.col("code"), "13"))


@query("op_try_cast_filter", """
    WITH p AS (SELECT p_partkey, CASE WHEN p_size < 25 THEN p_brand ELSE split_part(p_brand, '#', 2) END AS text
               FROM part)
    SELECT p_partkey, CAST(text AS DOUBLE) AS number FROM p WHERE TRY_CAST(text AS DOUBLE) IS NOT NULL
""")
def try_cast_filter(src: Source) -> DataFrame:
    text = F.when(F.col("p_size") < 25, F.col("p_brand")).otherwise(codes.last_token(F.col("p_brand"), "#"))
    mixed = src.part.select("p_partkey", text.alias("text"))
    return mixed.where(predicates.is_number(F.col("text"))).select(
        "p_partkey", F.col("text").try_cast("double").alias("number")
    )


@query("op_filter_then_project", """
    SELECT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_shipdate >= TIMESTAMP '2000-01-01'
""")
def filter_then_project(src: Source) -> DataFrame:
    kept = (F.col("l_returnflag") == "R") & (F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
    return src.lineitem.where(kept).select("l_orderkey", "l_partkey")


@query("op_pack_features", """
    SELECT p_partkey, CAST(to_json({'size': p_size, 'type': p_type, 'label': p_name}) AS VARCHAR) AS features FROM part
""")
def pack_features(src: Source) -> DataFrame:
    packed = F.struct(F.col("p_size").alias("size"), F.col("p_type").alias("type"), F.col("p_name").alias("label"))
    return src.part.select("p_partkey", packed.alias("features")).select("p_partkey", F.to_json("features").alias("features"))
