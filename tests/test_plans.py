"""Shape of the physical plans: no pairwise joins, no Python rows, pruned and filtered scans."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from lakestrata.ml import models
from lakestrata.queries import tables
from lakestrata.queries.registry import Source

QUERIES = contract.queries()
# The operators, and the table builders that are one plan (the others store tables in between).
ONE_PLAN = sorted(
    n for n in contract.oracle_sql()
    if n.startswith("op_") or n in ("table_municipality_profile", "table_weather_monthly", "table_owners_clean")
)


# Boosted trees of several classes score in Arrow batches, the one Python step outside the corpus operators.
SCORED_IN_BATCHES = {"op_impute_boosted", "op_boosted_multiclass", "op_cross_fitted"}


def plan(spark, name):
    return QUERIES[name](spark, contract.SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ONE_PLAN)
def test_no_pairwise_join_and_no_python(spark, name):
    text = plan(spark, name)
    batches = "" if name in SCORED_IN_BATCHES else "|ArrowEvalPython"
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython|MapInPandas" + batches, text)


@pytest.mark.parametrize("name,columns", [
    ("op_filter_then_project", {"l_orderkey", "l_partkey", "l_returnflag", "l_shipdate"}),
    ("op_distinct_rows", {"l_orderkey", "l_linenumber"}),
    ("op_range_filter", {"o_orderkey", "o_totalprice"}),
])
def test_scan_reads_only_what_is_used(spark, name, columns):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(spark, name)).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == columns


@pytest.mark.parametrize("name,pushed", [
    ("op_filter_then_project", "EqualTo(l_returnflag,R)"),
    ("op_range_filter", "LessThan(o_totalprice"), ("op_date_window", "GreaterThanOrEqual(o_orderdate"),
    ("op_semi_gate", "EqualTo(o_orderstatus,P)"), ("op_event_counts_by_year", "LessThan(l_shipdate"),
])
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(spark, name)


def test_dense_id_reads_its_input_once(spark):
    from pyspark.sql import functions as F
    from lakestrata.operators.ids import distinct_with_id

    df = distinct_with_id(spark.range(1000).select((F.col("id") % 300).alias("k")), "n")
    rows = df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    assert len(rows) == 300 and "ReusedExchange" in text.split("Initial Plan")[0]


def test_areas_leave_the_facts_out_of_the_plan(spark):
    """Of the files of licences, consumption and certificates only the one that ties departments to regions is read."""
    plan = tables._areas(Source(spark, contract.SMOKE_DIR))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [l_orderkey") == 1 and "LeftOuter" not in plan


def test_a_classifier_is_fitted_on_stored_features(spark):
    seen = []

    class Told(models.SoftmaxBooster):
        def fit(self, df):
            seen.append(df)
            return super().fit(df)

    rows = spark.range(40).selectExpr("double(id % 8) AS v", "string(id % 2) AS w", "int(id % 8 > 3) AS t")
    models.train_classifier(rows, "t", ["v"], ["w"], Told("label", maxIter=1, minInstancesPerNode=1))
    assert seen[0].columns == ["features", "label"] and "Scan ExistingRDD" in seen[0]._jdf.queryExecution().executedPlan().toString()
