"""Every registered query against its SQL oracle on the small driver tables."""

from __future__ import annotations

import os
import re

import compare
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", contract.SMOKE_DIR)
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    assert compare.differences(df, con, ORACLES[name]) is None
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin|BatchEvalPython", plan)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs_without_oracle(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    assert contract.entry(spark).count() > 0
