"""Every registered query against its SQL counterpart, and the shape of its plan."""

import re

import pytest
from compare import connect, differences

from cohortwise.plans.oracle import ORACLE
from cohortwise.plans.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    assert differences(df, duck, ORACLE[name]) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("NestedLoopJoin|CartesianProduct", plan)


def test_every_query_has_sql():
    # Posterior draws have no SQL; test_structural holds them against dense algebra.
    assert set(QUERIES) - set(ORACLE) == {"intervention_structural", "intervention_components"}
    assert set(ORACLE) <= set(QUERIES)


def test_period_reaches_the_scan(spark):
    plan = QUERIES["user_ctr"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "GreaterThanOrEqual(ts" in scan and "LessThan(ts" in scan
    assert "props" not in scan.split("ReadSchema")[1]
