"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import pytest

from __spark_entry__ import entry
from barloom.plans.catalog import QUERIES
from barloom.plans.oracle import ORACLE
from tests.oracle_check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    rows, problem = compare(spark, con, SF_DIR, QUERIES[name], ORACLE[name])
    assert problem is None
    assert rows > 0


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.endswith("_job")))
def test_plan_has_no_product_python_or_single_task(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan, f"{name}: {operator}"


def test_entry(spark):
    assert entry(spark).columns == ["symbol", "trading_date", "total_volume", "volume_rank"]
