"""Every registered query against its SQL, and the shape of its plan."""

import re

import pytest

import __spark_entry__ as entry
import oracles
from compare import differences, open_oracle
from mercata.plans.queries import all_queries
from mercata.plans.workspace import Workspace

QUERIES, SQL = all_queries(), oracles.all_statements()


@pytest.fixture(scope="module")
def oracle(sf_dir):
    return open_oracle(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, sf_dir, oracle, name):
    df = QUERIES[name](spark, sf_dir)
    assert differences(oracle, SQL[name], df) == []
    plan = df._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert unwanted not in plan
    # Facts and raw rows are never gathered into one task before they are aggregated.
    for line in plan.splitlines():
        if "SinglePartition" in line:
            below = plan[plan.index(line) + len(line):]
            assert re.search(r"HashAggregate|SortAggregate|Window|Scan parquet .*(order-|categories-)", below), line


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "pct_cumulative" in df.columns


BUILT = (
    "stg_orders", "stg_order_items", "stg_order_payments", "stg_order_reviews", "rejected_rows",
    "dim_product", "dim_customer", "fct_order_items", "fct_orders",
)


@pytest.mark.parametrize("name", BUILT)
def test_tables_are_built_without_one_task_stages(spark, sf_dir, name):
    """The plan that builds a table, not the scan of its written form."""
    plan = Workspace.of(spark, sf_dir)._derive(name)._jdf.queryExecution().executedPlan().toString()
    for unwanted in ("SinglePartition", "CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in plan
    joins = {"stg_orders": 0, "dim_product": 1, "dim_customer": 2, "fct_order_items": 4, "fct_orders": 5}
    assert len(re.findall(r"[a-zA-Z]+Join ", plan)) >= joins.get(name, 0)
