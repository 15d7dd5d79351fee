"""Every query against its SQL twin, and checks on every plan."""

import __spark_entry__ as entry_module
import pytest
from compare import connect, duck_rows, spark_rows

from rollcall.catalogue import oracle, queries as catalogue

# the training-data operators have tests of their own
QUERIES, ORACLES = catalogue.QUERIES, oracle.ORACLES


@pytest.fixture(scope="module")
def duck(tables):
    return connect(tables)


# Queries that score names or places by matched letters, the one Python step.
SCORED = {
    "fuzzy_join", "name_match", "joined_funds", "holder_changed", "match_report", "state_utilisation", "funds_kpis",
    "funds_slice",
}


def test_every_query_has_a_twin():
    assert set(ORACLES) == set(QUERIES)
    assert set(QUERIES) <= set(entry_module.queries()) and set(ORACLES) <= set(entry_module.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, tables, name):
    df = QUERIES[name](spark, tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    if name not in SCORED:
        assert "Python" not in plan and "Pandas" not in plan
    assert spark_rows(df) == duck_rows(duck, ORACLES[name])


def test_entry(spark):
    assert entry_module.entry(spark).count() == 14


def test_marts_read_only_what_they_need(spark, tables):
    plan = QUERIES["age_dist"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert "ReadSchema: struct<is_winner:boolean,age_band:string>" in plan
    plan = QUERIES["winners_slice"](spark, tables)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(election_year" in plan and "EqualTo(is_winner,true)" in plan
