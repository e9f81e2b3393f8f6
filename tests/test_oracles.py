"""Every registered query agrees with its DuckDB equivalent and is not empty."""

from __future__ import annotations

import pytest
from conftest import SF_DIR

import __spark_entry__ as driver
from eventlake_checks.compare import connect, differences
from eventlake_checks.oracles import build_oracles
from eventlake_checks.queries import build_queries

QUERIES, ORACLES = build_queries(), build_oracles()
FORBIDDEN = ("EvalPython", "InPandas", "InArrow", "CartesianProduct", "BroadcastNestedLoopJoin")


@pytest.fixture(scope="module")
def duck():
    with connect(SF_DIR) as con:
        yield con


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    assert differences(df, duck, ORACLES[name]) == []
    # two empty results would agree without proving anything
    count = duck.execute(f"SELECT count(*) FROM ({ORACLES[name]})").fetchall()[0][0]
    assert count > 0
    # no Python in the plan and no join without an equality
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [operator for operator in FORBIDDEN if operator in plan]


def test_entry_has_every_query():
    assert set(QUERIES) <= set(driver.queries()) and set(ORACLES) <= set(driver.oracle_sql())


def test_comparison_notices_a_difference(spark, duck):
    df = QUERIES["stg_actors"](spark, SF_DIR)
    changed = ORACLES["stg_actors"].replace("ORDER BY created_at DESC", "ORDER BY created_at")
    assert differences(df, duck, changed)


def test_entry(spark):
    assert driver.entry(spark).count() > 0
