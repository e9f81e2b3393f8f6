"""Queries of this package agree with their DuckDB equivalents; native ones have no Python in their plans."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as driver
from eventlake.llm.oracles import llm_oracles
from eventlake.llm.queries import llm_queries
from eventlake_checks.compare import connect, differences

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", list(llm_oracles()))
def test_query_matches_oracle(spark, name):
    df = llm_queries()[name](spark, SF_DIR)
    with connect(SF_DIR) as duck:
        assert differences(df, duck, llm_oracles()[name]) == []
    if name.startswith(("op4_", "op7_")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def test_one_query_per_operator():
    names = set(driver.queries())
    assert all(sum(n.startswith(f"op{k}_") for n in names) == 1 for k in range(1, 14))
    assert "pipeline" in names
