"""Every registered query against DuckDB on the same files."""

from __future__ import annotations

from pathlib import Path

import oracle
import pytest

import __spark_entry__ as driver
from rowtide.queries import QUERIES

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="test data is not here")


def test_every_query_has_its_sql():
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    df = driver.queries()[name](spark, SF)
    assert oracle.compare(df, driver.oracle_sql()[name], SF) is None


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_filters_and_columns_reach_the_scan(spark):
    for name, parts in {
        "scan_where": ["PushedFilters: [IsNotNull(o_orderstatus)", "EqualTo(o_orderstatus,F)", "o_totalprice:double"],
        "incr_state": ["GreaterThan(o_orderdate,1998-06-01"],
        "incr_lookback": ["Or(GreaterThan(ts,2024-01-30T12:00),GreaterThan(ts,2024-01-30T00:00))"],
        "filter_lte": ["Or(IsNull(p_size),LessThanOrEqual(p_size,10))"],
        "map_positional": ["ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double>"],
    }.items():
        plan = driver.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        for part in parts:
            assert part in plan, (name, part, plan)


def test_no_query_joins_without_a_key(spark):
    for name, query in QUERIES.items():
        if not name.startswith(("sink", "incr_two", "stream", "fanout")):
            plan = query(spark, SF)._jdf.queryExecution().executedPlan().toString()
            if name != "table_schema":
                assert "CartesianProduct" not in plan and "NestedLoop" not in plan, name
