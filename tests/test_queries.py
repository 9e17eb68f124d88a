"""Every registered query against its DuckDB twin, and the shape of their plans."""

import re

import pytest

import __spark_entry__ as entry
from compare import differences, duck

SF = "/root/testdata/sf0.001"
# The corpus operators have tests of their own.
QUERIES = {k: v for k, v in entry.queries().items() if k not in entry.CORPUS_QUERIES}
ORACLE = {k: v for k, v in entry.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    if name in ORACLE:
        assert differences(spark, con, SF, QUERIES[name], ORACLE[name]) == []
    else:
        assert QUERIES[name](spark, SF).count() > 0


def test_twins_belong_to_queries():
    assert set(ORACLE) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).columns == ["week_start", "location_id", "net_sales", "qty_sold"]


def test_suite_has_74_checks(spark):
    rows = QUERIES["validation_suite"](spark, SF).collect()
    assert len(rows) == 74 and len({r.check_name for r in rows}) == 74
    assert [r.passed for r in rows] == sorted(r.passed for r in rows)


@pytest.mark.parametrize("name", ["fact_sales", "fact_labour_hourly", "fact_purchases", "usage_weekly_bridge", "store_kpi"])
def test_no_row_by_row_python_and_no_pair_joins(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().toString()
    assert not re.search(r"Python|Cartesian|NestedLoop", plan)


def test_the_bridge_reads_each_source_once(spark):
    """Purchases and counts are used twice, but their shuffles are reused."""
    df = QUERIES["usage_weekly_bridge"](spark, SF)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet \[l_", plan)) == 3  # sales, purchases, waste
    assert len(re.findall(r"FileScan parquet \[o_", plan)) == 2  # sales, counts
