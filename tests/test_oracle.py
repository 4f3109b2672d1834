"""Every registered query against DuckDB on the given tables."""

import pytest

import __spark_entry__ as entry_module
from compare import difference, duck

QUERIES, ORACLE = entry_module.queries(), entry_module.oracle_sql()
# Estimates have no SQL; tests/test_rollups.py holds them against exact counts.
ESTIMATES = {"customers_by_month"}


def beyond_sql(name):
    """Queries of other packages that SQL cannot express have tests of their own."""
    return name == "pipeline" or name[:2] == "op" and name[2].isdigit()


@pytest.fixture(scope="module")
def con(small):
    return duck(small)


def test_every_query_has_a_counterpart():
    assert not set(ORACLE) - set(QUERIES)
    assert {q for q in QUERIES if q not in ORACLE and not beyond_sql(q)} == ESTIMATES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, con, small, name):
    assert difference(spark, con, small, QUERIES[name], ORACLE[name]) is None


def test_entry(spark):
    df = entry_module.entry(spark)
    assert df.count() > 0 and "avg_rating" in df.columns


def test_larger_tables(spark, testdata):
    folder = f"{testdata}/sf0.01"
    con = duck(folder)
    for name in ("restaurant_performance", "fact_orders", "scd2_as_of", "business_summary_hourly"):
        assert difference(spark, con, folder, QUERIES[name], ORACLE[name]) is None, name
