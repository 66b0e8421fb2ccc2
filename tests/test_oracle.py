"""Every registered query against its DuckDB twin (row count, column names,
order-insensitive row multiset) on the smallest scale factor; the driver runs
the same comparison at sf0.01."""

import pytest

import __spark_entry__ as entry
from constella.plans.check import compare, duck
from constella.plans.queries import REGISTRY
from tests.conftest import SF_SMALL

QUERIES = entry.queries()
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_query_has_an_oracle():
    # the text operators, which SQL cannot all express, are listed beside their own tests
    assert set(SQL) <= set(QUERIES)
    assert set(REGISTRY) <= set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    r = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], con)
    assert r["ok"], r


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and df.columns


@pytest.mark.parametrize("name", ["q_coalesce_nested", "q_dim_date_day", "q_fact"])
def test_results_do_not_depend_on_session_time_zone(spark, con, name):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    try:
        r = compare(spark, SF_SMALL, name, QUERIES[name], SQL[name], con)
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert r["ok"], r
