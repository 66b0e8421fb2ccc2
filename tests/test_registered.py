"""Registered queries that the comparison with DuckDB alone would not guard."""

import pytest

import __spark_entry__ as entry
from constella.plans.check import compare, duck
from tests.conftest import SF_SMALL

def test_dense_key_query_runs_and_numbers_every_order(spark):
    r = compare(spark, SF_SMALL, "q_dense_key", entry.queries()["q_dense_key"], entry.oracle_sql()["q_dense_key"], duck(SF_SMALL))
    assert r["ok"], r


@pytest.mark.parametrize("name", ["q_distinct", "q_distinct_multi", "q_inner_join", "q_union"])
def test_both_windows_are_read(spark, name):
    both = f"{name}_both"
    con = duck(SF_SMALL)
    r = compare(spark, SF_SMALL, both, entry.queries()[both], entry.oracle_sql()[both], con)
    assert r["ok"], r
    rows = lambda q: len(con.sql(entry.oracle_sql()[q]).fetchall())
    # both windows hold the same years
    assert rows(both) == rows(name) if name in ("q_distinct", "q_union") else rows(both) > rows(name)


@pytest.mark.parametrize("name", ["q_left_join", "q_anti_expr"])
def test_joins_read_the_movies_and_not_single_tables(spark, name):
    sql = entry.oracle_sql()[name]
    assert "raw AS (" in sql and "lineitem" in sql
    r = compare(spark, SF_SMALL, name, entry.queries()[name], sql, duck(SF_SMALL))
    assert r["ok"], r


def test_an_orders_lines_are_the_smallest_of_each_line_number(spark):
    from constella.plans.standins import LINE_FIELDS, order_lines

    kinds = "l_orderkey bigint, " + ", ".join(f"{c} {'int' if c == 'l_linenumber' else 'bigint'}" for c in LINE_FIELDS)
    line = lambda order, n, part: (order, n, part, *[None] * (len(LINE_FIELDS) - 2))
    rows = [line(1, 3, 5), line(1, 1, 9), line(1, 1, 2), line(1, 1, 2), line(2, None, 1), line(2, 8, 1), line(3, 7, None), line(3, 7, 4)]
    lines = order_lines(spark.createDataFrame(rows, kinds))
    plan = lines._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1        # rows are dealt out once
    found = {r.l_orderkey: [(x.l_linenumber, x.l_partkey) for x in r.lines] for r in lines.collect()}
    assert {k: v for k, v in found.items() if v} == {1: [(1, 2), (3, 5)], 3: [(7, None)]}
