"""Every query with SQL must give the rows of that SQL on the smallest tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_points
from check_queries import compare, connect

ROOT = "/root/testdata/sf0.001"
SQL = entry_points.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    got = entry_points.queries()[name](spark, ROOT).toArrow()
    assert compare(got, con.execute(SQL[name]).to_arrow_table()) == ""


def test_every_sql_has_a_query():
    assert set(SQL) <= set(entry_points.queries())


def test_entry_returns_rows(spark):
    rows = entry_points.entry(spark).collect()
    assert len(rows) == 5 and rows == sorted(rows, key=lambda r: -r["n"])
