"""Every query with an SQL twin agrees with it row for row; the rest are checked by invariants elsewhere."""

import pytest

import __spark_entry__ as entry
from oracle import connect, differences

FOLDER = "/root/testdata/sf0.001"
SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, con, name):
    report = differences(entry.queries()[name](spark, FOLDER), con, SQL[name])
    assert report["columns"][0] == report["columns"][1]
    assert report["rows"][0] == report["rows"][1] > 0
    assert report["differing"] == 0
    assert not report["types"]


def test_entry_returns_ranked_products(spark):
    rows = entry.entry(spark).orderBy("rank").collect()
    assert [r["rank"] for r in rows] == list(range(1, 21))
    assert all(a["count"] >= b["count"] for a, b in zip(rows, rows[1:]))


def test_oracle_keys_are_queries():
    assert set(SQL) <= set(entry.queries())
