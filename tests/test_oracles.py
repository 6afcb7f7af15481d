"""Every query that has an oracle against DuckDB, and every other one for rows, at the smallest scale."""

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from airwave.plans.registry import ORACLES, QUERIES
from tests.conftest import SF

TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events", "documents", "conversations")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def comparable(rows):
    plain = lambda x: float(x) if isinstance(x, (int, float, decimal.Decimal)) and not isinstance(x, bool) else x
    return sorted(([plain(x) for x in r] for r in rows), key=str)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_oracle(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    cur = duck.execute(ORACLES[name])
    names = [d[0] for d in cur.description]
    assert sorted(got.columns) == sorted(names)
    assert comparable(tuple(r) for r in got.select(names).collect()) == comparable(cur.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_without_an_oracle_has_rows(spark, name):
    assert entry.queries()[name](spark, SF).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 658
