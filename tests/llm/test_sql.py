"""The queries that SQL can express against their SQL."""

import duckdb
import pytest

from airwave.llm import registry
from tests.conftest import SF


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cur = con.execute(registry.oracle_sql()[name])
    names = [d[0] for d in cur.description]
    got = registry.queries()[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert sorted(map(str, map(tuple, got.select(names).collect()))) == sorted(map(str, cur.fetchall()))
