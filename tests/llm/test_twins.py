"""Each registered query against its SQL twin on the smallest tables."""

import duckdb
import pytest

from tidewater.llm.queries import SQL, Q

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    want = con.sql(SQL[name])
    got = Q[name](spark, SF)
    assert sorted(got.columns) == sorted(want.columns)
    assert sorted(map(tuple, got.select(*want.columns).collect()), key=str) == sorted(want.fetchall(), key=str)
