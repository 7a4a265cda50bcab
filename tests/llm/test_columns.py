"""The registered queries' columns and rows, against those of their SQL."""

import duckdb
import pytest

from factmill.llm import oracles, queries

TABLES = {"op12_chat": "conversations", "op13_merkle": "documents"}


@pytest.mark.parametrize("name", TABLES)
def test_a_query_gives_what_its_sql_gives(spark, name):
    sf_dir, table = "/root/testdata/sf0.001", TABLES[name]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    want = con.execute(oracles.oracle_sql()[name])
    got = queries.queries()[name](spark, sf_dir)
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want.fetchall(), key=str)
