"""Queries beside their SQL, on the smallest tables."""

import os

import duckdb
import pytest

from tallyhouse.llm import queries

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    got = queries.QUERIES[name](spark, FOLDER)
    found = con.execute(queries.ORACLES[name])
    names = [c[0] for c in found.description]
    assert sorted(names) == sorted(got.columns)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(found.fetchall())
