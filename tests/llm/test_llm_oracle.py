"""Every llm query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import glob
import os

import pytest

from quern.llm import queries

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="the test tables are not here")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for p in glob.glob(f"{TABLES}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    df = queries.queries()[name](spark, TABLES)
    found = c.sql(queries.oracle_sql()[name])
    places = [found.columns.index(x) for x in df.columns]
    assert sorted(map(tuple, df.collect()), key=repr) == sorted((tuple(r[i] for i in places) for r in found.fetchall()), key=repr)
