"""Every query with SQL gives the rows that DuckDB gives, on the smallest tables."""

import glob
import os

import pytest

from quern.plans import registry

TABLES = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(TABLES), reason="the test tables are not here")


def plain(x):
    if isinstance(x, float):
        return None if x != x else round(x, 9)
    if isinstance(x, (list, tuple)) or hasattr(x, "tolist"):
        return tuple(plain(y) for y in x)
    return int(x) if type(x).__name__ == "Decimal" else x


def connected():
    import duckdb

    c = duckdb.connect()
    c.sql("SET TimeZone='UTC'")
    for p in glob.glob(f"{TABLES}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return c


def rows_of(columns, names, rows):
    places = [names.index(c) for c in columns]
    return sorted((tuple(plain(r[i]) for i in places) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_sql(spark, name):
    df = registry.queries()[name](spark, TABLES)
    found = connected().sql(registry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(found.columns)
    assert rows_of(df.columns, df.columns, df.collect()) == rows_of(df.columns, found.columns, found.fetchall())


def test_what_has_no_sql_is_known():
    """All core queries have SQL."""
    assert set(registry.queries()) == set(registry.oracle_sql())
