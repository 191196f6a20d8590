"""Every named query over captures, held against its SQL."""

import os

import duckdb
import pytest

from flowloom.plans import outcomes, queries  # noqa: F401  outcomes adds queries


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for t in os.listdir(sf):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{sf}/{t}'")
    return con


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf, db, name):
    df = queries.QUERIES[name](spark, sf)
    columns = sorted(df.columns)
    got = sorted(str(tuple(r[c] for c in columns)) for r in df.collect())
    if name not in queries.SQL:
        assert got
        return
    cursor = db.execute(queries.SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    assert got == sorted(str(tuple(r[names.index(c)] for c in columns)) for r in cursor.fetchall())


def test_entry_points():
    import __spark_entry__ as entry

    assert set(queries.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
