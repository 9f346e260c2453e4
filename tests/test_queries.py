"""Every registered query against its SQL twin, on the smallest tables."""

from pathlib import Path

import duckdb
import pytest
from conftest import rows

import __spark_entry__ as entry
from roost.plans import catalog

SF = Path("/root/testdata/sf0.001")
QUERIES, SQL = catalog.queries(), catalog.oracle_sql()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in SF.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
    assert len(QUERIES) == 84


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, db, name):
    df = QUERIES[name](spark, str(SF))
    columns = sorted(df.columns)
    found = db.execute(SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    want = sorted((tuple(r[names.index(c)] for c in columns) for r in found.fetchall()), key=repr)
    assert rows(df, *columns) == want


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
