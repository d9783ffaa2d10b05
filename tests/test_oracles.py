"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.compare import table
from tieproof.catalog import ORACLES, QUERIES
from tieproof.sources.shapes import TABLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_same_rows(spark, duck, name):
    df = QUERIES[name](spark, FOLDER)
    got = table(df.columns, [tuple(r) for r in df.collect()])
    cur = duck.execute(ORACLES[name])
    assert got == table([d[0] for d in cur.description], cur.fetchall())


def test_contract(spark):
    assert set(ORACLES) == set(QUERIES) and set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0
