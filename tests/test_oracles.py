"""Every query against its SQL check on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import normal


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob("/root/testdata/sf0.001/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("key", [k for k in entry.queries() if k in entry.oracle_sql()])  # the others have tests of their own
def test_query(spark, db, sf, key):
    df = entry.queries()[key](spark, sf)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(entry.oracle_sql()[key])
    want = normal([c[0] for c in result.description], result.fetchall())
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
