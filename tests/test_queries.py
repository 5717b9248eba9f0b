"""Every registered query against its SQL on another engine, over the smallest tables."""

import glob
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from conftest import TESTDATA

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for path in glob.glob(f"{TESTDATA}/*.parquet"):
        con.execute(f"CREATE VIEW {Path(path).stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(rows):
    return Counter(tuple(repr(v + 0.0) if isinstance(v, float) else str(v) for v in row) for row in rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, TESTDATA)
    columns = sorted(df.columns)
    mine = plain(df.select(columns).collect())
    if name not in ORACLES:
        assert mine
        return
    theirs = con.sql(ORACLES[name])
    assert sorted(theirs.columns) == columns
    assert mine == plain(theirs.select(*[f'"{c}"' for c in columns]).fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
