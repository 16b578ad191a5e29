"""Each query against its SQL, as the driver compares them."""

import datetime
import decimal
import os

import duckdb
import pytest

from ledgerspark.queries import NAMES, ORACLE_SQL, QUERIES

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test data")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    return con


def plain(v):
    if isinstance(v, float):
        return round(v, 4)
    if isinstance(v, decimal.Decimal):
        return str(v)
    return v.replace(tzinfo=None) if isinstance(v, datetime.datetime) else v


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([tuple(plain(r[i]) for i in order) for r in rows], key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query(spark, db, name):
    df = QUERIES[name](spark, SF)
    want = db.execute(ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert got == rows_of(names, want.fetchall()) and got
