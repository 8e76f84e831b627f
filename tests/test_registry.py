"""Every registered query runs on the smallest tables; oracles agree there."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as driver
from registry import load
from tools.check import rows_of

SF_DIR = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE", "date": "DATE"}
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables are not here")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    return con


@pytest.mark.parametrize("name", sorted(load()[0]))
def test_query(spark, db, name):
    df = driver.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, df.collect())
    cur = db.execute(driver.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert sorted(columns) == sorted(df.columns)
    assert got == rows_of(columns, cur.fetchall())
    types = {r[0]: r[1] for r in db.execute("DESCRIBE " + driver.oracle_sql()[name]).fetchall()}
    assert {c: TYPES[t] for c, t in df.dtypes} == types


def test_every_query_has_an_oracle():
    assert set(load()[1]) == set(load()[0])


def test_entry(spark):
    assert driver.entry(spark).count() > 0
