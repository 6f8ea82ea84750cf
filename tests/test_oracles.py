"""Every query with SQL against another engine on the smallest driver tables, where they are there."""

import glob
import os
from collections import Counter

import pytest

import __spark_entry__ as driver

DATA = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
duckdb = pytest.importorskip("duckdb")
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no driver tables")


@pytest.fixture(scope="module")
def engine():
    c = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        source = path if os.path.isfile(path) else f"{path}/*.parquet"
        c.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{source}'")
    return c


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


def rows_of(columns, rows):
    order = [columns.index(c) for c in sorted(columns)]
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_equals_sql(spark, engine, name):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    got = driver.queries()[name](spark, DATA)
    want = engine.sql(driver.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got.columns, got.collect()) == rows_of(want.columns, want.fetchall())


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def test_entry(spark):
    assert driver.entry(spark).columns == ["ccn", "valid_from", "valid_to"]
