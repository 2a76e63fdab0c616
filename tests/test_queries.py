"""Every registered query against its DuckDB equivalent on the smallest sample."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as driver
from rollwise.queries import QUERIES
from tests.compare import assert_same

SAMPLE = Path("/root/testdata/sf0.001")
TABLES = [p.stem for p in SAMPLE.glob("*.parquet")]

pytestmark = pytest.mark.skipif(not TABLES, reason="sample tables are not available")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SAMPLE}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(QUERIES) <= set(driver.oracle_sql())
    assert set(driver.oracle_sql()) <= set(driver.queries())


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    assert_same(driver.queries()[name](spark, str(SAMPLE)), duck.execute(driver.oracle_sql()[name]))


def test_entry_has_all_columns(spark):
    df = driver.entry(spark)
    assert len(df.columns) == len({c.lower() for c in df.columns}) == 313
    assert df.count() > 0
