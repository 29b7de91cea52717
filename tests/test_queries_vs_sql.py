"""Every query against its SQL on the same tables, compared row by row."""

import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver
from querybook import catalog, oracle

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = ("orders", "customer")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.sql(f"create view {table} as from '{SF_DIR}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    if isinstance(value, Decimal):
        return float(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([_plain(row[i]) for i in order]) for row in rows)


def test_every_query_has_sql():
    assert set(catalog.registered()) == set(oracle.oracle())
    assert set(catalog.registered()) <= set(driver.queries()) and set(oracle.oracle()) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalog.registered()))
def test_query_matches_sql(spark, duck, name):
    found = driver.queries()[name](spark, SF_DIR)
    expected = duck.sql(driver.oracle_sql()[name])
    assert sorted(found.columns) == sorted(expected.columns)
    got, want = _rows(found.columns, found.collect()), _rows(expected.columns, expected.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_entry_runs(spark):
    assert driver.entry(spark).head(1)
