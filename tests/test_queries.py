"""Every registered query against its DuckDB counterpart on the smallest test tables."""

import math
import os
from datetime import date, datetime
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__ as driver

SF_DIR = "/root/testdata/sf0.001"
OPTIONAL = driver.optional.queries() if driver.optional else {}
QUERIES = {name: query for name, query in driver.queries().items() if name not in OPTIONAL}
ORACLES = {name: sql for name, sql in driver.oracle_sql().items() if name not in OPTIONAL}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(
            f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'"
        )
    return connection


def cell(value):
    if isinstance(value, (float, Decimal)):
        return None if math.isnan(value) else round(float(value), 9)
    return value.date() if isinstance(value, datetime) else value


def multiset(columns, records):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted((tuple(cell(r[i]) for i in order) for r in records), key=str)


def family(kind):
    return {"int": "integer", "string": "varchar"}.get(kind, kind)


def test_every_query_has_a_counterpart():
    assert list(QUERIES) and set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    theirs = duck.sql(ORACLES[name])
    assert sorted(ours.columns) == sorted(theirs.columns)
    kinds = {f.name: family(f.dataType.simpleString()) for f in ours.schema}
    assert kinds == {c: str(t).lower() for c, t in zip(theirs.columns, theirs.types)}
    expected = multiset(theirs.columns, theirs.fetchall())
    assert expected
    assert multiset(ours.columns, ours.collect()) == expected


def test_entry(spark):
    assert driver.entry(spark).columns == ["dp", "rx_count", "count"]


def test_dates_survive_comparison():
    assert cell(datetime(2020, 1, 1)) == date(2020, 1, 1)
