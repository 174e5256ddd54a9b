"""Queries with a DuckDB counterpart, on the smallest given tables."""

import os

import duckdb
import pytest

from cohortspark.llm import registry

SF_DIR = "/root/testdata/sf0.001"
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in os.listdir(SF_DIR):
        connection.execute(
            f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{name}'"
        )
    return connection


@pytest.mark.parametrize("name", ORACLES)
def test_query(spark, duck, name):
    ours = QUERIES[name](spark, SF_DIR)
    columns = ", ".join(sorted(ours.columns))
    theirs = duck.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()
    assert theirs
    assert sorted(map(tuple, ours.select(*sorted(ours.columns)).collect()), key=str) == sorted(
        theirs, key=str
    )


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_query_returns_every_row(spark, name):
    rows = QUERIES[name](spark, SF_DIR).collect()
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    ids = {r["doc_id"] for r in rows}
    assert len(ids) == documents if name != "pipeline" else 0 < len(ids) < documents
