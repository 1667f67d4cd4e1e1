"""Every registered query against its SQL, on the smallest driver tables."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as contract
from starcheck.bind import STAR_SCHEMAS
from starcheck.oracle import ORACLES
from starcheck.queries import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in STAR_SCHEMAS:
        connection.execute(f"create view {table} as select * from '{SF}/{table}.parquet'")
    return connection


def ordered(rows):
    return sorted(rows, key=lambda row: [(v is not None, str(v)) for v in row])


def test_every_query_has_an_oracle():
    assert set(REGISTRY) == set(ORACLES) and len(REGISTRY) == 72
    assert set(REGISTRY) <= set(contract.queries()) and set(ORACLES) <= set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).count() == 4


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query_equals_its_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    found = [tuple(row) for row in df.collect()]
    result = duck.execute(contract.oracle_sql()[name])
    columns = [column[0] for column in result.description]
    assert sorted(columns) == sorted(df.columns)
    places = [columns.index(column) for column in df.columns]
    expected = [tuple(row[i] for i in places) for row in result.fetchall()]
    assert found and ordered(found) == ordered(expected)
