"""Every query against its SQL, on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as contract
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in os.listdir(SF):
        connection.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF}/{file}'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(row[i] for i in order) for row in rows], key=repr)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = contract.queries()[name](spark, SF)
    found = rows_of(df.columns, df.collect())
    answer = duck.sql(contract.oracle_sql()[name])
    assert sorted(df.columns) == sorted(answer.columns)
    assert found == rows_of(answer.columns, answer.fetchall())


def test_entry(spark):
    assert contract.entry(spark).count() > 0
