"""Queries of the subpackage against their SQL, on the smallest tables."""

import os

import duckdb
import pytest

from corploom.llm.oracles import ORACLES
from corploom.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for file in os.listdir(SF):
        duck.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{SF}/{file}'")
    df = QUERIES[name](spark, SF)
    answer = duck.execute(ORACLES[name])
    names = [c[0] for c in answer.description]
    assert sorted(df.columns) == sorted(names)
    found = sorted((tuple(r) for r in df.select(*names).collect()), key=repr)
    assert found == sorted(answer.fetchall(), key=repr)


def test_all_are_there():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
