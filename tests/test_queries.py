"""Registered queries against their comparison SQL, and the entry module."""

import duckdb
import pytest

import __spark_entry__ as entry
from workload import tables
from workload.oracles import ORACLES
from workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in tables.BASE:
        con.execute(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert QUERIES.keys() <= entry.queries().keys() and ORACLES.keys() <= entry.oracle_sql().keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, duck, name):
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    result = duck.execute(ORACLES[name])
    places = {c[0]: i for i, c in enumerate(result.description)}
    assert sorted(places) == columns
    wanted = [[repr(row[places[c]]) for c in columns] for row in result.fetchall()]
    got = [[repr(row[c]) for c in columns] for row in found.collect()]
    assert sorted(got) == sorted(wanted)
