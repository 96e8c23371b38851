"""Every registered query of the library against its SQL."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from check import TABLES, rows_of
from rootwise.plans.oracles import ORACLES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{FOLDER}/{name}.parquet'")
    return connection


def test_registry():
    queries, sql = entry_points.queries(), entry_points.oracle_sql()
    assert set(sql) <= set(queries)
    own = {name for name in queries if not name.startswith("op") and name != "pipeline"}
    assert own == {name for name in sql if not name.startswith("op")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, duck, name):
    got = entry_points.queries()[name](spark, FOLDER).toPandas()
    want = duck.sql(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows_of(got) == rows_of(want)
