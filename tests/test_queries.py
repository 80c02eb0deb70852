"""Every registered query against its SQL on the provided tables."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry
from barloom.plans.catalog import QUERIES
from barloom.plans.oracles import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no tables")


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    connection = duckdb.connect()
    for file in os.listdir(SF_DIR):
        name = file.removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS FROM '{SF_DIR}/{file}'")
    return connection


def rows(table):
    names = sorted(table.column_names)
    types = {name: str(table.schema.field(name).type) for name in names}
    columns = [table.column(name).to_pylist() for name in names]
    return types, sorted(repr(row) for row in zip(*columns))


@pytest.mark.parametrize("name", QUERIES)
def test_query_matches_sql(spark, duck, name):
    found = rows(QUERIES[name](spark, SF_DIR).toArrow())
    expected = rows(duck.sql(ORACLES[name]).to_arrow_table())
    assert found[0] == expected[0]
    assert found[1] == expected[1]


def test_entry(spark):
    assert entry(spark).count() > 0
