"""Every registered query against its SQL twin on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract
from matrixq.catalog.oracle import oracle
from matrixq.catalog.queries import QUERIES
from tests.conftest import TABLES


@pytest.fixture(scope="module")
def views():
    con = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def rows_of(table):
    names = sorted(table.column_names)
    return names, sorted(zip(*(table[n].to_pylist() for n in names)), key=repr)


@pytest.mark.parametrize("name", sorted(oracle()))
def test_query_matches_sql(spark, views, name):
    found = rows_of(QUERIES[name](spark, TABLES).toArrow())
    expected = rows_of(views.execute(oracle()[name]).to_arrow_table())
    assert found == expected


def test_every_query_has_sql():
    assert set(QUERIES) == set(oracle())


def test_entry(spark):
    assert contract.entry(spark).columns == ["i", "j", "v"]


def test_contract_has_every_query():
    assert set(QUERIES) <= set(contract.queries())
    assert set(contract.oracle_sql()) <= set(contract.queries())
