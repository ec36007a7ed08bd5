"""The training-data queries with SQL against it on the smallest tables."""

import glob
import os

import duckdb
import pytest

from matrixq.llm.queries import ORACLES, QUERIES
from tests.conftest import TABLES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for path in glob.glob(f"{TABLES}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {view} as select * from '{path}'")
    found = QUERIES[name](spark, TABLES)
    columns = ", ".join(found.columns)
    expected = con.execute(f"select {columns} from ({ORACLES[name]})").fetchall()
    got = [tuple(r) for r in found.collect()]
    assert got and sorted(got, key=repr) == sorted(expected, key=repr)
