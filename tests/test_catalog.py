"""Every registered query against its SQL counterpart on the smallest tables."""

import glob
import os

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from tools.check import compare

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF}/*.parquet"):
        name = os.path.basename(path)[:-8]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


@pytest.mark.parametrize("name", list(queries()))
def test_query(spark, con, name):
    text, _ = compare(spark, con, name, SF)
    assert text.startswith("ok" if name in oracle_sql() else "rows-only"), text


def test_entry(spark):
    assert entry(spark).count() > 0
