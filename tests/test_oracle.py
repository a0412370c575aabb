"""Every registered query against its SQL in DuckDB, on the smallest tables."""

import os
import sys

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as contract

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))
from check_oracle import TABLES, normal  # noqa: E402

SF = "/root/testdata/sf0.001"
SQL = contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


def test_every_sql_has_its_query():
    assert set(SQL) <= set(contract.queries())


def test_entry(spark):
    assert contract.entry(spark).columns[:3] == ["product_key", "submission_key", "date_key"]


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, duck, name):
    got = contract.queries()[name](spark, SF).toPandas().astype(object)
    if name not in SQL:
        assert len(got) > 0
        return
    cursor = duck.execute(SQL[name])
    want = pd.DataFrame(cursor.fetchall(), columns=[d[0] for d in cursor.description], dtype=object)
    assert normal(got).to_dict("list") == normal(want).to_dict("list")
