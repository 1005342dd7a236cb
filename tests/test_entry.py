"""The driver contract, and every SQL-backed query against DuckDB at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as E  # noqa: E402
from tools.check_oracle import TABLES, _rows  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["genre", "rk", "mid", "avg"]
    assert df.count() >= 0


def test_oracle_keys_subset():
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"create view {t} as select * from read_parquet('{p}')")
    return c


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = E.queries()[name](spark, SF).toPandas()
    want = con.execute(E.oracle_sql()[name]).df()
    assert _rows(got) == _rows(want)
