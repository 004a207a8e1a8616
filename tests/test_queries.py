"""Every registered query against its SQL, on the smallest data set."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as registered  # noqa: E402
from check import TABLES, compare  # noqa: E402
from suite import ORACLES, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf}/{name}.parquet'")
    return con


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert QUERIES.keys() <= registered.queries().keys()


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, con, sf, name):
    verdict, _, _, note = compare(spark, con, name, sf)
    assert verdict == "ok", note


def test_entry(spark):
    assert registered.entry(spark).count() == 13
