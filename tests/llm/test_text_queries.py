"""The registered queries for training text against their SQL, on the smallest data set."""

import duckdb
import pytest

from check import TABLES, compare
from rowgraft.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_agrees_with_sql(spark, sf, name):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from '{sf}/{table}.parquet'")
    verdict, _, _, note = compare(spark, con, name, sf)
    assert verdict == "ok", note


def test_one_query_per_operator():
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, 14))
