"""Registration of queries and the SQL text helpers their oracles share."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from rowgraft.operators.skew import ensure_checkpoint_dir
from rowgraft.sources.relations import normalised

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


_TABLES: dict[tuple[str, str, str], DataFrame] = {}


def spread(df: DataFrame, least_rows: int = 100_000) -> DataFrame:
    """The given tables are files of one row group each, which one core would read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= cores or df.count() < least_rows:
        return df
    return df.repartition(cores)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, sf, name)
    if key not in _TABLES:
        _TABLES[key] = spread(normalised(spark.read.parquet(f"{sf}/{name}.parquet")))
    return _TABLES[key]


def derived(spark: SparkSession, sf: str, sql: str, *names: str) -> DataFrame:
    """A relation derived by SQL in which {name} stands for a given table."""
    return normalised(spark.sql(sql, **{n: table(spark, sf, n) for n in names}))


def workspace(spark: SparkSession, name: str) -> str:
    """A new folder for a run's graph, in the shared folder of the session."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def text(column: str) -> str:
    return f"cast({column} as varchar)"


def instant(column: str) -> str:
    """Timestamp text: six digits of fraction or none."""
    return (
        f"(strftime({column}, '%Y-%m-%d %H:%M:%S') || case when date_part('microseconds', {column}) % 1000000 = 0 "
        f"then '' else strftime({column}, '.%f') end)"
    )


def sha(*texts: str) -> str:
    """SHA-256 of texts with unit separators between them, NULL as NUL."""
    return "sha256(" + " || chr(31) || ".join(f"coalesce({t}, chr(0))" for t in texts) + ")"


def uuid_of(hex32: str) -> str:
    return f"regexp_replace({hex32}, '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"


def tag_name(column: str) -> str:
    return f"regexp_replace(replace(lower({column}), ' ', '_'), '[^\\x00-\\x7F]', '', 'g')"


def pairs(source: str, id_sql: str, **values: str) -> str:
    """(id, key, value) rows of the given value expressions, NULL values left out."""
    branches = [f"select {id_sql} as id, '{k}' as key, {v} as value from {source}" for k, v in values.items()]
    return "select * from (" + " union all ".join(branches) + ") where value is not null"
