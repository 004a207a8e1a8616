"""Session settings the library counts on."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def tuned(spark: SparkSession) -> SparkSession:
    """The session with these settings; nothing about its size is changed."""
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and the benchmark."""
    return tuned(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("rowgraft")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .getOrCreate()
    )


def small_frame(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A frame of a few driver rows as a local relation, without a job of its own."""
    fields = StructType.fromDDL(schema)
    records = [
        {f.name: list(v.items()) if isinstance(v, dict) else v for f, v in zip(fields, row)} for row in rows
    ]
    return spark.createDataFrame(pa.Table.from_pylist(records, schema=to_arrow_schema(fields)), fields)
