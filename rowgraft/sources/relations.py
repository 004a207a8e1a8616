"""Reading source relations: tables, queries, files and JDBC."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgraft.specs import MappingSpec, SourceSpec, SpecError


def normalised(df: DataFrame) -> DataFrame:
    """Lower-case column names; names that differ only by case are an error."""
    names = [c.lower() for c in df.columns]
    clash = sorted(c for c, n in Counter(names).items() if n > 1)
    if clash:
        raise SpecError(f"columns differ only by case: {clash}")
    return df.toDF(*names)


def read_relation(
    spark: SparkSession, source: SourceSpec, relations: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """The rows of a source with normalised column names.

    ``relations`` are frames known by name; they win over catalog tables.
    """
    relations = relations or {}
    if not source.is_active:
        raise SpecError(f"source {source.relation or source.path!r} is not active")
    if source.jdbc_url:
        df = read_jdbc(spark, source)
    elif source.query:
        df = spark.sql(source.query, **{k: v for k, v in relations.items() if "{" + k + "}" in source.query})
    elif source.path:
        df = spark.read.format(source.format).options(**dict(source.options)).load(source.path)
    elif source.relation in relations:
        df = relations[source.relation]
    elif source.relation:
        df = spark.table(source.relation)
    else:
        raise SpecError("a source needs a table, a query, a path or a jdbc url")
    return normalised(df)


def extract_rows(
    spark: SparkSession,
    spec: MappingSpec,
    relations: Mapping[str, DataFrame] | None = None,
    since: datetime | str | None = None,
) -> DataFrame:
    """Source rows of a mapping: its row filter, then strictly later than ``since``.

    Both predicates reach the scan.  With a high-water mark, rows without a watermark
    value are left out; without one every row is read.
    """
    df = filtered(read_relation(spark, spec.source, relations), spec)
    if since is not None:
        df = df.where(later_than(df, spec.watermark_column, since))
    return df


def filtered(df: DataFrame, spec: MappingSpec) -> DataFrame:
    """The rows a mapping takes from its relation."""
    return df.where(F.expr(spec.row_filter)) if spec.row_filter else df


def later_than(df: DataFrame, column: str, since: datetime | str) -> Column:
    name = column.lower()
    mark = since.strftime("%Y-%m-%d %H:%M:%S.%f") if isinstance(since, datetime) else since
    return F.col(f"`{name}`") > F.lit(mark).cast(df.schema[name].dataType)


def bounds(df: DataFrame, column: str) -> DataFrame:
    """One row: smallest and largest key; both NULL for an empty relation."""
    return df.agg(F.min(column).alias("low"), F.max(column).alias("high"))


def chunk_count(low, high, chunk: int) -> int:
    """How many key ranges of width ``chunk`` a relation is read in; 0 when it is empty."""
    if low is None or high is None:
        return 0
    span = high - low
    if not isinstance(span, (int, float, Decimal)):
        span = span.days
    return max(1, math.ceil((float(span) + 1) / chunk))


def read_jdbc(spark: SparkSession, source: SourceSpec) -> DataFrame:
    """A JDBC read, split into key ranges when a partition column is named.

    Spark's first and last range are open and the first takes NULL keys, so no row is
    lost to the bounds whatever the key looks like.
    """
    options = {"url": source.jdbc_url, "fetchsize": str(source.partition_size), **dict(source.options)}
    relation = f"({source.query}) src" if source.query else source.relation
    reader = spark.read.format("jdbc").options(**options)
    if not source.partition_column:
        return reader.option("dbtable", relation).load()
    column = source.partition_column
    probe = f"(SELECT MIN({column}) AS low_key, MAX({column}) AS high_key FROM {relation}) bounds"
    edge = spark.read.format("jdbc").options(**options).option("dbtable", probe).load().first()
    parts = chunk_count(edge[0], edge[1], source.partition_size)
    reader = reader.option("dbtable", relation)
    if parts > 1:
        reader = (
            reader.option("partitionColumn", column)
            .option("lowerBound", str(edge[0]))
            .option("upperBound", str(edge[1]))
            .option("numPartitions", str(parts))
        )
    return reader.load()


def ranged(df: DataFrame, column: str, chunk_rows: int) -> DataFrame:
    """Rows of a file source spread by key range; the range bounds come from a sample of
    the keys, so uneven keys still give even partitions and NULL keys are kept."""
    low, high = bounds(df, column).first()
    parts = chunk_count(low, high, chunk_rows)
    return df.repartitionByRange(parts, column) if parts else df
