"""Rows that share an id become one element."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgraft.operators.properties import PROPS_TYPE, merged_props


def last_value(column: str, order: Column) -> Column:
    """The last value that is not NULL."""
    value = F.col(column)
    return F.max_by(value, F.when(value.isNotNull(), order))


def collapse_rows(df: DataFrame, keys: list[str], values: list[str], order: Column, extra: list[Column]) -> DataFrame:
    """One row per key: for each value column the last value that is not NULL, plus
    ``n_rows``.  Plain aggregates, so each task first folds its own rows and a key that
    holds a third of the table is shuffled as one row per task."""
    folded = [last_value(v, order).alias(v) for v in values]
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"), *folded, *extra)


def merge_ranked(df: DataFrame, keys: list[str], carried: list[str], rank: str = "rank") -> DataFrame:
    """Merges elements several mappings contribute to: properties in rank order, other
    columns from the highest rank.  Callers guarantee one row per key and rank, so a group
    is never larger than the number of mappings."""
    entry = F.struct(rank, F.map_entries("props").alias("entries"))
    ordered = F.transform(F.array_sort(F.collect_list(entry)), lambda e: F.map_from_entries(e["entries"]))
    props = F.aggregate(ordered, F.create_map().cast(PROPS_TYPE), merged_props)
    return df.groupBy(*keys).agg(
        *[F.max_by(c, rank).alias(c) for c in carried],
        F.max(rank).alias(rank),
        props.alias("props"),
    )
