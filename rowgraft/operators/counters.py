"""Counts of what a run did."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgraft.operators.changes import DELETE, INSERT, SKIP, UPDATE

SUCCESS, PARTIAL, FAILED, RUNNING = "SUCCESS", "PARTIAL", "FAILED", "RUNNING"


def mapping_counts(changes: DataFrame) -> DataFrame:
    """Rows per mapping by outcome, and the distinct elements behind the upserted rows."""
    upserted = F.col("op").isin(INSERT, UPDATE)
    rows = F.col("n_rows")
    return changes.groupBy("mapping_id").agg(
        F.coalesce(F.sum(F.when(upserted, rows)), F.lit(0)).cast("long").alias("rows_upserted"),
        F.coalesce(F.sum(F.when(F.col("op") == DELETE, rows)), F.lit(0)).cast("long").alias("rows_deleted"),
        F.coalesce(F.sum(F.when(F.col("op") == SKIP, rows)), F.lit(0)).cast("long").alias("rows_skipped"),
        F.count_if(upserted).alias("elements_upserted"),
    )


def run_totals(details: DataFrame) -> DataFrame:
    """One row per run: summed counters and the status they add up to."""
    failed = F.count_if(F.col("error_message").isNotNull())
    return details.groupBy("run_id").agg(
        F.sum("rows_upserted").cast("long").alias("rows_upserted"),
        F.sum("rows_deleted").cast("long").alias("rows_deleted"),
        F.sum("rows_skipped").cast("long").alias("rows_skipped"),
        F.when(failed == 0, F.lit(SUCCESS)).otherwise(F.lit(PARTIAL)).alias("status"),
    )
