"""Run state: row fingerprints and watermarks, as functions from frame to frame."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgraft.operators.changes import DELETE, INSERT, UNCHANGED, UPDATE
from rowgraft.operators.skew import lookup_join

STATE_SCHEMA = (
    "mapping_id string, id string, from_id string, to_id string, row_hash string, "
    "first_seen_run_id string, last_seen_run_id string, updated_at timestamp_ntz"
)
STATE_KEYS = ["mapping_id", "id", "from_id", "to_id"]
MARK_SCHEMA = (
    "mapping_id string, last_watermark timestamp_ntz, pending_watermark timestamp_ntz, "
    "last_run_id string, updated_at timestamp_ntz"
)


def _at(moment: datetime | str) -> Column:
    return F.lit(str(moment)).cast("timestamp_ntz")


def seen_rows(changes: DataFrame, run_id: str, at: datetime | str) -> DataFrame:
    """The complete state of the mappings in a change set that compared whole extracts."""
    return changes.where(F.col("op").isin(INSERT, UPDATE, UNCHANGED)).select(
        *STATE_KEYS,
        "row_hash",
        F.coalesce("first_seen_run_id", F.lit(run_id)).alias("first_seen_run_id"),
        F.lit(run_id).alias("last_seen_run_id"),
        _at(at).alias("updated_at"),
    )


def version_part(mapping_id: str) -> str:
    """The part of the state that holds the versions of a mapping's values."""
    return f"{mapping_id}#versions"


def version_rows(changes: DataFrame, run_id: str, at: datetime | str) -> DataFrame:
    """The versions a change set enters: deleted elements keep theirs, so that older values stay out."""
    kept = changes.where(F.col("op").isin(INSERT, UPDATE, DELETE)).withColumn("op", F.lit(UPDATE))
    return seen_rows(kept, run_id, at)


def changed_rows(changes: DataFrame, run_id: str, at: datetime | str) -> DataFrame:
    """The rows a change set enters into the state: those it inserts or updates."""
    return seen_rows(changes.where(F.col("op") != UNCHANGED), run_id, at)


def upsert_hashes(state: DataFrame, seen: DataFrame, run_id: str, at: datetime | str) -> DataFrame:
    """State with the seen rows (keys and row_hash) entered; a known row keeps the run that
    saw it first."""
    new = seen.select(*STATE_KEYS, F.col("row_hash").alias("__hash"))
    hit = F.col("__hash").isNotNull()
    return state.join(new, STATE_KEYS, "full_outer").select(
        *STATE_KEYS,
        F.coalesce("__hash", "row_hash").alias("row_hash"),
        F.coalesce("first_seen_run_id", F.lit(run_id)).alias("first_seen_run_id"),
        F.when(hit, F.lit(run_id)).otherwise(F.col("last_seen_run_id")).alias("last_seen_run_id"),
        F.when(hit, _at(at)).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def delete_hashes(state: DataFrame, gone: DataFrame) -> DataFrame:
    """State without the rows named by key."""
    return lookup_join(state, gone.select(*STATE_KEYS).distinct(), STATE_KEYS, "left_anti", ["id"])


def clear_mappings(df: DataFrame, mapping_ids: list[str]) -> DataFrame:
    """State or watermarks without the mappings named."""
    return df.where(~F.col("mapping_id").isin(mapping_ids)) if mapping_ids else df


def set_pending(marks: DataFrame, mappings: DataFrame, at: datetime | str, run_id: str) -> DataFrame:
    """Enters the run's start as pending mark, before anything is read."""
    hit = F.col("__hit").isNotNull()
    incoming = mappings.select("mapping_id").distinct().withColumn("__hit", F.lit(True))
    return marks.join(incoming, "mapping_id", "full_outer").select(
        "mapping_id",
        "last_watermark",
        F.when(hit, _at(at)).otherwise(F.col("pending_watermark")).alias("pending_watermark"),
        F.when(hit, F.lit(run_id)).otherwise(F.col("last_run_id")).alias("last_run_id"),
        F.when(hit, _at(at)).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def commit_marks(marks: DataFrame, mappings: DataFrame, at: datetime | str) -> DataFrame:
    """Makes the pending marks of the mappings their last ones; others stay pending."""
    hit = F.col("__hit").isNotNull()
    done = mappings.select("mapping_id").distinct().withColumn("__hit", F.lit(True))
    return marks.join(done, "mapping_id", "left").select(
        "mapping_id",
        F.when(hit, F.col("pending_watermark")).otherwise(F.col("last_watermark")).alias("last_watermark"),
        F.when(~hit, F.col("pending_watermark")).alias("pending_watermark"),
        "last_run_id",
        F.when(hit, _at(at)).otherwise(F.col("updated_at")).alias("updated_at"),
    )


def mark_of(marks: DataFrame, mapping_id: str) -> datetime | None:
    """The committed watermark of a mapping."""
    found = marks.where(F.col("mapping_id") == mapping_id).select("last_watermark").limit(1).collect()
    return found[0][0] if found else None
