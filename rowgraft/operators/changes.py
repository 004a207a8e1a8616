"""Change detection: what an extract means for the graph."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgraft.operators.elements import GONE, element_keys
from rowgraft.operators.skew import durable, is_small, sized_join
from rowgraft.specs import FULL, MappingSpec

INSERT, UPDATE, UNCHANGED, DELETE, SKIP = "insert", "update", "unchanged", "delete", "skip"
DANGLING = "dangling"
CHANGE_COLUMNS = [
    "mapping_id", "entity_type", "label", "id", "from_id", "to_id",
    "props", "row_hash", "op", "reason", "n_rows", "first_seen_run_id",
]


def changes_by_fingerprint(extract: DataFrame, state: DataFrame, spec: MappingSpec) -> DataFrame:
    """Insert, update, unchanged or delete, by comparing a complete extract with the stored
    fingerprints of its mapping.  In full mode a known row is always an update.

    One full outer join on the element key; an extract that was just folded on that key
    is already partitioned for it.  Only changed rows keep their properties.
    """
    keys = element_keys(spec)
    # Columns of the state keep their names below the join: a renaming would hide how it is dealt.
    stored = state.where(F.col("mapping_id") == spec.mapping_id).select(*keys, "row_hash", "first_seen_run_id")
    differs = F.lit(True) if spec.change_mode == FULL else F.col("__old") != F.col("row_hash")
    op = (
        F.when(F.col("reason").isNotNull(), F.lit(SKIP))
        .when(F.col("row_hash").isNull(), F.lit(DELETE))
        .when(F.col("__old").isNull(), F.lit(INSERT))
        .when(differs, F.lit(UPDATE))
        .otherwise(F.lit(UNCHANGED))
    )
    fresh = extract.drop("mapping_id", "entity_type", "label").withColumnRenamed("row_hash", "__new")
    joined = fresh.join(stored, keys, "full_outer").withColumnsRenamed({"row_hash": "__old", "__new": "row_hash"})
    return _change_set(joined, spec, op)


def changes_with_late_props(extract: DataFrame, state: DataFrame, spec: MappingSpec) -> DataFrame:
    """The same without unchanged rows, for an extract that was not folded: only keys and
    fingerprints are compared; properties are fetched by a second read, of changed rows alone.

    A row that changes between the two reads is left for the next run, which sees it as changed.
    """
    keys = element_keys(spec)
    bare = extract.withColumn("props", F.lit(None).cast(extract.schema["props"].dataType))
    found = durable(changes_by_fingerprint(bare, state, spec).where(F.col("op") != UNCHANGED))
    wanted = upserts(found).select(*keys, "row_hash")
    props = extract.select(*keys, "row_hash", "props")
    if is_small(wanted):
        props = props.join(F.broadcast(wanted), [*keys, "row_hash"], "left_semi")
    # Keys occur once, so many changed rows need neither salts nor a join before this one.
    changed = upserts(found).drop("props").join(props, [*keys, "row_hash"]).select(*found.columns)
    return changed.unionByName(found.where(~F.col("op").isin(INSERT, UPDATE)))


def changes_by_watermark(extract: DataFrame, spec: MappingSpec) -> DataFrame:
    """Every extracted row is an update, or a delete where the flag is set.

    Deletes follow upserts whatever the row order, so one flagged row deletes its id.
    """
    op = (
        F.when(F.col("reason").isNotNull(), F.lit(SKIP))
        .when(F.col("flagged"), F.lit(DELETE))
        .otherwise(F.lit(UPDATE))
    )
    return _change_set(extract.withColumn("first_seen_run_id", F.lit(None).cast("string")), spec, op)


def changes_by_version(extract: DataFrame, stored: DataFrame, spec: MappingSpec) -> DataFrame:
    """What a batch adds to elements whose values carry the order of their rows, in ``row_hash`` as
    JSON.  ``stored`` are the versions kept for the mapping.

    A value is taken when its row comes after the one the kept value is from, and after the newest
    deletion.  A deletion takes effect when no newer value is known.  So batches may come in any
    order, and again.  What changes nothing is ``unchanged``.
    """
    keys = element_keys(spec)
    batch = durable(extract)
    asked = batch.where(F.col("id").isNotNull()).select(*keys)
    held = stored.where(F.col("mapping_id") == spec.mapping_id).select(*keys, F.col("row_hash").alias("__held"), "first_seen_run_id")
    known = sized_join(held, asked, keys, "left_semi", keys, is_small(asked))
    joined = batch.join(known, keys, "left")
    none = F.create_map().cast("map<string,string>")
    old = F.coalesce(F.from_json("__held", "map<string,string>"), none)
    joined = joined.withColumns({"__old": old, "__new": F.coalesce("versions", none)})
    merged = F.map_zip_with("__old", "__new", lambda k, a, b: F.greatest(a, b))
    joined = joined.withColumn("__all", merged)
    gone = F.coalesce(F.col("__all")[GONE], F.lit(""))
    alive = F.map_filter("__all", lambda k, v: (k == GONE) | (v > gone))
    newer = lambda k: F.col("__new")[k].isNull() | ((F.col("__new")[k] > F.coalesce(F.col("__old")[k], F.lit(""))) & (F.col("__new")[k] > gone))
    fresh = F.map_filter("props", lambda k, v: newer(k))
    taken = F.exists(F.map_keys("__new"), lambda k: (k != GONE) & newer(k))
    left = F.size(F.map_filter(alive, lambda k, v: k != GONE)) > 0
    later_gone = F.coalesce(F.col("__new")[GONE] > F.coalesce(F.col("__old")[GONE], F.lit("")), F.lit(False))
    op = (
        F.when(F.col("reason").isNotNull(), F.lit(SKIP))
        .when(~left & later_gone, F.lit(DELETE))
        .when(left & (taken | later_gone), F.lit(UPDATE))
        .otherwise(F.lit(UNCHANGED))
    )
    # Values that gave way keep their place with NULL, which replaces nothing.
    kept = F.map_zip_with("props", fresh, lambda k, a, b: b)
    return _change_set(joined.withColumns({"props": kept, "row_hash": F.to_json(alive), "__taken": op}), spec, F.col("__taken"))


def _change_set(df: DataFrame, spec: MappingSpec, op) -> DataFrame:
    marked = df.withColumns({"__op": op})
    return marked.select(
        F.lit(spec.mapping_id).alias("mapping_id"),
        F.lit(spec.entity_type).alias("entity_type"),
        F.lit(spec.entity_name).alias("label"),
        "id",
        F.coalesce("from_id", F.lit("")).alias("from_id"),
        F.coalesce("to_id", F.lit("")).alias("to_id"),
        F.when(F.col("__op").isin(INSERT, UPDATE), F.col("props")).alias("props"),
        "row_hash",
        F.col("__op").alias("op"),
        "reason",
        F.coalesce("n_rows", F.lit(1)).cast("long").alias("n_rows"),
        "first_seen_run_id",
    )


def upserts(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("op").isin(INSERT, UPDATE))


def deletions(changes: DataFrame) -> DataFrame:
    return changes.where(F.col("op") == DELETE)
