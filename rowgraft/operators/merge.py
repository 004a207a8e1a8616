"""Upserts and deletes on a graph held as two frames.

nodes: id, label, props          edges: id, label, from_id, to_id, props
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowgraft.operators.properties import PROPS_TYPE, merged_props
from rowgraft.operators.skew import (
    BROADCAST_BYTES,
    BROADCAST_ROWS,
    durable,
    is_small,
    lookup_join,
    measured,
    sized_join,
)

NODE_SCHEMA = f"id string, label string, props {PROPS_TYPE}"
EDGE_SCHEMA = f"id string, label string, from_id string, to_id string, props {PROPS_TYPE}"
NODE_KEYS = ["id"]
EDGE_KEYS = ["label", "id", "from_id", "to_id"]
EDGE_ID_KEYS = ["label", "id"]
# Changes carry property maps, so fewer of them count as small.
SMALL_CHANGE_ROWS = 20_000


def upsert(
    current: DataFrame,
    changed: DataFrame,
    keys: list[str],
    replace: bool = False,
    small: bool | None = None,
) -> DataFrame:
    """Current elements with the changed ones merged in (``replace`` swaps whole property
    maps instead).  Both frames have one row per key.

    A small change set is broadcast, so the graph is read but not shuffled; otherwise one
    full outer join does it.  ``small`` skips the check when the caller knows.
    """
    if small is None:
        small = is_small(changed, SMALL_CHANGE_ROWS)
    carried = [c for c in current.columns if c not in keys and c != "props"]
    incoming = changed.select(
        *keys, *[F.col(c).alias(f"__new_{c}") for c in carried], F.col("props").alias("__new_props"),
        F.lit(True).alias("__hit"),
    )
    if replace:
        props = F.when(F.col("__hit"), F.col("__new_props")).otherwise(F.col("props"))
    else:
        props = F.when(F.col("__hit"), merged_props(F.col("props"), F.col("__new_props"))).otherwise(F.col("props"))
    columns = {"props": props} | {c: F.coalesce(f"__new_{c}", c) for c in carried}
    if not small:
        joined = current.join(incoming, keys, "full_outer")
        return joined.withColumns(columns).select(*current.columns)
    merged = current.join(F.broadcast(incoming), keys, "left").withColumns(columns).select(*current.columns)
    known = current.select(*keys).join(F.broadcast(changed.select(*keys)), keys, "left_semi")
    added = changed.select(*current.columns).join(F.broadcast(known), keys, "left_anti")
    return merged.unionByName(added)


def upsert_nodes(nodes: DataFrame, changed: DataFrame, replace: bool = False, small: bool | None = None) -> DataFrame:
    return upsert(nodes, changed, NODE_KEYS, replace, small)


def upsert_edges(
    edges: DataFrame,
    changed: DataFrame,
    replace: bool = False,
    small: bool | None = None,
    keys: list[str] | None = None,
) -> DataFrame:
    """Edges are one and the same when label, id and both ends agree; pass EDGE_ID_KEYS for
    targets that know an edge by its id alone (the ends then come from the newer row)."""
    return upsert(edges, changed, keys or EDGE_KEYS, replace, small)


def delete_nodes(nodes: DataFrame, edges: DataFrame, ids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes without the ids given (column ``id``), edges without those that touch them."""
    gone = ids.select("id").distinct()
    small = is_small(gone)
    return _without(nodes, gone, "id", ["id"], small), without_incident(edges, gone, small)


def without_incident(edges: DataFrame, ids: DataFrame, small: bool | None = None) -> DataFrame:
    """Edges of which neither end is among the ids."""
    if small is None:
        small = is_small(ids)
    kept = _without(edges, ids, "from_id", ["id", "to_id"], small)
    return _without(kept, ids, "to_id", ["id", "from_id"], small)


def incident(edges: DataFrame, ids: DataFrame, small: bool | None = None) -> DataFrame:
    """Edges of which at least one end is among the ids: what a delete takes with it."""
    gone = ids.select("id").distinct()
    if small is None:
        small = is_small(gone)
    for side, other in (("from", "to"), ("to", "from")):
        hit = gone.select(F.col("id").alias(f"{side}_id"), F.lit(True).alias(f"__{side}"))
        edges = sized_join(edges, hit, [f"{side}_id"], "left", ["id", f"{other}_id"], small)
    return edges.where("__from or __to").drop("__from", "__to")


def delete_edges(edges: DataFrame, keyed: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Edges without the ones named by ``keyed`` (columns ``keys``, the id by default)."""
    keys = keys or ["id"]
    gone = keyed.select(*keys).distinct()
    return lookup_join(edges, gone, keys, "left_anti", ["id", "from_id", "to_id"])


def _without(df: DataFrame, ids: DataFrame, column: str, spread_by: list[str], small: bool) -> DataFrame:
    return sized_join(df, ids.select(F.col("id").alias(column)), [column], "left_anti", spread_by, small)


def missing_endpoints(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Ids that edges refer to and no node has.

    Endpoints are made distinct before they travel, so this moves each id once per task
    and never the edges themselves.
    """
    ends = edges.select(F.col("from_id").alias("id")).union(edges.select(F.col("to_id").alias("id")))
    return ends.distinct().join(nodes.select("id"), "id", "left_anti")


def unclaimed(gone: DataFrame, claims: DataFrame, keys: list[str]) -> DataFrame:
    """Of the keys one owner gives up, those no owner still claims."""
    gone = gone.select(*keys).distinct()
    claims = claims.select(*keys)
    if is_small(gone):
        claims = claims.join(F.broadcast(gone), keys, "left_semi")
    return gone.join(claims, keys, "left_anti")


@dataclass(frozen=True)
class Absent:
    """Materialised missing endpoint ids and what their size allows."""

    ids: DataFrame
    empty: bool
    small: bool


def absent_endpoints(edges: DataFrame, nodes: DataFrame, others: DataFrame | None = None) -> Absent:
    """``nodes`` are those that the edges are expected to end at; the ``others`` are only asked
    for ids that none of these has."""
    absent = _measured_ids(missing_endpoints(edges, nodes))
    if others is None or absent.empty:
        return absent
    held = others.select("id")
    if absent.small:
        held = held.join(F.broadcast(absent.ids), "id", "left_semi")
    return _measured_ids(absent.ids.join(held, "id", "left_anti"))


def _measured_ids(ids: DataFrame) -> Absent:
    ids = durable(ids)
    rows, size = measured(ids)
    return Absent(ids, rows == 0, rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES)


def marked_edges(edges: DataFrame, absent: Absent) -> DataFrame:
    """Edges with a column ``missing``: NULL, or 'from', 'to' or 'both'.

    No missing id leaves the edges untouched, few are broadcast, many are joined with
    heavy ends spread out.
    """
    if absent.empty:
        return edges.withColumn("missing", F.lit(None).cast("string"))
    for side, other in (("from", "to"), ("to", "from")):
        ids = absent.ids.select(F.col("id").alias(f"{side}_id"), F.lit(True).alias(f"__no_{side}"))
        edges = sized_join(edges, ids, [f"{side}_id"], "left", ["id", f"{other}_id"], absent.small)
    lost_from, lost_to = F.coalesce("__no_from", F.lit(False)), F.coalesce("__no_to", F.lit(False))
    which = F.when(lost_from & lost_to, F.lit("both")).when(lost_from, F.lit("from")).when(lost_to, F.lit("to"))
    return edges.withColumn("missing", which).drop("__no_from", "__no_to")


def checked_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return marked_edges(edges, absent_endpoints(edges, nodes))


def valid_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return checked_edges(edges, nodes).where(F.col("missing").isNull()).drop("missing")


def dangling_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    return checked_edges(edges, nodes).where(F.col("missing").isNotNull())


def parallel_pairs(edges: DataFrame) -> DataFrame:
    """Node pairs joined by more than one edge."""
    return edges.groupBy("from_id", "to_id").agg(F.count(F.lit(1)).alias("n_edges")).where("n_edges > 1")


def with_tenant(nodes: DataFrame, key: str, value: str, current: DataFrame | None = None) -> DataFrame:
    """The tenant property on every new node; a node that exists keeps the one it has."""
    props = F.map_concat(
        F.map_filter(F.col("props"), lambda k, v: k != key), F.create_map(F.lit(key), F.lit(value))
    )
    if current is None:
        return nodes.withColumn("props", props)
    known = current.select("id", F.lit(True).alias("__known"))
    kept = F.map_filter(F.col("props"), lambda k, v: k != key)
    return (
        nodes.join(known, "id", "left")
        .withColumn("props", F.when(F.col("__known"), kept).otherwise(props))
        .drop("__known")
    )


def totals(df: DataFrame) -> DataFrame:
    """Elements per label."""
    return df.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
