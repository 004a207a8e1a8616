"""From source rows to graph elements: one frame per mapping, one row per element."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgraft.functions.text import sortable, truthy
from rowgraft.operators.collapse import collapse_rows
from rowgraft.operators.identity import content, element_id, endpoint_id, id_of_content, row_fingerprint
from rowgraft.operators.properties import final_attributes, property_map, with_values
from rowgraft.specs import EDGE, AttrSpec, MappingSpec

NO_ID, NO_ENDPOINT = "no_id", "no_endpoint"
ELEMENT_COLUMNS = [
    "mapping_id", "entity_type", "label", "id", "from_id", "to_id",
    "props", "row_hash", "flagged", "reason", "n_rows",
]


def element_keys(spec_or_type: MappingSpec | str) -> list[str]:
    """What makes an element: the id of a node, the id and both ends of an edge."""
    kind = spec_or_type if isinstance(spec_or_type, str) else spec_or_type.entity_type
    return ["id", "from_id", "to_id"] if kind == EDGE else ["id"]


def delete_flag(df: DataFrame, spec: MappingSpec) -> Column:
    if not spec.delete_flag:
        return F.lit(False)
    flag = F.expr(spec.delete_flag)
    return truthy(flag, df.select(flag.alias("f")).schema["f"].dataType)


def _fixed_values(spec: MappingSpec, attributes: list[AttrSpec]) -> set[str]:
    """Value columns that cannot differ within one id: everything the content id covers.

    Parts of a composite id are not among them, as 'a_b','c' and 'a','b_c' give one id.
    """
    if spec.id_expr or spec.id_attributes:
        return set()
    return {f"__v{i}" for i in range(len(attributes))}


def elements(
    df: DataFrame,
    spec: MappingSpec,
    specs: Mapping[str, MappingSpec],
    separated: bool = True,
    late_ids: bool = False,
) -> DataFrame:
    """Elements of a mapping.  Rows without an id or endpoint come out with ``id`` NULL and
    a reason, folded to one row per reason that still counts them in ``n_rows``.

    With ``late_ids`` rows are folded by the content that an id is the digest of, and ids made
    of folded ones: less to exchange, but what comes out is not dealt by id."""
    spec.check()
    if spec.versioned:
        return _versioned(df, spec, specs, separated)
    return _elements(df, spec, specs, separated, late_ids=late_ids)


#: Name of the version of a deletion among those of properties.
GONE = ""


def _versioned(df: DataFrame, spec: MappingSpec, specs: Mapping[str, MappingSpec], separated: bool) -> DataFrame:
    """Elements with ``versions``: of each property, and of the deletion, the order of its row."""
    attributes = final_attributes(spec.attributes)
    parts = [sortable(df[f"`{c.lower()}`"], df.schema[c.lower()].dataType) for c in spec.order_columns]
    order = F.concat(*[F.coalesce(p, F.lit("0" * 16)) for p in parts])
    versions = {f"__t{i}": F.when(F.col(f"__v{i}").isNotNull(), F.col("__version")) for i in range(len(attributes))}
    versions["__gone"] = F.when(F.col("flagged"), F.col("__version"))
    found = _elements(df, spec, specs, separated, order, versions)
    names = [*[a.target_property for a in attributes], GONE]
    given = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(c) for c in versions]))
    return found.withColumn("versions", F.map_filter(given, lambda k, v: v.isNotNull())).drop(*versions)


def _elements(
    df: DataFrame,
    spec: MappingSpec,
    specs: Mapping[str, MappingSpec],
    separated: bool,
    version: Column | None = None,
    versions: Mapping[str, Column] | None = None,
    late_ids: bool = False,
) -> DataFrame:
    versions = versions or {}
    late_ids = late_ids and not (spec.unique_ids or spec.id_expr or spec.id_attributes)
    edge = spec.entity_type == EDGE
    attributes = final_attributes(spec.attributes)
    values = [f"__v{i}" for i in range(len(attributes))]
    rows = with_values(df, attributes, "__v")

    own = content(rows, spec.entity_name, [a.source_column for a in spec.attributes]) if late_ids else element_id(rows, spec)
    start = endpoint_id(rows, spec, "from", specs) if edge else F.lit("")
    end = endpoint_id(rows, spec, "to", specs) if edge else F.lit("")
    mapped = [a.column for a in spec.attributes]
    order = [rows[f"`{c.lower()}`"] for c in spec.order_columns]
    rows = rows.select(
        own.alias("id"),
        start.alias("from_id"),
        end.alias("to_id"),
        # Digests travel as bytes, half as long as text.
        F.unhex(row_fingerprint(rows, spec.fingerprint_columns, separated)).alias("row_hash"),
        F.substring(F.unhex(row_fingerprint(rows, mapped or spec.fingerprint_columns)), 1, 16).alias("__tie"),
        delete_flag(rows, spec).alias("flagged"),
        F.struct(*order, F.lit(0)).alias("__order"),
        *([version.alias("__version")] if version is not None else []),
        *values,
    ).withColumns(dict(versions))

    # A skipped row keeps no key: its reason travels in from_id.
    may_skip = spec.id_expr is not None or (
        edge and any(specs[m].id_expr for m in (spec.from_mapping_id, spec.to_mapping_id))
    )
    if may_skip:
        reason = F.when(F.col("id").isNull(), F.lit(NO_ID)).when(
            F.col("from_id").isNull() | F.col("to_id").isNull(), F.lit(NO_ENDPOINT)
        )
        rows = rows.withColumn("__reason", reason).withColumns(
            {
                "id": F.when(F.col("__reason").isNull(), F.col("id")),
                "from_id": F.coalesce("__reason", "from_id"),
                "to_id": F.when(F.col("__reason").isNull(), F.col("to_id")),
            }
        ).drop("__reason")

    if spec.unique_ids:
        found = rows.withColumn("n_rows", F.lit(1).cast("long"))
        if may_skip:
            skipped = found.where(F.col("id").isNull())
            more = ["__version", *versions] if versions else []
            empty = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in ["__tie", "__order", *more, *values]]
            folded = skipped.groupBy("from_id").agg(F.count(F.lit(1)).alias("n_rows")).select(
                F.lit(None).cast("string").alias("id"), "from_id", F.lit(None).cast("string").alias("to_id"),
                F.lit(None).cast("binary").alias("row_hash"), F.lit(False).alias("flagged"), "n_rows", *empty,
            )
            found = found.where(F.col("id").isNotNull()).unionByName(folded)
    else:
        # Rows of a folded group differ only in attributes; to tell the last one, the
        # declared order comes first and the whole content settles ties.
        keys = ["id", "from_id", "to_id"] if edge or may_skip else ["id"]
        order = F.struct("__order", "__tie")
        newest = [F.max_by("row_hash", order).alias("row_hash"), F.max("flagged").alias("flagged")]
        fixed = _fixed_values(spec, attributes)
        newest += [F.max(v).alias(v) for v in [*[v for v in values if v in fixed], *versions]]
        found = collapse_rows(rows, keys, [v for v in values if v not in fixed], order, newest)
        if "from_id" not in keys:
            found = found.withColumns({"from_id": F.lit(""), "to_id": F.lit("")})

    if late_ids:
        found = found.withColumn("id", id_of_content(F.col("id"), spec.entity_name))
    skipped = F.col("id").isNull() if may_skip else F.lit(False)
    return found.select(
        F.lit(spec.mapping_id).alias("mapping_id"),
        F.lit(spec.entity_type).alias("entity_type"),
        F.lit(spec.entity_name).alias("label"),
        "id",
        F.when(~skipped, F.col("from_id")).alias("from_id"),
        "to_id",
        F.when(~skipped, property_map(attributes, [F.col(v) for v in values])).alias("props"),
        F.when(~skipped, F.lower(F.hex("row_hash"))).alias("row_hash"),
        "flagged",
        F.when(skipped, F.col("from_id")).alias("reason"),
        "n_rows",
        *versions,
    )
