"""Stable ids of nodes and edges, as expressions over the source row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgraft.functions.text import FIELD_SEPARATOR, canon, digest, joined
from rowgraft.specs import MappingSpec, SpecError


def source_column(df: DataFrame, name: str) -> Column:
    """A source column, or NULL when the relation has none of that name."""
    name = name.lower()
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast("string")


def source_text(df: DataFrame, name: str) -> Column:
    name = name.lower()
    if name not in df.columns:
        return F.lit(None).cast("string")
    return canon(F.col(f"`{name}`"), df.schema[name].dataType)


def expression_id(df: DataFrame, expression: str) -> Column:
    """An id computed by a SQL expression over the row; NULL means the row is skipped."""
    value = F.expr(expression)
    return canon(value, df.select(value.alias("v")).schema["v"].dataType)


def composite_id(df: DataFrame, entity_name: str, columns: list[str]) -> Column:
    """name_v1_v2, a missing value leaving its place empty."""
    parts = [F.coalesce(source_text(df, c), F.lit("")) for c in columns]
    return F.concat_ws("_", F.lit(entity_name), *parts)


def content_id(df: DataFrame, entity_name: str, columns: list[str]) -> Column:
    """name_<sha256 of the name and every mapped value>."""
    return id_of_content(content(df, entity_name, columns), entity_name)


def content(df: DataFrame, entity_name: str, columns: list[str]) -> Column:
    """The text whose digest is the id: as telling, and in an exchange shorter, as it packs well."""
    return joined([F.lit(entity_name)] + [source_text(df, c) for c in columns], FIELD_SEPARATOR)


def id_of_content(text: Column, entity_name: str) -> Column:
    return F.concat(F.lit(f"{entity_name}_"), F.sha2(text, 256))


def element_id(df: DataFrame, spec: MappingSpec) -> Column:
    """Expression first, then the id attributes, then the whole content."""
    if spec.id_expr:
        own = expression_id(df, spec.id_expr)
        if spec.id_starts is None:
            return own
        broken = F.raise_error(F.concat(F.lit(f"{spec.mapping_id}: an id does not begin with {spec.id_starts}: "), own))
        return F.when(own.isNull() | F.startswith(own, F.lit(spec.id_starts)), own).otherwise(broken)
    if spec.id_attributes:
        return composite_id(df, spec.entity_name, [a.source_column for a in spec.id_attributes])
    return content_id(df, spec.entity_name, [a.source_column for a in spec.attributes])


def endpoint_id(
    df: DataFrame, spec: MappingSpec, side: str, specs: Mapping[str, MappingSpec]
) -> Column:
    """The id rule of the referenced mapping, applied to the edge's own row."""
    reference = spec.from_mapping_id if side == "from" else spec.to_mapping_id
    if reference is None:
        raise SpecError(f"{spec.mapping_id}: no {side} mapping")
    if reference not in specs:
        raise SpecError(f"{spec.mapping_id}: {side} mapping {reference!r} is not loaded")
    return element_id(df, specs[reference])


def row_fingerprint(df: DataFrame, columns: list[str], separated: bool = True) -> Column:
    """SHA-256 of the named columns.  ``separated=False`` puts nothing between the values,
    the older form in which ('ab', 'c') and ('a', 'bc') are the same."""
    return digest([source_text(df, c) for c in columns], FIELD_SEPARATOR if separated else "")
