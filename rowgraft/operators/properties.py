"""Property maps of nodes and edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowgraft.functions.text import VALID_KEY, canon, property_key
from rowgraft.operators.identity import source_column, source_text
from rowgraft.specs import AttrSpec

PROPS_TYPE = "map<string,string>"


def final_attributes(attributes: tuple[AttrSpec, ...]) -> list[AttrSpec]:
    """One attribute per property: a later one of the same name takes the place of an earlier."""
    return list({a.target_property: a for a in attributes}.values())


def with_values(df: DataFrame, attributes: list[AttrSpec], prefix: str) -> DataFrame:
    """Adds one text column ``<prefix><i>`` per attribute, transforms applied.

    A transform is a SQL expression over ``value``; each is evaluated in its own
    projection with ``value`` naming the attribute's column, and Catalyst folds the
    projections into one.
    """
    shadowed = "value" in df.columns
    if shadowed:
        df = df.withColumn("__source_value", F.col("value"))

    def raw(name: str) -> Column:
        return F.col("__source_value") if shadowed and name == "value" else source_column(df, name)

    plain = {f"{prefix}{i}": source_text(df, a.column) for i, a in enumerate(attributes) if not a.transform}
    df = df.withColumns(plain) if plain else df
    for i, attr in enumerate(attributes):
        if not attr.transform:
            continue
        original = raw(attr.column)
        step = df.withColumn("value", original)
        result = canon(F.expr(attr.transform), step.select(F.expr(attr.transform).alias("v")).schema["v"].dataType)
        if attr.on_null == "keep":
            result = F.coalesce(result, canon(F.col("value"), step.schema["value"].dataType))
        df = step.withColumn(f"{prefix}{i}", result)
    if shadowed:
        return df.withColumn("value", F.col("__source_value")).drop("__source_value")
    return df.drop("value") if any(a.transform for a in attributes) else df


def property_map(attributes: list[AttrSpec], columns: list[Column]) -> Column:
    """Properties with their privacy and security companions, in attribute order."""
    entries: dict[str, Column] = {}
    for attr, column in zip(attributes, columns):
        entries[attr.target_property] = column
        if attr.privacy_class:
            entries[f"{attr.target_property}__privacy_class"] = F.lit(attr.privacy_class)
        if attr.security_class:
            entries[f"{attr.target_property}__security_class"] = F.lit(attr.security_class)
    if not entries:
        return F.create_map().cast(PROPS_TYPE)
    pairs = [part for name, column in entries.items() for part in (F.lit(name), column)]
    return F.create_map(*pairs)


def project_properties(df: DataFrame, attributes: tuple[AttrSpec, ...], name: str = "props") -> DataFrame:
    """The relation with a property map column."""
    chosen = final_attributes(attributes)
    valued = with_values(df, chosen, "__v")
    columns = [F.col(f"__v{i}") for i in range(len(chosen))]
    return valued.withColumn(name, property_map(chosen, columns)).drop(*[f"__v{i}" for i in range(len(chosen))])


def without_nulls(props: Column) -> Column:
    return F.map_filter(props, lambda k, v: v.isNotNull())


def with_valid_keys(props: Column) -> Column:
    """Keys made valid; of keys that become equal, the later property stays.

    Keys are renamed and compared with each other only in maps where one of them is not valid."""
    given = without_nulls(props)
    valid = F.forall(F.map_keys(given), lambda k: F.rlike(k, F.lit(VALID_KEY)))
    return F.when(valid, given).otherwise(_renamed(given))


def _renamed(props: Column) -> Column:
    entries = F.map_entries(props)
    renamed = F.transform(entries, lambda e: F.struct(property_key(e["key"]).alias("key"), e["value"].alias("value")))
    names = F.transform(renamed, lambda e: e["key"])
    last = F.filter(
        renamed,
        lambda e, i: F.coalesce(F.array_position(F.slice(names, i + 2, F.size(names)), e["key"]), F.lit(0)) == 0,
    )
    return F.map_from_entries(last)


def merged_props(old: Column, new: Column) -> Column:
    """New values over old ones; a NULL or missing new value keeps the old one."""
    none = F.create_map().cast(PROPS_TYPE)
    return F.map_zip_with(
        F.coalesce(old, none), F.coalesce(new, none), lambda key, before, after: F.coalesce(after, before)
    )
