"""Concept tags: one node per tag and an edge from every node of a tagged mapping."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rowgraft.operators.merge import NODE_SCHEMA
from rowgraft.operators.skew import lookup_join
from rowgraft.session import small_frame
from rowgraft.specs import NODE, MappingSpec, TagSpec, in_load_order

# Labels and the id infix of tag elements.
TAG_LABEL = "ConceptTag"
TAGGED_AS = "TAGGED_AS"
TAG_INFIX = "__TAG__"


def tag_properties(name: Column, category: Column, display: Column) -> Column:
    return F.create_map(
        F.lit("name"), name, F.lit("category"), category,
        F.lit("display_name"), F.coalesce(F.nullif(display, F.lit("")), name),
    )


def tag_nodes(tags: DataFrame) -> DataFrame:
    """Tag nodes from tag rows (tag_id, tag_name, tag_category, display_name), unique by id."""
    return tags.select(
        F.col("tag_id").alias("id"),
        F.lit(TAG_LABEL).alias("label"),
        tag_properties(F.col("tag_name"), F.col("tag_category"), F.col("display_name")).alias("props"),
    )


def unique_tags(assignments: DataFrame, order: list[str]) -> DataFrame:
    """One row per tag id over the node mappings, the first in ``order`` winning."""
    details = F.struct("tag_name", "tag_category", "display_name")
    first = F.min_by(details, F.struct(*order, details))
    return (
        assignments.where(F.col("entity_type") == NODE)
        .groupBy("tag_id")
        .agg(first.alias("d"))
        .select("tag_id", "d.tag_name", "d.tag_category", "d.display_name")
    )


def tagged_as(nodes: DataFrame, assignments: DataFrame) -> DataFrame:
    """TAGGED_AS edges: nodes (mapping_id, id) with the tags of their mapping.

    A mapping may own most of the nodes, so it is never a shuffle key on its own.
    """
    tags = assignments.select("mapping_id", "tag_id").distinct()
    paired = lookup_join(nodes.select("mapping_id", "id"), tags, ["mapping_id"], "inner", ["id"])
    return _tag_edges(paired)


def tagged_as_spec(nodes: DataFrame, tags: tuple[TagSpec, ...]) -> DataFrame:
    """TAGGED_AS edges for the nodes of one mapping whose tags are known: no join at all."""
    ids = F.array(*[F.lit(t) for t in dict.fromkeys(tag.tag_id for tag in tags)])
    return _tag_edges(nodes.select("id", F.explode(ids).alias("tag_id")))


def _tag_edges(paired: DataFrame) -> DataFrame:
    return paired.select(
        F.concat("id", F.lit(TAG_INFIX), "tag_id").alias("id"),
        F.lit(TAGGED_AS).alias("label"),
        F.col("id").alias("from_id"),
        F.col("tag_id").alias("to_id"),
        F.create_map().cast("map<string,string>").alias("props"),
    )


def spec_tag_nodes(spark: SparkSession, specs: list[MappingSpec]) -> DataFrame:
    """Tag nodes of the loaded node mappings."""
    first: dict[str, TagSpec] = {}
    for spec in in_load_order(specs):
        if spec.entity_type == NODE:
            for tag in spec.concept_tags:
                first.setdefault(tag.tag_id, tag)
    rows = [
        (t.tag_id, TAG_LABEL, {"name": t.name, "category": t.category, "display_name": t.display_name or t.name})
        for t in first.values()
    ]
    return small_frame(spark, rows, NODE_SCHEMA)

