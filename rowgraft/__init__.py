"""rowgraft: grafts the rows of relational tables onto a property graph, on Spark."""

from rowgraft.specs import AttrSpec, MappingSpec, SourceSpec, TagSpec

__all__ = ["AttrSpec", "MappingSpec", "SourceSpec", "TagSpec"]
