"""Mapping metadata, held on the driver.

A mapping says which relation becomes which node or edge.  Metadata is small by
nature (one attribute per column of a source table), so it lives in frozen
dataclasses and the row work is expressed as DataFrame plans built from them.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass, field

NODE, EDGE = "node", "edge"
FULL, HASH, TIMESTAMP = "full", "hash", "timestamp"


class SpecError(ValueError):
    """A mapping that cannot be turned into a plan."""


@dataclass(frozen=True)
class AttrSpec:
    source_column: str
    target_property: str
    data_type: str = "String"
    is_id: bool = False
    transform: str | None = None
    # What a NULL transform result means: 'keep' falls back to the source value
    # (a failed try_* call reads as NULL), 'null' lets the NULL through.
    on_null: str = "keep"
    privacy_class: str | None = None
    security_class: str | None = None
    nullable: bool = True
    attr_id: str = ""

    @property
    def column(self) -> str:
        return self.source_column.lower()


@dataclass(frozen=True)
class TagSpec:
    tag_id: str
    name: str
    category: str = "business_domain"
    display_name: str | None = None


@dataclass(frozen=True)
class SourceSpec:
    """Where rows come from: exactly one of ``table``, ``query``, ``path`` or a JDBC url.

    A JDBC source names its relation with ``table`` or ``query`` as well.
    """

    table: str | None = None
    schema: str | None = None
    query: str | None = None
    path: str | None = None
    format: str = "parquet"
    jdbc_url: str | None = None
    options: tuple[tuple[str, str], ...] = ()
    partition_column: str | None = None
    partition_size: int = 100_000
    is_active: bool = True

    @property
    def relation(self) -> str | None:
        if self.table is None:
            return None
        return f"{self.schema}.{self.table}" if self.schema else self.table


@dataclass(frozen=True)
class MappingSpec:
    mapping_id: str
    entity_name: str
    entity_type: str = NODE
    attributes: tuple[AttrSpec, ...] = ()
    source: SourceSpec = field(default_factory=SourceSpec)
    id_expr: str | None = None
    # What every id of the expression begins with; an id that does not makes the mapping fail.
    # It keeps the mapping apart from others whose ids begin otherwise.
    id_starts: str | None = None
    from_mapping_id: str | None = None
    to_mapping_id: str | None = None
    row_filter: str | None = None
    change_mode: str = FULL
    watermark_column: str | None = None
    delete_flag: str | None = None
    hash_columns: tuple[str, ...] | None = None
    concept_tags: tuple[TagSpec, ...] = ()
    # Columns that say which of several rows with one id is the last one.
    order_columns: tuple[str, ...] = ()
    # Values carry the order of their rows (numbers, dates or instants), so that a late or repeated
    # batch does not replace newer ones.  For timestamp mappings.
    versioned: bool = False
    # The source guarantees one row per id, so no collapse (and no shuffle) is needed.
    unique_ids: bool = False
    load_order: int = 100

    def __post_init__(self) -> None:
        if self.entity_type not in (NODE, EDGE):
            raise SpecError(f"{self.mapping_id}: entity_type must be node or edge")
        if self.change_mode not in (FULL, HASH, TIMESTAMP):
            raise SpecError(f"{self.mapping_id}: unknown change_mode {self.change_mode!r}")

    def check(self) -> None:
        """Raises when rows of this mapping cannot be identified or followed."""
        if not self.id_expr and not self.attributes:
            raise SpecError(f"{self.mapping_id}: no id expression and no attributes, rows cannot be identified")
        if self.change_mode == TIMESTAMP and not self.watermark_column:
            raise SpecError(f"{self.mapping_id}: timestamp mode needs a watermark column")
        if self.versioned and (self.change_mode != TIMESTAMP or not self.order_columns):
            raise SpecError(f"{self.mapping_id}: versions need timestamp mode and order columns")

    @property
    def id_attributes(self) -> tuple[AttrSpec, ...]:
        return tuple(a for a in self.attributes if a.is_id)

    @property
    def fingerprint_columns(self) -> list[str]:
        """Columns of the row fingerprint: the declared ones or every mapped column."""
        return [c.lower() for c in (self.hash_columns or [a.source_column for a in self.attributes])]

    @property
    def id_prefix(self) -> str | None:
        """Text every id of this mapping starts with, or None when an expression decides and
        promises nothing."""
        return self.id_starts if self.id_expr else f"{self.entity_name}_"


def index_specs(specs: list[MappingSpec]) -> dict[str, MappingSpec]:
    """Mappings by id; an id that occurs twice is an error, not a silent last-one-wins."""
    twice = [m for m, n in Counter(s.mapping_id for s in specs).items() if n > 1]
    if twice:
        raise SpecError(f"mapping ids are not unique: {sorted(twice)}")
    return {s.mapping_id: s for s in specs}


def in_load_order(specs: list[MappingSpec]) -> list[MappingSpec]:
    return sorted(specs, key=lambda s: (s.load_order, s.mapping_id))


def id_families(specs: list[MappingSpec]) -> list[list[MappingSpec]]:
    """Groups of node mappings whose ids may coincide.

    Ids that begin with prefixes of which neither begins with the other can never be
    equal, so such mappings need no common shuffle.  An id expression that promises no
    beginning may produce anything and so ties everything together.
    """
    nodes = in_load_order([s for s in specs if s.entity_type == NODE])
    if any(s.id_prefix is None for s in nodes):
        return [nodes] if nodes else []
    families: list[list[MappingSpec]] = []
    for spec in nodes:
        related = [
            fam
            for fam in families
            if any(m.id_prefix.startswith(spec.id_prefix) or spec.id_prefix.startswith(m.id_prefix) for m in fam)
        ]
        merged = [m for fam in related for m in fam] + [spec]
        families = [fam for fam in families if fam not in related] + [in_load_order(merged)]
    return families
