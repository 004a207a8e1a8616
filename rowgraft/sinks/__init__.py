"""Exports by name.  An export is a function (nodes, edges, path, **options)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from rowgraft.sinks import gml, graphml, rows

Export = Callable[..., None]
_EXPORTS: dict[str, Export] = {
    "bulk_csv": rows.write_bulk_csv,
    "typed_csv": rows.write_typed_csv,
    "json_rows": rows.write_json_rows,
    "batches": rows.write_batches,
    "gml": gml.write_gml,
    "graphml": graphml.write_graphml,
}


def register(name: str, export: Export) -> None:
    """Adds a target, or replaces the one of that name."""
    _EXPORTS[name.lower()] = export


def export_graph(name: str, nodes: DataFrame, edges: DataFrame, path: str, **options) -> None:
    try:
        export = _EXPORTS[name.lower()]
    except KeyError:
        raise ValueError(f"unknown export {name!r}; known: {sorted(_EXPORTS)}") from None
    export(nodes, edges, path, **options)
