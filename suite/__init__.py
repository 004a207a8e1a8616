"""Queries over the given tables, each with the SQL that must give the same rows."""

from suite import catalogs, changes, exports, graphs, nodes, runs, sources
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "catalogs", "changes", "exports", "graphs", "nodes", "runs", "sources"]
