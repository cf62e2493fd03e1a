"""Named queries over the given tables, each with the SQL that must agree with it."""

from runlens.plans.bindings import cells, keyed, lines, ordered, sqlcells, stages, streams
from runlens.plans.bindings.registry import oracles, queries

__all__ = ["cells", "keyed", "lines", "oracles", "ordered", "queries", "sqlcells", "stages", "streams"]
