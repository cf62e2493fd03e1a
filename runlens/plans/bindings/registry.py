"""Registry of named queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL of its expected result."""

    def add(fn: Query) -> Query:
        if name in _queries:
            raise ValueError(f"query {name!r} exists")
        _queries[name] = fn
        if sql is not None:
            _oracles[name] = sql.strip()
        return fn

    return add


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracles() -> dict[str, str]:
    return dict(_oracles)


def joined(items: Column | str, mark: str = ",") -> Column:
    """A list as one text, so that results compare as plain values."""
    column = F.col(items) if isinstance(items, str) else items
    return F.array_join(column.cast("array<string>"), mark)
