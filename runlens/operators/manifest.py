"""Differences of path lists, with set semantics."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from runlens.functions.text import every


def distinct_union(parts: Sequence[DataFrame], column: str = "uri") -> DataFrame:
    """All entries of several lists, once each."""
    return reduce(DataFrame.union, (p.select(column) for p in parts)).distinct()


def manifest_diff(
    entries: Sequence[DataFrame],
    known: Sequence[DataFrame],
    column: str = "uri",
    keep: Sequence[Column] = (),
) -> DataFrame:
    """Entries that pass every predicate and are in none of the known lists.

    One aggregation with map-side partials, so a repeated entry is no hot key, and a
    null entry counts as known when a known list holds a null.
    """
    known_tag = F.lit(True).alias("_known")
    wanted = reduce(DataFrame.union, (e.select(column) for e in entries))
    tagged = wanted.filter(every(keep)).select(column, F.lit(False).alias("_known"))
    for part in known:
        tagged = tagged.union(part.select(column, known_tag))
    found = tagged.groupBy(column).agg(F.bool_or("_known").alias("_known"))
    return found.filter(~F.col("_known")).select(column)


def without_ignored(
    df: DataFrame, ignored: Sequence[str], column: str = "uri"
) -> DataFrame:
    """Rows whose entry is not in a short list; null entries stay."""
    if not ignored:
        return df
    hit = F.col(column).isin(list(ignored))
    return df.filter(~F.coalesce(hit, F.lit(False)))
