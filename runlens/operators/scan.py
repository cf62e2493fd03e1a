"""Prefix scans: running values and as-of lookups over range partitions.

``Window.partitionBy(key).orderBy(...)`` puts all rows of a key into one task.  Here rows
are range-partitioned on (key, order), so a hot key, or one with all of its rows in the
same hour, spreads over many tasks.  What a scan carries is associative, so two passes
give it: each partition's share of a key is reduced to one row, these rows are scanned in
the order of the partitions, and within a partition the scan starts from what they carry.
No window holds more of a key than one range partition does.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from runlens.operators.ranks import range_laid


@dataclass(frozen=True)
class Scan:
    """A running value of ``column``, null where no row so far has one.

    ``total`` reduces the rows of a partition, ``over`` the rows of a window, and ``join``
    combines what came before with what a window gave; each skips nulls.
    """

    column: str
    total: Callable[[str], Column]
    over: Callable[[str, WindowSpec], Column]
    join: Callable[[Column, Column], Column]


def last(column: str) -> Scan:
    """The last value that is not null, up to and with the row."""
    return Scan(
        column,
        lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))),
        lambda c, w: F.last(c, ignorenulls=True).over(w),
        lambda before, here: F.coalesce(here, before),
    )


def running_sum(column: str) -> Scan:
    return Scan(
        column,
        F.sum,
        lambda c, w: F.sum(c).over(w),
        lambda before, here: F.coalesce(before + here, here, before),
    )


def running_max(column: str) -> Scan:
    return Scan(column, F.max, lambda c, w: F.max(c).over(w), F.greatest)


def running_min(column: str) -> Scan:
    return Scan(column, F.min, lambda c, w: F.min(c).over(w), F.least)


def prefix_scan(
    df: DataFrame, group: Sequence[str], order: Sequence[str], scans: dict[str, Scan]
) -> DataFrame:
    """Add a column per scan: its value over the rows of the group up to this one.

    Rows that tie come in no particular order but in the same one for every scan; null
    group keys form a group of their own, and nulls come first in the order.  One range
    shuffle, one written table, and one shuffle by partition.
    """
    laid = range_laid(df, [*group, *order], "scan")
    # A row per group and partition; a group's rows here are at most the partitions.
    heads = laid.groupBy(*group, "_part").agg(
        *(s.total(s.column).alias(f"_h{i}") for i, s in enumerate(scans.values()))
    )
    earlier = Window.partitionBy(*group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    heads = heads.select(
        *(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)),
        F.col("_part").alias("_p"),
        *(s.over(f"_h{i}", earlier).alias(f"_c{i}") for i, s in enumerate(scans.values())),
    )
    here = Window.partitionBy("_part", *group).orderBy("_at")
    here = here.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = laid.select(
        "*", *(s.over(s.column, here).alias(f"_l{i}") for i, s in enumerate(scans.values()))
    )
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    found = local.join(heads, same)
    return found.select(
        *(F.col(f"`{c}`") for c in df.columns),
        *(
            s.join(F.col(f"_c{i}"), F.col(f"_l{i}")).alias(name)
            for i, (name, s) in enumerate(scans.items())
        ),
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    by: str,
    value: str,
    name: str | None = None,
) -> DataFrame:
    """Each row of ``left`` with ``value`` of the latest row of ``right`` at or before it.

    Rows match by equal ``on`` (null matches null); ``by`` is the time on both sides.  Of
    several latest rows the largest value counts; null values count for nothing, and a row
    without an earlier one gets null.  A row of ``left`` without a time gets null.
    """
    name = name or value
    keys = [F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(on)]
    here = F.struct(*(F.col(f"`{c}`") for c in left.columns))
    value_type = right.schema[value].dataType
    time_type = left.schema[by].dataType
    # On equal times what is looked up comes first, the largest value last.
    both = left.select(
        *keys,
        F.col(f"`{by}`").alias("_t"),
        F.lit(None).cast(value_type).alias("_v"),
        F.lit(True).alias("_left"),
        here.alias("_row"),
    ).unionByName(
        right.filter(F.col(f"`{by}`").isNotNull()).select(
            *keys,
            F.col(f"`{by}`").cast(time_type).alias("_t"),
            F.col(f"`{value}`").alias("_v"),
            F.lit(False).alias("_left"),
            F.lit(None).cast(left.select(here.alias("r")).schema["r"].dataType).alias("_row"),
        )
    )
    scanned = prefix_scan(both, [f"_k{i}" for i in range(len(on))], ["_t", "_left", "_v"], {"_found": last("_v")})
    return scanned.filter("_left").select("_row.*", F.col("_found").alias(name))
