"""Positions and dense numbers without a single-task window.

``Window.partitionBy(key)`` sorts one key in one task, which fails when a key holds a
large share of the rows.  Here rows are range-partitioned on (group, order), so a hot
group spreads over many tasks, and the position is the sum of the row's place in its
partition and the row counts of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from runlens.operators.skew import row_hash
from runlens.plans.staging import stage

# Fixed value: the first dense id.
FIRST_ID = 222223

# monotonically_increasing_id keeps the row's place in the low 33 bits.
_PLACE_BITS = 33


def range_laid(df: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """The rows, range-partitioned and sorted by ``keys``, written once.

    Adds ``_part``, the number of the partition, and ``_at``, which ascends with the order
    of all rows of a partition and with the partitions.
    """
    laid = df
    if keys:
        # Rows with equal keys are told apart by what they hold and where they come
        # from, so a repeated task sends each to the same place.
        ties = {"_tie": row_hash(df), "_from": F.spark_partition_id()}
        laid = (
            df.withColumns(ties)
            .repartitionByRange(*keys, *ties)
            .sortWithinPartitions(*keys, *ties)
            .drop(*ties)
        )
    laid = laid.withColumn("_at", F.monotonically_increasing_id()).withColumn(
        "_part", F.shiftright("_at", _PLACE_BITS)
    )
    return stage(laid, name)


def with_position(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    name: str = "position",
) -> DataFrame:
    """Add the 0-based position of each row in its group, ordered by ``order``.

    Rows that tie get different positions in no particular order.  Null group keys
    form a group of their own.  Costs one range shuffle and one written table; with
    neither group nor order, rows stay where they are and only the table is written.
    """
    laid = range_laid(df, [*group, *order], "positions")
    # One row per group and partition: far fewer than the rows, and a group has at
    # most one per partition, so the window below is small whatever the skew.
    heads = laid.groupBy(*group, "_part").agg(
        F.min("_at").alias("_head"), F.count(F.lit(1)).alias("_rows")
    )
    earlier = (
        Window.partitionBy(*group)
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shift = (F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_head")).alias("_shift")
    heads = heads.select(
        *(F.col(g).alias(f"_g{i}") for i, g in enumerate(group)),
        F.col("_part").alias("_p"),
        shift,
    )
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return laid.join(heads, same).select(
        *(F.col(f"`{c}`") for c in df.columns),
        (F.col("_at") + F.col("_shift")).alias(name),
    )


def dense_ids(
    df: DataFrame, order: Sequence[str] = (), first: int = FIRST_ID, name: str = "id"
) -> DataFrame:
    """Consecutive ids as text from ``first`` on, in the given order or in any."""
    numbered = with_position(df, [], order, "_position")
    return numbered.withColumn(name, (F.col("_position") + F.lit(first)).cast("string")).drop(
        "_position"
    )


def random_ids(df: DataFrame, name: str = "id") -> DataFrame:
    """A random UUID per row."""
    return df.withColumn(name, F.uuid())
