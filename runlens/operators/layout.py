"""Caching, replication and the balance of partitions."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, functions as F


@contextmanager
def cached(
    df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK
) -> Iterator[DataFrame]:
    """``df`` kept in the cluster's memory and disks while the block runs."""
    held = df.persist(level)
    try:
        yield held
    finally:
        held.unpersist()


def replicated(df: DataFrame):
    """Like :func:`cached`, with every partition on two executors."""
    return cached(df, StorageLevel.MEMORY_AND_DISK_2)


def partition_balance(df: DataFrame, size: Column | None = None) -> DataFrame:
    """Rows and bytes per partition: ``(partition, rows, bytes)``.

    The size of a row is taken as the length of its text unless given.
    """
    if size is None:
        parts = (
            F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0))
            for c in df.columns
        )
        size = sum(parts, F.lit(0))
    rows = df.select(F.spark_partition_id().alias("partition"), size.alias("_size"))
    return rows.groupBy("partition").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("_size").cast("bigint").alias("bytes")
    )


def balance_summary(balance: DataFrame) -> DataFrame:
    """Totals of a balance report and how far its largest partition is off the mean."""
    mean = F.avg("rows")
    return balance.agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("rows").alias("rows"),
        F.sum("bytes").alias("bytes"),
        F.try_divide(F.max("rows") - mean, mean).alias("worst_deviation"),
    )


def size_deviation(before: DataFrame, after: DataFrame) -> DataFrame:
    """Total bytes of two balance reports and their relative deviation."""
    first = F.col("_first")
    both = before.withColumn("_first", F.lit(True)).unionByName(
        after.withColumn("_first", F.lit(False))
    )
    sums = both.agg(
        F.sum(F.when(first, F.col("rows"))).alias("rows_before"),
        F.sum(F.when(~first, F.col("rows"))).alias("rows_after"),
        F.sum(F.when(first, F.col("bytes"))).alias("bytes_before"),
        F.sum(F.when(~first, F.col("bytes"))).alias("bytes_after"),
    )
    change = F.abs(F.col("bytes_after") - F.col("bytes_before"))
    return sums.withColumn("deviation", F.try_divide(change, F.col("bytes_before")))
