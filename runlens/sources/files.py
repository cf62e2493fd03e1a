"""Ranges, literal rows, text files, key/value files and catalog tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def int_range(spark: SparkSession, first: int, last: int, slices: int) -> DataFrame:
    """The integers from ``first`` to ``last``, both included, as ``id``."""
    return spark.range(first, last + 1, 1, slices)


def literal_rows(
    spark: SparkSession, rows: Iterable, schema: T.StructType | str
) -> DataFrame:
    """A small table spelled out in code."""
    return spark.createDataFrame(list(rows), schema)


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines of text files: ``(file, block, place, value)``.

    ``block`` is the start of the file split a line was read from.  ``place`` grows
    along a split, without gaps; it says nothing across splits.
    """
    return spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("place"),
        "value",
    )


def key_values(
    lines: DataFrame, order: Sequence[str], ignore: Iterable[str] = (), value: str = "value"
) -> DataFrame:
    """Settings from ``key <blanks> value`` lines; the last value of a key wins.

    Lines that start with ``#`` and lines without a blank are dropped.  ``order`` names
    the columns that put the lines in sequence.
    """
    line = F.col(value)
    cut = lines.filter(~line.startswith("#")).select(
        F.split(line, r"\s+", 2).alias("_cut"), F.struct(*order).alias("_at")
    )
    pairs = cut.filter(F.size("_cut") == 2).select(
        F.col("_cut")[0].alias("key"), F.col("_cut")[1].alias("value"), "_at"
    )
    ignored = list(ignore)
    if ignored:
        pairs = pairs.filter(~F.col("key").isin(ignored))
    return pairs.groupBy("key").agg(F.max_by("value", "_at").alias("value"))


def catalog_table(spark: SparkSession, name: str) -> DataFrame:
    """A table of the session's catalog (a Hive metastore when that is enabled)."""
    return spark.table(name)
