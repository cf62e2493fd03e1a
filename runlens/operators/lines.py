"""Batches of consecutive lines, as shipped in one message."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from runlens.functions.text import split_lines

# Fixed value: a message holds a first line and up to ten more.
BATCH_LINES = 11


def text_lines(
    df: DataFrame, keep: Sequence[str], text: str = "text", at: str = "pos", name: str = "value"
) -> DataFrame:
    """One row per line of a text column, numbered from 0 within the text."""
    return df.select(*keep, F.posexplode(split_lines(F.col(text))).alias(at, name))


def batch_text(
    df: DataFrame,
    keep: Sequence[str],
    text: str = "text",
    size: int = BATCH_LINES,
    each=None,
) -> DataFrame:
    """Batches of the lines of a text column: ``(…keep, batch, lines)``; no shuffle.

    ``each`` is applied to every line first.
    """
    lines = split_lines(F.col(text))
    if each is not None:
        lines = F.transform(lines, each)
    held = df.select(*keep, lines.alias("_lines"))
    count = F.size("_lines")
    # Null, and so no batch, for a text without lines.
    starts = F.when(count > 0, F.sequence(F.lit(1), count, F.lit(size)))
    # The pieces are cut before the explode, so that no batch carries the whole text.
    pieces = F.transform(starts, lambda at: F.slice(F.col("_lines"), at, F.lit(size)))
    return held.select(*keep, F.posexplode(pieces).alias("batch", "lines"))


def batch_rows(
    lines: DataFrame,
    by: Sequence[str],
    at: str = "pos",
    value: str = "value",
    size: int = BATCH_LINES,
) -> DataFrame:
    """Batches of numbered lines per source, order kept: ``(…by, batch, lines)``.

    A group is one batch, so its size is bounded however long the source is.
    """
    packed = F.sort_array(F.collect_list(F.struct(F.col(at).alias("at"), F.col(value).alias("v"))))
    number = F.floor(F.col(at) / F.lit(size)).cast("int")
    grouped = lines.withColumn("batch", number).groupBy(*by, "batch").agg(packed.alias("_packed"))
    return grouped.select(*by, "batch", F.transform("_packed", lambda x: x["v"]).alias("lines"))


def batch_adjacent(
    lines: DataFrame,
    by: Sequence[str],
    at: str,
    value: str = "value",
    size: int = BATCH_LINES,
) -> DataFrame:
    """Batches of lines that already lie next to each other: ``(…by, at, lines)``.

    For files and file streams, whose lines reach a task in order.  Any run of at most
    ``size`` consecutive lines of one source is a valid batch, so the lines are cut
    where they are, without a shuffle.  ``at`` is the position of a batch's first line.
    Works on batch and streaming frames.
    """
    by = list(by)
    fields = lines.schema
    out_type = T.StructType(
        [*(fields[c] for c in by), fields[at], T.StructField("lines", T.ArrayType(T.StringType()))]
    )
    out_arrow = to_arrow_schema(out_type)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            # A new source starts a batch, and so does every size-th line after it.
            fresh = np.zeros(n, dtype=bool)
            fresh[0] = True
            for c in by:
                codes = batch.column(c).dictionary_encode().indices.fill_null(-1).to_numpy(False)
                fresh[1:] |= codes[1:] != codes[:-1]
            heads = np.flatnonzero(fresh)
            since = np.arange(n) - np.repeat(heads, np.diff(np.append(heads, n)))
            starts = np.flatnonzero(since % size == 0)
            offsets = pa.array(np.append(starts, n), pa.int32())
            values = batch.column(value).cast(pa.string())
            firsts = [batch.column(c).take(pa.array(starts)) for c in [*by, at]]
            arrays = [*firsts, pa.ListArray.from_arrays(offsets, values)]
            yield pa.RecordBatch.from_arrays(
                [a.cast(f.type) for a, f in zip(arrays, out_arrow)], schema=out_arrow
            )

    return lines.select(*by, at, value).mapInArrow(cut, out_type)


