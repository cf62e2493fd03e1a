"""User-defined sums on whole columns: neighbours of a key are combined pairwise.

``plus`` takes two Arrow tables of equal length and adds them row by row.  The rows of all
keys of a batch are halved together, so a batch of ``n`` rows takes ``log2(n)`` calls at
most, whether they are of one key or of ``n / 2``; no call is made per row or per key.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from runlens.operators.ranks import range_laid

Plus = Callable[[pa.Table, pa.Table], pa.Table]

#: Rows that are combined at once, and partial sums of different keys that a task holds.
BATCH_ROWS = 1 << 17
MAX_PARTIALS = 1 << 18


def reduce_segments(values: pa.Table, starts: np.ndarray, plus: Plus) -> pa.Table:
    """One row per segment; ``starts`` has the first row of each, in order."""
    n = values.num_rows
    while n > len(starts):
        segment = np.zeros(n, np.int64)
        segment[starts[1:]] = 1
        place = np.arange(n) - starts[np.cumsum(segment)]
        sizes = np.diff(np.append(starts, n))
        paired = np.flatnonzero((place % 2 == 0) & (place + 1 < np.repeat(sizes, sizes)))
        single = np.flatnonzero((place % 2 == 0) & (place + 1 == np.repeat(sizes, sizes)))
        both = plus(values.take(pa.array(paired)), values.take(pa.array(paired + 1)))
        if both.num_rows != len(paired):
            raise ValueError(f"plus gave {both.num_rows} rows for {len(paired)}")
        both = both.select(values.column_names).cast(values.schema)
        order = np.argsort(np.concatenate([paired, single]), kind="stable")
        values = pa.concat_tables([both, values.take(pa.array(single))]).take(pa.array(order))
        starts = np.cumsum(np.append(0, (sizes[:-1] + 1) // 2))
        n = values.num_rows
    return values


def _codes(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Equal numbers for equal keys; nulls are equal to each other."""
    if not keys:
        return np.zeros(table.num_rows, np.int64)
    frame = table.select(keys).to_pandas(types_mapper=pd.ArrowDtype)
    return frame.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            rows += batch.num_rows
        if rows >= BATCH_ROWS:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if held:
        yield pa.Table.from_batches(held)


def combine_columns(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[str],
    plus: Plus,
    order: Sequence[str] = (),
) -> DataFrame:
    """``keys`` and the combined ``fields`` of each key, by an associative ``plus``.

    Without ``order`` rows meet in any order, so ``plus`` must be commutative too; each task
    combines its own rows before the shuffle, so a hot key moves as one row per task.  With
    ``order`` a key's rows are combined in it: rows are range-partitioned on key and order
    (one shuffle, one written table), and a task's part of a key is one row again.  Null
    keys are one key; without keys the result is one row, or none for no input.
    """
    keys, fields = list(keys), list(fields)
    shape = T.StructType([df.schema[c] for c in (*keys, *fields)])
    partial = T.StructType([*shape.fields, T.StructField("_at", T.LongType(), False)])
    partial_arrow, result_arrow = to_arrow_schema(partial), to_arrow_schema(shape)

    def reduced(table: pa.Table, starts: np.ndarray) -> pa.Table:
        sums = reduce_segments(table.select(fields), starts, plus)
        first = table.take(pa.array(starts))
        columns = {c: first[c] for c in keys} | {c: sums[c] for c in fields} | {"_at": first["_at"]}
        return pa.table(columns).cast(partial_arrow)

    def sorted_starts(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
        codes = _codes(table, keys)
        order_ = np.argsort(codes, kind="stable")
        codes = codes[order_]
        starts = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
        return table.take(pa.array(order_)), starts

    def any_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for table in _gathered(batches):
            own = reduced(*sorted_starts(table))
            held = own if held is None else reduced(*sorted_starts(pa.concat_tables([held, own])))
            if held.num_rows > MAX_PARTIALS:
                yield from held.to_batches()
                held = None
        if held is not None:
            yield from held.to_batches()

    def in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in order; what ascends without a gap in ``_at`` is combined."""
        for table in _gathered(batches):
            codes, at = _codes(table, keys), table["_at"].to_numpy()
            broken = (codes[1:] != codes[:-1]) | (at[1:] != at[:-1] + 1)
            yield from reduced(table, np.flatnonzero(np.append(True, broken))).to_batches()

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partial rows in order of their keys; the last key of a batch may go on."""
        held = None
        for table in _gathered(batches):
            table = table if held is None else pa.concat_tables([held, table])
            codes = _codes(table, keys)
            own = reduced(table, np.flatnonzero(np.append(True, codes[1:] != codes[:-1])))
            held = own.slice(own.num_rows - 1)
            done = own.slice(0, own.num_rows - 1).select([*keys, *fields])
            yield from done.cast(result_arrow).to_batches()
        if held is not None:
            yield from held.select([*keys, *fields]).cast(result_arrow).to_batches()

    if order:
        laid = range_laid(df.select(*dict.fromkeys([*keys, *fields, *order])), [*keys, *order], "segments")
        parts = laid.select(*keys, *fields, "_at").mapInArrow(in_order, partial)
    else:
        rows = df.select(*keys, *fields, F.lit(0).cast("long").alias("_at"))
        parts = rows.mapInArrow(any_order, partial)
    parts = parts.repartition(*keys) if keys else parts.repartition(1)
    return parts.sortWithinPartitions(*keys, "_at").mapInArrow(final, shape)
