"""Keyed and whole-table steps: lists, sums, user aggregates, lookups, user functions."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce as fold
from typing import Any

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from runlens.operators.ranks import with_position
from runlens.operators.skew import MAX_BROADCAST_ROWS, lookup_join
from runlens.plans.staging import stage


def captured(df: DataFrame, name: str, value: Any) -> DataFrame:
    """Add a constant.  The value is bound now: later reassignment has no effect."""
    return df.withColumn(name, F.lit(value))


def user_function(fn: Callable[[pd.Series], pd.Series], dtype: str):
    """A user function over whole column batches, for what no expression can say."""

    def apply(values: pd.Series) -> pd.Series:
        return fn(values)

    return F.pandas_udf(apply, dtype)


def total(df: DataFrame, *columns: Column) -> DataFrame:
    """Row count and sums, aggregated where the rows are."""
    sums = [F.sum(c).alias(f"sum_{i}") for i, c in enumerate(columns)]
    return df.agg(F.count(F.lit(1)).alias("rows"), *sums)


def observed(df: DataFrame, **metrics: Column) -> dict[str, Any]:
    """Run ``df`` for its side effects only and return aggregates seen on the way."""
    watch = Observation()
    seen = df.observe(watch, *(c.alias(n) for n, c in metrics.items()))
    seen.write.format("noop").mode("overwrite").save()
    return watch.get


def lookup(
    df: DataFrame, table: DataFrame, on: Sequence[str], max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Look each row up in a table; the table is read as it is when the query runs."""
    return lookup_join(df, table, on, "inner", max_rows)


def group_lists(
    df: DataFrame,
    key: str | Sequence[str],
    value: str,
    run_rows: int = 10_000,
    name: str = "items",
) -> DataFrame:
    """Sorted values per key, in runs: ``(key, run, items)``.

    A run holds at most ``run_rows`` values and the runs of a key, taken in order, are
    its whole list, so no row grows with the data.  Keys up to that size are one run
    and take one shuffle; only larger keys go through :func:`with_position`.
    """
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.select(*keys, value)
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    large = stage(sizes.filter(F.col("_rows") > run_rows).select(*keys), "large-keys")

    def lists(part: DataFrame, run: Column) -> DataFrame:
        # Wrapped in a struct, because collect_list drops bare nulls.
        packed = F.sort_array(F.collect_list(F.struct(F.col(value).alias("v"))))
        grouped = part.withColumn("run", run).groupBy(*keys, "run").agg(packed.alias("_packed"))
        return grouped.select(
            *keys, "run", F.transform("_packed", lambda x: x["v"]).alias(name)
        )

    zero = F.lit(0).cast("bigint")
    if large.isEmpty():
        return lists(rows, zero)
    names = {k: f"_large{i}" for i, k in enumerate(keys)}
    marked = large.withColumnsRenamed(names)
    same = fold(lambda a, b: a & b, (rows[k].eqNullSafe(marked[n]) for k, n in names.items()))
    placed = with_position(rows.join(marked, same, "left_semi"), keys, [value], "_place")
    run = F.floor(F.col("_place") / F.lit(run_rows)).cast("bigint")
    return lists(rows.join(marked, same, "left_anti"), zero).unionByName(lists(placed, run))


def sum_fields(df: DataFrame, key: str | Sequence[str], value: str) -> DataFrame:
    """Field-wise sum of a struct column per key."""
    keys = [key] if isinstance(key, str) else list(key)
    fields = df.schema[value].dataType.fieldNames()
    sums = F.struct(*(F.sum(F.col(value)[f]).alias(f) for f in fields))
    return df.groupBy(*keys).agg(sums.alias(value))


# Buffers a task holds; past this, those unused for longest are handed on.
MAX_BUFFERS = 50_000
_OUT_ROWS = 10_000
# Rows reduced at a time: more rows mean fewer calls of the user's function.
_REDUCE_BYTES = 32 << 20


def _larger(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Neighbouring batches put together."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= _REDUCE_BYTES:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def aggregate_by_key(
    df: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    zero: tuple,
    reduce: Callable[[tuple, pd.DataFrame], tuple],
    merge: Callable[[tuple, tuple], tuple],
    finish: Callable[[tuple], tuple],
    buffer: T.StructType,
    result: T.StructType,
) -> DataFrame:
    """User aggregate from zero, reduce, merge and finish, with map-side partials.

    ``reduce`` folds a frame of values into a buffer (a tuple with the fields of
    ``buffer``); ``merge`` joins two buffers; ``finish`` gives the fields of
    ``result``.  Each task reduces its own rows first, so a hot key shuffles as about
    one buffer per task; sorted buffers are then merged one by one, and no group is
    ever held in memory.  With no keys the result is one row, also for no input.
    """
    keys, values = list(keys), list(values)
    key_type = T.StructType([df.schema[k] for k in keys])
    partial_type = T.StructType([*key_type.fields, *buffer.fields])
    result_type = T.StructType([*key_type.fields, *result.fields])
    partial_arrow, result_arrow = to_arrow_schema(partial_type), to_arrow_schema(result_type)
    n = len(keys)

    def pack(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
        arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows), schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def partials(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Ordered by last use, so that hot keys stay.
        held: dict[tuple, tuple] = {}
        for batch in _larger(batches):
            if keys:
                # Arrow-backed keys: nulls group together and integers stay exact.
                by = batch.select(keys).to_pandas(types_mapper=pd.ArrowDtype)
                codes = by.groupby(keys, dropna=False, sort=False).ngroup().to_numpy()
            else:
                codes = np.zeros(batch.num_rows, dtype=np.int64)
            order = np.argsort(codes, kind="stable")
            edges = [0, *(np.flatnonzero(np.diff(codes[order])) + 1), batch.num_rows]
            frame = batch.select(values).to_pandas().take(order)
            names = batch.select(keys).take(pa.array(order[edges[:-1]])).to_pydict()
            found = zip(*names.values()) if keys else [()]
            for k, start, end in zip(found, edges, edges[1:]):
                held[k] = reduce(held.pop(k, zero), frame.iloc[start:end])
            if len(held) > MAX_BUFFERS:
                old = [(k, held.pop(k)) for k in list(held)[: len(held) // 2]]
                yield pack([(*k, *b) for k, b in old], partial_arrow)
        if held:
            yield pack([(*k, *b) for k, b in held.items()], partial_arrow)

    def finals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, mark, total, out = None, None, zero, []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                # NaN keys are equal to each other.
                this = tuple("NaN" if x != x else (x,) for x in row[:n])
                if mark is not None and this != mark:
                    out.append((*key, *finish(total)))
                    total = zero
                key, mark, total = row[:n], this, merge(total, row[n:])
                if len(out) >= _OUT_ROWS:
                    yield pack(out, result_arrow)
                    out = []
        if mark is not None:
            out.append((*key, *finish(total)))
        if out:
            yield pack(out, result_arrow)

    needed = [*keys, *(v for v in values if v not in keys)]
    parts = df.select(*needed).mapInArrow(partials, partial_type)
    if keys:
        parts = parts.repartition(*keys).sortWithinPartitions(*keys)
    else:
        # One buffer per task at most, and the zero, which no merge notices.
        start = df.sparkSession.createDataFrame([zero], partial_type)
        parts = parts.unionByName(start).repartition(1)
    return parts.mapInArrow(finals, result_type)


def combine_by_key(
    df: DataFrame, key: str, fields: Sequence[str], plus: Callable[[tuple, tuple], tuple]
) -> DataFrame:
    """Combine the value tuples of each key with an associative ``plus``.

    For plain sums use :func:`sum_fields`, which never leaves the JVM.
    """
    shape = T.StructType([df.schema[f] for f in fields])
    names = list(fields)

    def add(a: tuple, b: tuple) -> tuple:
        if a[0] is False:
            return b
        return a if b[0] is False else (True, *plus(a[1:], b[1:]))

    def reduce(buffer: tuple, frame: pd.DataFrame) -> tuple:
        rows = frame[names].itertuples(index=False, name=None)
        return fold(add, ((True, *r) for r in rows), buffer)

    buffer = T.StructType([T.StructField("_seen", T.BooleanType()), *shape.fields])
    zero = (False, *([None] * len(names)))
    return aggregate_by_key(df, [key], names, zero, reduce, add, lambda b: b[1:], buffer, shape)
