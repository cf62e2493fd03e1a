"""Table functions for SQL cells, on Arrow batches.

    SELECT * FROM idle_gaps(TABLE(SELECT stage_id, started, ended FROM tasks)
                            PARTITION BY stage_id ORDER BY started)

Spark sorts each partition and hands it over a batch at a time; between batches a function
keeps one number, so a partition of any size is streamed and never held.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession, functions as F


class IdleGaps:
    """Times between intervals of a partition during which none goes on.

    Takes a table of key, start and end (whole numbers, ordered by start) and gives the
    key, where the gap begins and ends, and its length.  Intervals without a start are left
    out; one without an end, or with an earlier one, ends where it starts.
    """

    def __init__(self) -> None:
        self.busy_until: int | None = None

    def eval(self, rows: pa.RecordBatch) -> Iterator[pa.Table]:
        rows = rows.filter(rows.column(1).is_valid())
        start = rows.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
        if not len(start):
            return
        known = rows.column(2).is_valid().to_numpy(zero_copy_only=False)
        end = np.where(known, rows.column(2).fill_null(0).to_numpy(zero_copy_only=False), start)
        until = np.maximum.accumulate(np.maximum(start, end.astype(np.int64)))
        if self.busy_until is not None:
            until = np.maximum(until, self.busy_until)
        before = np.append(start[0] if self.busy_until is None else self.busy_until, until[:-1])
        self.busy_until = int(until[-1])
        gap = np.flatnonzero(start > before)
        if len(gap):
            yield pa.table(
                {
                    "key": rows.column(0).take(pa.array(gap)).cast(pa.int64()),
                    "idle_from": pa.array(before[gap]),
                    "idle_to": pa.array(start[gap]),
                    "idle": pa.array(start[gap] - before[gap]),
                }
            )


idle_gaps = F.arrow_udtf(IdleGaps, returnType="key BIGINT, idle_from BIGINT, idle_to BIGINT, idle BIGINT")


def register_tables(spark: SparkSession) -> None:
    """Make the table functions known to the session's SQL."""
    spark.udtf.register("idle_gaps", idle_gaps)
