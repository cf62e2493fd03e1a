"""Bursts of events per key: session windows on event time, in append mode.

A burst ends when its key is quiet for longer than ``gap``.  It is given out once, when the watermark
(the latest event time less ``delay``) has passed that, and its state is dropped.  Events
that come later than the watermark belong to no burst any more; Spark counts them, and
:func:`late_rows` tells how many there were.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery


def bursts(events: DataFrame, keys: Sequence[str], ts: str, gap: str, delay: str) -> DataFrame:
    """``keys``, first and last time of a burst, and its events ``n`` (batch or stream).

    Events without a time are left out; null keys are one key.
    """
    timed = events.filter(F.col(ts).isNotNull()).withColumn("_at", F.col(ts).cast("timestamp"))
    if events.isStreaming:
        timed = timed.withWatermark("_at", delay)
    found = timed.groupBy(*keys, F.session_window("_at", gap)).agg(
        F.min(ts).alias("first"), F.max(ts).alias("last"), F.count(F.lit(1)).alias("n")
    )
    return found.select(*keys, "first", "last", "n")


def late_rows(query: StreamingQuery) -> int:
    """Rows that this run of a query dropped for being behind the watermark."""
    return sum(
        op.numRowsDroppedByWatermark for p in query.recentProgress for op in p.stateOperators
    )
