"""Live stage progress as a streaming aggregation.

Input: a stream of run events ``(app_id, stage_id, kind, ts, num_tasks, stage_name)``.

:func:`progress_updates` keeps partial counts on the map side and one small state per
stage; a task event counts as soon as its stage is known, early or not.
:func:`write_strict_progress` drops task events that come before their stage, as a
live listener does.  It forgets a completed stage once events of a later time have come,
``ttl`` after its completion; a stage that has not completed is never forgotten, however
long it is quiet, and no clock is read.  :mod:`runlens.streaming.stagestate` does the same
with keyed state.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from runlens.operators.progress import (
    COMPLETED,
    STAGE_KEY,
    done_count,
    first_submission,
    last_completion,
    split_events,
    started_count,
)
from runlens.operators.skew import lookup_join
from runlens.streaming.backoff import retrying

# A completed stage is forgotten by the strict rule when event time is this much further.
TTL = timedelta(hours=24)
_STATE = (
    "num_tasks: int, stage_name: string, started: bigint, done: bigint, stage_done: boolean, "
    "last: bigint, last_ts: {0}, done_ts: {0}"
)


def progress_updates(events: DataFrame) -> DataFrame:
    """Changed stages per micro-batch (update mode); unknown stages are held back."""
    totals = events.groupBy(*STAGE_KEY).agg(
        first_submission().alias("first"),
        started_count().alias("started"),
        done_count().alias("done"),
        last_completion().alias("done_ts"),
    )
    return totals.filter(F.col("first").isNotNull()).select(
        *STAGE_KEY,
        F.col("first.stage_name").alias("stage_name"),
        F.col("first.num_tasks").alias("num_tasks"),
        "started",
        "done",
        F.col("done_ts").isNotNull().alias("stage_done"),
        "done_ts",
    )


def advance(
    before: DataFrame | None,
    batch: DataFrame,
    batch_id: int,
    hold: Callable[[DataFrame], DataFrame] = lambda df: df,
) -> DataFrame:
    """The stages known after a micro-batch of events, from those known before it.

    Events of stages known before all count.  For a stage first submitted in this
    batch, earlier events of the batch do not.  Events of other stages are dropped.
    ``last`` in the result is the last batch that held an event of the stage, ``last_ts``
    the latest time of one.  ``hold`` may keep a frame that is read several times.
    """
    stages, tasks = split_events(batch)
    time_type = batch.schema["ts"].dataType.simpleString()
    found = stages.groupBy(*STAGE_KEY).agg(
        first_submission().alias("first"),
        last_completion().alias("done_ts"),
        F.max(F.col("kind") == COMPLETED).alias("completed"),
        F.max("ts").alias("at"),
    )
    if before is None:
        merged = found.select("*", F.lit(None).cast(f"struct<{_STATE.format(time_type)}>").alias("old"))
    else:
        fields = [c for c in before.columns if c not in STAGE_KEY]
        merged = found.join(
            before.select(*STAGE_KEY, F.struct(*fields).alias("old")), STAGE_KEY, "full"
        )
    known, old = F.col("old").isNotNull(), F.col("old")
    in_time = known | (F.col("done_ts") >= F.col("first.ts"))
    finished = F.coalesce(F.col("completed") & in_time, F.lit(False))
    merged = merged.filter(known | F.col("first").isNotNull()).select(
        *STAGE_KEY,
        "old",
        F.coalesce(old["num_tasks"], F.col("first.num_tasks")).alias("num_tasks"),
        F.coalesce(old["stage_name"], F.col("first.stage_name")).alias("stage_name"),
        F.when(~known, F.col("first.ts")).alias("since"),
        (F.coalesce(old["stage_done"], F.lit(False)) | finished).alias("stage_done"),
        F.greatest(old["done_ts"], F.when(finished, F.col("done_ts"))).alias("done_ts"),
        F.col("completed").isNotNull().alias("touched"),
        "at",
    )
    merged = hold(merged)
    in_scope = lookup_join(tasks, merged.select(*STAGE_KEY, "since"), STAGE_KEY)
    counted = in_scope.filter(F.col("since").isNull() | (F.col("ts") >= F.col("since")))
    counts = counted.groupBy(*STAGE_KEY).agg(
        started_count().alias("more"), done_count().alias("ended"), F.max("ts").alias("task_at")
    )
    touched = F.col("touched") | F.col("more").isNotNull()
    zero = F.lit(0).cast("bigint")
    after = merged.join(counts, STAGE_KEY, "left").select(
        *STAGE_KEY,
        "num_tasks",
        "stage_name",
        (F.coalesce(old["started"], zero) + F.coalesce("more", zero)).alias("started"),
        (F.coalesce(old["done"], zero) + F.coalesce("ended", zero)).alias("done"),
        "stage_done",
        "done_ts",
        F.when(touched, F.lit(batch_id)).otherwise(old["last"]).cast("bigint").alias("last"),
        F.greatest(old["last_ts"], "at", "task_at").alias("last_ts"),
    )
    return after


def remembered(known: DataFrame, ttl: timedelta = TTL) -> DataFrame:
    """The known stages without those completed ``ttl`` before the latest event of any."""
    latest = known.agg(F.max("last_ts")).first()[0]
    if latest is None:
        return known
    old = F.col("stage_done") & (F.col("done_ts") < F.lit(latest - ttl))
    return known.filter(~F.coalesce(old, F.lit(False)))


def write_strict_progress(
    events: DataFrame, path: str, ttl: timedelta = TTL, **retry
) -> DataStreamWriter:
    """Progress under the strict rule; changed stages go to ``path/rows/batch=<id>``.

    ``path/state`` holds the known stages after the last two micro-batches, so that a
    repeated one finds what it started from and replaces its own result.  Every step is
    an ordinary distributed aggregation or join, so a hot stage is split like any key.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        read = batch.sparkSession.read

        def rewrite(df: DataFrame, name: str) -> DataFrame:
            df.write.mode("overwrite").parquet(f"{path}/{name}")
            return read.parquet(f"{path}/{name}")

        before = None
        if batch_id > 0:
            before = remembered(read.parquet(f"{path}/state/{(batch_id - 1) % 2}"), ttl)
        # The batch is read again for stages and for tasks, each with the columns it needs.
        after = advance(before, batch, batch_id, lambda df: rewrite(df, "known"))
        after = rewrite(after, f"state/{batch_id % 2}")
        changed = after.filter(F.col("last") == batch_id).drop("last", "last_ts")
        rewrite(changed, f"rows/batch={batch_id}")

    return events.writeStream.foreachBatch(retrying(write, **retry))


def write_updates(updates: DataFrame, path: str, **retry) -> DataStreamWriter:
    """Keep the changed rows of each micro-batch under ``path/batch=<id>``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return updates.writeStream.outputMode("update").foreachBatch(retrying(write, **retry))


def latest_progress(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every stage written by :func:`write_updates`."""
    rows = spark.read.parquet(path)
    fields = [c for c in rows.columns if c not in (*STAGE_KEY, "batch")]
    newest = rows.groupBy(*STAGE_KEY).agg(F.max_by(F.struct(*fields), "batch").alias("row"))
    return newest.select(*STAGE_KEY, "row.*")
