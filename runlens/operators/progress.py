"""Progress of stages from run events.

Events come as two frames, because their volumes differ by orders of magnitude:

* stages: ``app_id, stage_id, kind, ts, num_tasks, stage_name``
* tasks: ``app_id, stage_id, kind, ts`` and, for :func:`stage_progress` with
  ``distinct_tasks``, also ``task_index, ok``

Each side is aggregated on its own (map-side first), so a stage with a large share of
all task events shuffles as a few partial counts, and the join sees one row per stage.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, functions as F

from runlens.functions import stages as labels
from runlens.operators.skew import lookup_join
from runlens.plans.staging import stage

SUBMITTED = "stage_submitted"
COMPLETED = "stage_completed"
TASK_START = "task_start"
TASK_END = "task_end"

STAGE_KEY = ["app_id", "stage_id"]
# Fixed value: how long a finished stage stays visible.
LINGER = timedelta(seconds=3)


def first_submission() -> Column:
    """Aggregate: the earliest submission (later ones do not change a stage)."""
    submitted = F.col("kind") == SUBMITTED
    return F.min(F.when(submitted, F.struct("ts", "num_tasks", "stage_name")))


def last_completion() -> Column:
    return F.max(F.when(F.col("kind") == COMPLETED, F.col("ts")))


def started_count() -> Column:
    return F.count(F.when(F.col("kind") == TASK_START, 1))


def done_count() -> Column:
    return F.count(F.when(F.col("kind") == TASK_END, 1))


def known_stages(stages: DataFrame, ordered: bool = False) -> DataFrame:
    """One row per submitted stage; completions of unknown stages are dropped."""
    found = stages.groupBy(*STAGE_KEY).agg(
        first_submission().alias("first"),
        # A completion without a time counts from the stage's last event.
        F.coalesce(last_completion(), F.max("ts")).alias("done_ts"),
        F.max(F.col("kind") == COMPLETED).alias("completed"),
    )
    completed = F.col("completed")
    if ordered:
        completed = completed & F.coalesce(F.col("done_ts") >= F.col("first.ts"), F.lit(False))
    return found.filter(F.col("first").isNotNull()).select(
        *STAGE_KEY,
        F.col("first.num_tasks").alias("num_tasks"),
        F.col("first.stage_name").alias("stage_name"),
        F.col("first.ts").alias("submitted_ts"),
        completed.alias("stage_done"),
        F.when(completed, F.col("done_ts")).alias("done_ts"),
    )


def task_counts(tasks: DataFrame, distinct_tasks: bool = False) -> DataFrame:
    """Started and done tasks per stage.

    All task ends count, failed and repeated ones too, so a stage can pass 100 %.
    With ``distinct_tasks`` each task index counts once, and only if it succeeded.
    """
    if not distinct_tasks:
        return tasks.groupBy(*STAGE_KEY).agg(
            started_count().alias("started"), done_count().alias("done")
        )
    succeeded = (F.col("kind") == TASK_END) & F.col("ok")
    per_task = tasks.groupBy(*STAGE_KEY, "task_index").agg(
        started_count().alias("_starts"), F.count(F.when(succeeded, 1)).alias("_ends")
    )
    return per_task.groupBy(*STAGE_KEY).agg(
        F.count(F.when(F.col("_starts") > 0, 1)).alias("started"),
        F.count(F.when(F.col("_ends") > 0, 1)).alias("done"),
    )


def after_submission(tasks: DataFrame, known: DataFrame) -> DataFrame:
    """Task events that do not come before the first submission of their stage."""
    first = known.select(*STAGE_KEY, "submitted_ts")
    kept = lookup_join(tasks, first, STAGE_KEY)
    return kept.filter(F.col("ts") >= F.col("submitted_ts")).drop("submitted_ts")


def stage_progress(
    stages: DataFrame, tasks: DataFrame, ordered: bool = False, distinct_tasks: bool = False
) -> DataFrame:
    """One row per known stage with its task counters.

    Task events of a stage that was never submitted are dropped.  With ``ordered``,
    so are events earlier than the submission, as a live listener would see them.
    """
    known = known_stages(stages, ordered)
    if ordered:
        # Read three times below, and far smaller than the tasks.
        known = stage(known, "known-stages")
        tasks = after_submission(tasks, known)
    counts = task_counts(tasks, distinct_tasks)
    zero = F.lit(0).cast("bigint")
    return known.join(counts, STAGE_KEY, "left").select(
        *STAGE_KEY,
        "stage_name",
        "num_tasks",
        F.coalesce("started", zero).alias("started"),
        F.coalesce("done", zero).alias("done"),
        "stage_done",
        "submitted_ts",
        "done_ts",
    )


def event_progress(events: DataFrame) -> DataFrame:
    """:func:`stage_progress` of one mixed frame that is read once.

    Events are counted by stage and kind first, stage events by their fields too, in
    buffers of one number, so task events are never sorted; what is left is a few rows per
    stage.
    """
    of_stage = F.col("kind").isin(SUBMITTED, COMPLETED)
    fields = [F.when(of_stage, F.col(c)).alias(c) for c in ("ts", "num_tasks", "stage_name")]
    rows = events.filter(of_stage | F.col("kind").isin(TASK_START, TASK_END))
    few = rows.groupBy(*STAGE_KEY, "kind", *fields).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("bigint")

    def counted(kind: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), zero)

    found = few.groupBy(*STAGE_KEY).agg(
        first_submission().alias("first"),
        counted(TASK_START).alias("started"),
        counted(TASK_END).alias("done"),
        F.max(F.col("kind") == COMPLETED).alias("stage_done"),
        # As in known_stages: the last event of the stage, if its completion has no time.
        F.coalesce(last_completion(), F.max("ts")).alias("done_ts"),
    )
    return found.filter(F.col("first").isNotNull()).select(
        *STAGE_KEY,
        F.col("first.stage_name").alias("stage_name"),
        F.col("first.num_tasks").alias("num_tasks"),
        "started",
        "done",
        "stage_done",
        F.col("first.ts").alias("submitted_ts"),
        F.when(F.col("stage_done"), F.col("done_ts")).alias("done_ts"),
    )


def split_events(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Stage events and task events of one mixed frame."""
    return (
        events.filter(F.col("kind").isin(SUBMITTED, COMPLETED)),
        events.filter(F.col("kind").isin(TASK_START, TASK_END)),
    )


def with_labels(progress: DataFrame) -> DataFrame:
    """Add percentages, the text label and the bar label."""
    n, started, done = F.col("num_tasks"), F.col("started"), F.col("done")
    return progress.withColumns(
        {
            "ongoing": labels.ongoing(started, done),
            "done_pct": labels.done_pct(done, n),
            "ongoing_pct": labels.ongoing_pct(started, done, n),
            "label": labels.text_label(
                F.col("stage_name"), n, started, done, F.col("stage_done")
            ),
            "bar": labels.bar_label(n, started, done),
        }
    )


def active(progress: DataFrame, now: datetime, keep: bool = False) -> DataFrame:
    """Stages on display: unfinished ones, and finished ones for a short while."""
    limit = F.lit(now - LINGER)
    if now.tzinfo is None:
        # Wall-clock time of the session, whether or not the events carry a zone.
        limit = F.lit(str(now - LINGER)).cast(progress.schema["done_ts"].dataType)
    gone = F.col("stage_done") & (F.col("done_ts") <= limit)
    return progress if keep else progress.filter(~F.coalesce(gone, F.lit(False)))
