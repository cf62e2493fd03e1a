"""Run events from Spark event logs (JSON lines, ``spark.eventLog.compress=false``).

Rolled logs (``eventlog_v2_<app>/events_*``) and single files both work, as a batch or
as a stream.  Lines are picked by a text search before any JSON is parsed, and each
kind of event is parsed with only the fields it needs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runlens.operators.progress import COMPLETED, SUBMITTED, TASK_END, TASK_START

# Event names in the log, and our kinds.
STAGE_EVENTS = {
    "SparkListenerStageSubmitted": SUBMITTED,
    "SparkListenerStageCompleted": COMPLETED,
}
TASK_EVENTS = {
    "SparkListenerTaskStart": TASK_START,
    "SparkListenerTaskEnd": TASK_END,
}

ROLLED_MARK = "/eventlog_v2_"

STAGE_FIELDS = """
    Event STRING,
    `Stage Info` STRUCT<
        `Stage ID`: INT, `Stage Name`: STRING, `Number of Tasks`: INT,
        `Submission Time`: BIGINT, `Completion Time`: BIGINT>
"""
TASK_FIELDS = """
    Event STRING,
    `Stage ID` INT,
    `Task Info` STRUCT<
        `Index`: INT, `Launch Time`: BIGINT, `Finish Time`: BIGINT, `Failed`: BOOLEAN,
        `Killed`: BOOLEAN>
"""


def read_event_log(spark: SparkSession, path: str, streaming: bool = False) -> DataFrame:
    """Lines of all event logs under ``path``: ``(file, value)``.

    A stream of this kind takes each file once, so it suits closed (rolled) files;
    for growing files use the tail source.
    """
    reader = spark.readStream if streaming else spark.read
    lines = reader.option("recursiveFileLookup", "true").text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), "value")


def app_of(file: Column) -> Column:
    """Application id from the path of an event log file."""
    rolled = F.substring_index(F.substring_index(file, ROLLED_MARK, -1), "/", 1)
    single = F.substring_index(F.substring_index(file, "/", -1), ".", 1)
    return F.when(file.contains(ROLLED_MARK), rolled).otherwise(single)


def _mentions(names: dict[str, str]) -> Column:
    return reduce(lambda a, b: a | b, (F.col("value").contains(n) for n in names))


def _kind(names: dict[str, str]) -> Column:
    kind = F.lit(None).cast("string")
    for name, ours in names.items():
        kind = F.when(F.col("Event") == name, F.lit(ours)).otherwise(kind)
    return kind


def _time(first_kind: str, first: Column, other: Column) -> Column:
    return F.timestamp_millis(F.when(F.col("kind") == first_kind, first).otherwise(other))


def _parsed(log: DataFrame, names: dict[str, str], fields: str) -> DataFrame:
    hits = log.filter(_mentions(names))
    # As a generator the parser runs once a line; as a plain column it would run again
    # for every filter on its fields.
    parsed = F.inline(F.array(F.from_json("value", fields)))
    rows = hits.select(app_of(F.col("file")).alias("app_id"), parsed)
    return rows.withColumn("kind", _kind(names)).filter(F.col("kind").isNotNull())


def stage_events(log: DataFrame) -> DataFrame:
    """Stage submissions and completions of event log lines."""
    info = F.col("Stage Info")
    return _parsed(log, STAGE_EVENTS, STAGE_FIELDS).select(
        "app_id",
        info["Stage ID"].alias("stage_id"),
        "kind",
        _time(SUBMITTED, info["Submission Time"], info["Completion Time"]).alias("ts"),
        info["Number of Tasks"].alias("num_tasks"),
        info["Stage Name"].alias("stage_name"),
    )


def task_events(log: DataFrame) -> DataFrame:
    """Task starts and ends of event log lines."""
    info = F.col("Task Info")
    unusable = F.coalesce(info["Failed"], F.lit(False)) | F.coalesce(info["Killed"], F.lit(False))
    return _parsed(log, TASK_EVENTS, TASK_FIELDS).select(
        "app_id",
        F.col("Stage ID").alias("stage_id"),
        "kind",
        _time(TASK_START, info["Launch Time"], info["Finish Time"]).alias("ts"),
        info["Index"].alias("task_index"),
        (~unusable).alias("ok"),
    )
