"""Run events from Spark event logs, compressed with Zstandard or plain, in one scan.

Spark compresses event logs unless told not to, with Zstandard unless told otherwise.  This
source lists the logs below a folder, decodes each file where a task reads it, frame by
frame and never as a whole, and hands on the lines of the four kinds of event that progress
needs; Spark parses their JSON.  A plain file is cut into ranges; a compressed one is one
range, which Spark's rolling bounds (``spark.eventLog.rolling.maxFileSize``).

As a stream it takes each closed file once: a rolled file as soon as the next one is there
or the application has ended, a single file when it is no longer ``.inprogress``.  As a
batch it reads open files too, up to the last whole line.

Rows: ``app_id``, ``kind`` and ``value``; :func:`run_events` gives their fields.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from runlens.operators.progress import SUBMITTED, TASK_START
from runlens.sources.eventlog import STAGE_EVENTS, TASK_EVENTS
from runlens.sources.tail import FileRange, _files, _lines, _open_fs

FORMAT = "runlens_eventlog"
SCHEMA = "app_id STRING, kind STRING, value STRING"
SPLIT_BYTES = 64 << 20

# Names of rolled logs, of their files and of compressed files.
_ROLLED = re.compile(r"eventlog_v2_([^/]+)/(events|appstatus)_(.*)$")
_CODECS = ("zstd", "lz4", "snappy", "lzf")
_OPEN = ".inprogress"

_KINDS = STAGE_EVENTS | TASK_EVENTS
_NAMED = re.compile(rb'"Event" ?: ?"(' + "|".join(_KINDS).encode() + rb')"')
_HEAD = 256
_BLOCK = 1 << 20
_BATCH = 1 << 14

_FIELDS = """
    `Stage Info` STRUCT<
        `Stage ID`: INT, `Stage Name`: STRING, `Number of Tasks`: INT,
        `Submission Time`: BIGINT, `Completion Time`: BIGINT>,
    `Stage ID` INT,
    `Task Info` STRUCT<
        `Index`: INT, `Launch Time`: BIGINT, `Finish Time`: BIGINT, `Failed`: BOOLEAN,
        `Killed`: BOOLEAN>
"""


@dataclass
class LogRange(InputPartition):
    """A range of a log file; ``open`` if it may end within a line or a frame."""

    app: str
    where: FileRange
    codec: str
    open: bool


@dataclass(frozen=True)
class _Log:
    path: str
    size: int
    app: str
    codec: str
    open: bool


def _codec(name: str) -> str:
    """The compression that a file's name says, empty for none."""
    last = name.removesuffix(_OPEN).rsplit(".", 1)[-1]
    return last if last in _CODECS else ""


def find_logs(path: str) -> list[_Log]:
    """Event files at or below a path, each with its application and whether it may grow."""
    found, rolled, ended = [], {}, set()
    for file, size in _files([path]):
        match = _ROLLED.search(file)
        if match is None:
            name = file.rsplit("/", 1)[-1]
            codec = _codec(name)
            app = name.removesuffix(_OPEN).removesuffix(f".{codec}" if codec else "")
            found.append(_Log(file, size, app, codec, name.endswith(_OPEN)))
        elif match[2] == "events":
            rolled.setdefault(match[1], []).append((int(match[3].split("_", 1)[0]), file, size))
        elif not file.endswith(_OPEN):
            ended.add(match[1])
    for app, files in rolled.items():
        top = max(n for n, _, _ in files)
        for n, file, size in sorted(files):
            found.append(_Log(file, size, app, _codec(file), n == top and app not in ended))
    return found


def applications_ended(path: str) -> bool:
    """Whether there are logs at or below a path and all of their applications have ended."""
    logs = find_logs(path)
    return bool(logs) and not any(log.open for log in logs)


def _ranges(log: _Log, split: int) -> Iterator[LogRange]:
    if log.codec not in ("", "zstd"):
        raise ValueError(f"{log.path} is compressed with {log.codec}; zstd and plain logs can be read")
    step = max(log.size, 1) if log.codec else split
    for at in range(0, log.size, step):
        where = FileRange(log.path, 0, at, min(at + step, log.size), log.size)
        yield LogRange(log.app, where, log.codec, log.open)


def _decoded(part: LogRange) -> Iterator[list[bytes]]:
    """Whole lines of a compressed file, a block at a time."""
    import zstandard

    system, inner = _open_fs(part.where.file)
    frame, rest = zstandard.ZstdDecompressor().decompressobj(), b""
    with system.open_input_file(inner) as f:
        fresh = True  # nothing of the current frame has been read
        while block := f.read(_BLOCK):
            pieces = [rest]
            while block:
                pieces.append(frame.decompress(block))
                fresh, block = frame.eof, frame.unused_data if frame.eof else b""
                if frame.eof:
                    frame = zstandard.ZstdDecompressor().decompressobj()
            *lines, rest = b"".join(pieces).split(b"\n")
            yield lines
    if not fresh and not part.open:
        raise ValueError(f"{part.where.file} ends within a frame")
    if rest and not part.open:
        yield [rest]


def _plain(part: LogRange) -> Iterator[list[bytes]]:
    # The last line may have no end; only lines with one are whole.
    for _, lines in _lines(part.where):
        yield lines


def read_range(part: LogRange) -> Iterator[pa.RecordBatch]:
    """Lines of the four kinds, with the kind."""
    schema = pa.schema([(c, pa.string()) for c in ("app_id", "kind", "value")])
    kinds: list[str] = []
    values: list[bytes] = []

    def batch() -> pa.RecordBatch:
        text = pa.array([v.decode("utf-8", "replace") for v in values], pa.string())
        made = [pa.array([part.app] * len(kinds), pa.string()), pa.array(kinds, pa.string()), text]
        kinds.clear(), values.clear()
        return pa.RecordBatch.from_arrays(made, schema=schema)

    for lines in (_decoded if part.codec else _plain)(part):
        for line in lines:
            named = _NAMED.search(line, 0, _HEAD)
            if named:
                kinds.append(_KINDS[named[1].decode()])
                values.append(line)
                if len(values) >= _BATCH:
                    yield batch()
    if values:
        yield batch()


class LogReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.split = _options(options)

    def partitions(self) -> list[LogRange]:
        return [r for log in find_logs(self.path) for r in _ranges(log, self.split)]

    def read(self, partition: LogRange | None) -> Iterator[pa.RecordBatch]:
        return read_range(partition) if partition is not None else iter(())


class LogStreamReader(DataSourceStreamReader):
    """The offset names the closed files that are there, with their sizes."""

    def __init__(self, options: dict[str, str]):
        self.path, self.split = _options(options)

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return {log.path: log.size for log in find_logs(self.path) if not log.open}

    def partitions(self, start: dict, end: dict) -> list[LogRange]:
        logs = {log.path: log for log in find_logs(self.path)}
        new = [logs[p] for p in sorted(end) if p not in start and p in logs]
        return [r for log in new for r in _ranges(log, self.split)]

    def read(self, partition: LogRange) -> Iterator[pa.RecordBatch]:
        return read_range(partition)

    def commit(self, end: dict) -> None:
        pass


def _options(options: dict[str, str]) -> tuple[str, int]:
    if not options.get("path"):
        raise ValueError("the event log source needs a path")
    return options["path"], int(options.get("splitbytes", options.get("splitBytes", SPLIT_BYTES)))


class LogSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> LogReader:
        return LogReader(dict(self.options))

    def streamReader(self, schema) -> LogStreamReader:
        return LogStreamReader(dict(self.options))


def read_packed_log(
    spark: SparkSession, path: str, streaming: bool = False, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """Event lines ``(app_id, kind, value)`` of all logs at or below ``path``."""
    spark.dataSource.register(LogSource)
    reader = spark.readStream if streaming else spark.read
    return reader.format(FORMAT).option("path", path).option("splitBytes", split_bytes).load()


def run_events(log: DataFrame) -> DataFrame:
    """Stage and task events in one frame, each line parsed once.

    ``app_id, stage_id, kind, ts, num_tasks, stage_name, task_index, ok``
    """
    # As a generator the parser runs once a line, whatever reads its fields.
    parsed = log.select("app_id", "kind", F.inline(F.array(F.from_json("value", _FIELDS))))
    stage, task = F.col("Stage Info"), F.col("Task Info")
    kind = F.col("kind")
    of_task = kind.isin(list(TASK_EVENTS.values()))
    millis = (
        F.when(kind == SUBMITTED, stage["Submission Time"])
        .when(~of_task, stage["Completion Time"])
        .when(kind == TASK_START, task["Launch Time"])
        .otherwise(task["Finish Time"])
    )
    unusable = F.coalesce(task["Failed"], F.lit(False)) | F.coalesce(task["Killed"], F.lit(False))
    return parsed.select(
        "app_id",
        F.when(of_task, F.col("Stage ID")).otherwise(stage["Stage ID"]).cast("long").alias("stage_id"),
        "kind",
        F.timestamp_millis(millis).alias("ts"),
        stage["Number of Tasks"].alias("num_tasks"),
        stage["Stage Name"].alias("stage_name"),
        task["Index"].alias("task_index"),
        F.when(of_task, ~unusable).alias("ok"),
    )


def write_packed_log(lines: DataFrame, path: str, app_col: str = "app", value_col: str = "value") -> None:
    """Write lines as rolled, compressed logs: a file per task and application.

    A task that runs again writes the same files again.
    """
    names = [app_col, value_col]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() + 1
        open_files: dict = {}
        try:
            for batch in batches:
                apps = batch.column(0).to_numpy(zero_copy_only=False)
                texts = batch.column(1).to_pylist()
                for app in np.unique(apps):
                    if app not in open_files:
                        system, inner = _open_fs(f"{path}/eventlog_v2_{app}")
                        system.create_dir(inner, recursive=True)
                        raw = system.open_output_stream(f"{inner}/events_{number}_{app}.zstd")
                        open_files[app] = raw, zstandard.ZstdCompressor(level=1).stream_writer(raw, closefd=False)
                    body = "".join(texts[i] + "\n" for i in np.flatnonzero(apps == app))
                    open_files[app][1].write(body.encode())
        finally:
            for raw, packed in open_files.values():
                packed.close()
                raw.close()
        yield pa.RecordBatch.from_arrays([pa.array(list(open_files), pa.string())], names=["app"])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for app in batch.column(0).to_pylist():
                system, inner = _open_fs(f"{path}/eventlog_v2_{app}/appstatus_{app}")
                system.open_output_stream(inner).close()
            yield batch

    # An application has ended when that file is there; the shuffle waits for all events.
    written = lines.select(*names).mapInArrow(write, "app string").distinct()
    written.mapInArrow(finish, "app string").write.format("noop").mode("overwrite").save()
