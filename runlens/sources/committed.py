"""A message sink with two-phase commit: each micro-batch is there once and whole, or not.

Tasks write their rows to files of their own under ``staged``; nothing reads those.  When
all tasks of a micro-batch are done, one manifest is put in place by a rename: it names the
files, and from then on they are published.  A task that is killed, runs twice or belongs
to a batch that is given up leaves files that no manifest names.  A micro-batch that Spark
repeats after its commit finds its manifest and publishes nothing more.

    stream.writeStream.format("runlens_committed").option("path", "/shared/sent")

Rows need a column ``value``, the message; :func:`read_committed` reads what is published.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import DataStreamWriter

from runlens.sources.tail import _open_fs

FORMAT = "runlens_committed"
SCHEMA = "value STRING"
# Files that are opened for one listing of published batches.
_BATCH = "batch="


@dataclass
class Staged(WriterCommitMessage):
    """What a task has written: a file's name, empty for no rows, and its rows."""

    name: str
    rows: int


class CommitWriter(DataSourceStreamArrowWriter):
    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        """Runs in a task; a name that no other attempt has."""
        system, inner = _open_fs(f"{self.path}/staged")
        name, rows, out = f"{uuid.uuid4().hex}.txt", 0, None
        try:
            for batch in iterator:
                if not batch.num_rows:
                    continue
                if out is None:
                    system.create_dir(inner, recursive=True)
                    out = system.open_output_stream(f"{inner}/{name}")
                values = batch.column("value").to_pylist()
                out.write("".join(f"{json.dumps(v)}\n" for v in values).encode())
                rows += len(values)
        finally:
            if out is not None:
                out.close()
        return Staged(name if rows else "", rows)

    def commit(self, messages: list[Staged | None], batchId: int) -> None:
        names = sorted(m.name for m in messages if m is not None and m.name)
        system, inner = _open_fs(self.path)
        manifest = f"{inner}/{_BATCH}{batchId}.json"
        if system.get_file_info(manifest).type == fs.FileType.File:
            self._remove(names)  # published before; Spark had not heard of it
            return
        system.create_dir(inner, recursive=True)
        part = f"{inner}/.{batchId}-{uuid.uuid4().hex}"
        with system.open_output_stream(part) as f:
            f.write(json.dumps(names).encode())
        system.move(part, manifest)

    def abort(self, messages: list[Staged | None], batchId: int) -> None:
        self._remove([m.name for m in messages if m is not None and m.name])

    def _remove(self, names: list[str]) -> None:
        system, inner = _open_fs(f"{self.path}/staged")
        for name in names:
            if system.get_file_info(f"{inner}/{name}").type == fs.FileType.File:
                system.delete_file(f"{inner}/{name}")


class CommittedSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamWriter(self, schema, overwrite: bool) -> CommitWriter:
        if "value" not in schema.fieldNames():
            raise ValueError("the sink needs a column named value")
        if not self.options.get("path"):
            raise ValueError("the sink needs a path")
        return CommitWriter(self.options["path"])


def write_committed(messages: DataFrame, path: str, value: str = "value") -> DataStreamWriter:
    """A writer, not started yet, that publishes the messages of a stream."""
    messages.sparkSession.dataSource.register(CommittedSink)
    column = messages.select(F.col(f"`{value}`").cast("string").alias("value"))
    return column.writeStream.format(FORMAT).option("path", path)


def published(path: str) -> dict[int, list[str]]:
    """The published batches and their files."""
    system, inner = _open_fs(path)
    found = {}
    for info in system.get_file_info(fs.FileSelector(inner, allow_not_found=True)):
        if info.base_name.startswith(_BATCH) and info.base_name.endswith(".json"):
            with system.open_input_file(info.path) as f:
                found[int(info.base_name[len(_BATCH) : -5])] = json.loads(f.read())
    return dict(sorted(found.items()))


def read_committed(spark: SparkSession, path: str) -> DataFrame:
    """Published messages: ``(batch, value)``.

    The manifests are read as a table and joined with the files' lines by name.
    """
    manifests = spark.read.option("wholetext", "true").option("pathGlobFilter", f"{_BATCH}*.json").text(path)
    names = F.explode(F.from_json("value", "array<string>"))
    files = manifests.select(
        F.regexp_extract(F.col("_metadata.file_name"), r"=(\d+)", 1).cast("long").alias("batch"),
        names.alias("_name"),
    )
    system, inner = _open_fs(f"{path}/staged")
    if system.get_file_info(inner).type != fs.FileType.Directory:
        return files.select("batch", F.col("_name").alias("value")).limit(0)
    lines = spark.read.text(f"{path}/staged").select(F.col("_metadata.file_name").alias("_name"), "value")
    text = F.from_json(F.concat(F.lit('{"v":'), F.col("value"), F.lit("}")), "v string")["v"]
    return lines.join(files, "_name").select("batch", text.alias("value"))
