"""A change log that stays small: newest rows by key, merged by level.

Each micro-batch writes its changed rows as a segment of level 0.  ``FANOUT`` segments of a
level are merged into one of the next, which keeps the newest row of a key; so a row is
rewritten once a level, and the number of live segments grows with the logarithm of the
number of batches.  A commit file, written last and put in place by one rename, lists the
live segments.  What a crash leaves behind is in no commit file and changes nothing; the
repeated micro-batch starts from the commit before it and writes the same segments again.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from runlens.operators.progress import STAGE_KEY
from runlens.sources.tail import _open_fs
from runlens.streaming.backoff import retrying

#: Segments of a level that are merged into one of the next.
FANOUT = 8
# Commits that stay, and with them the segments they list, for those who read meanwhile.
_KEPT = 2


@dataclass(frozen=True)
class Segment:
    """Changed rows of the batches ``first`` to ``last``."""

    level: int
    first: int
    last: int

    @property
    def name(self) -> str:
        return f"level={self.level}/{self.first:012d}-{self.last:012d}"


def _commits(path: str) -> list[int]:
    system, inner = _open_fs(f"{path}/commits")
    found = system.get_file_info(fs.FileSelector(inner, allow_not_found=True))
    return sorted(int(f.base_name[:-5]) for f in found if f.base_name.endswith(".json"))


def _read_commit(path: str, number: int) -> list[Segment]:
    system, inner = _open_fs(f"{path}/commits/{number}.json")
    with system.open_input_file(inner) as f:
        return [Segment(*s) for s in json.loads(f.read())]


def _write_commit(path: str, number: int, segments: list[Segment]) -> None:
    system, inner = _open_fs(f"{path}/commits")
    system.create_dir(inner, recursive=True)
    with system.open_output_stream(f"{inner}/.{number}") as f:
        f.write(json.dumps([[s.level, s.first, s.last] for s in segments]).encode())
    system.move(f"{inner}/.{number}", f"{inner}/{number}.json")


def _newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    fields = [c for c in rows.columns if c not in keys]
    newest = rows.groupBy(*keys).agg(F.max_by(F.struct(*fields), "_batch").alias("_row"))
    return newest.select(*keys, "_row.*")


def append_changes(
    changed: DataFrame, path: str, batch_id: int, keys: Sequence[str], fanout: int = FANOUT
) -> list[Segment]:
    """Add the changed rows of a batch, one a key, and merge what is due."""
    spark = changed.sparkSession
    before = [n for n in _commits(path) if n < batch_id]
    live = _read_commit(path, before[-1]) if before else []
    own = Segment(0, batch_id, batch_id)
    changed.withColumn("_batch", F.lit(batch_id).cast("long")).write.mode("overwrite").parquet(
        f"{path}/{own.name}"
    )
    live = [*live, own]
    level = 0
    while len(due := [s for s in live if s.level == level]) >= fanout:
        made = Segment(level + 1, due[0].first, due[-1].last)
        rows = spark.read.parquet(*(f"{path}/{s.name}" for s in due))
        _newest(rows, keys).write.mode("overwrite").parquet(f"{path}/{made.name}")
        live = [s for s in live if s.level != level] + [made]
        level += 1
    _write_commit(path, batch_id, live)
    _clean(path, batch_id)
    return live


def _clean(path: str, batch_id: int) -> None:
    """Remove commits before the last ones, and segments that no kept commit lists."""
    numbers = [n for n in _commits(path) if n <= batch_id]
    kept = {s.name for n in numbers[-_KEPT:] for s in _read_commit(path, n)}
    system, inner = _open_fs(path)
    for number in numbers[:-_KEPT]:
        system.delete_file(f"{inner}/commits/{number}.json")
    # What is listed is about what is kept: all else went with an earlier batch.
    for level in system.get_file_info(fs.FileSelector(inner)):
        if level.base_name.startswith("level="):
            for segment in system.get_file_info(fs.FileSelector(level.path)):
                if f"{level.base_name}/{segment.base_name}" not in kept:
                    system.delete_dir(segment.path)


def write_changes(
    updates: DataFrame, path: str, keys: Sequence[str] = STAGE_KEY, fanout: int = FANOUT, **retry
) -> DataStreamWriter:
    """Keep the changed rows of each micro-batch (update mode) in the change log."""

    def write(batch: DataFrame, batch_id: int) -> None:
        append_changes(batch, path, batch_id, keys, fanout)

    return updates.writeStream.outputMode("update").foreachBatch(retrying(write, **retry))


def latest_changes(spark: SparkSession, path: str, keys: Sequence[str] = STAGE_KEY) -> DataFrame:
    """The newest row of every key as of the last commit."""
    numbers = _commits(path)
    if not numbers:
        raise FileNotFoundError(f"{path} has no commits")
    segments = _read_commit(path, numbers[-1])
    rows = spark.read.parquet(*(f"{path}/{s.name}" for s in segments))
    return _newest(rows, keys).drop("_batch")
