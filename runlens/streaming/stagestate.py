"""Live stage progress as keyed state with event-time timers.

Input: a stream of run events ``(app_id, stage_id, kind, ts, num_tasks, stage_name)``, as
in :mod:`runlens.streaming.progress`, and the same strict rule: an event that comes before
its stage does not count.

Each task first packs its events of a micro-batch into one row per stage and kind, with no
shuffle: the times of the events, eight bytes each.  Stages are dealt over ``BUCKETS`` by a
hash of their key, and a bucket's packed events move to the state as one Arrow payload.
The state of a bucket is a table with a few numbers per stage, in RocksDB, on local disk and
in the checkpoint, not in memory.  A micro-batch reads and writes it once and works on whole
columns, so nothing is paid for a stage or an event but its bytes.

A stage stays known as long as it has not completed, through any outage.  A completed one
is removed by its bucket's timer when events ``ttl`` later than its completion have come, of
whatever stage: the watermark is the latest event time, no clock is read.  The events
themselves carry no watermark, so none is ever dropped for being late; a row per task tells it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from runlens.operators.progress import COMPLETED, SUBMITTED, TASK_END, TASK_START
from runlens.streaming.progress import TTL

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_PACKED = (
    "app_id string, stage_id long, mark timestamp, kind string, times array<long>, "
    "num_tasks int, stage_name string"
)
_CHANGED = (
    "app_id string, stage_id long, stage_name string, num_tasks int, started long, done long, "
    "stage_done boolean, done_at long"
)
_BUCKETED = "bucket int, mark timestamp, payload binary"
_VALUE = "stages binary, timer long"
_STAGES = pa.schema(
    [
        ("app_id", pa.string()),
        ("stage_id", pa.int64()),
        ("stage_name", pa.string()),
        ("num_tasks", pa.int32()),
        ("started", pa.int64()),
        ("done", pa.int64()),
        ("stage_done", pa.bool_()),
        ("done_at", pa.int64()),
    ]
)

#: Buckets of stages in the state; a checkpoint holds as many as it began with.
BUCKETS = 1024
#: Events a task packs at a time.
PACKED_EVENTS = 1 << 19
# The key of rows that only tell the latest event time.
_NO_BUCKET = -1


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state in RocksDB; the session's setting comes back."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(app_id, stage_id, kind, at, num_tasks, stage_name)`` packed batch by batch."""
    latest = None
    order = [f.split()[0] for f in _PACKED.split(", ")]
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        top = pc.max(rows["at"]).as_py()
        if top is not None:
            latest = top if latest is None else max(latest, top)
        task = pc.is_in(rows["kind"], pa.array([TASK_START, TASK_END]))
        tasks = rows.filter(task).group_by(["app_id", "stage_id", "kind"]).aggregate([("at", "list")])
        stages = rows.filter(pc.invert(task))
        single = pa.ListArray.from_arrays(
            pa.array(range(stages.num_rows + 1), pa.int32()), stages["at"].combine_chunks()
        )
        for found, times in ((stages, single), (tasks, tasks["at_list"])):
            n = found.num_rows
            columns = {
                "app_id": found["app_id"],
                "stage_id": found["stage_id"],
                "mark": pa.nulls(n, pa.timestamp("us", "UTC")),
                "kind": found["kind"],
                "times": times,
                "num_tasks": found["num_tasks"] if found is stages else pa.nulls(n, pa.int32()),
                "stage_name": found["stage_name"] if found is stages else pa.nulls(n, pa.string()),
            }
            yield from pa.table([columns[c] for c in order], names=order).to_batches()
    if latest is not None:
        mark = pa.array([latest], pa.timestamp("us", "UTC"))
        told = [pa.nulls(1, pa.string()), pa.nulls(1, pa.int64()), mark, pa.nulls(1, pa.string())]
        told += [pa.nulls(1, pa.list_(pa.int64())), pa.nulls(1, pa.int32()), pa.nulls(1, pa.string())]
        yield pa.RecordBatch.from_arrays(told, names=order)


def _known_kinds(events: DataFrame) -> DataFrame:
    known = F.col("kind").isin(SUBMITTED, COMPLETED, TASK_START, TASK_END)
    return events.filter(known & F.col("stage_id").isNotNull()).select(
        "app_id",
        F.col("stage_id").cast("long").alias("stage_id"),
        "kind",
        F.unix_micros(F.col("ts").cast("timestamp")).alias("at"),
        F.col("num_tasks").cast("int").alias("num_tasks"),
        "stage_name",
    )


def packed_events(events: DataFrame) -> DataFrame:
    """One row per stage, kind of task event and Arrow batch; stage events one by one.

    Events of unknown kinds and those without a stage are left out.
    """
    return _known_kinds(events).mapInArrow(_pack, _PACKED)


def _bytes_of(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _table_of(payload: bytes) -> pa.Table:
    return pa.ipc.open_stream(payload).read_all()


def _bucket_of(app: pa.Array, stage: pa.Array) -> np.ndarray:
    """The bucket of each stage, from its key alone."""
    apps = app.dictionary_encode(null_encoding="encode")
    crc = [zlib.crc32((a or "").encode()) for a in apps.dictionary.to_pylist()]
    h = np.array(crc, np.uint64)[apps.indices.to_numpy()] * np.uint64(0x9E3779B97F4A7C15)
    h ^= stage.to_numpy().view(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return ((h >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int32)


def _large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``PACKED_EVENTS``."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= PACKED_EVENTS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if size:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed events as one payload per bucket and batch, and a row with the latest time."""
    names = [f.split()[0] for f in _BUCKETED.split(", ")]
    for packed in _pack(_large(batches)):
        rows = packed.drop_columns(["mark"])
        if packed.column("stage_id").null_count:  # the row that tells the time
            found, marks, payloads = [_NO_BUCKET], packed.column("mark"), [None]
        else:
            bucket = _bucket_of(packed.column("app_id"), packed.column("stage_id"))
            order = np.argsort(bucket, kind="stable")
            rows, bucket = rows.take(pa.array(order)), bucket[order]
            first = np.flatnonzero(np.diff(bucket, prepend=_NO_BUCKET))
            found = bucket[first]
            ends = np.append(first[1:], len(bucket))
            payloads = [
                _bytes_of(pa.Table.from_batches([rows.slice(a, b - a)])) for a, b in zip(first, ends)
            ]
            marks = pa.nulls(len(found), pa.timestamp("us", "UTC"))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found, pa.int32()), marks, pa.array(payloads, pa.binary())], names=names
        )


def _keys(stages: pa.Table, events: pa.Table) -> tuple[np.ndarray, pa.Table]:
    """A number for the stage of each event, and the stages by number, known ones first.

    A null app is an app of its own.
    """
    both = pa.concat_tables([t.select(["app_id", "stage_id"]) for t in (stages, events)]).combine_chunks()
    app = both["app_id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    ids, stage = np.unique(both["stage_id"].to_numpy(), return_inverse=True)
    _, first, number = np.unique(app.astype(np.int64) * len(ids) + stage, return_index=True, return_inverse=True)
    order = np.argsort(first)
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return place[number][stages.num_rows :], both.take(pa.array(first[order]))


def _submissions(events: pa.Table, key: np.ndarray) -> pa.Table:
    """The first submission of each key: the earliest, nulls first in every field."""
    rows = pa.table(
        {"key": key, "at": pc.list_element(events["times"], 0) if len(key) else pa.nulls(0, pa.int64()),
         "num_tasks": events["num_tasks"], "stage_name": events["stage_name"]}
    )
    order = pc.sort_indices(rows, [(c, "ascending") for c in rows.column_names], null_placement="at_start")
    rows = rows.take(order)
    return rows.take(pa.array(np.flatnonzero(np.diff(rows["key"].to_numpy(), prepend=-1))))


def advance_stages(stages: pa.Table, events: pa.Table) -> tuple[pa.Table, np.ndarray]:
    """The known stages after packed events, and which of them had one.

    Events of stages known before all count; of a stage first submitted here, earlier ones
    do not.  Events of other stages are dropped.
    """
    key, every = _keys(stages, events)
    n, before = every.num_rows, stages.num_rows
    kind = pc.fill_null(events["kind"], "").to_numpy()
    fresh = (kind == SUBMITTED) & (key >= before)
    submitted = _submissions(events.filter(pa.array(fresh)), key[fresh])
    new = submitted["key"].to_numpy()
    kept = np.arange(n) < before
    kept[new] = True
    # Of known stages, and of those submitted at an unknown time, all events count.
    dated = submitted["at"].is_valid().to_numpy()
    since, limited = np.zeros(n, np.int64), np.zeros(n, bool)
    since[new] = pc.fill_null(submitted["at"], 0).to_numpy()
    limited[new] = dated

    times = events["times"].combine_chunks()
    size = pc.fill_null(pc.list_value_length(times), 0).to_numpy()
    at = times.flatten()
    has_at, at = at.is_valid().to_numpy(False), at.fill_null(0).to_numpy()
    of, what = np.repeat(key, size), np.repeat(kind, size)
    counts = ~limited[of] | (has_at & (at >= since[of]))

    def more(name: str) -> np.ndarray:
        return np.bincount(of[(what == name) & counts], minlength=n)

    def known(name: str) -> np.ndarray:
        out = np.zeros(n, np.int64)
        out[:before] = pc.fill_null(stages[name].cast(pa.int64()), 0).to_numpy()
        return out

    ended = what == COMPLETED
    has_end = np.bincount(of[ended], minlength=n) > 0
    last, has_last = np.full(n, np.iinfo(np.int64).min), np.zeros(n, bool)
    np.maximum.at(last, of[ended & has_at], at[ended & has_at])
    has_last[of[ended & has_at]] = True
    finished = has_end & ((np.arange(n) < before) | (limited & has_last & (last >= since)))
    done_at, has_done_at = known("done_at"), np.zeros(n, bool)
    has_done_at[:before] = stages["done_at"].is_valid().to_numpy()
    later = finished & has_last & (~has_done_at | (last > done_at))
    done_at, has_done_at = np.where(later, last, done_at), has_done_at | later

    place = np.full(n, -1)
    place[:before] = np.arange(before)
    place[new] = before + np.arange(len(new))
    place = pa.array(place[kept])
    columns = {
        "app_id": every["app_id"].filter(pa.array(kept)),
        "stage_id": every["stage_id"].filter(pa.array(kept)),
        **{
            c: pa.chunked_array([*stages[c].chunks, *submitted[c].chunks], _STAGES.field(c).type).take(place)
            for c in ("stage_name", "num_tasks")
        },
        "started": (known("started") + more(TASK_START))[kept],
        "done": (known("done") + more(TASK_END))[kept],
        "stage_done": (known("stage_done").astype(bool) | finished)[kept],
        "done_at": pa.array(done_at[kept], mask=~has_done_at[kept]),
    }
    touched = np.zeros(n, bool)
    touched[key] = True
    return pa.table(columns, schema=_STAGES).combine_chunks(), touched[kept]


class StageState(StatefulProcessor):
    """Counters of the stages of a bucket; its timer removes them when event time has moved on."""

    def __init__(self, ttl: timedelta):
        self.ttl = int(ttl.total_seconds() * 1000)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("bucket", _VALUE)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        if key[0] == _NO_BUCKET:  # only tells the latest event time
            return
        events = pa.concat_tables([_table_of(r.payload) for r in rows]).combine_chunks()
        old = self.value.get()
        stages, timer = (_table_of(old[0]), old[1]) if old is not None else (_STAGES.empty_table(), None)
        stages, touched = advance_stages(stages, events)
        if stages.num_rows == 0:
            return
        due = self._first_due(stages)
        if due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        self.value.update((_bytes_of(stages), due))
        yield Row(payload=_bytes_of(stages.filter(pa.array(touched))))

    def _due(self, stages: pa.Table) -> pa.Array:
        """When each stage is forgotten; null for those that are not."""
        at = stages["done_at"]
        due = pc.fill_null(at, 0).to_numpy() // 1000 + self.ttl
        return pa.array(due, mask=at.is_null().to_numpy())

    def _first_due(self, stages: pa.Table) -> int | None:
        return pc.min(self._due(stages)).as_py()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        old = self.value.get()
        if old is None:
            return iter(())
        stages, fired = _table_of(old[0]), expiredTimerInfo.getExpiryTimeInMs()
        due = self._due(stages)
        # What the watermark has passed goes now, with no timer of its own.
        gone = pc.or_(pc.less_equal(due, fired), pc.less(due, timerValues.getCurrentWatermarkInMs()))
        stages = stages.filter(pc.invert(pc.fill_null(gone, False)))
        if stages.num_rows == 0:
            self.value.clear()
            return iter(())
        due = self._first_due(stages)
        if due is not None:
            self.handle.registerTimer(due)
        self.value.update((_bytes_of(stages), due))
        return iter(())

    def close(self) -> None:
        pass


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for payload in batch.column("payload"):
            yield from _table_of(payload.as_buffer()).to_batches()


def stage_updates(events: DataFrame, ttl: timedelta = TTL) -> DataFrame:
    """Changed stages per micro-batch (update mode), from keyed state.

    Start its query inside :func:`rocksdb_state`.
    """
    dealt = _known_kinds(events).mapInArrow(_deal, _BUCKETED).withWatermark("mark", "0 seconds")
    changed = dealt.groupBy("bucket").transformWithState(
        StageState(ttl), "payload binary", "Update", "EventTime"
    )
    changed = changed.mapInArrow(_unpack, _CHANGED)
    return changed.select(
        *(c for c in changed.columns if c != "done_at"), F.timestamp_micros("done_at").alias("done_ts")
    )
