"""Buckets of stages in keyed state: against a loop, and what the state holds."""

import datetime
import random

import pyarrow as pa
from pyspark.sql import functions as F

from runlens.streaming import stagestate
from runlens.streaming.lifecycle import run_available
from runlens.streaming.progress import latest_progress, write_updates
from runlens.streaming.stagestate import rocksdb_state, stage_updates

KINDS = ["stage_submitted", "stage_completed", "task_start", "task_end"]


def in_turn(known, events):
    """The rule for one micro-batch, event by event."""
    low = lambda v: (v is not None, v if v is not None else 0)
    since = {}
    for app, stage, kind, at, n, name in events:
        if kind == "stage_submitted" and (app, stage) not in known:
            first = (low(at), low(n), (name is not None, name or ""), at, n, name)
            since[app, stage] = min(since.get((app, stage), first), first, key=lambda f: f[:3])
    out = dict(known) | {k: (f[5], f[4], 0, 0, False, None) for k, f in since.items()}
    for app, stage, kind, at, _, _ in events:
        key = (app, stage)
        if key not in out:
            continue
        start = since[key][3] if key in since else None
        counts = start is None or (at is not None and at >= start)
        if kind == "stage_completed" and key in since:
            counts = start is not None and at is not None and at >= start
        name, n, started, done, ended, done_at = out[key]
        if counts and kind == "stage_completed":
            ended, done_at = True, max((t for t in (done_at, at) if t is not None), default=None)
        started, done = started + (counts and kind == "task_start"), done + (counts and kind == "task_end")
        out[key] = (name, n, started, done, ended, done_at)
    touched = {e[:2] for e in events} & set(out)
    return out, touched


def packed(events):
    rows = pa.Table.from_pylist(
        [dict(zip(("app_id", "stage_id", "kind", "at", "num_tasks", "stage_name"), e)) for e in events],
        pa.schema([("app_id", pa.string()), ("stage_id", pa.int64()), ("kind", pa.string()),
                   ("at", pa.int64()), ("num_tasks", pa.int32()), ("stage_name", pa.string())]),
    )
    batches = [b for b in stagestate._pack(iter(rows.to_batches(max_chunksize=7))) if not b["stage_id"].null_count]
    return pa.Table.from_batches(batches)


def test_stages_of_a_bucket_advance_as_one_by_one():
    rng = random.Random(3)
    known, stages = {}, stagestate._STAGES.empty_table()
    for _ in range(60):
        events = [
            (rng.choice(["a", "b", None]), rng.randrange(-3, 9), rng.choice(KINDS), rng.choice([None, *range(9)]),
             rng.choice([None, 1, 2]), rng.choice([None, "s", "é", "z"]))
            for _ in range(rng.randrange(1, 25))
        ]
        known, touched = in_turn(known, events)
        stages, changed = stagestate.advance_stages(stages, packed(events))
        rows = [tuple(r.values()) for r in stages.to_pylist()]
        assert {r[:2]: r[2:] for r in rows} == known and len(rows) == len(known)
        assert {r[:2] for r, c in zip(rows, changed) if c} == touched
        if rng.random() < 0.1:
            known, stages = {}, stages.slice(0, 0)


def test_buckets_follow_the_key_alone():
    app, stage = pa.array(["a", None, "b", "a"]), pa.array([1, 1, -5, 1], pa.int64())
    found = stagestate._bucket_of(app, stage).tolist()
    assert found == [*stagestate._bucket_of(app.slice(0, 2), stage.slice(0, 2)), *stagestate._bucket_of(app.slice(2), stage.slice(2))]
    assert found[0] == found[3] and all(0 <= b < stagestate.BUCKETS for b in found)
    many = stagestate._bucket_of(pa.array([f"app-{i % 100}" for i in range(100_000)]), pa.array([i // 100 for i in range(100_000)]))
    assert max(many.tolist().count(b) for b in range(0, stagestate.BUCKETS, 97)) < 200


def test_the_state_holds_buckets_and_one_timer_clears_many(spark, tmp_path):
    """More stages than buckets; all complete, and are forgotten at two times."""
    day, n = datetime.timedelta(days=1), 3000
    start = datetime.datetime(2024, 1, 1)
    ids = spark.range(n).select(F.lit("a").alias("app_id"), F.col("id").alias("stage_id"))

    def rows(kind, ts, some=ids):
        cell = [F.lit(kind).alias("kind"), F.lit(ts).cast("timestamp").alias("ts")]
        return some.select("*", *cell, F.lit(3).alias("num_tasks"), F.lit("s").alias("stage_name"))

    even, odd = ids.filter("stage_id % 2 = 0"), ids.filter("stage_id % 2 = 1")
    batches = [
        rows("stage_submitted", start).union(rows("task_start", start + day)),
        rows("stage_completed", start + day, even).union(rows("stage_completed", start + 9 * day, odd)),
        rows("stage_submitted", start + 10 * day, ids.limit(1).withColumn("app_id", F.lit("z"))),
        # Even ones are gone by now; a micro-batch later, after a long time, all are.
        rows("task_end", start + 10 * day),
        rows("stage_submitted", start + 99 * day, ids.limit(1).withColumn("app_id", F.lit("y"))),
        rows("task_end", start + 99 * day),
    ]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    held = []
    for batch in batches:
        batch.coalesce(1).write.mode("append").parquet(source)
        arriving = spark.readStream.schema(batch.schema).parquet(source)
        with rocksdb_state(spark):
            query = run_available(write_updates(stage_updates(arriving, 2 * day), out), str(tmp_path / "ck"))
        held += [o.numRowsTotal for p in query.recentProgress for o in p.stateOperators]
    # At most a state and a timer (kept twice) for each bucket.
    assert max(held) <= 3 * stagestate.BUCKETS + 3
    found = latest_progress(spark, out).filter("app_id = 'a'").groupBy(F.col("stage_id") % 2, "started", "done").count()
    assert sorted(tuple(r) for r in found.collect()) == [(0, 1, 0, n // 2), (1, 1, 1, n // 2)]
