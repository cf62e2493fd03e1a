import datetime

import pytest

from runlens.operators.progress import active, split_events, stage_progress, with_labels
from runlens.sources.sinks import print_lines
from runlens.streaming.backoff import with_backoff
from runlens.streaming.lifecycle import POLL, Runner, run_available
from runlens.streaming.logs import ship_with
from runlens.streaming.progress import (
    advance,
    latest_progress,
    progress_updates,
    remembered,
    write_strict_progress,
    write_updates,
)
from runlens.streaming.stagestate import PROVIDER, ROCKSDB, packed_events, rocksdb_state, stage_updates

from test_progress import EVENTS, SCHEMA, at, counters, event

FIELDS = "app_id stage_id kind ts num_tasks stage_name".split()


def drop(spark, path, name, rows):
    """Put one file of events into the folder of a stream."""
    df = spark.createDataFrame(rows, SCHEMA).select(*FIELDS).coalesce(1)
    df.write.mode("append").parquet(str(path))


def stream(spark, path):
    schema = spark.createDataFrame([], SCHEMA).select(*FIELDS).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(path))


def test_progress_over_many_batches_equals_the_batch_twin(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ck")
    for i in range(0, len(EVENTS), 5):
        drop(spark, source, i, EVENTS[i : i + 5])
        run_available(write_updates(progress_updates(stream(spark, source)), out), checkpoint)
    batch = stage_progress(*split_events(spark.createDataFrame(EVENTS, SCHEMA)))
    live = latest_progress(spark, out)
    assert counters(live) == counters(batch)
    # The live table serves the display like the batch one.
    for second in (6, 7):
        want = counters(active(batch, at(second)))
        assert counters(active(with_labels(live), at(second))) == want


def strict(spark, tmp_path, batches):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for i, rows in enumerate(batches):
        drop(spark, source, i, rows)
        run_available(write_strict_progress(stream(spark, source), out), str(tmp_path / "ck"))
    return counters(latest_progress(spark, f"{out}/rows"))


def test_strict_progress_in_one_batch_is_the_ordered_twin(spark, tmp_path):
    df = spark.createDataFrame(EVENTS, SCHEMA)
    batch = stage_progress(*split_events(df), ordered=True)
    assert strict(spark, tmp_path, [EVENTS]) == counters(batch)
    rows = latest_progress(spark, f"{tmp_path}/out/rows").collect()
    times = {(r["app_id"], r["stage_id"]): r["done_ts"] for r in rows}
    assert (times["b", 1], times["a", 9]) == (at(4), None)


def test_strict_progress_drops_what_arrives_before_its_stage(spark, tmp_path):
    batches = [
        [event("a", 1, "task_start", 9), event("a", 1, "stage_completed", 9)],
        [event("a", 1, "stage_submitted", 1, 3, "s"), event("a", 1, "task_start", 2)],
        # Known by now: counts, whatever its time says.
        [event("a", 1, "task_start", 0), event("a", 1, "task_end", 3)],
        [event("b", 2, "stage_submitted", 1, 1, "other")],
        [event("a", 1, "stage_submitted", 9, 8, "again"), event("a", 1, "stage_completed", 5)],
    ]
    assert strict(spark, tmp_path, batches) == {
        ("a", 1): ("s", 3, 2, 1, True),
        ("b", 2): ("other", 1, 0, 0, False),
    }


def day(n, hour=0):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(days=n, hours=hour)


def on(app, stage, kind, ts, n=None, name=None):
    made = event(app, stage, kind, 0, n, name)
    return (*made[:3], ts, *made[4:])


OUTAGE = [
    [on("a", 1, "stage_submitted", day(0), 3, "runs"), on("a", 2, "stage_submitted", day(0), 1, "ends")],
    [on("a", 2, "stage_completed", day(0, 1)), on("a", 1, "task_start", day(0, 1))],
    # 25 hours of nothing, then another stage.
    [on("b", 1, "stage_submitted", day(1, 2), 3, "later")],
    # The running stage is still known, the completed one is not.
    [on("a", 1, "task_end", day(1, 3)), on("a", 2, "task_start", day(1, 3))],
    [on("a", 1, "task_start", day(0, 2)), on("b", 1, "task_start", day(1, 3))],
    [on("a", 1, "stage_completed", day(9)), on("b", 1, "task_end", day(9))],
    [on("b", 1, "task_end", day(12)), on("c", 1, "stage_submitted", day(12), 1, "new")],
    [on("a", 1, "task_end", day(12))],
]
AFTER_OUTAGE = {
    ("a", 1): ("runs", 3, 2, 1, True),
    ("a", 2): ("ends", 1, 0, 0, True),
    ("b", 1): ("later", 3, 1, 2, False),
    ("c", 1): ("new", 1, 0, 0, False),
}


def test_running_stages_outlive_an_outage(spark, tmp_path):
    assert strict(spark, tmp_path, OUTAGE) == AFTER_OUTAGE


def test_completed_stages_are_forgotten_by_event_time(spark):
    known = None
    for i, rows in enumerate(OUTAGE[:3]):
        known = advance(known, spark.createDataFrame(rows, SCHEMA).select(*FIELDS), i).cache()
    assert sorted((r["app_id"], r["stage_id"]) for r in known.collect()) == [("a", 1), ("a", 2), ("b", 1)]
    assert sorted((r["app_id"], r["stage_id"]) for r in remembered(known).collect()) == [("a", 1), ("b", 1)]
    assert remembered(known, datetime.timedelta(days=2)).count() == 3
    assert remembered(known.limit(0)).count() == 0


def keyed(spark, tmp_path, batches, **options):
    source, out = tmp_path / "in", str(tmp_path / "out")
    for i, rows in enumerate(batches):
        drop(spark, source, i, rows)
        with rocksdb_state(spark):
            run_available(write_updates(stage_updates(stream(spark, source), **options), out), str(tmp_path / "ck"))
    return counters(latest_progress(spark, out))


def test_keyed_state_over_many_batches_equals_the_batch_twin(spark, tmp_path):
    """Events in order of time, a few a batch, with a restart before each batch."""
    rows = sorted(EVENTS, key=lambda e: (e[3], e[2] != "stage_submitted"))
    parts = [rows[i : i + 4] for i in range(0, len(rows), 4)]
    assert len(parts) >= 5
    batch = stage_progress(*split_events(spark.createDataFrame(EVENTS, SCHEMA)), ordered=True)
    found = keyed(spark, tmp_path, parts, ttl=datetime.timedelta(days=1))
    assert found == counters(batch) == strict(spark, tmp_path / "other", parts)
    assert spark.conf.get(PROVIDER, None) != ROCKSDB


def test_keyed_state_through_an_outage(spark, tmp_path):
    assert keyed(spark, tmp_path, OUTAGE) == AFTER_OUTAGE


def test_events_are_packed_where_they_are(spark):
    rows = [on("a", 1, "task_start", day(0, h)) for h in range(9)] + [on("a", 1, "task_end", None)]
    rows += [on("a", 1, "stage_submitted", day(0), 3, "s"), on("a", 1, "other", day(5)), on("a", None, "task_end", day(6))]
    df = spark.createDataFrame(rows, SCHEMA).select(*FIELDS).coalesce(1)
    packed = packed_events(df)
    assert "Exchange" not in packed._jdf.queryExecution().executedPlan().toString()
    found = packed.collect()
    assert sorted((r["kind"], len(r["times"])) for r in found if r["kind"]) == [
        ("stage_submitted", 1), ("task_end", 1), ("task_start", 9),
    ]
    assert [r["mark"] for r in found if r["mark"]] == [day(0, 8)]
    assert packed_events(df.limit(0)).count() == 0


class Failing:
    def __init__(self, times, error=RuntimeError):
        self.left, self.error, self.calls = times, error, 0

    def __call__(self, *args):
        self.calls += 1
        if self.left:
            self.left -= 1
            raise self.error("not now")
        return "sent"


@pytest.mark.parametrize(
    "failures, delays", [(0, []), (1, [5]), (5, [5, 10, 20, 40, 60]), (6, [5, 10, 20, 40, 60, 60])]
)
def test_backoff_delays(failures, delays):
    slept = []
    assert with_backoff(Failing(failures), tries=None, sleep=slept.append) == "sent"
    assert slept == delays


def test_backoff_gives_up_and_lets_interrupts_through():
    slept = []
    with pytest.raises(RuntimeError):
        with_backoff(Failing(99), tries=3, sleep=slept.append)
    assert slept == [5, 10]
    with pytest.raises(KeyboardInterrupt):
        with_backoff(Failing(1, KeyboardInterrupt), sleep=slept.append)
    with pytest.raises(ValueError):
        with_backoff(Failing(0), factor=0.5)


def test_failing_sink_gets_each_batch_once(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.txt").write_text("a\nb\n")
    seen, slept, fail = {}, [], Failing(2)

    def write(batch, batch_id):
        fail()
        seen[batch_id] = [r[0] for r in batch.collect()]

    lines = spark.readStream.text(str(tmp_path / "in"))
    run_available(ship_with(lines, write, sleep=slept.append), str(tmp_path / "ck"))
    assert (seen, slept) == ({0: ["a", "b"]}, [5, 10])


def test_runner_lifecycle(spark, tmp_path):
    (tmp_path / "in").mkdir()
    lines = spark.readStream.text(str(tmp_path / "in"))
    runner = Runner(lines.writeStream.format("noop"), str(tmp_path / "ck"), every=POLL)
    query = runner.start()
    assert runner.start() is query and query.isActive
    runner.stop()
    assert not query.isActive
    with pytest.raises(RuntimeError):
        runner.start()
    idle = Runner(lines.writeStream.format("noop"), str(tmp_path / "ck2"), enabled=False)
    assert idle.start() is None
    idle.stop()


def test_lines_to_the_console(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.txt").write_text("hello there\n")
    lines = spark.readStream.text(str(tmp_path / "in"))
    query = run_available(print_lines(lines), str(tmp_path / "ck"))
    assert sum(p.numInputRows for p in query.recentProgress) == 1
