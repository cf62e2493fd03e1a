"""Bursts against gaps and islands, late rows, and a runner that stops by itself."""

import datetime
import random
import threading
import time

from runlens.sources.packedlog import applications_ended, read_packed_log, run_events
from runlens.streaming.lifecycle import REFRESH, Runner, run_available
from runlens.streaming.progress import latest_progress, progress_updates, write_updates
from runlens.streaming.sessions import bursts, late_rows

from test_packedlog import lines_of, packed

T0 = datetime.datetime(2024, 1, 1)
SCHEMA = "app string, ts timestamp_ntz"


def at(minute):
    return T0 + datetime.timedelta(minutes=minute)


def islands(rows, gap):
    out = []
    for app in {a for a, _ in rows}:
        own = sorted(t for a, t in rows if a == app and t is not None)
        start = 0
        for i in range(1, len(own) + 1):
            if i == len(own) or own[i] - own[i - 1] > datetime.timedelta(minutes=gap):
                out.append((app, own[start], own[i - 1], i - start))
                start = i
    return sorted(out, key=str)


def test_bursts_equal_islands_and_late_rows_are_counted(spark, tmp_path):
    rng = random.Random(4)
    times = sorted(rng.randrange(2000) for _ in range(150))
    rows = [(rng.choice(["a", "a", "b", None]), at(t)) for t in times]
    parts = [rows[i : i + 25] for i in range(0, len(rows), 25)]
    assert len(parts) >= 5
    late = 0

    def run():
        events = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        found = bursts(events, ["app"], "ts", "20 minutes", "5 minutes")
        writer = found.writeStream.format("parquet").option("path", f"{tmp_path}/out").outputMode("append")
        return late_rows(run_available(writer, f"{tmp_path}/ck"))

    def put(part):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    for part in parts:
        put([*part, ("a", None)])
        late += run()
    assert late == 0
    put([("a", at(1)), ("b", at(2)), ("b", at(3000))])
    assert run() == 2
    found = spark.read.parquet(f"{tmp_path}/out").collect()
    # All but the burst that b has just begun.
    assert sorted(map(tuple, found), key=str) == islands(rows, 20)
    batch = bursts(spark.createDataFrame([*rows, ("a", None)], SCHEMA), ["app"], "ts", "20 minutes", "5 minutes")
    assert sorted(map(tuple, batch.collect()), key=str) == islands(rows, 20)


def runner(spark, tmp_path, logs):
    events = run_events(read_packed_log(spark, str(logs), streaming=True))
    writer = write_updates(progress_updates(events), f"{tmp_path}/out")
    return Runner(writer, f"{tmp_path}/ck", every=REFRESH, ended=lambda: applications_ended(str(logs)))


def test_a_runner_stops_when_the_application_ends(spark, tmp_path):
    logs = tmp_path / "logs"
    rolled = logs / "eventlog_v2_app-1"
    rolled.mkdir(parents=True)
    (rolled / "appstatus_app-1.inprogress").write_text("")
    whole = lines_of("a", 40)
    (rolled / "events_1_app-1.zstd").write_bytes(packed(whole[:22]))
    assert not applications_ended(str(logs)) and not applications_ended(str(tmp_path / "none"))
    following = runner(spark, tmp_path, logs)

    def end():
        time.sleep(6)
        assert following.query.isActive
        (rolled / "events_2_app-1.zstd").write_bytes(packed(whole[22:]))
        (rolled / "appstatus_app-1.inprogress").rename(rolled / "appstatus_app-1")

    threading.Thread(target=end).start()
    following.run(pause=0.5)
    assert following.stopped and not following.query.isActive
    assert [(r["started"], r["done"]) for r in latest_progress(spark, f"{tmp_path}/out").collect()] == [(40, 40)]


def test_a_runner_on_a_finished_log(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    (logs / "app-1.zstd").write_bytes(packed(lines_of("a", 30)))
    runner(spark, tmp_path, logs).run(pause=0.5)
    assert [(r["started"], r["done"]) for r in latest_progress(spark, f"{tmp_path}/out").collect()] == [(30, 30)]
    off = Runner(spark.readStream.text(str(logs)).writeStream.format("noop"), f"{tmp_path}/ck2", enabled=False)
    assert off.run() is None
