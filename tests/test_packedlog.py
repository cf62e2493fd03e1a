"""Compressed event logs: what Spark writes, what breaks off, and what a stream takes."""

import subprocess
import sys

import pytest
import zstandard

from runlens.operators.progress import event_progress, split_events, stage_progress
from runlens.sources.eventlog import read_event_log, stage_events, task_events
from runlens.sources.packedlog import find_logs, read_packed_log, run_events, write_packed_log
from runlens.streaming.lifecycle import run_available
from runlens.streaming.progress import latest_progress, progress_updates, write_updates

from test_progress import EVENTS, SCHEMA, counters

APP = """
import sys
from pyspark.sql import SparkSession
b = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
for k, v in {"enabled": "true", "dir": "file:" + sys.argv[1], "compress": sys.argv[2], "rolling.enabled": sys.argv[3]}.items():
    b = b.config("spark.eventLog." + k, v)
spark = b.getOrCreate()
spark.range(0, 100, 1, 7).repartition(3).count()
spark.stop()
"""


def own_app(folder, compress, rolling):
    folder.mkdir()
    code = [sys.executable, "-c", APP, str(folder), compress, rolling]
    subprocess.run(code, check=True, capture_output=True, timeout=300)


@pytest.mark.parametrize("rolling", ["true", "false"])
def test_logs_that_spark_compresses(spark, tmp_path, rolling):
    own_app(tmp_path / "packed", "true", rolling)
    (log,) = find_logs(str(tmp_path / "packed"))
    assert log.codec == "zstd" and log.app.startswith("local-") and not log.open
    found = event_progress(run_events(read_packed_log(spark, str(tmp_path / "packed"))))
    rows = [r for r in found.collect() if r["num_tasks"] == 7]
    assert rows and (rows[0]["started"], rows[0]["done"], rows[0]["stage_done"]) == (7, 7, True)
    assert rows[0]["app_id"] == log.app and rows[0]["done_ts"] >= rows[0]["submitted_ts"]


def lines_of(app, n, stage=0):
    events = ['{"Event":"SparkListenerLogStart"}', '{"Event":"SparkListenerStageSubmitted","Stage Info":{"Stage ID":%d,"Stage Name":"s","Number of Tasks":%d,"Submission Time":5}}' % (stage, n)]
    for i in range(n):
        events.append('{"Event":"SparkListenerTaskStart","Stage ID":%d,"Task Info":{"Index":%d,"Launch Time":%d}}' % (stage, i, 6 + i))
        events.append('{"Event":"SparkListenerTaskEnd","Stage ID":%d,"Task Info":{"Index":%d,"Finish Time":%d,"Failed":%s}}' % (stage, i, 9 + i, "true" if i == 1 else "false"))
    return events


def packed(lines, frames=1):
    """Compressed lines, cut into frames anywhere."""
    data = ("\n".join(lines) + "\n").encode()
    step = len(data) // frames + 1
    pack = zstandard.ZstdCompressor().compress
    return b"".join(pack(data[i : i + step]) for i in range(0, len(data), step))


def progress(spark, path):
    found = event_progress(run_events(read_packed_log(spark, str(path), split_bytes=200))).collect()
    return {(r["app_id"], r["stage_id"]): (r["num_tasks"], r["started"], r["done"]) for r in found}


def test_frames_files_and_plain_logs(spark, tmp_path):
    (tmp_path / "app-1.zstd").write_bytes(packed(lines_of("a", 30), 7))
    (tmp_path / "app-2").write_text("\n".join(lines_of("b", 20)) + "\n")
    rolled = tmp_path / "eventlog_v2_app-3"
    rolled.mkdir()
    (rolled / "appstatus_app-3").write_text("")
    whole = lines_of("c", 40)
    (rolled / "events_1_app-3.zstd").write_bytes(packed(whole[:30]))
    (rolled / "events_2_app-3").write_text("\n".join(whole[30:]) + "\n")
    assert progress(spark, tmp_path) == {("app-1", 0): (30, 30, 30), ("app-2", 0): (20, 20, 20), ("app-3", 0): (40, 40, 40)}
    rows = run_events(read_packed_log(spark, str(tmp_path / "app-1.zstd"))).collect()
    assert sum(r["ok"] is False for r in rows) == 1 and {r["task_index"] for r in rows} == {None, *range(30)}
    assert sorted({r["kind"] for r in rows}) == ["stage_submitted", "task_end", "task_start"]


def test_open_and_broken_logs(spark, tmp_path):
    data = packed(lines_of("a", 4000), 3)
    (tmp_path / "app-1.zstd.inprogress").write_bytes(data[: len(data) * 2 // 3])
    (got,) = progress(spark, tmp_path).values()
    assert got[0] == 4000 and 1000 < got[1] < 4000
    (tmp_path / "app-1.zstd.inprogress").rename(tmp_path / "app-1.zstd")
    with pytest.raises(Exception, match="within a frame"):
        progress(spark, tmp_path)
    (tmp_path / "app-1.zstd").rename(tmp_path / "app-1.lz4")
    with pytest.raises(Exception, match="lz4"):
        progress(spark, tmp_path)
    (tmp_path / "none").mkdir()
    assert progress(spark, tmp_path / "none") == {}


def test_one_scan_gives_what_two_frames_do(spark):
    events = spark.createDataFrame(EVENTS, SCHEMA)
    two = stage_progress(*split_events(events))
    one = event_progress(events)
    assert one.columns == two.columns
    assert sorted(map(str, one.collect())) == sorted(map(str, two.collect()))
    assert counters(event_progress(events.limit(0))) == {}


def test_the_plan_reads_the_logs_once(spark, tmp_path):
    (tmp_path / "app-1.zstd").write_bytes(packed(lines_of("a", 30)))
    plan = event_progress(run_events(read_packed_log(spark, str(tmp_path))))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("BatchScan") == 1 and "partial_count(1)" in text
    # Only the few rows of a stage are sorted: below the counts there is no sort.
    assert "Sort" not in text[text.index("partial_count(1)") :]


def test_a_stream_takes_each_closed_file_once(spark, tmp_path):
    logs, out = tmp_path / "logs", str(tmp_path / "out")
    rolled = logs / "eventlog_v2_app-1"
    rolled.mkdir(parents=True)
    whole = lines_of("a", 40)

    def run():
        events = run_events(read_packed_log(spark, str(logs), streaming=True))
        run_available(write_updates(progress_updates(events), out), str(tmp_path / "ck"))
        return [(r["started"], r["done"]) for r in latest_progress(spark, out).collect()]

    (rolled / "appstatus_app-1.inprogress").write_text("")
    (rolled / "events_1_app-1.zstd").write_bytes(packed(whole[:22]))
    (rolled / "events_2_app-1.zstd").write_bytes(packed(whole[22:]))
    assert run() == [(10, 10)]  # the second file may still grow
    (rolled / "appstatus_app-1.inprogress").rename(rolled / "appstatus_app-1")
    assert run() == [(40, 40)] and run() == [(40, 40)]


def test_written_logs_are_read_by_both_sources(spark, tmp_path):
    lines = [(f"app-{n}", line) for n in range(3) for line in lines_of("", 5 + n)]
    df = spark.createDataFrame(lines, "app string, value string").repartition(3)
    write_packed_log(df, str(tmp_path / "packed"))
    want = {(f"app-{n}", 0): (5 + n, 5 + n, 5 + n) for n in range(3)}
    assert progress(spark, tmp_path / "packed") == want
    (tmp_path / "plain").mkdir()
    for n in range(3):
        (tmp_path / "plain" / f"app-{n}").write_text("\n".join(v for a, v in lines if a == f"app-{n}") + "\n")
    log = read_event_log(spark, str(tmp_path / "plain"))
    other = stage_progress(stage_events(log), task_events(log)).collect()
    assert {(r["app_id"], r["stage_id"]): (r["num_tasks"], r["started"], r["done"]) for r in other} == want
