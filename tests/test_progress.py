import datetime

import pytest
from pyspark.sql import functions as F

from runlens.functions import (
    bar_label, call_site, done_pct, ongoing_pct, stage_action, stage_title_html, text_label,
)
from runlens.operators.progress import (
    active,
    split_events,
    stage_progress,
    with_labels,
)
from runlens.operators.requests import answer_requests, decode_requests, known_ids
from runlens.sources.eventlog import app_of, read_event_log, stage_events, task_events

SCHEMA = (
    "app_id string, stage_id bigint, kind string, ts timestamp_ntz, num_tasks int, "
    "stage_name string, task_index int, ok boolean"
)
T0 = datetime.datetime(2024, 1, 1)


def at(second):
    return T0 + datetime.timedelta(seconds=second)


def event(app, stage, kind, second, tasks=None, name=None, index=None, ok=None):
    return (app, stage, kind, at(second), tasks, name, index, ok)


EVENTS = [
    event("a", 1, "stage_submitted", 10, 4, "count at A.scala:1"),
    event("a", 1, "task_start", 5, index=0),  # before its stage
    event("a", 1, "task_start", 10, index=0),  # at the very time of its stage
    event("a", 1, "task_start", 11, index=1),
    event("a", 1, "task_end", 12, index=0, ok=True),
    event("a", 1, "task_end", 13, index=1, ok=False),  # failed
    event("a", 1, "task_start", 14, index=1),
    event("a", 1, "task_end", 15, index=1, ok=True),
    event("a", 1, "stage_submitted", 16, 9, "resubmitted"),  # changes nothing
    event("b", 1, "stage_submitted", 1, 1, "collect"),  # same id, other application
    event("b", 1, "task_start", 2, index=0),
    event("b", 1, "task_end", 3, index=0, ok=True),
    event("b", 1, "task_end", 3, index=0, ok=True),  # more ends than tasks
    event("b", 1, "stage_completed", 4),
    event("a", 2, "stage_submitted", 3, 0, "empty at X at Y"),
    event("a", 7, "task_start", 1, index=0),  # never submitted
    event("a", 8, "stage_completed", 1),  # never submitted
    event("a", 9, "stage_completed", 1),  # before its submission
    event("a", 9, "stage_submitted", 2, 2, "late"),
]


@pytest.fixture(scope="module")
def events(spark):
    return spark.createDataFrame(EVENTS, SCHEMA).repartition(3)


def counters(df):
    return {
        (r["app_id"], r["stage_id"]): (
            r["stage_name"], r["num_tasks"], r["started"], r["done"], r["stage_done"],
        )
        for r in df.collect()
    }


def test_progress(events):
    assert counters(stage_progress(*split_events(events))) == {
        ("a", 1): ("count at A.scala:1", 4, 4, 3, False),
        ("b", 1): ("collect", 1, 1, 2, True),
        ("a", 2): ("empty at X at Y", 0, 0, 0, False),
        ("a", 9): ("late", 2, 0, 0, True),
    }


def test_ordered_progress_drops_early_events(events):
    assert counters(stage_progress(*split_events(events), ordered=True)) == {
        ("a", 1): ("count at A.scala:1", 4, 3, 3, False),
        ("b", 1): ("collect", 1, 1, 2, True),
        ("a", 2): ("empty at X at Y", 0, 0, 0, False),
        ("a", 9): ("late", 2, 0, 0, False),
    }


def test_distinct_tasks(events):
    found = counters(stage_progress(*split_events(events), distinct_tasks=True))
    assert found["a", 1][2:4] == (2, 2) and found["b", 1][2:4] == (1, 1)


def test_labels(events):
    found = with_labels(stage_progress(*split_events(events))).collect()
    labels = {(r["app_id"], r["stage_id"]): (r["label"], r["bar"], r["done_pct"]) for r in found}
    assert labels == {
        ("a", 1): ("count at A.scala:1 (75% of 4 tasks, 1 on-going)", "3 + 1 / 4", 75),
        ("b", 1): ("collect (done)", "2 + -1 / 1", 200),
        ("a", 2): ("empty at X at Y (0% of 0 task)", "0 / 0", 0),
        ("a", 9): ("late (done)", "0 / 2", 0),
    }


def test_percent_rounds_halves_up(spark):
    df = spark.createDataFrame([(1, 8, 4), (1, 200, 2), (3, 200, 2), (1, 3, 1)], "d int, n int, s int")
    got = df.select(done_pct(F.col("d"), F.col("n")), ongoing_pct(F.col("s"), F.col("d"), F.col("n")))
    assert [tuple(r) for r in got.collect()] == [(13, 38), (1, 1), (2, 0), (33, 0)]


def test_label_of_a_single_task(spark):
    one = spark.range(1).select(
        text_label(F.lit("x"), F.lit(1), F.lit(1), F.lit(0), F.lit(False)),
        bar_label(F.lit(1), F.lit(0), F.lit(0)),
    )
    assert tuple(one.first()) == ("x (0% of 1 task, 1 on-going)", "0 / 1")


def test_stage_names(spark):
    names = ["count at A.scala:1", "collect", "a at b at c", "<init> at <console>:3"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    name = F.col("n")
    got = df.select(stage_action(name), call_site(name), stage_title_html(name)).collect()
    assert [tuple(r) for r in got] == [
        ("count", "A.scala:1", "<code>count</code> at <code>A.scala:1</code>"),
        ("collect", None, "<code>collect</code>"),
        ("a", "b at c", "<code>a</code> at <code>b at c</code>"),
        ("<init>", "<console>:3",
         "<code>&lt;init&gt;</code> at <code>&lt;console&gt;:3</code>"),
    ]


def test_finished_stages_linger(events):
    found = stage_progress(*split_events(events))

    def shown(second, keep=False):
        return set(counters(active(found, at(second), keep)))

    assert ("b", 1) in shown(6) and ("b", 1) not in shown(7)
    assert ("a", 1) in shown(1000) and len(shown(1000, keep=True)) == 4


def test_requests(spark):
    messages = [
        '{"stageId": 1}', '{"stageId": 5}', '{"stageId": 2, "other": []}', "nonsense",
        '{"stageId": "x"}', '{"stageId": 99999999999}', "{}", '{"stageid2": 1}', None,
    ]
    df = spark.createDataFrame(list(enumerate(messages)), "i int, message string")
    known = spark.createDataFrame([(1,), (2,), (2,)], "stage_id int")
    got = answer_requests(decode_requests(df, "message"), known, ["stage_id"]).orderBy("i").collect()
    assert [r["outcome"] for r in got] == ["cancel", "not found", "cancel"] + ["error"] * 6
    assert [r["message"] for r in got[:4]] == [
        "Cancelling stage 1",
        "Stage 5 not found",
        "Cancelling stage 2",
        "Error decoding message",
    ]


def test_requests_are_matched_in_their_application(spark):
    asked = spark.createDataFrame([("A", 3), ("B", 3), ("A", None)], "app_id string, stage_id int")
    known = spark.createDataFrame([("B", 3), ("A", 4)], "app_id string, stage_id bigint")
    found = {(r["app_id"], r["stage_id"]): r["outcome"] for r in answer_requests(asked, known).collect()}
    assert found == {("A", 3): "not found", ("B", 3): "cancel", ("A", None): "error"}


def test_known_ids(events):
    stages, _ = split_events(events)
    rows = known_ids(stages, ["app_id"], run_rows=2).orderBy("app_id", "run").collect()
    assert [(r["app_id"], r["run"], r["items"]) for r in rows] == [
        ("a", 0, [1, 2]), ("a", 1, [8, 9]), ("b", 0, [1]),
    ]


def test_application_of_a_log_file(spark):
    files = [
        "file:/x/eventlog_v2_app-1_2/events_1_app-1_2", "hdfs://h/logs/local-17",
        "file:/x/app-9.inprogress", "file:/x.y/app-9.zstd.inprogress",
    ]
    df = spark.createDataFrame([(f,) for f in files], "f string")
    got = [r[0] for r in df.select(app_of(F.col("f"))).collect()]
    assert got == ["app-1_2", "local-17", "app-9", "app-9"]


def test_own_event_log(spark, event_log_dir):
    app = spark.sparkContext.applicationId
    spark.range(0, 100, 1, 7).repartition(3).count()
    # The log is written by a listener that may lag a little behind.
    for _ in range(50):
        log = read_event_log(spark, event_log_dir)
        found = stage_progress(stage_events(log), task_events(log)).filter("stage_done")
        rows = [r for r in found.collect() if r["num_tasks"] == 7]
        if rows:
            break
    assert rows and rows[0]["app_id"] == app
    assert (rows[0]["started"], rows[0]["done"]) == (7, 7)
    distinct = stage_progress(
        stage_events(log), task_events(log), ordered=True, distinct_tasks=True
    ).filter(f"stage_id = {rows[0]['stage_id']}")
    assert distinct.first()["done"] == 7
