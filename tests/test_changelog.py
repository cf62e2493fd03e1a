"""The change log: newest rows, few segments, and crashes at every step."""

import pytest

from runlens.streaming import changelog
from runlens.streaming.changelog import Segment, append_changes, latest_changes, write_changes
from runlens.streaming.lifecycle import run_available
from runlens.streaming.progress import progress_updates

from test_progress import EVENTS, SCHEMA, counters
from test_streams import FIELDS, drop, stream

KEYS = ["k"]


def batch(spark, n):
    """Some keys change in each batch, one in all of them."""
    rows = [(0, n), *((1 + (n * 7 + i) % 40, n) for i in range(3))]
    return spark.createDataFrame(rows, "k long, v long").coalesce(1)


def newest(batches):
    out = {}
    for n in batches:
        out[0] = n
        out |= {1 + (n * 7 + i) % 40: n for i in range(3)}
    return out


def latest(spark, path):
    return {r["k"]: r["v"] for r in latest_changes(spark, path, KEYS).collect()}


def test_segments_grow_with_the_logarithm(spark, tmp_path):
    path = str(tmp_path)
    for n in range(30):
        live = append_changes(batch(spark, n), path, n, KEYS, fanout=3)
        assert len(live) <= 2 * 4
        assert [s.first for s in live][1:] == [s.last + 1 for s in live][:-1]
        if n in (0, 2, 10, 29):
            assert latest(spark, path) == newest(range(n + 1))
    on_disk = {str(p.relative_to(tmp_path)) for p in tmp_path.glob("level=*/*")}
    kept = [changelog._read_commit(path, n) for n in changelog._commits(path)]
    assert on_disk == {s.name for segments in kept for s in segments}
    assert len(list((tmp_path / "commits").glob("*.json"))) == 2


def test_a_thousand_batches_have_few_live_segments():
    """The rule alone, without data: segments of a level never reach the fan-out."""
    live = []
    for n in range(1000):
        live.append(Segment(0, n, n))
        level = 0
        while len(due := [s for s in live if s.level == level]) >= changelog.FANOUT:
            live = [s for s in live if s.level != level] + [Segment(level + 1, due[0].first, due[-1].last)]
            level += 1
        assert len(live) <= 7 * 4
    assert sorted((s.first, s.last) for s in live)[-1][1] == 999


@pytest.mark.parametrize("step", ["_newest", "_write_commit", "_clean"])
def test_a_crash_changes_nothing(spark, tmp_path, monkeypatch, step):
    """Between merge and commit, or right after it; then the batch is repeated."""
    path = str(tmp_path)
    for n in range(8):
        append_changes(batch(spark, n), path, n, KEYS, fanout=3)

    def fail(*args):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(changelog, step, fail)
        with pytest.raises(RuntimeError):
            append_changes(batch(spark, 8), path, 8, KEYS, fanout=3)
    assert latest(spark, path) == newest(range(9 if step == "_clean" else 8))
    append_changes(batch(spark, 8), path, 8, KEYS, fanout=3)
    append_changes(batch(spark, 8), path, 8, KEYS, fanout=3)
    assert latest(spark, path) == newest(range(9))
    append_changes(batch(spark, 9), path, 9, KEYS, fanout=3)
    assert latest(spark, path) == newest(range(10))


def test_live_progress_through_the_log(spark, tmp_path):
    source, log = tmp_path / "in", str(tmp_path / "log")
    from runlens.operators.progress import split_events, stage_progress

    for i in range(0, len(EVENTS), 5):
        drop(spark, source, i, EVENTS[i : i + 5])
        run_available(write_changes(progress_updates(stream(spark, source)), log, fanout=2), str(tmp_path / "ck"))
    twin = stage_progress(*split_events(spark.createDataFrame(EVENTS, SCHEMA)))
    assert counters(latest_changes(spark, log)) == counters(twin)
    assert "stage_id" in FIELDS
    with pytest.raises(FileNotFoundError):
        latest_changes(spark, str(tmp_path / "none"))
