"""The tail source: every complete line once, across appends, splits and restarts."""

import json
import random

import pytest

from runlens.sources import tail
from runlens.sources.tail import FileRange, TailReader, _lines, read_tail
from runlens.streaming.lifecycle import run_available, run_to_the_end
from runlens.streaming.logs import line_messages, open_messages, read_messages, ship


def read_all(reader, start, end):
    rows = []
    for part in reader.partitions(start, end):
        for batch in reader.read(part):
            rows += batch.to_pylist()
    return rows


@pytest.mark.parametrize("split", [1, 2, 7, 64, 1 << 20])
def test_splits_give_each_line_once(tmp_path, split):
    rng = random.Random(split)
    lines = ["x" * rng.choice([0, 1, 3, 20, 90]) + str(i) for i in range(200)]
    lines[5:8] = ["", "", ""]
    file = tmp_path / "a.log"
    file.write_text("\n".join(lines) + "\nunfinished")
    reader = TailReader({"path": str(file), "splitbytes": str(split)})
    end = reader.latestOffset()
    rows = read_all(reader, {}, end)
    assert [r["value"] for r in rows] == lines
    data = file.read_bytes()
    for r in rows:
        assert data[r["pos"] : r["pos"] + len(r["value"])].decode() == r["value"]
    # A later part that starts in the middle of the file.
    middle = {identity: [str(file), rows[100]["pos"]] for identity in end}
    assert [r["value"] for r in read_all(reader, middle, end)] == lines[100:]


def test_line_ends_and_encodings(tmp_path):
    file = tmp_path / "a.log"
    file.write_bytes("é\r\nb\rc\n\r\n".encode() + b"\xff\n")
    reader = TailReader({"path": f"file:{file}"})
    rows = read_all(reader, {}, reader.latestOffset())
    assert [(r["pos"], r["value"]) for r in rows] == [
        (0, "é"), (4, "b"), (6, "c"), (8, ""), (10, "\ufffd"),
    ]


def test_missing_empty_and_unfinished_files(tmp_path):
    missing, empty, open_ended = tmp_path / "m", tmp_path / "e", tmp_path / "o"
    empty.write_text("")
    open_ended.write_text("no end")
    reader = TailReader({"path": f"{missing},{empty},{open_ended}"})
    assert reader.latestOffset() == {}
    open_ended.write_text("no end, now\n")
    assert list(reader.latestOffset().values()) == [[str(open_ended), 12]]
    with pytest.raises(ValueError):
        TailReader({})


@pytest.mark.parametrize("restart", [False, True])
def test_rotated_truncated_and_returning_files(tmp_path, restart):
    logs = tmp_path / "logs"
    (logs / "deep" / "er").mkdir(parents=True)
    reader, at = TailReader({"path": str(logs)}), {}

    def new():
        nonlocal reader, at
        if restart:
            reader = TailReader({"path": str(logs)})
        end = reader.latestOffset()
        rows, at = read_all(reader, at, end), end
        return sorted(r["value"] for r in rows)

    file = logs / "a.log"
    file.write_text("".join(f"line {i}\n" for i in range(20)))
    (logs / "deep" / "er" / "b.log").write_text("deep\n")
    (logs / "deep" / "_hidden").write_text("no\n")
    assert len(new()) == 21 and new() == []
    with open(file, "a") as f:
        f.write("more\n" * 50)
    assert new() == ["more"] * 50
    file.rename(logs / "a.log.1")
    file.write_text("fresh\n")
    assert new() == ["fresh"] and new() == []
    with open(file, "a") as f:
        f.write("fresher\n")
    assert new() == ["fresher"]
    (logs / "a.log.1").write_text("cut\n")
    assert new() == ["cut"] and new() == []
    if not restart:
        (logs / "a.log.1").rename(tmp_path / "away")
        assert new() == []
        (tmp_path / "away").rename(logs / "a.log.1")
        assert new() == []


class Follower:
    """Micro-batches of a source; a restart makes a new reader, as Spark does."""

    def __init__(self, path, **options):
        self.options = {"path": str(path), **{k.lower(): str(v) for k, v in options.items()}}
        self.reader = TailReader(self.options)
        self.at = None

    def restart(self):
        self.reader = TailReader(self.options)

    def new(self, commit=True):
        end = self.reader.latestOffset()
        if self.at is None:
            self.at = self.reader.initialOffset()
        rows = read_all(self.reader, self.at, end)
        if commit:
            self.at = json.loads(json.dumps(end))
        return sorted(r["value"] for r in rows)


@pytest.mark.parametrize("restart", [False, True])
@pytest.mark.parametrize("inodes", [False, True])
@pytest.mark.parametrize("ledger", [False, True])
def test_files_that_begin_alike(tmp_path, monkeypatch, restart, inodes, ledger):
    """A new file beside one that begins the same is read whole, also without inodes."""
    if not inodes:
        monkeypatch.setattr(tail, "_inode", lambda path: 0)
    logs = tmp_path / "logs"
    logs.mkdir()
    source = Follower(logs, **({"ledger": tmp_path / "ledger"} if ledger else {}))
    lines = [f"the same line {i}, long enough for a prefix" for i in range(20)]
    (logs / "b.log").write_text("\n".join(lines) + "\n")
    assert len(source.new()) == 20
    (logs / "a.log").write_text("\n".join([*lines, "one more"]) + "\n")
    if restart:
        source.restart()
    assert source.new() == sorted([*lines, "one more"]) and source.new() == []
    # Renamed both ways round: nothing is sent again.
    (logs / "a.log").rename(logs / "c.log")
    if restart:
        source.restart()
    assert source.new() == []
    with open(logs / "c.log", "a") as f:
        f.write("after\n")
    assert source.new() == ["after"]
    # Replaced by a longer file that begins otherwise.
    (logs / "b.log").write_text("x" * 5000 + "\nnew\n")
    if restart:
        source.restart()
    assert source.new() == ["new", "x" * 5000] and source.new() == []


@pytest.mark.parametrize("inodes", [False, True])
def test_a_file_that_is_away_during_a_restart(tmp_path, monkeypatch, inodes):
    if not inodes:
        monkeypatch.setattr(tail, "_inode", lambda path: 0)
    logs = tmp_path / "logs"
    logs.mkdir()
    source = Follower(logs, ledger=tmp_path / "ledger")
    file = logs / "a.log"
    file.write_text("".join(f"line {i}\n" for i in range(20)))
    (logs / "b.log").write_text("other\n")
    assert len(source.new()) == 21
    file.rename(tmp_path / "away")
    for _ in range(3):
        source.restart()
        assert source.new() == []
    (tmp_path / "away").rename(file)
    source.restart()
    assert source.new() == []
    with open(file, "a") as f:
        f.write("back\n")
    assert source.new() == ["back"]


def test_missing_generations_are_bounded_by_their_number(tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    source = Follower(logs, keepMissing=2)
    for i in range(5):
        (logs / f"{i}.log").write_text(f"{i}\n")
        assert source.new() == [str(i)]
        (logs / f"{i}.log").rename(tmp_path / f"{i}.log")
    source.new()
    assert [v[0][-5:] for v in source.at.values()] == ["3.log", "4.log"]
    for i in (2, 3, 4):
        (tmp_path / f"{i}.log").rename(logs / f"{i}.log")
    assert source.new() == ["2"]


@pytest.mark.parametrize("restart", [False, True])
def test_a_batch_keeps_to_its_budget(tmp_path, restart):
    """Every line once, about a budget a batch, no file waits for another."""
    logs = tmp_path / "logs"
    logs.mkdir()
    lines = {f"{n}.log": [f"{n} {i} " + "x" * (i % 40) for i in range(300 * n)] for n in (1, 2, 5)}
    for name, own in lines.items():
        (logs / name).write_text("\n".join(own) + "\n")
    (logs / "long.log").write_text("y" * 4000 + "\nshort\n")
    source = Follower(logs, maxBytes=2000, splitBytes=300, ledger=tmp_path / "ledger")
    got, sizes = [], []
    for n in range(200):
        if restart and n:
            source.restart()
        # Spark may die after it heard of an offset and before it wrote it down.
        new = source.new(commit=n % 7 != 3)
        if n % 7 == 3:
            source.restart()
            continue
        if not new:
            break
        got += new
        sizes.append(sum(len(x) + 1 for x in new))
        if n == 2:
            assert len({x.split()[0] for x in got if x[0] in "125"}) == 3
    assert sorted(got) == sorted([x for own in lines.values() for x in own] + ["y" * 4000, "short"])
    assert len(sizes) > 15 and sorted(sizes)[-2] <= 2 * (2000 + 3 * 50)
    assert len(list((tmp_path / "ledger").glob("*.json"))) <= 2


def test_a_new_checkpoint_ignores_an_old_ledger(tmp_path):
    file = tmp_path / "a.log"
    file.write_text("one\n")
    assert Follower(file, ledger=tmp_path / "ledger").new() == ["one"]
    assert Follower(file, ledger=tmp_path / "ledger").new() == ["one"]
    other = TailReader({"path": str(file), "ledger": str(tmp_path / "ledger")})
    assert [r["value"] for r in read_all(other, other.initialOffset(), other.latestOffset())] == ["one"]
    with pytest.raises(ValueError, match="ledger"):
        TailReader({"path": str(file), "maxbytes": "5"})


def test_runs_until_all_is_read(spark, tmp_path):
    logs = tmp_path / "logs"
    logs.mkdir()
    lines = [f"line {i}" for i in range(120)]
    (logs / "a.log").write_text("\n".join(lines[:80]) + "\n")
    (logs / "b.log").write_text("\n".join(lines[80:]) + "\n")
    out = str(tmp_path / "out")

    def writer():
        tailed = read_tail(spark, str(logs), max_bytes=400, ledger=str(tmp_path / "ledger"))
        return ship(line_messages(tailed), out)

    assert run_to_the_end(writer, str(tmp_path / "ck")) >= 3
    sent = read_messages(spark, out).collect()
    assert sorted(x for r in sent for x in r["data"]) == sorted(lines)
    assert run_to_the_end(writer, str(tmp_path / "ck")) == 1


def test_a_range_stops_at_its_limit(tmp_path):
    file = tmp_path / "a"
    file.write_text("one\ntwo\nthree\n")

    def lines(*where):
        blocks = _lines(FileRange(str(file), *where))
        return [(int(p), line) for at, found in blocks for p, line in zip(at, found)]

    assert lines(0, 0, 4, 8) == [(0, b"one")]
    assert lines(0, 2, 8, 8) == [(4, b"two")]
    assert lines(4, 4, 14, 14) == [(4, b"two"), (8, b"three")]


def test_stream_follows_appends_across_restarts(spark, tmp_path):
    logs, out, checkpoint = tmp_path / "logs", str(tmp_path / "out"), str(tmp_path / "ck")
    logs.mkdir()
    home = "/home/u"

    def run():
        tailed = read_tail(spark, str(logs), split_bytes=16)
        run_available(ship(line_messages(tailed, home, size=3), out), checkpoint)
        sent = read_messages(spark, out).collect()
        assert all(1 <= len(r["data"]) <= 3 for r in sent)
        return sorted(line for r in sent for line in r["data"])

    first = [f"a{i} {home}/x {home}" for i in range(8)]
    (logs / "a.log").write_text("\n".join(first) + "\npart")
    (logs / "b.log").write_text("")
    want = [f"a{i} ~/x ~" for i in range(8)]
    assert run() == sorted(want)
    with open(logs / "a.log", "a") as f:
        f.write("ial\nlast\n")
    (logs / "c.log").write_text("c0\n")
    want += ["partial", "last", "c0"]
    assert run() == sorted(want)
    assert run() == sorted(want)
    written = spark.read.text(out).filter("file LIKE '%/a.log'").collect()
    opened = [r["batch"] for r in written if "file_name" in r["value"]]
    assert opened == [0] and len(written) > 3


def test_open_messages(spark):
    rows = [("/home/u/a.log", 0), ("/home/u/a.log", 9), ("/x", 0)]
    lines = spark.createDataFrame(rows, "file string, pos bigint")
    got = [r["message"] for r in open_messages(lines, "/home/u").collect()]
    assert sorted(got) == ['{"file_name":"/x"}', '{"file_name":"~/a.log"}']
