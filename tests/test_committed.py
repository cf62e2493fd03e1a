"""The committed sink: killed tasks, repeated batches and aborts leave each message once."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from runlens.sources import committed
from runlens.sources.committed import CommitWriter, published, read_committed, write_committed
from runlens.streaming.lifecycle import run_available


def rows(*values):
    return iter([pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])] if values else [])


def got(spark, path):
    return sorted((r["batch"], r["value"]) for r in read_committed(spark, path).collect())


def test_only_what_a_manifest_names_is_published(spark, tmp_path):
    path = str(tmp_path / "sent")
    writer = CommitWriter(path)
    writer.write(rows("lost"))  # a task that was killed after it had written
    first = [writer.write(rows("a", "b")), writer.write(rows()), writer.write(rows("c"))]
    assert published(path) == {}
    writer.commit([*first, None], 0)
    assert got(spark, path) == [(0, "a"), (0, "b"), (0, "c")]
    # The driver died after the commit: Spark repeats the batch with new files.
    writer.commit([writer.write(rows("a", "b")), writer.write(rows("c"))], 0)
    assert got(spark, path) == [(0, "a"), (0, "b"), (0, "c")]
    given_up = [writer.write(rows("d")), None]
    writer.abort(given_up, 1)
    assert not (tmp_path / "sent" / "staged" / given_up[0].name).exists()
    writer.commit([writer.write(rows("d", 'é "x"\nnext line', None))], 1)
    writer.commit([writer.write(rows())], 2)
    second = read_committed(spark, path).filter("batch = 1").collect()
    assert {r["value"] for r in second} == {"d", 'é "x"\nnext line', None}
    assert list(published(path)) == [0, 1, 2] and published(path)[2] == []


def test_a_task_that_fails_leaves_nothing_published(spark, tmp_path):
    path = str(tmp_path / "sent")

    def broken():
        yield from rows("a")
        raise RuntimeError("gone")

    with pytest.raises(RuntimeError):
        CommitWriter(path).write(broken())
    assert published(path) == {}


def test_commit_is_the_rename(spark, tmp_path, monkeypatch):
    """A driver that dies before the manifest is in place has published nothing."""
    path = str(tmp_path / "sent")
    writer = CommitWriter(path)
    staged = [writer.write(rows("a"))]

    class Failing:
        def __init__(self, system):
            self.system = system

        def __getattr__(self, name):
            if name == "move":
                raise RuntimeError("gone")
            return getattr(self.system, name)

    real = committed._open_fs
    with monkeypatch.context() as m:
        m.setattr(committed, "_open_fs", lambda p: (Failing(real(p)[0]), real(p)[1]))
        with pytest.raises(RuntimeError):
            writer.commit(staged, 0)
    assert published(path) == {}
    writer.commit([writer.write(rows("a"))], 0)
    assert got(spark, path) == [(0, "a")]


def test_a_stream_publishes_each_message_once(spark, tmp_path):
    """Micro-batches, restarts, a lost commit and a batch that fails at first."""
    path, source = str(tmp_path / "sent"), tmp_path / "in"
    fail = tmp_path / "fail"

    def run():
        lines = spark.readStream.text(str(source))

        def check(batches, flag=str(fail)):
            import os

            for batch in batches:
                yield batch
            if os.path.exists(flag):
                raise RuntimeError("not now")

        run_available(write_committed(lines.mapInArrow(check, "value string"), path), str(tmp_path / "ck"))

    source.mkdir()
    want = []
    for n in range(3):
        own = [f"{n} {i}" for i in range(20)]
        want += own
        (source / f"{n}.txt").write_text("\n".join(own) + "\n")
        if n == 1:
            fail.write_text("")
            with pytest.raises(Exception, match="not now"):
                run()
            fail.rename(tmp_path / "no longer")
        run()
        assert sorted(v for _, v in got(spark, path)) == sorted(want)
    commits = tmp_path / "ck" / "commits"
    last = max((p for p in commits.glob("[0-9]*")), key=lambda p: int(p.name))
    last.unlink()
    (commits / f".{last.name}.crc").unlink(missing_ok=True)
    run()
    assert sorted(v for _, v in got(spark, path)) == sorted(want)


def test_wrong_use_and_an_empty_sink(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text("a\n")
    lines = spark.readStream.text(str(tmp_path / "in"))
    write_committed(lines, str(tmp_path / "x"))  # registers the sink
    other = lines.select(F.col("value").alias("text")).writeStream.format(committed.FORMAT)
    with pytest.raises(Exception, match="value"):
        run_available(other.option("path", str(tmp_path / "x")), str(tmp_path / "ck"))
    CommitWriter(str(tmp_path / "none")).commit([], 0)
    assert got(spark, str(tmp_path / "none")) == []
