"""Stored sketches, merged over batches, against exact answers."""

import random

from runlens.operators.sketches import (
    COUNT_ERROR, RANK_ERROR, distinct, merge_sketches, quantile, seen, sketch, stored_sketches, write_sketches,
)
from runlens.streaming.lifecycle import run_available

SCHEMA = "app string, took long, user string"


def rows_of(n, seed):
    rng = random.Random(seed)
    return [
        ("hot" if i % 3 else f"app{i % 7}", None if i % 40 == 0 else int(rng.lognormvariate(6, 2)), f"u{rng.randrange(3000)}")
        for i in range(n)
    ]


def check(state, rows):
    shares = (0.0, 0.1, 0.5, 0.9, 0.99, 1.0)
    found = state.select("app", seen("took").alias("n"), distinct("user").alias("users"), *(quantile("took", s) for s in shares))
    answers = found.collect()
    assert {r["app"] for r in answers} == {a for a, _, _ in rows}
    for r in answers:
        took = sorted(t for a, t, _ in rows if a == r["app"] and t is not None)
        users = len({u for a, _, u in rows if a == r["app"]})
        assert r["n"] == len(took) and abs(r["users"] - users) <= COUNT_ERROR * users
        for share, at in zip(shares, r[3:]):
            if not took:
                assert at is None
                continue
            below, upto = sum(t < at for t in took), sum(t <= at for t in took)
            assert below / len(took) <= share + RANK_ERROR and upto / len(took) >= share - RANK_ERROR


def test_sketches_of_a_stream_equal_those_of_all_rows(spark, tmp_path):
    """Five micro-batches with a restart before each, and one that is repeated."""
    every = []
    for i in range(5):
        rows = rows_of(4000, i)
        every += rows
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{tmp_path}/in")
        writer = write_sketches(stream, f"{tmp_path}/state", ["app"], ["took"], ["user"])
        run_available(writer, f"{tmp_path}/ck")
        check(stored_sketches(spark, f"{tmp_path}/state", i), every)
    # Spark repeats the last micro-batch when its commit is missing.
    commits = sorted((tmp_path / "ck" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    commits[-1].unlink()
    for crc in (tmp_path / "ck" / "commits").glob(f".{commits[-1].name}.crc"):
        crc.unlink()
    run_available(write_sketches(stream, f"{tmp_path}/state", ["app"], ["took"], ["user"]), f"{tmp_path}/ck")
    check(stored_sketches(spark, f"{tmp_path}/state", 4), every)


def test_merging_is_what_sketching_together_is(spark):
    rows = rows_of(3000, 9) + [("empty", None, "u1"), (None, 5, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    parts = [df.filter(f"abs(hash(took, user)) % 3 = {n}") for n in range(3)]
    states = [sketch(p, ["app"], ["took"], ["user"]) for p in parts]
    merged = merge_sketches(states[0].unionByName(states[1]).unionByName(states[2]), ["app"])
    known = [r for r in rows if r[0] is not None]
    check(merged.filter("app IS NOT NULL"), known)
    alone = merged.filter("app IS NULL").select(seen("took"), distinct("user"), quantile("took", 0.5)).first()
    assert tuple(alone) == (1, 0, 5)
    assert merge_sketches(states[0].limit(0), ["app"]).count() == 0
