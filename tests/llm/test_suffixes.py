import hashlib
import random

import cases
import numpy as np
import pytest

from runlens.llm import suffixdedup
from runlens.llm.induced import BucketQueues, same_prefix, suffix_order
from runlens.llm.suffixdedup import remove_repeats


def brute(rows, length):
    seen, out = {}, {}
    for doc, text in sorted({r[:2] for r in rows if r[0] is not None}, key=lambda r: r[0]):
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for at in range(len(raw) - length + 1):
            if seen.setdefault(raw[at : at + length], (doc, at)) != (doc, at):
                gone[at : at + length] = True
        spans = int((gone[:-1] & ~np.append(False, gone[:-1])[:-1]).sum())
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out[doc] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def found(df, **settings):
    rows = remove_repeats(df, digest=True, **settings).collect()
    return [(r["doc_id"], (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]).hex())) for r in rows]


def strings(n):
    rng = random.Random(n)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randrange(8, 30))) for _ in range(8)]
    rows = []
    for i in range(n):
        text = "".join(rng.choice([*parts, "é", "xyz", "\0"]) for _ in range(rng.randrange(0, 6)))
        rows.append((i, text, None, None))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(
    "rows,settings",
    [
        (cases.ROWS, {}),
        (strings(60), {"length": 12, "core": 5, "shard_bytes": 300}),
        (strings(61), {"length": 12, "core": 5, "hot": 2}),
        (strings(40), {"length": 6, "core": 6, "hot": 0}),
    ],
)
def test_removal_equals_brute_force(spark, rows, settings):
    got = found(cases.frame(spark, rows, extra=True), **settings)
    assert len(got) == len(rows)
    expected = brute(rows, settings.get("length", 100))
    assert all(expected[doc] == value for doc, value in got)
    assert sum(v[1] for v in expected.values()) > 0


def test_judging_does_not_depend_on_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        rows = strings(50)
        got = dict(found(cases.frame(spark, rows), length=12, core=5))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute(rows, 12)


def test_rows_without_an_id_and_empty_tables(spark):
    text = cases.prose(1, 60)
    rows = [(None, text, None, None), (1, text, None, None), (2, text, None, None)]
    got = dict(found(cases.frame(spark, rows)))
    assert got[None][1] == 0 and got[1][1] == 0 and got[2][1] == len(text)
    assert found(cases.frame(spark, [])) == []


def test_kept_bytes_are_returned(spark):
    rows = [(1, "x" * 150, None, None), (2, "y" * 20, None, None)]
    kept = {r["doc_id"]: bytes(r["kept"]) for r in remove_repeats(cases.frame(spark, rows)).collect()}
    # All but the first byte lies in a string that starts earlier, too.
    assert kept == {1: b"x", 2: b"y" * 20}


@pytest.mark.parametrize("limit", [40, 1 << 30])
def test_suffixes_are_sorted(limit):
    rng = np.random.default_rng(limit)
    for trial in range(150):
        n = int(rng.integers(0, 60))
        data = (rng.integers(0, rng.integers(1, 5), n) * 85).astype(np.uint8)
        if trial % 3 == 0:
            data = np.tile(data[: max(1, n // 4)], 4)
        raw = data.tobytes()
        order = suffix_order(data, 10**6, limit)
        assert order.tolist() == sorted(range(len(raw)), key=lambda i: raw[i:])
        same = same_prefix(data, order, 5)
        for i in range(1, len(raw)):
            a, b = raw[order[i - 1] :][:5], raw[order[i] :][:5]
            assert same[i] == (a == b and len(a) == 5)


def test_queues_give_back_in_order_from_memory_and_disk():
    rng = np.random.default_rng(3)
    queues, plain = BucketQueues(limit=200), {}
    for _ in range(60):
        buckets, suffixes = rng.integers(0, 5, 20), rng.integers(0, 10**9, 20)
        queues.push(buckets, suffixes)
        for b, s in zip(buckets.tolist(), suffixes.tolist()):
            plain.setdefault(b, []).append(s)
        if rng.random() < 0.2:
            b = int(rng.integers(0, 5))
            assert queues.pop(b).tolist() == plain.pop(b, [])
    assert queues.file is not None
    for b in range(6):
        assert queues.pop(b).tolist() == plain.pop(b, [])
    queues.close()


def test_anchors_are_found_whatever_surrounds_them():
    rng = np.random.default_rng(5)
    core, length = 4, 11
    passage = rng.integers(97, 100, 40).astype(np.uint8)
    runs = []
    for k in range(20):
        text = np.concatenate([rng.integers(97, 100, k), passage, rng.integers(97, 100, 7)]).astype(np.uint8)
        rows = suffixdedup.Rows(0, text, np.array([0, len(text)]))
        _, place, run, _ = suffixdedup.anchors(rows, length, core)
        inside = (place >= k + length) & (place < k + 40 - length)
        runs.append([(int(p) - k, int(r)) for p, r in zip(place[inside], run[inside])])
    assert all(r == runs[0] for r in runs)
