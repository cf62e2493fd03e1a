from collections import Counter

import cases
import numpy as np
import pytest

from runlens.llm import decontaminate
from runlens.llm.decontaminate import BlockIndex, find_leaks, fingerprints, without_leaks

ITEM = cases.prose(50, 40)
ITEMS = [
    (100, ITEM),
    (101, cases.prose(51, 33)),
    (102, None),
    (103, ""),
    (104, "three short words"),
    (105, ITEM),
]


def leaky(n):
    words = ITEM.split()
    return " ".join([cases.prose(60 + n, 30), *words, cases.prose(70 + n, 30)])


ROWS = [
    *cases.ROWS,
    (30, leaky(1), None, None),
    (31, leaky(2).upper().replace(" ", ",\n"), None, None),
    (32, " ".join([cases.prose(80, 30), *ITEM.split()[:-2], cases.prose(81, 30)]), None, None),
    (33, " ".join([cases.prose(82, 30), *ITEM.split()[:20], cases.prose(83, 30)]), None, None),
    (34, ITEM, None, None),
    (35, "here are three short words for you", None, None),
    (None, leaky(3), None, None),
]


def brute(rows, items):
    found = {}
    for doc, text, *_ in rows:
        words = cases.plain_words(text)
        for item, passage in items:
            own = cases.plain_words(passage)
            if not own:
                continue
            size = min(5, len(own))
            bag, best = cases.shingle_bag(own, size), 0.0
            grams = list(zip(*(words[i:] for i in range(size))))
            for at in range(max(1, len(grams) - sum(bag.values()) + 1)):
                window = Counter(grams[at : at + sum(bag.values())])
                if window:
                    shared = sum((window & bag).values())
                    best = max(best, shared / (sum(window.values()) + sum(bag.values()) - shared))
            if best >= 0.8:
                found[doc, item] = best
    return found


@pytest.mark.parametrize("a_pass", [1000, 2])
def test_leaks_equal_brute_force(spark, monkeypatch, a_pass):
    monkeypatch.setattr(decontaminate, "ITEMS_A_PASS", a_pass)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    rows = [r for r in ROWS if r[0] != 9]
    found = find_leaks(cases.frame(spark, rows, extra=True), items).collect()
    got = {(r["doc_id"], r["item_id"]): r["similarity"] for r in found}
    expected = brute(rows, ITEMS)
    assert got == pytest.approx(expected)
    assert {d for d, _ in got} == {30, 31, 32, 34, 35, None}


def test_clean_documents_stay(spark):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = cases.frame(spark, ROWS, extra=True)
    kept = without_leaks(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.filter("doc_id > 20").collect()) == [33]
    assert kept.filter("doc_id < 20").count() == len(cases.ROWS)


@pytest.mark.parametrize("a_pass", [1000, 1])
def test_rows_are_judged_by_their_own_text(spark, monkeypatch, a_pass):
    """A leaking text without an id goes; a clean text with a leaking row's id stays."""
    monkeypatch.setattr(decontaminate, "ITEMS_A_PASS", a_pass)
    items = [(1, cases.prose(50, 40)), (2, cases.prose(51, 30)), (3, None)]
    long = f"{cases.LONG} {cases.prose(51, 30)} {cases.LONG}"
    rows = [(None, f"before {items[0][1]} after", None, None), (None, cases.prose(70, 50), None, None)]
    rows += [(2, items[1][1], None, None), (2, cases.prose(71, 50), None, None), (3, None, None, None), (4, long, None, None), (5, cases.LONG, None, None)]
    kept = without_leaks(cases.frame(spark, rows, extra=True), spark.createDataFrame(items, "item_id long, text string"))
    assert sorted((str(r["doc_id"]), r["text"] or "") for r in kept.collect()) == sorted(
        (str(d), t or "") for d, t, *_ in (rows[1], rows[3], rows[4], rows[6])
    )
    assert "Join" not in kept._jdf.queryExecution().executedPlan().toString()


def test_no_items_no_rows(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert find_leaks(cases.frame(spark), none).count() == 0
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert find_leaks(cases.frame(spark, []), items).count() == 0


def test_block_index_finds_every_pair_within_the_radius():
    rng = np.random.default_rng(1)
    prints = rng.integers(0, 256, (30, 16), dtype=np.uint8)
    wanted = np.repeat(prints, 8, axis=0)
    for row in wanted:
        for bit in rng.choice(128, rng.integers(0, 60), replace=False):
            row[bit // 8] ^= 1 << (bit % 8)
    index = BlockIndex(prints, 32)
    row, item = index.near(wanted)
    distance = np.unpackbits(wanted[:, None, :] ^ prints[None, :, :], axis=2).sum(axis=2)
    assert set(zip(row.tolist(), item.tolist())) == set(zip(*(x.tolist() for x in np.nonzero(distance <= 32))))


def test_fingerprints_depend_on_what_a_window_holds():
    rng = np.random.default_rng(4)
    hashes = rng.integers(0, 2**64, 12, dtype=np.uint64)[rng.integers(0, 12, 300)]
    for size in (1, 7, 40):
        starts = np.arange(len(hashes) - size + 1)
        every = fingerprints(hashes, starts, size)
        for s in starts[::9]:
            own = rng.permutation(hashes[s : s + size])
            assert (fingerprints(own, np.zeros(1, np.int64), size)[0] == every[s]).all()


def test_an_altered_refrain_is_found(spark):
    items, docs = [], []
    for i in range(20):
        refrain = [f"r{i}x{k}" for k in range(9)]
        words = []
        for part in range(6):
            words += refrain + [f"u{i}y{part}y{k}" for k in range(37)]
        changed = [f"{w}altered" if w == refrain[4] else w for w in words]
        items.append((i, " ".join(words)))
        docs.append((100 + i, " ".join(["before"] * 9 + changed + ["after"] * 9), None, None))
    found = find_leaks(cases.frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(100 + i, i) for i in range(20)]
    assert all(0.8 <= r["similarity"] < 0.803 for r in found)
