import random
from collections import Counter, defaultdict
from pathlib import Path

import cases
import numpy as np
import pyarrow as pa
import pytest

from runlens.llm import neardup, shared
from runlens.llm.bytetext import chunks
from runlens.llm.components import components
from runlens.llm.neardup import band_keys, first_of_class, jaccard, near_duplicates, weighted_sets


def brute(rows, least=0.8):
    """Class of every id by comparing all pairs that share a shingle."""
    docs = {d: cases.plain_words(t) for d, t, *_ in rows if d is not None}
    every = [cases.plain_words(t) for _, t, *_ in rows]
    df = Counter(w for words in every for w in set(words))
    idf = lambda w: np.log((len(every) + 1) / (df[w] + 1)) + 1
    sets, holders = {}, defaultdict(list)
    for d, words in docs.items():
        bag = cases.shingle_bag(words)
        sets[d] = {g: n * np.mean([idf(w) for w in g]) for g, n in bag.items()}
        for g in sets[d]:
            holders[g].append(d)
    parent = {d: d for d in docs}

    def find(d):
        while parent[d] != d:
            d = parent[d]
        return d

    pairs = {(a, b) for own in holders.values() for a in own for b in own if a < b}
    pairs |= {(a, b) for a in docs for b in docs if a < b and not docs[a] and not docs[b]}
    for a, b in pairs:
        shared = sum(min(w, sets[b].get(g, 0)) for g, w in sets[a].items())
        whole = sum(sets[a].values()) + sum(sets[b].values()) - shared
        if not whole or shared / whole >= least:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {d: find(d) for d in docs}


def edited(text, rng, n):
    words = text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def families(n):
    """Copies, near copies and texts that share a key but are not near."""
    rng, rows = random.Random(5), []
    for f in range(n):
        base = cases.prose(500 + f, 120)
        for k in range(6):
            rows.append((len(rows) + 100, edited(base, rng, (0, 1, 2, 4, 8, 0)[k]), None, None))
    chain = cases.prose(900, 200)
    for _ in range(12):  # each near the one before, the ends far apart
        rows.append((len(rows) + 100, chain, None, None))
        chain = edited(chain, rng, 3)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block,salt", [(1024, 64), (2, 2)])
def test_classes_equal_brute_force(spark, monkeypatch, block, salt):
    monkeypatch.setattr(neardup, "BLOCK", block)
    monkeypatch.setattr(neardup, "SALT_SIZE", salt)
    rows = [*cases.ROWS, *families(8)]
    found = near_duplicates(cases.frame(spark, rows, extra=True)).collect()
    assert len(found) == len(rows)
    assert {r["doc_id"]: r["class_id"] for r in found} == brute(rows)


def test_one_document_of_each_class_stays(spark):
    rows = [*cases.ROWS, *families(2), (None, cases.prose(1, 200), None, None)]
    docs = cases.frame(spark, rows, extra=True)
    kept = first_of_class(docs)
    assert kept.columns == docs.columns
    classes = set(brute(rows).values())
    # Rows without an id and repeated rows of a kept document stay.
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter([*classes, 7, None])


def test_small_tables_are_few_files(spark, tmp_path):
    """Every file has its price, so their number follows the bytes, not the shuffle partitions."""
    rows, made = [*cases.ROWS, *families(4)], len(shared._made)
    settings = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        first_of_class(cases.frame(spark, rows)).write.parquet(f"{tmp_path}/kept")
        kept = spark.read.parquet(f"{tmp_path}/kept")
        near_duplicates(cases.frame(spark, rows)).write.parquet(f"{tmp_path}/classes")
        assert spark.read.parquet(f"{tmp_path}/classes").count() == len(rows)
        assert {r["doc_id"] for r in kept.collect()} == set(brute(rows).values())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    tables = [t for f in shared._made[made:] for t in Path(f.removeprefix("file://")).iterdir()]
    files = {f"{t.parent.name}/{t.name}": len(list(t.glob("part-*"))) for t in [*tables, tmp_path / "kept", tmp_path / "classes"]}
    assert {t.name for t in tables} >= {"signed", "nodes", "members", "links-0", "parts-0", "open"}
    assert max(files.values()) <= spark.sparkContext.defaultParallelism, files


def test_null_ids_and_empty_tables(spark):
    rows = [(None, "a b c d e f", None, None), (1, "a b c d e f", None, None)]
    found = near_duplicates(cases.frame(spark, rows)).collect()
    assert sorted(map(tuple, found), key=str) == [(1, 1), (None, None)]
    assert near_duplicates(cases.frame(spark, [])).count() == 0


def test_samples_agree_as_often_as_sets_are_similar():
    rng, rates = random.Random(8), []
    texts = []
    for k in range(150):
        base = cases.prose(2000 + k, 150)
        texts += [base, edited(base, rng, 3)]
    idf = np.ones(1 << neardup.BUCKET_BITS, np.float32) * 2
    idf[::3] = 5
    agree = similar = 0.0
    for rows in chunks(pa.array(texts)):
        ids, weights, bounds, _ = weighted_sets(rows, idf)
        keys, _ = band_keys(ids, weights, bounds)
        for a in range(0, rows.count, 2):
            own = [(ids[bounds[r] : bounds[r + 1]], weights[bounds[r] : bounds[r + 1]]) for r in (a, a + 1)]
            similar += jaccard(*own[0], *own[1]) ** neardup.ROWS
            agree += (keys[a] == keys[a + 1]).mean()
        rates.append(rows.count)
    assert agree / 150 == pytest.approx(similar / 150, abs=0.04)


def test_components_of_paths_stars_and_rings(spark):
    path = [(i, i + 1) for i in range(0, 40)]
    star = [(100, i) for i in range(101, 160)]
    ring = [(200 + i, 200 + (i + 1) % 9) for i in range(9)]
    rows = path + star + ring + [(300, 300)]
    random.Random(1).shuffle(rows)
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(rows, "u long, v long")).collect()}
    assert all(found[i] == 0 for i in range(41)) and all(found[i] == 100 for i in range(100, 160))
    assert all(found[200 + i] == 200 for i in range(9)) and 300 not in found
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def family_of(n):
    """Texts that are 0.6 to 0.9 similar to each other: a shared part, and a part of their own."""
    rng, rows = random.Random(12), []
    shared = cases.prose(700, 200).split()
    for k in range(n):
        own = [f"own{k}x{i}" for i in range(rng.choice((4, 5, 6, 7, 8)))]
        at = rng.randrange(3)
        rows.append((5000 + k, " ".join([*own, *shared] if at == 0 else [*shared, *own] if at == 1 else [*shared[:50], *own, *shared[50:]]), None, None))
    return rows


@pytest.mark.parametrize("block", [100])
def test_large_family_below_and_above_the_threshold(spark, monkeypatch, block):
    """All links of a family whose pairs lie on both sides of 0.8, and few pairs compared."""
    monkeypatch.setattr(neardup, "BLOCK", block)
    rows = family_of(250)
    opened = []
    links = neardup._links

    def counted(pairs, *more):
        opened.append(pairs.count())
        return links(pairs, *more)

    monkeypatch.setattr(neardup, "_links", counted)
    found = near_duplicates(cases.frame(spark, rows)).collect()
    want = brute(rows)
    assert {r["doc_id"]: r["class_id"] for r in found} == want
    assert 50 < len(set(want.values())) < 240
    pairs = len(rows) * (len(rows) - 1) / 2
    assert sum(opened) < pairs / 3, f"{opened} of {pairs}"


def test_bounds_hold_for_random_sets():
    """No pair of 0.8 or more is ruled out by the first shared of the rarest shingles."""
    rng = np.random.default_rng(7)
    often = np.zeros(1 << neardup.BUCKET_BITS, np.int64)
    sets = []
    for _ in range(40):
        ids = np.sort(rng.choice(60, rng.integers(1, 50), replace=False)).astype(np.uint64) << np.uint64(40)
        sets.append((ids, rng.uniform(0.5, 4, len(ids)).astype(np.float32)))
        near = np.delete(ids, rng.integers(len(ids)))
        sets.append((near, np.delete(sets[-1][1], rng.integers(len(ids)))))
    ids, weights = (np.concatenate(x) for x in zip(*sets))
    bounds = np.cumsum([0, *(len(i) for i, _ in sets)])
    rare, before, counts = neardup.rarest(ids, weights, bounds, often, 0.8)
    apart = neardup.first_shared(rare, before, np.repeat(np.arange(len(sets)), counts), len(sets))
    whole = np.array([w.sum(dtype=np.float64) for _, w in sets])
    near = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            if i != j and len(a[0]) and len(b[0]) and jaccard(*a, *b) >= 0.8:
                shared = min(whole[i] - apart[i, j], whole[j] - apart[j, i])
                assert shared / (whole[i] + whole[j] - shared) >= 0.8 - 1e-5
                near += 1
    assert near > 20
