"""Fingerprints and their components against every pair of documents."""

import random
import re

import numpy as np
import pytest
import xxhash

from cases import LONG, ROWS, frame, prose
from runlens.llm.anchors import anchors_near, close_pairs, forest, near_links, op13_simhash_anchors, simhash_components


def plain_print(text, size=4):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    grams = [" ".join(words[i : i + size]) for i in range(len(words) - size + 1)]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams or ([" ".join(words)] if words else [])]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, threshold):
    """The number of each print's component."""
    part = list(range(len(prints)))
    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= threshold and part[i] != part[j]:
                old, new = max(part[i], part[j]), min(part[i], part[j])
                part = [new if p == old else p for p in part]
    return part


def plain(rows, threshold=4):
    prints = [plain_print(text) for _, text, *_ in rows]
    part = plain_components(prints, threshold)
    least = {}
    for (i, *_), p in zip(rows, part):
        if i is not None:
            least[p] = min(i, least.get(p, i))
    return sorted((str(i), f"{f:016x}", str(least.get(p))) for (i, *_), f, p in zip(rows, prints, part))


def near(text, seed, n):
    words = text.split()
    rnd = random.Random(seed)
    for _ in range(n):
        words[rnd.randrange(len(words))] = f"new{rnd.random()}"
    return " ".join(words)


def family():
    base = prose(50, 600)
    rows = [(100 + i, near(base, i, 1 + i % 4), "en", "a") for i in range(60)]
    return rows + [(900, base, "en", "a"), (901, base, "en", "a"), (None, base, "en", "a")]


def test_documents(spark, tmp_path):
    rows = ROWS + family() + [(None, "alone without an id", "en", "a"), (77, "A b\tc", "", ""), (78, "a  B c", "", "")]
    assert max(len(t or "") for _, t, *_ in rows) == len(LONG) > 200_000
    frame(spark, rows, extra=True).write.parquet(f"{tmp_path}/documents.parquet")
    found = op13_simhash_anchors(spark, str(tmp_path)).collect()
    got = sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in found)
    want = plain(rows)
    assert got == want
    assert len({(f, c) for _, f, c in want}) > len({c for _, _, c in want}) + 5, "no links between different texts"


def test_empty_table(spark):
    assert simhash_components(frame(spark, [])).collect() == []


@pytest.mark.parametrize("threshold, tile", [(4, 2048), (4, 3), (3, 2048), (1, 2), (0, 2048)])
def test_links(spark, threshold, tile):
    """Random fingerprints and their neighbours, with anchors that hold many tiles."""
    rnd = random.Random(threshold * 10 + tile)
    prints = []
    for _ in range(12):
        x = rnd.getrandbits(64)
        for _ in range(9):
            prints.append(x)
            for b in rnd.sample(range(64), rnd.randrange(6)):
                x ^= 1 << b
    prints = list(dict.fromkeys(prints))
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    table = spark.createDataFrame(signed, "print long").repartition(3)
    links = near_links(table, threshold, tile).collect()
    at = {s[0]: n for n, s in enumerate(signed)}
    assert all((prints[at[r.u]] ^ prints[at[r.v]]).bit_count() or r.u == r.v for r in links)
    part = list(range(len(prints)))
    for r in links:
        old, new = part[at[r.u]], part[at[r.v]]
        part = [new if p == old else p for p in part]
    want = plain_components(prints, threshold)
    assert len(set(zip(part, want))) == len(set(part)) == len(set(want)) > 12


def test_anchors_meet():
    """Two fingerprints up to twice ``beyond`` apart share an anchor; none is sent twice."""
    rng = np.random.default_rng(5)
    for beyond in (0, 1, 2):
        for apart in range(2 * beyond + 1):
            a = rng.integers(0, 2**64, 40, dtype=np.uint64)
            b = a.copy()
            for k in range(len(b)):
                for bit in rng.choice(64, apart, replace=False):
                    b[k] ^= np.uint64(1) << np.uint64(bit)
            (x, u), (y, v) = anchors_near(a, beyond), anchors_near(b, beyond)
            left, right = set(zip(x.tolist(), u.tolist())), set(zip(y.tolist(), v.tolist()))
            assert len(left) == len(u) and {k for k, _ in left & right} == set(range(40))


def test_forest_connects_what_links_do():
    rnd = random.Random(9)
    u = np.array([rnd.randrange(60) for _ in range(50)])
    v = np.array([rnd.randrange(60) for _ in range(50)])
    a, b = forest(u, v)

    def parts(pairs):
        part = list(range(60))
        for x, y in pairs:
            part = [part[y] if p == part[x] else p for p in part]
        return part

    assert len(set(zip(parts(zip(u, v)), parts(zip(a, b))))) == len(set(parts(zip(u, v))))
    assert len(a) < 60


def test_close_pairs_stay_within_groups():
    groups = np.array([1, 1, 1, 2, 2, 5])
    prints = np.array([0, 1, 7, 0, 0b111100000, 0], np.uint64)
    u, v = close_pairs(groups, prints, 2)
    assert sorted(zip(u.tolist(), v.tolist())) == [(0, 1), (1, 2)]
