"""Clusters over zone maps against plain rounds in whole numbers."""

import hashlib
import math
import random

import numpy as np
import pytest

import duckdb
from runlens.llm import zonemaps
from runlens.llm.zonemaps import candidates, hilbert_keys, nearest, with_inertia, zone_kmeans

SCHEMA = "vec_id long, embedding array<double>, cluster string, distance string"


def plain(rows, k, rounds, dims, scale=256, seed="2"):
    """(vec_id, cluster, distance, cluster inertia, inertia, digest) of every kept row."""
    kept = [
        (i, [math.floor(scale * x) for x in v])
        for i, v, *_ in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)
    ]
    named = [r for r in kept if r[0] is not None]
    named.sort(key=lambda r: (hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), np.array(r[1]).tobytes()))
    centroids = [list(v) for _, v in named[:k]]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    def assign():
        return [min((far(v, c), n) for n, c in enumerate(centroids)) for _, v in kept]

    for _ in range(rounds):
        at = assign()
        for n in range(len(centroids)):
            own = [v for (_, v), (_, c) in zip(kept, at) if c == n]
            if own:
                centroids[n] = [sum(x) // len(own) for x in zip(*own)]
    at = assign() if centroids else []
    inertia = {}
    for d, c in at:
        inertia[c] = inertia.get(c, 0) + d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted(
        (str(i), c, d, inertia[c], sum(inertia.values()), digest[c]) for (i, _), (d, c) in zip(kept, at)
    )


def rows_of(n, dims, seed, centres=0):
    rnd = random.Random(seed)
    middle = [[rnd.uniform(-1, 1) for _ in range(dims)] for _ in range(centres)]
    made = []
    for i in range(n):
        base = rnd.choice(middle) if centres else [0.0] * dims
        made.append((i, [b + rnd.gauss(0, 0.02 if centres else 0.3) for b in base], "x", "y"))
    return made


def awkward(dims):
    rows = rows_of(150, dims, 1)
    same = rows[5][1]
    rows += [(1000 + i, same, None, None) for i in range(200)]  # one very common vector
    rows += [(7, same, "x", "y"), (7, rows[3][1], "x", "y"), (None, same, "x", "y")]
    rows += [(2000, None, "x", "y"), (2001, [], "x", "y"), (2002, same[:-1], "x", "y"), (2003, same + [0.0], "x", "y")]
    for bad in (None, float("nan"), float("inf"), float("-inf")):
        rows.append((3000, [bad, *same[1:]], "x", "y"))
    rows += [(4000, [-0.001] * dims, "x", "y"), (4001, [20000.0] + [-20000.0] * (dims - 1), "x", "y")]
    return rows


def found(df):
    return sorted((str(r[0]), *r[1:]) for r in df.collect())


@pytest.mark.parametrize("k", [1, 7, 400])
def test_rounds(spark, k):
    rows = awkward(6)
    table = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(with_inertia(zone_kmeans(table, k=k, rounds=3, dims=6))) == plain(rows, k, 3, 6)


def test_empty_table(spark):
    assert with_inertia(zone_kmeans(spark.createDataFrame([], SCHEMA), dims=6)).collect() == []


def test_component_too_large(spark):
    table = spark.createDataFrame([(1, [1e300, 0.0], "", "")], SCHEMA)
    with pytest.raises(Exception, match="beyond"):
        zone_kmeans(table, dims=2)


def test_query_follows_its_sql(spark, tmp_path):
    rows = [r[:2] for r in awkward(64)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    table.write.parquet(f"{tmp_path}/embeddings.parquet")
    ours = zonemaps.op11_zone_centroids(spark, str(tmp_path))
    assert found(ours) == plain(rows, 40, 5, 64)
    con = duckdb.connect()
    con.execute(
        f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet' WHERE vec_id <> 7"
    )
    lone = table.filter("vec_id <> 7")
    sql = con.execute(zonemaps._sql()).fetchall()
    assert sorted((str(r[0]), *r[1:]) for r in sql) == found(with_inertia(zone_kmeans(lone)))


def test_curve_visits_neighbours():
    side = np.arange(8)
    cells = np.stack(np.meshgrid(side, side, side), -1).reshape(-1, 3)
    keys = [bytes(k) for k in hilbert_keys(cells, 3)]
    assert len(set(keys)) == len(keys)
    walk = cells[sorted(range(len(keys)), key=keys.__getitem__)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_candidates_hold_every_nearest():
    rng = np.random.default_rng(3)
    for spread in (1, 5, 40):
        centroids = rng.integers(-60, 60, (30, 8))
        centroids[7] = centroids[3]
        points = rng.integers(-50, 50, 8) + rng.integers(-spread, spread + 1, (40, 8))
        few = candidates(points.min(axis=0), points.max(axis=0), centroids)
        whole = nearest(points, centroids)
        part = nearest(points, centroids[few])
        assert (few[part[0]] == whole[0]).all() and (part[1] == whole[1]).all()
        if spread == 1:
            assert len(few) < 5


def test_large_components_are_exact():
    points = np.array([[1 << 27, -(1 << 27)], [(1 << 27) - 1, 5]])
    centroids = np.array([[-(1 << 27), 1 << 27], [1 << 27, 4]])
    at, far = nearest(points, centroids)
    want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(p, c)), n) for n, c in enumerate(centroids)) for p in points]
    assert [(int(d), int(n)) for n, d in zip(at, far)] == want


def test_boxes_leave_centroids_out(spark):
    """Where vectors lie in heaps, a block is compared with few centroids."""
    table = spark.createDataFrame(rows_of(3000, 6, 2, centres=12), SCHEMA)
    whole = zonemaps.whole_vectors(zonemaps.kept_vectors(table, "vec_id", "embedding", 6), 6, 256)
    blocks = zonemaps.zone_blocks(whole, 6)
    share = zonemaps.candidate_share(blocks, zonemaps.first_centroids(whole, 30, "2", 6))
    assert share < 0.4
