"""Centroid clustering over zone maps along a space-filling curve.

Vectors are laid out along a Hilbert curve through all of their dimensions and cut into
blocks of ``BLOCK`` successive vectors; each block keeps the smallest box around them.  In
every round, a block first compares boxes only: with ``p`` the centroid nearest to the
middle of the box, another centroid ``c`` is left out if ``d(x, p) - d(x, c)``, linear in
``x`` and so largest in a corner, is below zero all over the box.  The centroids that are
left are the block's candidates; its vectors are compared with these, all at once and in
whole numbers.  A block with one candidate adds its sums without a comparison.

The blocks are written once and read by every round; a round moves one row of sums per
task and centroid, and the driver holds ``k`` centroids.  The curve orders equal vectors
by a hash of their ids, so copies of one vector spread over blocks and tasks.

Defined results: vectors that are null, have another number of components, or a null, NaN
or infinite component are not kept and get no row; each repeated row is a vector of its
own.  A vector without an id takes part but is no first centroid.  Distances that tie go
to the smaller centroid.  Equal ids tie as first centroids by their components.  With
fewer than ``k`` vectors there are as many centroids; an empty table gives no rows.  A
component that is beyond 2^27 after scaling stops the job, as a distance may then exceed
a long.  Other columns play no part, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from runlens.llm.registry import query
from runlens.llm.shared import load, new_folder

#: Vectors of a block.
BLOCK = 64
#: Bits of the curve a dimension: cells a side of the grid that the curve visits.
BITS = 4
#: Largest component, and the largest with which products of doubles are exact.
LARGEST = 1 << 27
EXACT = 1 << 22

_POINTS = "vec_id long, points binary"
_BLOCKS = "vec_ids array<long>, points binary, low binary, high binary"


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places along the Hilbert curve of cells ``(n, dims)``, as rows of bytes that sort.

    The coordinates are turned into the curve's transposed index, whose bits are then
    dealt out one of each dimension at a time, the highest first.
    """
    x = cells.astype(np.uint16).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    side = top
    while side > 1:
        low = np.uint16(side - 1)
        for i in range(dims):
            high = (x[i] & np.uint16(side)) != 0
            swap = np.where(high, np.uint16(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(high, low, swap)
            x[i] ^= swap
        side >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    side = top
    while side > 1:
        turn ^= np.where(x[-1] & np.uint16(side), np.uint16(side - 1), np.uint16(0))
        side >>= 1
    x ^= turn
    planes = [(x >> np.uint16(b)) & np.uint16(1) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T.astype(np.uint8), axis=1)


def candidates(low: np.ndarray, high: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Numbers of the centroids that may be nearest to a vector of the box, ascending."""
    twice = 2 * centroids - (low + high)
    pivot = int(np.argmin((twice * twice).sum(axis=1)))
    slope = 2 * (centroids - centroids[pivot])
    squares = (centroids * centroids).sum(axis=1)
    most = np.where(slope > 0, slope * high, slope * low).sum(axis=1) + squares[pivot] - squares
    left = most >= 0
    left[pivot] = True
    left[pivot + 1 :] &= most[pivot + 1 :] > 0  # a tie goes to the pivot there
    return np.flatnonzero(left)


def nearest(points: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each vector's nearest centroid and its squared distance, exactly."""
    if max(np.abs(points).max(initial=0), np.abs(centroids).max(initial=0)) <= EXACT:
        p, c = points.astype(np.float64), centroids.astype(np.float64)
        far = (p * p).sum(axis=1)[:, None] - 2 * (p @ c.T) + (c * c).sum(axis=1)
        at = far.argmin(axis=1)
        return at, far[np.arange(len(at)), at].astype(np.int64)
    far = np.stack([((points - c) ** 2).sum(axis=1) for c in centroids], axis=1)
    at = far.argmin(axis=1)
    return at, far[np.arange(len(at)), at]


def kept_vectors(table: DataFrame, id_col: str, vector_col: str, dims: int) -> DataFrame:
    """``(vec_id, vector)`` of the vectors that take part."""
    vector = F.col(f"`{vector_col}`").cast("array<double>")
    huge = F.lit(float("inf"))
    usable = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < huge))
    rows = table.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vector.alias("vector"))
    return rows.filter((F.size(vector) == dims) & F.coalesce(usable, F.lit(False)))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _packed(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in np.ascontiguousarray(rows)], pa.binary())


def _whole(vectors: np.ndarray, scale: int) -> np.ndarray:
    scaled = np.floor(scale * vectors)
    if np.abs(scaled).max(initial=0) > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling by {scale}")
    return scaled.astype(np.int64)


def whole_vectors(kept: DataFrame, dims: int, scale: int) -> DataFrame:
    """``(vec_id, points)``: the components in whole numbers, 8 bytes each."""

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _whole(_matrix(batch.column(1), dims), scale)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), _packed(points)], names=["vec_id", "points"]
            )

    return kept.mapInArrow(turn, _POINTS)


def _points(column: pa.Array, dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dims)


def _range_of(whole: DataFrame, dims: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each dimension's least and largest component, and the dimensions by spread.

    A task hands on a row per dimension; these are combined by Spark.
    """

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dims, LARGEST), np.full(dims, -LARGEST)
        first = second = np.zeros(dims)
        n = 0
        for batch in batches:
            if batch.num_rows:
                points = _points(batch.column(1), dims)
                low, high = np.minimum(low, points.min(axis=0)), np.maximum(high, points.max(axis=0))
                first = first + points.sum(axis=0)
                second = second + (points.astype(np.float64) ** 2).sum(axis=0)
                n += batch.num_rows
        if n:
            columns = [np.arange(dims), np.full(dims, n), low, high, first, second]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in columns], names=["dim", "n", "low", "high", "first", "second"]
            )

    schema = "dim long, n long, low long, high long, first double, second double"
    found = whole.mapInArrow(measure, schema).groupBy("dim").agg(
        F.sum("n").alias("n"),
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.sum("first").alias("first"),
        F.sum("second").alias("second"),
    )
    rows = sorted(found.collect())
    low, high = (np.array([r[c] for r in rows], np.int64) for c in ("low", "high"))
    spread = np.array([r["second"] / r["n"] - (r["first"] / r["n"]) ** 2 for r in rows])
    return low, high, np.argsort(-spread, kind="stable")


def zone_blocks(whole: DataFrame, dims: int) -> DataFrame:
    """The vectors in curve order, ``BLOCK`` a row, with the box around them."""
    low, high, order = _range_of(whole, dims)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = _points(batch.column(1), dims)
            cells = ((points - low) << BITS) // (high - low + 1)
            keys = hilbert_keys(cells[:, order]) if len(points) else np.zeros((0, 1), np.uint8)
            yield pa.RecordBatch.from_arrays(
                [_packed(keys), *batch.columns], names=["place", "vec_id", "points"]
            )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        rows: list = []

        def blocks(last: bool) -> pa.RecordBatch:
            out = []
            while len(rows) >= BLOCK or (last and rows):
                points = np.frombuffer(b"".join(rows[:BLOCK]), np.int64).reshape(-1, dims)
                box = points.min(axis=0).tobytes(), points.max(axis=0).tobytes()
                out.append((ids[:BLOCK], points.tobytes(), *box))
                del ids[:BLOCK], rows[:BLOCK]
            columns = list(zip(*out)) if out else [()] * 4
            kinds = [pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                names=["vec_ids", "points", "low", "high"],
            )

        for batch in batches:
            ids.extend(batch.column(0).to_pylist())
            rows.extend(batch.column(1).to_pylist())
            yield blocks(False)
        yield blocks(True)

    placed = whole.mapInArrow(place, f"place binary, {_POINTS}")
    salt = F.xxhash64("vec_id", "points")
    placed = placed.select("*", salt.alias("salt"), F.spark_partition_id().alias("origin"))
    keys = ["place", "salt", "origin"]
    laid = placed.repartitionByRange(*keys).sortWithinPartitions(*keys)
    return laid.select("vec_id", "points").mapInArrow(cut, _BLOCKS)


def _assigned(batch: pa.RecordBatch, centroids: np.ndarray) -> Iterator[tuple]:
    """Ids, vectors, cluster and distance of each block of a batch."""
    dims = centroids.shape[1]
    for i in range(batch.num_rows):
        points, low, high = (
            np.frombuffer(batch.column(c)[i].as_buffer(), np.int64) for c in (1, 2, 3)
        )
        points = points.reshape(-1, dims)
        few = candidates(low, high, centroids)
        yield batch.column(0)[i].values, points, few


def _round(blocks: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round."""
    k, dims = centroids.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros((k, dims), np.int64), np.zeros(k, np.int64)
        for batch in batches:
            for _, points, few in _assigned(batch, centroids):
                if len(few) == 1:
                    sums[few[0]] += points.sum(axis=0)
                    counts[few[0]] += len(points)
                    continue
                at = few[nearest(points, centroids[few])[0]]
                np.add.at(sums, at, points)
                counts += np.bincount(at, minlength=k)
        some = np.flatnonzero(counts)
        columns = [some, counts[some], *sums[some].T]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ascontiguousarray(c)) for c in columns],
            names=["cluster", "n", *(f"s{i}" for i in range(dims))],
        )

    schema = ", ".join(["cluster long", "n long", *(f"s{i} long" for i in range(dims))])
    parts = blocks.mapInArrow(add, schema)
    # Sums of a bounded number of tasks first; at the end a row per centroid.
    level = parts.withColumn("part", F.floor(F.spark_partition_id() / 256))
    names = ["n", *(f"s{i}" for i in range(dims))]
    wide = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in names]
    summed = level.groupBy("cluster", "part").agg(*wide).groupBy("cluster").agg(
        *(F.sum(c).alias(c) for c in names)
    )
    moved = centroids.copy()
    for row in summed.collect():
        moved[row["cluster"]] = [int(row[c]) // int(row["n"]) for c in names[1:]]
    return moved


def first_centroids(whole: DataFrame, k: int, seed: str, dims: int) -> np.ndarray:
    """The ``k`` vectors whose seeded ids have the smallest hashes, in that order."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    named = whole.filter("vec_id IS NOT NULL").select(digest.alias("digest"), "points")
    rows = named.orderBy("digest", "points").limit(k).collect()
    return np.frombuffer(b"".join(r["points"] for r in rows), np.int64).reshape(-1, dims)


@dataclass
class Clusters:
    """Assigned vectors ``(vec_id, cluster, distance)`` and the final centroids."""

    assigned: DataFrame
    centroids: np.ndarray


def zone_kmeans(
    table: DataFrame,
    k: int = 40,
    rounds: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    dims: int = 64,
    scale: int = 256,
    seed: str = "2",
) -> Clusters:
    """Lloyd's rounds in whole numbers, each over the zone maps, and a last assignment."""
    spark = table.sparkSession
    folder = new_folder(spark, "zones")

    def written(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    whole = written(whole_vectors(kept_vectors(table, id_col, vector_col, dims), dims, scale), "whole")
    centroids = first_centroids(whole, k, seed, dims)
    none = "vec_id long, cluster int, distance long"
    if not len(centroids):
        return Clusters(spark.createDataFrame([], none), centroids)
    blocks = written(zone_blocks(whole, dims), "blocks")
    for _ in range(rounds):
        centroids = _round(blocks, centroids)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, points, few in _assigned(batch, centroids):
                at, far = nearest(points, centroids[few])
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(few[at].astype(np.int32)), pa.array(far)],
                    names=["vec_id", "cluster", "distance"],
                )

    return Clusters(written(blocks.mapInArrow(last, none), "assigned"), centroids)


def candidate_share(blocks: DataFrame, centroids: np.ndarray) -> float:
    """Mean share of the centroids that a block compares its vectors with."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = [len(few) for _, _, few in _assigned(batch, centroids)]
            yield pa.RecordBatch.from_arrays([pa.array(n, pa.int64())], names=["n"])

    found = blocks.mapInArrow(count, "n long").agg(F.avg("n")).first()
    return float(found[0]) / len(centroids)


def with_inertia(found: Clusters) -> DataFrame:
    """The assigned vectors with their cluster's figures: sums of distances, digest.

    The figures are one row per centroid, so joining them moves nothing.
    """
    spark = found.assigned.sparkSession
    sums = found.assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()
    total = sum(r["d"] for r in sums)
    rows = [
        (r["cluster"], r["d"], total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
        for r in sums
        for c in [found.centroids[r["cluster"]].tolist()]
    ]
    schema = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    return found.assigned.join(F.broadcast(spark.createDataFrame(rows, schema)), "cluster").select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"
    )


def _sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    def assign(step: int) -> str:
        return f"""
        a{step} AS (
            SELECT row, min([d, cluster])[2] AS cluster, min([d, cluster])[1] AS d
            FROM (
                SELECT row, cluster, sum((p.v - c.v) * (p.v - c.v))::BIGINT AS d
                FROM points p JOIN c{step} c USING (dim) GROUP BY ALL
            ) GROUP BY row
        )"""

    parts = [
        f"""
        WITH kept AS (
            SELECT row_number() OVER () AS row, vec_id, embedding FROM embeddings
            WHERE len(embedding) = {dims}
              AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims}
        ),
        points AS (
            SELECT row, vec_id, d AS dim, floor(256 * embedding[d]::DOUBLE)::BIGINT AS v
            FROM kept, range(1, {dims + 1}) t(d)
        ),
        seeds AS (
            SELECT row, (row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1)::INT AS cluster
            FROM kept WHERE vec_id IS NOT NULL
        ),
        c0 AS (
            SELECT cluster, dim, v FROM points JOIN seeds USING (row) WHERE cluster < {k}
        )"""
    ]
    for step in range(rounds):
        parts.append(assign(step))
        parts.append(
            f"""
        c{step + 1} AS (
            SELECT cluster, dim, coalesce(((s - ((s % n + n) % n)) // n)::BIGINT, v) AS v
            FROM c{step} LEFT JOIN (
                SELECT cluster, dim, sum(v) AS s, count(*) AS n
                FROM a{step} JOIN points USING (row) GROUP BY ALL
            ) USING (cluster, dim)
        )"""
        )
    parts.append(assign(rounds))
    return f"""{",".join(parts)}
        SELECT vec_id, cluster, d AS distance,
            (sum(d) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia,
            (sum(d) OVER ())::BIGINT AS inertia, centroid_sha256
        FROM a{rounds} JOIN kept USING (row) JOIN (
            SELECT cluster, sha256(string_agg(v, ',' ORDER BY dim)) AS centroid_sha256
            FROM c{rounds} GROUP BY cluster
        ) USING (cluster)"""


@query("op11_zone_centroids", _sql())
def op11_zone_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return with_inertia(zone_kmeans(load(spark, folder, "embeddings")))
