"""SimHash near duplicates by anchor points of a covering code.

A text's fingerprint has a bit set if over half of its shingles' hashes have it set.
Fingerprints that differ in at most ``threshold`` bits are linked, and a component is what
links reach.  Anchors are the words of a covering code: every point of the space lies
within the covering radius of one.  Of two fingerprints at most ``threshold`` apart, some
point between them is at most ``ceil(threshold / 2)`` from both, so both lie within the
covering radius plus that of the anchor around it.  Each fingerprint is sent to every
anchor so near to it, and fingerprints are compared where they meet: no link is missed.
(The covering radius plus the whole threshold would be enough from one side alone; half of
it from both sides sends a twentieth as many rows.)

The code is a product: two Golay codes of 23 bits (radius 3), two Hamming codes of 7 bits
(radius 1), and 4 bits that no anchor looks at.  The radius counts for each part on its
own, which is what the point between them needs.  All parts are perfect codes, so no
fingerprint has a second anchor within the bare radius: 2^32 anchors, and with a threshold
of 4 a fingerprint goes to 36 to 151 anchors, 127 on average, once to each.  Where an
anchor holds over ``TILE`` different fingerprints, these are laid out as tiles, and each
pair of tiles is a group of its own.

Within a batch of anchors only the links that connect something are handed on, never all
pairs of a group.  Equal fingerprints are one from the start.

Defined results: a text with fewer words than a shingle is one shingle; texts without
words (null and empty ones too) have fingerprint zero and are linked like others.  Texts of
any length are read whole, a bounded number of shingles at a time.  Rows without an id are
linked like others but name no component; a component without any id has none (null).
Repeated rows each get a row.  An empty table gives no rows.  Other columns play no part,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from runlens.llm.bytetext import LOWER, SPACED, Rows, chunks, words
from runlens.llm.components import components
from runlens.llm.registry import query
from runlens.llm.shared import load, new_folder

SHINGLE = 4
SEED = 42
THRESHOLD = 4
#: Fingerprints of an anchor that one task compares all with all.
TILE = 2048
#: Shingles whose bits are counted at once.
_SLICE = 1 << 16
#: Rows that are compared at once, whole anchors together.
_BATCH = 1 << 17

# Lengths, radii and generator polynomials of the perfect codes.
GOLAY = (23, 3, 0b110001110101)
HAMMING = (7, 1, 0b1011)
#: The parts of the covering code, from the lowest bit up; no anchor looks at the rest.
PARTS = (GOLAY, GOLAY, HAMMING, HAMMING)


def fingerprints(rows: Rows, size: int = SHINGLE) -> np.ndarray:
    """The 64-bit fingerprint of each row's text."""
    found = words(rows, SPACED)
    # All words once more, one space after each: shingles are slices of that.
    lengths = found.end - found.start
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    spaced = np.full(int(lengths.sum()) + len(lengths), 32, np.uint8)
    letters = np.ones(len(spaced), bool)
    letters[ends] = False
    spaced[letters] = LOWER[rows.data[SPACED[rows.data]]]
    text = spaced.tobytes()
    counts = np.diff(found.bounds)
    out = np.zeros(rows.count, np.uint64)
    for r in np.flatnonzero(counts):
        first, last = found.bounds[r], found.bounds[r + 1]
        step = min(size, last - first)
        total = np.zeros(64, np.int64)
        n = last - first - step + 1
        for low in range(first, first + n, _SLICE):
            high = min(low + _SLICE, first + n)
            spans = zip(starts[low:high].tolist(), ends[low + step - 1 : high + step - 1].tolist())
            hashes = [xxhash.xxh64_intdigest(text[a:b], SEED) for a, b in spans]
            bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            total += bits.sum(axis=0, dtype=np.int64)
        out[r] = np.packbits(2 * total > n, bitorder="little").view("<u8")[0]
    return out


@dataclass
class Code:
    """A perfect cyclic code: the syndrome of every word, and the errors of each syndrome.

    ``errors[begin[s, c]:begin[s, c + 1]]`` are the patterns of syndrome ``s`` that lie
    ``c`` bits beyond the covering radius (``c`` = 0: within).
    """

    bits: int
    syndrome: np.ndarray
    errors: np.ndarray
    begin: np.ndarray


@cache
def perfect_code(bits: int, radius: int, generator: int, beyond: int) -> Code:
    rest = generator.bit_length() - 1
    syndrome = np.zeros(1 << bits, np.int16)
    for i in range(bits):
        value = 1 << i
        while value.bit_length() > rest:
            value ^= generator << (value.bit_length() - 1 - rest)
        syndrome[1 << i : 2 << i] = syndrome[: 1 << i] ^ value
    found = []
    for weight in range(radius + beyond + 1):
        for places in combinations(range(bits), weight):
            error = sum(1 << p for p in places)
            found.append((int(syndrome[error]), max(0, weight - radius), error))
    own = np.array(sorted(found), np.int64)
    kinds, costs = 1 << rest, beyond + 1
    edges = np.searchsorted(own[:, 0] * costs + own[:, 1], np.arange(kinds * costs + 1))
    begin = np.column_stack([edges[:-1].reshape(kinds, costs), edges[costs::costs]])
    return Code(bits, syndrome, own[:, 2], begin)


def anchors_near(prints: np.ndarray, beyond: int) -> tuple[np.ndarray, np.ndarray]:
    """Each fingerprint's anchors within the covering radius plus ``beyond``.

    Two columns: the place of the fingerprint, and the anchor.
    """
    at = np.arange(len(prints))
    anchor = np.zeros(len(prints), np.uint64)
    spent = np.zeros(len(prints), np.int64)
    shift = 0
    for kind in PARTS:
        code = perfect_code(*kind, beyond)
        own = (prints[at] >> np.uint64(shift)) & np.uint64((1 << code.bits) - 1)
        syndrome = code.syndrome[own.astype(np.int64)]
        low, high = code.begin[syndrome, 0], code.begin[syndrome, beyond - spent + 1]
        n = high - low
        back = np.repeat(np.arange(len(at)), n)
        place = np.arange(len(back)) - np.repeat(np.cumsum(n) - n, n) + low[back]
        error = code.errors[place].astype(np.uint64)
        anchor = anchor[back] | ((own[back] ^ error) << np.uint64(shift))
        farther = code.begin[syndrome[back], 1 : beyond + 1]
        at, spent = at[back], spent[back] + (place[:, None] >= farther).sum(axis=1)
        shift += code.bits
    return at, anchor


def forest(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect the same values as the given ones: each value to its smallest."""
    values, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = ends[: len(u)], ends[len(u) :]
    root = np.arange(len(values))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    own = np.flatnonzero(root != np.arange(len(values)))
    return values[root[own]], values[own]


def close_pairs(groups: np.ndarray, prints: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the rows of a group, sorted by group, that are at most ``threshold`` apart."""
    u, v = [], []
    left, gap = np.arange(len(groups) - 1), 1
    while len(left):
        left = left[groups[left] == groups[left + gap]]
        near = np.bitwise_count(prints[left] ^ prints[left + gap]) <= threshold
        u.append(left[near])
        v.append(left[near] + gap)
        gap += 1
        left = left[left + gap < len(groups)]
    return np.concatenate(u or [left]), np.concatenate(v or [left])


_MET = "u long, v long, anchor long, tile int, print long"


def _met(links: tuple = ((), ()), later: tuple = ((), (), ())) -> pa.RecordBatch:
    """Links, and rows of crowded anchors that are left for later."""
    n, more = len(links[0]), len(later[0])
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
    made = [pa.concat_arrays([pa.array(x, k), pa.nulls(more, k)]) for x, k in zip(links, kinds)]
    made += [pa.concat_arrays([pa.nulls(n, k), pa.array(x, k)]) for x, k in zip(later, kinds[2:])]
    return pa.RecordBatch.from_arrays(made, names=["u", "v", "anchor", "tile", "print"])


def _meet(threshold: int, tile: int):
    """Compare rows ``(anchor, print)`` in order of anchors."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = prints = np.zeros(0, np.int64)
        crowd, told = None, 0  # the last crowded anchor, and how many of its rows have gone

        def settle(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal anchors, prints, crowd, told
            starts = np.flatnonzero(np.append(True, anchors[1:] != anchors[:-1]))
            sizes = np.diff(np.append(starts, len(anchors)))
            crowded = sizes > tile
            crowded[0] |= crowd is not None and anchors[0] == crowd
            for k in np.flatnonzero(crowded):
                own = prints[starts[k] : starts[k] + sizes[k]]
                if anchors[starts[k]] != crowd:
                    crowd, told = int(anchors[starts[k]]), 0
                tiles = np.arange(told, told + len(own)) // tile
                told += len(own)
                yield _met(later=(np.full(len(own), crowd), tiles.astype(np.int32), own))
            # The last anchor may go on in the next batch.
            end = len(anchors) if last or crowded[-1] else int(starts[-1])
            use = np.flatnonzero(~np.repeat(crowded, sizes)[:end])
            a, b = close_pairs(anchors[use], prints[use].view(np.uint64), threshold)
            yield _met(links=forest(prints[use[a]], prints[use[b]]))
            anchors, prints = anchors[end:], prints[end:]

        for batch in batches:
            anchors = np.concatenate([anchors, batch.column(0).to_numpy()])
            prints = np.concatenate([prints, batch.column(1).to_numpy()])
            if len(anchors) >= _BATCH:
                yield from settle(False)
        if len(anchors):
            yield from settle(True)

    return meet


def _meet_tiles(threshold: int):
    """Compare rows ``(anchor, a, b, tile, print)`` in order of tile pairs."""

    def compare(left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
        u, v = [], []
        for low in range(0, len(left), 256):
            apart = np.bitwise_count(left[low : low + 256, None].view(np.uint64) ^ right.view(np.uint64))
            i, j = np.nonzero(apart <= threshold)
            u.append(left[low + i])
            v.append(right[j])
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in forest(np.concatenate(u), np.concatenate(v))], names=["u", "v"]
        )

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: tuple | None = None
        held: list[tuple[int, int]] = []

        def done() -> pa.RecordBatch:
            rows = np.array(held, np.int64).reshape(-1, 2)
            left = rows[rows[:, 0] == group[1], 1]
            right = left if group[1] == group[2] else rows[rows[:, 0] == group[2], 1]
            held.clear()
            return compare(np.ascontiguousarray(left), np.ascontiguousarray(right))

        for batch in batches:
            anchor, a, b, tile, prints = (batch.column(i).to_pylist() for i in range(5))
            for key, t, p in zip(zip(anchor, a, b), tile, prints):
                if key != group:
                    if held:
                        yield done()
                    group = key
                held.append((t, p))
        if held:
            yield done()

    return meet


def near_links(prints: DataFrame, threshold: int = THRESHOLD, tile: int = TILE) -> DataFrame:
    """Links ``(u, v)`` between different fingerprints ``(print)``, enough to connect all
    that are at most ``threshold`` apart."""
    spark = prints.sparkSession
    folder = new_folder(spark, "anchors")
    beyond = (threshold + 1) // 2

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(0).to_numpy()
            for low in range(0, len(own), 1024):
                at, anchor = anchors_near(own[low : low + 1024].view(np.uint64), beyond)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(own[low : low + 1024][at])],
                    names=["anchor", "print"],
                )

    placed = prints.select("print").distinct().mapInArrow(spread, "anchor long, print long")
    laid = placed.repartition("anchor").sortWithinPartitions("anchor", "print")
    laid.mapInArrow(_meet(threshold, tile), _MET).write.parquet(f"{folder}/met")
    met = spark.read.schema(_MET).parquet(f"{folder}/met")
    links = met.filter("u IS NOT NULL").select("u", "v")
    crowded = met.filter("anchor IS NOT NULL").select("anchor", "tile", "print")
    if crowded.limit(1).count():
        # Each row goes once to every tile of its anchor; no task holds more than two.
        last = crowded.groupBy("anchor").agg(F.max("tile").alias("last"))
        other = F.explode(F.sequence(F.lit(0), "last"))
        rows = crowded.join(last, "anchor").select("anchor", "tile", "print", other.alias("other"))
        pair = rows.select(
            "anchor", F.least("tile", "other").alias("a"), F.greatest("tile", "other").alias("b"), "tile", "print"
        )
        keyed = pair.repartition("anchor", "a", "b").sortWithinPartitions("anchor", "a", "b", "print")
        links = links.unionByName(keyed.mapInArrow(_meet_tiles(threshold), "u long, v long"))
    return links.distinct()


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: int = THRESHOLD,
) -> DataFrame:
    """``(id, print, component)`` for every row; ``print`` is the fingerprint as a long."""
    spark = docs.sparkSession
    folder = new_folder(spark, "simhash")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [fingerprints(rows) for rows in chunks(batch.column(1))]
            prints = np.concatenate(made or [np.zeros(0, np.uint64)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64))], names=["doc_id", "print"]
            )

    schema = "doc_id long, print long"
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    source.mapInArrow(sign, schema).write.parquet(f"{folder}/prints")
    signed = spark.read.schema(schema).parquet(f"{folder}/prints")
    least = signed.groupBy("print").agg(F.min("doc_id").alias("least"))
    parts = components(near_links(signed, threshold)).withColumnRenamed("node", "print")
    named = least.join(parts, "print", "left").withColumn("top", F.coalesce("component", "print"))
    names = named.groupBy("top").agg(F.min("least").alias("component_id"))
    found = named.select("print", "top").join(names, "top").select("print", "component_id")
    return signed.join(found, "print").select(
        F.col("doc_id").alias(id_col), "print", "component_id"
    )


@query("op13_simhash_anchors")
def op13_simhash_anchors(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash_components(load(spark, folder, "documents"))
    shown = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return found.select("doc_id", shown.alias("fingerprint"), "component_id")
