"""Benchmark passages in documents, found by fingerprints of item-sized windows.

A window has as many words as an item.  Its SimHash votes with every shingle it holds; a
shingle's second, third ... occurrence in the window votes with a hash of its own, so that
all votes weigh the same and the distance follows from the similarity alone, whether
shingles repeat or not.  Fingerprints are cut into blocks: two within the radius agree in
some block up to ``radius // blocks`` bits, so looking every block up in tables that list
the items within that distance finds all pairs within the radius.  Those pairs are then
compared exactly, by weighted Jaccard similarity of their shingles (weight: occurrences).
A window without any shingle of the benchmark has similarity 0 and gets no fingerprint.

Words are runs of ASCII letters (lower-cased), digits and all other characters beyond
ASCII.  Items or documents shorter than a shingle count as one shingle of all their words;
null and empty ones match nothing.  Repeated rows are judged alike, each on its own; a
tie between windows goes to the first.  Without items or without rows nothing is found.
Rows carry the id of the document; further columns are not looked at.  Texts of any length
are read whole, one at a time where they are long.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from runlens.llm.bytetext import PLAIN, chunks, mix, shingles, words
from runlens.llm.registry import query
from runlens.llm.shared import load

SHINGLE = 5
SIMILARITY = 0.8
#: Of 128 bits; similar windows differ in 19 at the similarity above, give or take 4.  The
#: largest radius that leaves a block a distance of 4.
RADIUS = 39
BLOCKS = 8
#: Items that one pass over the documents looks for, and most words of them together.
ITEMS_A_PASS = 1000

FOUND = "doc_id long, item_id long, similarity double, first_word long, n_words long"
_SIEVE_BITS = 22


def _occurrences(hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """For each place its equals before it in the window it ends, after it in the one it starts."""
    n = len(hashes)
    order = np.argsort(hashes, kind="stable")
    ordered = hashes[order]
    group = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]])) * (2 * (n + size) + 1)
    before, after = np.empty(n, np.int64), np.empty(n, np.int64)
    before[order] = np.arange(n) - np.searchsorted(group + order, group + np.maximum(order - size + 1, 0))
    after[order] = np.searchsorted(group + order, group + order + size) - 1 - np.arange(n)
    return before, after


def _votes(hashes: np.ndarray, occurrence: np.ndarray) -> np.ndarray:
    """Sums of the 128 votes of the first 0, 1, ... hashes."""
    own = hashes ^ (occurrence.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    both = np.stack([mix(own), mix(own ^ np.uint64(0x9E3779B97F4A7C15))], 1)
    votes = np.unpackbits(both.view(np.uint8), axis=1).astype(np.int32) * 2 - 1
    return np.concatenate([np.zeros((1, 128), np.int32), np.cumsum(votes, axis=0, dtype=np.int32)])


def fingerprints(hashes: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """SimHash of the windows of ``size`` shingles at ``starts``, as 16 bytes each.

    A place that enters a window votes as the occurrence it then is, and one that leaves
    takes back the last occurrence's vote, so a window's sums depend on what it holds only.
    """
    entering, leaving = _occurrences(hashes, size)
    entered = _votes(hashes, entering)
    left = _votes(hashes, leaving) if entering.any() else entered
    return np.packbits(entered[starts + size] > left[starts], axis=1)


class BlockIndex:
    """Items by every block value within the distance that the radius leaves a block."""

    def __init__(self, prints: np.ndarray, radius: int, blocks: int = BLOCKS) -> None:
        self.prints = np.ascontiguousarray(prints).view(np.uint64)
        self.radius = radius
        values = np.ascontiguousarray(prints).view(np.uint16)
        every = np.arange(1 << 16, dtype=np.uint16)
        near = every[np.bitwise_count(every) <= radius // blocks]
        self.items, self.offsets = [], []
        for b in range(blocks):
            keys = (values[:, b][:, None] ^ near[None, :]).ravel()
            order = np.argsort(keys, kind="stable")
            self.items.append((order // len(near)).astype(np.int32))
            counts = np.bincount(keys, minlength=1 << 16)
            self.offsets.append(np.concatenate([[0], np.cumsum(counts)]))

    def near(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (place in ``prints``, item) within the radius."""
        values = np.ascontiguousarray(prints).view(np.uint16)
        pairs = []
        for b, (items, offsets) in enumerate(zip(self.items, self.offsets)):
            first = offsets[values[:, b]]
            counts = offsets[values[:, b].astype(np.int64) + 1] - first
            ends = np.cumsum(counts)
            at = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts - first, counts)
            rows = np.repeat(np.arange(len(values)), counts)
            pairs.append((rows.astype(np.int64) << 32) | items[at])
        found = np.unique(np.concatenate(pairs))
        row, item = found >> 32, found & 0xFFFFFFFF
        own = np.ascontiguousarray(prints).view(np.uint64)
        distance = np.bitwise_count(own[row] ^ self.prints[item]).sum(axis=1)
        close = distance <= self.radius
        return row[close], item[close]


def text_shingles(column: pa.Array) -> Iterator[tuple[int, np.ndarray, int]]:
    """For each row: its number, its shingle hashes, its words."""
    for rows in chunks(column):
        found = words(rows, PLAIN, lower=True)
        grams, bounds = shingles(found, SHINGLE)
        for r in range(rows.count):
            own = grams[bounds[r] : bounds[r + 1]]
            n = int(found.bounds[r + 1] - found.bounds[r])
            if 0 < n < SHINGLE:
                own = whole_hash(found.hash[found.bounds[r] : found.bounds[r + 1]])
            yield rows.first + r, own, n


def whole_hash(word_hashes: np.ndarray) -> np.ndarray:
    """One hash for all words of a text that is shorter than a shingle."""
    total = np.zeros(1, np.uint64)
    for h in word_hashes:
        total = mix(total * np.uint64(31) + h + np.uint64(len(word_hashes)))
    return total


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    shared = sum((a & b).values())
    return shared / (sum(a.values()) + sum(b.values()) - shared)


class Benchmark:
    """The items of one pass, ready to be looked for."""

    def __init__(self, ids: list[int], texts: list[str | None], radius: int, least: float) -> None:
        self.least = least
        kept = [(ids[r], own, n) for r, own, n in text_shingles(pa.array(texts, pa.string())) if n]
        self.ids = [i for i, _, _ in kept]
        self.words = np.array([n for _, _, n in kept], np.int64)
        self.size = np.array([len(own) for _, own, _ in kept], np.int64)
        self.bags = [Counter(own.tolist()) for _, own, _ in kept]
        self.sieve = np.zeros(1 << _SIEVE_BITS, bool)
        if not kept:
            return
        prints = [fingerprints(own, np.zeros(1, np.int64), len(own)) for _, own, _ in kept]
        self.index = BlockIndex(np.concatenate(prints), radius)
        every = np.concatenate([own for _, own, _ in kept])
        holder = np.repeat(np.arange(len(kept)), self.size)
        order = np.argsort(every, kind="stable")
        self.shingle, self.holder = every[order], holder[order]
        self.sieve[every >> np.uint64(64 - _SIEVE_BITS)] = True
        # Items that are one short shingle match runs of their own number of words.
        self.short = sorted({int(n) for n in self.words if n < SHINGLE})

    def hits(self, hashes: np.ndarray) -> np.ndarray:
        """Places whose shingle some item holds."""
        maybe = np.flatnonzero(self.sieve[hashes >> np.uint64(64 - _SIEVE_BITS)])
        at = np.searchsorted(self.shingle, hashes[maybe])
        at[at == len(self.shingle)] = 0
        return maybe[self.shingle[at] == hashes[maybe]]

    def search(self, hashes: np.ndarray, hits: np.ndarray) -> dict[int, tuple[float, int]]:
        """For each item found in a text: the best similarity and the first such window."""
        left = np.searchsorted(self.shingle, hashes[hits], side="left")
        right = np.searchsorted(self.shingle, hashes[hits], side="right")
        counts = right - left
        ends = np.cumsum(counts)
        at = np.arange(ends[-1]) - np.repeat(ends - counts - left, counts)
        sizes = self.size[self.holder[at]]
        places = np.repeat(hits, counts)
        best: dict[int, tuple[float, int]] = {}
        for size in np.unique(sizes):
            width = min(int(size), len(hashes))
            near = np.unique(places[sizes == size])
            starts = np.unique((near[:, None] - np.arange(width)[None, :]).ravel())
            starts = starts[(starts >= 0) & (starts <= len(hashes) - width)]
            rows, items = self.index.near(fingerprints(hashes, starts, width))
            same = self.size[items] == size
            for row, item in zip(rows[same].tolist(), items[same].tolist()):
                start = int(starts[row])
                bag = Counter(hashes[start : start + width].tolist())
                found = similarity(bag, self.bags[item])
                if found >= self.least and found > best.get(item, (0.0, 0))[0]:
                    best[item] = (found, start)
        return best


def _finder(ids: list[int], texts: list[str | None], radius: int, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        benchmark = Benchmark(ids, texts, radius, least)
        for batch in batches:
            found: list[tuple] = []
            docs = batch.column(0)
            for rows in chunks(batch.column(1)) if benchmark.ids else ():
                cut = words(rows, PLAIN, lower=True)
                for size in (SHINGLE, *benchmark.short):
                    if size == SHINGLE:
                        grams, bounds = shingles(cut, SHINGLE)
                    else:
                        grams, bounds = short_shingles(cut, size)
                    hit = benchmark.hits(grams)
                    owner = np.searchsorted(bounds, hit, side="right") - 1
                    for r in np.unique(owner):
                        first = bounds[r]
                        own = grams[first : bounds[r + 1]]
                        for item, (score, start) in benchmark.search(
                            own, hit[owner == r] - first
                        ).items():
                            n = int(min(benchmark.words[item], cut.bounds[r + 1] - cut.bounds[r]))
                            row = (docs[int(rows.first + r)].as_py(), benchmark.ids[item])
                            found.append((*row, score, start, n))
            columns = list(zip(*found)) if found else [()] * 5
            types = [pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "item_id", "similarity", "first_word", "n_words"],
            )

    return run


def short_shingles(cut, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Runs of ``size`` words, hashed like whole texts of so many words."""
    counts = np.maximum(np.diff(cut.bounds) - size + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(bounds[-1]) + np.repeat(cut.bounds[:-1] - bounds[:-1], counts)
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total = mix(total * np.uint64(31) + cut.hash[at + k] + np.uint64(size))
    return total, bounds


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """Documents with a passage like an item: one row per document row and item.

    Items reach the tasks ``ITEMS_A_PASS`` at a time, one pass over the documents each, so
    what a task holds is bounded whatever the benchmark's size.  No shuffle.
    """
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    passes = [source.mapInArrow(run, FOUND) for run in _finders(items, radius, least)]
    result = passes[0]
    for part in passes[1:]:
        result = result.unionByName(part)
    return result


def _finders(items: DataFrame, radius: int, least: float) -> list:
    """A finder for every ``ITEMS_A_PASS`` items, one at least."""
    finders, block = [], []

    def add() -> None:
        texts = [r["text"] for r in block]
        finders.append(_finder([r["item_id"] for r in block], texts, radius, least))

    for row in items.select("item_id", "text").toLocalIterator():
        block.append(row)
        if len(block) == ITEMS_A_PASS:
            add()
            block = []
    if block or not finders:
        add()
    return finders


def _keeper(run, at: int):
    """Rows in whose text nothing is found; ``run`` gives a batch for each batch."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def texts() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                held.append(batch)
                row = pa.array(np.arange(batch.num_rows))
                yield pa.RecordBatch.from_arrays([row, batch.column(at).cast(pa.string())], names=["doc_id", "text"])

        for found in run(texts()):
            batch = held.pop()
            clean = np.ones(batch.num_rows, bool)
            clean[found.column(0).to_numpy()] = False
            yield batch.filter(pa.array(clean))

    return keep


def without_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    least: float = SIMILARITY,
    radius: int = RADIUS,
) -> DataFrame:
    """The documents in which no passage like an item is found, columns as they are.

    Every row is judged by its own text, whatever its id: rows without an id, and rows
    that share one with a leaking row, stay if they are clean.  No join and no shuffle.
    """
    at = docs.columns.index(text_col)
    for run in _finders(items, radius, least):
        docs = docs.mapInArrow(_keeper(run, at), docs.schema)
    return docs


@query("op1_decontaminate")
def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return find_leaks(load(spark, folder, "documents"), load(spark, folder, "benchmark"))
