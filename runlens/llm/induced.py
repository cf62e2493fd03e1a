"""Induced suffix sorting of one shard of text, with queues that spill to disk.

Suffixes are typed S or L by their first differing byte.  The leftmost S suffixes are
sorted by inducing from their buckets, named by equal substrings, and sorted by name on
names of doubled reach until names differ or reach far enough; from their order all other
suffixes are induced, L from the smallest bucket up, S from the largest down.  The queue
of a bucket takes suffixes in the order in which they are found and gives them back in
batches; beyond a bound it keeps them in a file that is gone when the task ends.
"""

from __future__ import annotations

import tempfile
from collections import defaultdict

import numpy as np

from runlens.llm.bytetext import span_hasher

#: Bytes of queued suffixes held in memory before queues go to disk.
QUEUE_BYTES = 4 << 20


class BucketQueues:
    """A priority queue by first byte: arrays of suffixes, in the order they were added."""

    def __init__(self, limit: int = QUEUE_BYTES) -> None:
        self.limit, self.held = limit, 0
        self.parts: dict[int, list] = defaultdict(list)
        self.file = None

    def push(self, buckets: np.ndarray, suffixes: np.ndarray) -> None:
        """Add suffixes to their buckets; within a bucket the given order holds."""
        if not len(suffixes):
            return
        order = np.argsort(buckets, kind="stable")
        buckets, suffixes = buckets[order], suffixes[order]
        cuts = np.flatnonzero(buckets[1:] != buckets[:-1]) + 1
        for bucket, part in zip(buckets[np.append(0, cuts)].tolist(), np.split(suffixes, cuts)):
            self.parts[bucket].append(part)
        self.held += suffixes.nbytes
        if self.held > self.limit:
            self._spill()

    def _spill(self) -> None:
        if self.file is None:
            self.file = tempfile.TemporaryFile()
        self.file.seek(0, 2)
        for parts in self.parts.values():
            for i, part in enumerate(parts):
                if isinstance(part, np.ndarray):
                    at = self.file.tell()
                    self.file.write(part.tobytes())
                    parts[i] = (at, len(part), part.dtype)
        self.held = 0

    def pop(self, bucket: int) -> np.ndarray:
        """Everything in a bucket, in order; later additions start it anew."""
        found = []
        for part in self.parts.pop(bucket, ()):
            if not isinstance(part, np.ndarray):
                at, count, dtype = part
                self.file.seek(at)
                part = np.frombuffer(self.file.read(count * dtype.itemsize), dtype)
            else:
                self.held -= part.nbytes
            found.append(part)
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def close(self) -> None:
        if self.file is not None:
            self.file.close()


def _is_s(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next; the last one (the sentinel) is."""
    n = len(text)
    step = np.sign(np.diff(text.astype(np.int32)))
    at = np.where(step != 0, np.arange(n - 1), n)
    ahead = np.minimum.accumulate(at[::-1])[::-1]
    kind = np.ones(n, bool)
    kind[:-1] = step[np.minimum(ahead, n - 2)] > 0
    return kind


def _induce(text: np.ndarray, is_s: np.ndarray, lms: np.ndarray, limit: int) -> np.ndarray:
    """All suffixes in order, given the leftmost S suffixes in order within buckets."""
    top = int(text.max()) + 1
    starts = BucketQueues(limit)
    starts.push(text[lms], lms)
    queue, larger = BucketQueues(limit), BucketQueues(limit)
    for c in range(top):
        batch = queue.pop(c)
        fixed = starts.pop(c)
        while True:
            if len(batch):
                larger.push(np.full(len(batch), c, text.dtype), batch)
            source = batch if len(batch) else fixed
            before = source[source > 0] - 1
            before = before[~is_s[before]]
            first = text[before]
            queue.push(first[first != c], before[first != c])
            if len(batch):
                batch = before[first == c]
            else:
                break
    order = []
    queue.close()
    starts.close()
    queue = BucketQueues(limit)
    for c in range(top - 1, -1, -1):
        batch = queue.pop(c)
        small = [batch]
        while len(batch):
            before = batch[batch > 0] - 1
            before = before[is_s[before]]
            first = text[before]
            queue.push(first[first != c], before[first != c])
            batch = before[first == c]
            small.append(batch)
        own = larger.pop(c)
        back = own[::-1]
        before = back[back > 0] - 1
        before = before[is_s[before]]
        queue.push(text[before], before)
        order += [*(b for b in small), back]
    queue.close()
    larger.close()
    # The sentinel is the smallest suffix, and none induces it.
    return np.concatenate([*order, [len(text) - 1]])[::-1]


def suffix_order(data: np.ndarray, depth: int, limit: int = QUEUE_BYTES) -> np.ndarray:
    """Starts of all suffixes of ``data``, sorted by their first ``depth`` bytes at least."""
    n = len(data)
    if n < 2:
        return np.arange(n)
    text = np.zeros(n + 1, np.uint16)
    text[:n] = data
    text[:n] += 1
    is_s = _is_s(text)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(lms) > 1:
        first = _induce(text, is_s, lms, limit)
        place = np.full(n + 1, -1, np.int64)
        place[lms] = np.arange(len(lms))
        found = place[first]
        found = found[found >= 0]
        names = _names(text, lms, found)
        lms = lms[_by_names(names, depth)]
    return _induce(text, is_s, lms, limit)[1:]


def _names(text: np.ndarray, lms: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Equal numbers for equal substrings between neighbours, in their order."""
    low, high = span_hasher((text & 0xFF).astype(np.uint8)), text >> 8
    end = np.append(lms[1:] + 1, len(text))
    key = low(lms, end) ^ (high[lms].astype(np.uint64) << np.uint64(17))
    size = end - lms
    a, b = found[:-1], found[1:]
    fresh = np.append(True, (key[a] != key[b]) | (size[a] != size[b]))
    names = np.empty(len(lms), np.int64)
    names[found] = np.cumsum(fresh) - 1
    return names


def _by_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names; two names span two bytes or more."""
    rank, reach = names, 1
    while True:
        ahead = np.full(len(rank), -1, np.int64)
        ahead[: max(0, len(rank) - reach)] = rank[reach:]
        order = np.lexsort((ahead, rank))
        if 2 * reach >= depth:
            return order
        a, b = order[:-1], order[1:]
        fresh = np.append(True, (rank[a] != rank[b]) | (ahead[a] != ahead[b]))
        new = np.empty(len(rank), np.int64)
        new[order] = np.cumsum(fresh) - 1
        if fresh.all():
            return order
        rank, reach = new, 2 * reach


def same_prefix(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether each sorted suffix shares its first ``depth`` bytes with the one before."""
    hashes = span_hasher(data)
    long = np.flatnonzero(order + depth <= len(data))
    prefix = np.zeros(len(order), np.uint64)
    prefix[long] = hashes(order[long], order[long] + depth)
    has = order + depth <= len(data)
    same = np.zeros(len(order), bool)
    same[1:] = has[1:] & has[:-1] & (prefix[1:] == prefix[:-1])
    return same
