"""Words, shingles and hashes of Arrow text columns, computed on whole byte buffers.

Every function works on one chunk of rows at a time, so memory follows the chunk (or the
longest single text), not the batch.  Nulls count as empty texts throughout.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20

_BASE = np.uint64(0x9E3779B97F4A7C55)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))

_SPACES = bytes([0x20, *range(0x09, 0x0E)])

#: Bytes of words that end at ASCII white space only.
SPACED = np.ones(256, bool)
SPACED[list(_SPACES)] = False

#: Bytes of words made of ASCII letters and digits and of all characters beyond ASCII.
PLAIN = np.zeros(256, bool)
PLAIN[128:] = True
for _c in b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz":
    PLAIN[_c] = True

#: A-Z to a-z; other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


_BYTE_CODES = mix(np.arange(1, 257, dtype=np.uint64))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        both = []
        for base in (_BASE, _INVERSE):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            both.append(np.cumprod(steps))
        _powers = (both[0], both[1])
    return _powers


@dataclass
class Rows:
    """Consecutive rows of a text column: one buffer and where each row starts in it."""

    first: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def count(self) -> int:
        return len(self.offsets) - 1


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all rows and the row offsets."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset :][: len(column) + 1]
    data = column.buffers()[2]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return bytes_, offsets if len(column) else np.zeros(1, np.int64)


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Rows]:
    """Whole rows, about ``limit`` bytes at a time; a longer row comes alone."""
    data, offsets = buffers(column)
    first, total = 0, len(offsets) - 1
    while first < total:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), total)
        own = offsets[first : last + 1]
        yield Rows(first, data[own[0] : own[-1]], own - own[0])
        first = last


@dataclass
class Words:
    """Words of some rows: byte spans, 64-bit hashes, and each row's slice of them."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray
    hasher: Callable[[np.ndarray, np.ndarray], np.ndarray]

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), np.diff(self.bounds))


def span_hasher(data: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """A function from span starts and ends to 64-bit hashes of the bytes between.

    Equal bytes have equal hashes wherever they lie.
    """
    up, down = _powers_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_CODES[data] * up[: len(data)], out=sums[1:])

    def hashes(start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (sums[end] - sums[start]) * down[start]
        return mix(raw ^ ((end - start).astype(np.uint64) << np.uint64(1)))

    return hashes


def words(rows: Rows, letters: np.ndarray = SPACED, lower: bool = False) -> Words:
    """Words are runs of bytes that ``letters`` marks; no word crosses a row."""
    data = LOWER[rows.data] if lower else rows.data
    inside = letters[data]
    before = np.empty_like(inside)
    after = np.empty_like(inside)
    if len(inside):
        before[1:], before[0] = inside[:-1], False
        after[:-1], after[-1] = inside[1:], False
        edges = rows.offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(inside))]
        before[edges] = False
        after[edges - 1] = False
    start = np.flatnonzero(inside & ~before)
    end = np.flatnonzero(inside & ~after) + 1
    hasher = span_hasher(data)
    return Words(start, end, hasher(start, end), np.searchsorted(start, rows.offsets), hasher)


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` successive words of a row, and each row's slice of them.

    The shingle at place ``i`` of the result of row ``r`` starts at the row's word ``i``.
    """
    counts = np.maximum(np.diff(found.bounds) - size + 1, 0)
    bounds = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(bounds[-1]) + np.repeat(found.bounds[:-1] - bounds[:-1], counts)
    total = np.zeros(len(at), np.uint64)
    for k in range(size):
        total = total * _BASE + found.hash[at + k]
    return mix(total), bounds


def texts_of(column: pa.Array) -> list[str]:
    return ["" if t is None else t for t in column.to_pylist()]
