"""Removal of repeated byte strings, by induced sorting of the places where texts may agree.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts earlier: in a
document with a smaller id, or earlier in the same document.

1. Anchors.  Every string of ``LENGTH`` bytes has an anchor, the smallest hash of the runs
   of ``CORE`` bytes in it, at the same place in each of its copies.  All strings with one
   anchor lie in a context of bounded size around it.  Anchors are grouped by their run:
   where a context is that of an earlier anchor, all of it goes, and a context whose run
   occurs in no other context has no copy.  Equal contexts of a batch are reduced to the
   first before the shuffle.
2. Shards.  The contexts left, those that share a run but differ, are gathered by run into
   shards, and the suffixes of a shard are put in order by induced sorting
   (``induced.py``), whose queues spill to disk.  Neighbours that share ``LENGTH`` bytes are
   copies; all but the first go.  The contexts of a run that has more of them than
   ``HOT`` are not gathered: their strings meet by hash, pre-aggregated.
3. The ranges found are joined with the texts and cut out.

Null and empty texts have no bytes.  Texts are whole; strings never cross documents.
Repeated rows are one document.  Rows that share an id but not their text share their
ranges, cut to their length.  Rows without an id are not compared and lose nothing.  An
empty table gives no rows.  Columns other than the id and the text are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from runlens.llm.bytetext import Rows, buffers, chunks, mix, span_hasher
from runlens.llm.induced import same_prefix, suffix_order
from runlens.llm.registry import query
from runlens.llm.shared import load, new_folder

LENGTH = 100
CORE = 32
#: Contexts of one run that are still sorted in a shard.
HOT = 5000
#: Bytes of contexts in a shard, but for a last run that goes beyond it.
SHARD_BYTES = 1 << 20
#: A byte that no UTF-8 text holds.
_MARK = 0xFF


def anchors(rows: Rows, length: int, core: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row, place in the row, run hash and context hash of every anchor of some texts."""
    data, n, width = rows.data, len(rows.data), length - core + 1
    none = np.zeros(0, np.int64)
    if n < length:
        return none, none, none.astype(np.uint64), none.astype(np.uint64)
    hashes = span_hasher(data)
    places = np.arange(n - core + 1)
    runs = hashes(places, places + core)
    least, reach = runs, 1
    while 2 * reach <= width:
        least, reach = np.minimum(least[:-reach], least[reach:]), 2 * reach
    if reach < width:
        least = np.minimum(least[: len(least) - width + reach], least[width - reach :])
    sizes = np.diff(rows.offsets)
    row_of = np.repeat(np.arange(rows.count), sizes)
    starts = np.flatnonzero(places[: len(least)] + length <= rows.offsets[row_of[: len(least)] + 1])
    # A string's anchor is the first place of its least hash; strings in a row mostly share it.
    low = least[starts]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (low[1:] != low[:-1]) | (starts[1:] != starts[:-1] + 1)
    head, want = starts[fresh], low[fresh]
    last = np.append(starts[np.flatnonzero(fresh)[1:] - 1], starts[-1:])
    found, todo = [], np.arange(len(head))
    at = head.copy()
    while len(todo):
        good = runs[at[todo]] == want[todo]
        found.append(at[todo[good]])
        # Strings that start beyond this place have a later anchor of the same hash.
        beyond = good & (last[todo] > at[todo])
        at[todo] += 1
        todo = todo[~good | beyond]
    at = np.unique(np.concatenate(found)) if found else none
    row = row_of[at]
    place = at - rows.offsets[row]
    first, end = context(place, sizes[row], length, core)
    base = rows.offsets[row]
    shape = mix((place - first).astype(np.uint64) << np.uint64(32) | (end - place).astype(np.uint64))
    return row, place, runs[at], mix(hashes(base + first, base + end) ^ shape)


def context(place: np.ndarray, size: np.ndarray, length: int, core: int) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text that strings with an anchor at ``place`` can cover."""
    return np.maximum(place - (length - core), 0), np.minimum(place + length, size)


_ANCHORS = "run long, context long, doc_id long, place long, size long, copy boolean"


def _anchor_maker(length: int, core: int):
    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            parts = []
            for rows in chunks(batch.column(1), 1 << 20):
                row, place, run, around = anchors(rows, length, core)
                size = np.diff(rows.offsets)[row]
                parts.append((run, around, ids[rows.first + row], place, size))
            run, around, doc, place, size = (
                np.concatenate([p[i] for p in parts] or [np.zeros(0, np.int64)]) for i in range(5)
            )
            run, around = run.astype(np.uint64), around.astype(np.uint64)
            order = np.lexsort((place, doc, around, run))
            run, around, doc, place, size = (x[order] for x in (run, around, doc, place, size))
            fresh = np.ones(len(run), bool)
            fresh[1:] = (run[1:] != run[:-1]) | (around[1:] != around[:-1])
            group = np.cumsum(fresh) - 1
            first = np.flatnonzero(fresh)
            copy = (doc != doc[first][group]) | (place != place[first][group])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(run.view(np.int64)),
                    pa.array(around.view(np.int64)),
                    pa.array(doc.astype(np.int64)),
                    pa.array(place.astype(np.int64)),
                    pa.array(size.astype(np.int64)),
                    pa.array(copy),
                ],
                names=["run", "context", "doc_id", "place", "size", "copy"],
            )

    return make


_JUDGED = "doc_id long, place long, size long, run long, copy boolean"


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by run, context and place: copies of earlier contexts, and open ones.

    A context is open if its run has another one.  Only the latest first-of-its-context
    row is carried from batch to batch.
    """
    names = ["run", "context", "doc_id", "place", "size"]
    held: np.ndarray | None = None
    held_open = False
    for batch in batches:
        known = batch.column("copy").to_numpy(zero_copy_only=False)
        sure = batch.filter(pa.array(known))
        table = np.stack([c.to_numpy() for c in (batch.filter(pa.array(~known)).column(n) for n in names)])
        start = 0
        if held is not None:
            table, start = np.concatenate([held[:, None], table], axis=1), 1
        if not table.shape[1]:
            yield _judged(sure, np.zeros((5, 0), np.int64), np.zeros((5, 0), np.int64))
            continue
        run, around, doc, place, _ = table
        fresh = np.ones(len(run), bool)
        fresh[1:] = (run[1:] != run[:-1]) | (around[1:] != around[:-1])
        first = np.flatnonzero(fresh)
        head = first[np.cumsum(fresh) - 1]
        copy = (doc != doc[head]) | (place != place[head])
        own = run[first]
        several = np.zeros(len(first), bool)
        several[1:] |= own[1:] == own[:-1]
        several[:-1] |= own[1:] == own[:-1]
        open_now = several.copy()
        if start and held_open:
            open_now[0] = False  # told already
        last_open = bool(several[-1]) or (len(first) == 1 and start == 1 and held_open)
        copy[:start] = False
        yield _judged(sure, table[:, copy], table[:, first[open_now]])
        held, held_open = table[:, first[-1]].copy(), last_open


def _judged(sure: pa.RecordBatch, copies: np.ndarray, open_: np.ndarray) -> pa.RecordBatch:
    names = ["doc_id", "place", "size", "run"]
    both = np.concatenate([copies, open_], axis=1)[[2, 3, 4, 0]]
    columns = [
        pa.concat_arrays([sure.column(n), pa.array(np.ascontiguousarray(x))])
        for n, x in zip(names, both)
    ]
    flags = np.zeros(sure.num_rows + both.shape[1], bool)
    flags[: sure.num_rows + copies.shape[1]] = True
    return pa.RecordBatch.from_arrays([*columns, pa.array(flags)], names=[*names, "copy"])


_CONTEXTS = "run long, hot boolean, doc_id long, first long, bytes binary"


def _cutter(length: int, core: int):
    """The bytes around the open anchors of each text."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            out: list[tuple] = []
            for r, (doc, found) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("found").to_pylist())):
                text = data[offsets[r] : offsets[r + 1]].tobytes()
                for a in found:
                    first, end = context(np.int64(a["place"]), np.int64(len(text)), length, core)
                    out.append((a["run"], a["hot"], doc, int(first), text[int(first) : int(end)]))
            columns = list(zip(*out)) if out else [()] * 5
            types = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["run", "hot", "doc_id", "first", "bytes"],
            )

    return cut


_RANGES = "doc_id long, start long, end long"


def _ranges(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(x).astype(np.int64)) for x in (doc, start, end)],
        names=["doc_id", "start", "end"],
    )


def sort_shard(
    docs: np.ndarray, firsts: np.ndarray, parts: list[bytes], length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of strings of a shard's contexts that have an earlier copy in the shard."""
    sizes = np.array([len(p) + 1 for p in parts], np.int64)
    data = np.frombuffer(b"".join(p + bytes([_MARK]) for p in parts), np.uint8)
    base = np.cumsum(sizes) - sizes
    owner = np.repeat(np.arange(len(parts)), sizes)
    inside = np.arange(len(data)) + length < (base + sizes)[owner]
    order = suffix_order(data, length)
    order = order[inside[order]]
    if not len(order):
        none = np.zeros(0, np.int64)
        return none, none, none
    group = np.cumsum(~same_prefix(data, order, length)) - 1
    doc = docs[owner[order]]
    start = firsts[owner[order]] + order - base[owner[order]]
    # The first of each group by document and start.
    by = np.lexsort((start, doc, group))
    head = np.flatnonzero(np.append(True, np.diff(group[by]) != 0))
    least = by[head][group]
    later = (doc != doc[least]) | (start != start[least])
    gone = np.sort(order[later])
    if not len(gone):
        return gone, gone, gone
    # Strings at successive places of a context make one range.
    cut = np.append(True, (np.diff(gone) != 1) | (np.diff(owner[gone]) != 0))
    a, b = gone[cut], gone[np.append(np.flatnonzero(cut)[1:] - 1, len(gone) - 1)]
    own = owner[a]
    shift = firsts[own] - base[own]
    return docs[own], a + shift, b + shift + length


def _sharder(length: int, shard_bytes: int):
    """Contexts sorted by run, gathered into shards that never split a run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[int] = []
        firsts: list[int] = []
        parts: list[bytes] = []
        held, last = 0, None

        def sorted_() -> pa.RecordBatch:
            return _ranges(*sort_shard(np.array(docs, np.int64), np.array(firsts, np.int64), parts, length))

        for batch in batches:
            for key, doc, first, part in zip(*(c.to_pylist() for c in batch.columns)):
                if held >= shard_bytes and key != last:
                    yield sorted_()
                    docs, firsts, parts, held = [], [], [], 0
                docs.append(doc)
                firsts.append(first)
                parts.append(part)
                held, last = held + len(part) + 1, key
        if parts:
            yield sorted_()

    return run


def _windows(length: int):
    """Every string of the contexts of hot runs, by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in chunks(batch.column("bytes")):
                hashes = span_hasher(rows.data)
                sizes = np.maximum(np.diff(rows.offsets) - length + 1, 0)
                row = np.repeat(np.arange(rows.count), sizes)
                at = np.arange(len(row)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                base = rows.offsets[row] + at
                doc = batch.column("doc_id").to_numpy()[rows.first + row]
                first = batch.column("first").to_numpy()[rows.first + row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes(base, base + length).view(np.int64)), pa.array(doc), pa.array(first + at)],
                    names=["string", "doc_id", "start"],
                )

    return run


def repeated_ranges(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    core: int = CORE,
    hot: int = HOT,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``(doc_id, start, end)`` byte ranges that repeat earlier ones; they may overlap."""
    spark = docs.sparkSession
    folder = new_folder(spark, "suffixes")
    known = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).filter("doc_id IS NOT NULL")
    made = known.mapInArrow(_anchor_maker(length, core), _ANCHORS)
    # Rows known to be copies need no company and go anywhere.
    route = F.when(F.col("copy"), F.xxhash64("doc_id", "place")).otherwise(F.col("run"))
    made.repartition(route).sortWithinPartitions("run", "context", "doc_id", "place").mapInArrow(
        _judge, _JUDGED
    ).write.parquet(f"{folder}/judged")
    judged = spark.read.schema(_JUDGED).parquet(f"{folder}/judged")
    reach = F.lit(length - core)
    zero = F.lit(0).cast("long")
    whole = judged.filter("copy").select(
        "doc_id",
        F.greatest(F.col("place") - reach, zero).alias("start"),
        F.least(F.col("place") + length, F.col("size")).alias("end"),
    )
    left = judged.filter("NOT copy")
    many = left.groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > hot)
    flagged = left.join(many, "run", "left").select(
        "doc_id", F.struct("place", "run", F.col("n").isNotNull().alias("hot")).alias("a")
    )
    wanted = flagged.groupBy("doc_id").agg(F.collect_list("a").alias("found"))
    contexts = known.join(wanted, "doc_id").mapInArrow(_cutter(length, core), _CONTEXTS)
    contexts.write.parquet(f"{folder}/contexts")
    contexts = spark.read.schema(_CONTEXTS).parquet(f"{folder}/contexts")
    shards = (
        contexts.filter("NOT hot")
        .select("run", "doc_id", "first", "bytes")
        .repartition("run")
        .sortWithinPartitions("run")
        .mapInArrow(_sharder(length, shard_bytes), _RANGES)
    )
    strings = contexts.filter("hot").mapInArrow(
        _windows(length), "string long, doc_id long, start long"
    )
    heads = strings.groupBy("string").agg(
        F.min(F.struct("doc_id", "start")).alias("head"), F.count(F.lit(1)).alias("n")
    )
    later = strings.join(heads.filter("n > 1"), "string").filter(
        F.struct("doc_id", "start") > F.col("head")
    )
    met = later.select("doc_id", "start", (F.col("start") + length).alias("end"))
    return whole.unionByName(shards).unionByName(met)


_CUT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
)


def _remover(keep: bool):
    """Cut the ranges out of the texts; the rest as bytes, or its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = buffers(batch.column("text"))
            out = []
            for r, (doc, found) in enumerate(zip(batch.column("doc_id").to_pylist(), batch.column("ranges").to_pylist())):
                text = data[offsets[r] : offsets[r + 1]]
                step = np.zeros(len(text) + 1, np.int32)
                for a in found or ():
                    step[min(a["start"], len(text))] += 1
                    step[min(a["end"], len(text))] -= 1
                gone = np.cumsum(step)[:-1] > 0
                spans = int((gone & ~np.append(False, gone[:-1])).sum())
                rest = text[~gone].tobytes()
                kept = rest if keep else hashlib.sha256(rest).digest()
                out.append((doc, len(text), int(gone.sum()), spans, kept))
            columns = list(zip(*out)) if out else [()] * 5
            types = [pa.int64()] * 4 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
    **settings: int,
) -> DataFrame:
    """Every row's byte counts and what is kept of its text: bytes, or their SHA-256."""
    found = repeated_ranges(docs, id_col, text_col, **settings)
    ranges = found.groupBy("doc_id").agg(F.collect_list(F.struct("start", "end")).alias("ranges"))
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    joined = source.join(ranges, "doc_id", "left").select("doc_id", "text", "ranges")
    return joined.mapInArrow(_remover(not digest), _CUT)


@query("op8_suffix_dedup")
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cut = remove_repeats(load(spark, folder, "documents"), digest=True)
    return cut.withColumn("kept_sha256", F.lower(F.hex("kept"))).drop("kept")
