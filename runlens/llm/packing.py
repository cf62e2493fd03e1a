"""Bounded-space online packing of token ids into windows of a fixed length.

Each partition keeps a fixed number of open windows.  A document's last piece (what is
left after its full windows) goes where it leaves the least room.  When it fits nowhere,
it is cut to fill the fullest open window, which is emitted, and the rest is placed again.
Windows still open at the end of a partition are merged, a bounded number of partitions
at a time, until one group is left; only its last window may stay short.

A row gets at least the end id, so null and empty texts become one-token documents.
Repeated rows are packed each on its own, null ids stay null, an empty table gives no
rows, and columns other than the id and the text are not read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from runlens.llm.bytetext import texts_of
from runlens.llm.registry import query
from runlens.llm.shared import drop, load, new_folder
from runlens.llm.wordcache import encoder

WINDOW = 4096
OPEN_WINDOWS = 32
END_ID = 2
#: Partitions whose open windows one merging task takes.
MERGED = 64
ROWS = 8192

SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)
_FIELDS = pa.schema(
    [
        *((n, pa.int64()) for n in "doc_id start length ids_crc32 doc_tokens".split()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
        ("ids", pa.binary()),
    ]
)

# A piece is (doc id, start, ids as little-endian bytes, tokens of the document).
Piece = tuple


class Packer:
    """Open windows of one partition; full ones leave as soon as they are full."""

    def __init__(self, window: int, slots: int) -> None:
        self.window, self.slots = window, slots
        self.free: list[tuple[int, int]] = []
        self.open: dict[int, list[Piece]] = {}
        self.made = 0

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Place a piece; yields the windows that became full, as lists of pieces."""
        doc, start, ids, total = piece
        size, window = len(ids) // 4, self.window
        while size >= window:
            yield [(doc, start, ids[: 4 * window], total)]
            start, ids, size = start + window, ids[4 * window :], size - window
        while size:
            at = bisect_left(self.free, (size, -1))
            if at < len(self.free):
                room, key = self.free.pop(at)
            elif len(self.free) < self.slots:
                room, key, self.made = window, self.made, self.made + 1
                self.open[key] = []
            else:
                room, key = self.free.pop(0)
            take = min(size, room)
            self.open[key].append((doc, start, ids[: 4 * take], total))
            start, ids, size = start + take, ids[4 * take :], size - take
            if take == room:
                yield self.open.pop(key)
            else:
                insort(self.free, (room - take, key))

    def rest(self) -> Iterator[list[Piece]]:
        for _, key in self.free:
            yield self.open.pop(key)


def _rows(windows: Iterable[tuple[list[Piece], bool]], first: int) -> Iterator[pa.RecordBatch]:
    """Windows as rows; those still open (True) carry their ids."""
    columns: list[list] = [[] for _ in _FIELDS]
    for number, (pieces, is_open) in enumerate(windows):
        offset = 0
        for doc, start, ids, total in pieces:
            row = (doc, start, len(ids) // 4, zlib.crc32(ids), total, first + number, offset)
            for column, value in zip(columns, (*row, bytes(ids) if is_open else None)):
                column.append(value)
            offset += len(ids) // 4
        if len(columns[0]) >= ROWS:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(columns, _FIELDS)], schema=_FIELDS
            )
            columns = [[] for _ in _FIELDS]
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, _FIELDS)], schema=_FIELDS
    )


def _first_id(level: int, number: int) -> int:
    """Start of the sequence ids of one task: 2 ** 32 for each of 2 ** 27 tasks a level."""
    return (level << 59) | (number << 32)


def _pack(pieces: Iterable[Piece], window: int, slots: int) -> Iterator[tuple[list[Piece], bool]]:
    packer = Packer(window, slots)
    for piece in pieces:
        for full in packer.add(piece):
            yield full, False
    for left in packer.rest():
        yield left, True


def pack(
    df: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    slots: int = OPEN_WINDOWS,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: document, start, length, CRC of its ids, sequence and offset.

    Nothing is shuffled but the open windows (at most ``slots`` a partition).
    """
    spark = df.sparkSession
    end = end_id.to_bytes(4, "little")
    source = df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )

    def first_level(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer)

        def pieces() -> Iterator[Piece]:
            for batch in batches:
                for doc, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                    ids = encode(text) + end
                    yield doc, 0, ids, len(ids) // 4

        yield from _rows(_pack(pieces(), window, slots), _first_id(0, TaskContext.get().partitionId()))

    folder = new_folder(spark, "packing")
    source.mapInArrow(first_level, SCHEMA).write.parquet(f"{folder}/0")
    levels = [f"{folder}/0"]
    left = _task_of(spark, levels[-1])
    while left:
        level = len(levels)
        groups = left // MERGED + 1
        opened = spark.read.schema(SCHEMA).parquet(levels[-1]).filter("ids IS NOT NULL")
        task = F.shiftrightunsigned(F.col("sequence_id"), 32).bitwiseAND(F.lit((1 << 27) - 1))
        group = F.floor(task / MERGED).cast("long")
        merged = opened.withColumn("merge_group", group).groupBy("merge_group").applyInArrow(
            _merger(level, window), SCHEMA
        )
        merged.write.parquet(f"{folder}/{level}")
        levels.append(f"{folder}/{level}")
        left = groups - 1
    parts = [spark.read.schema(SCHEMA).parquet(p) for p in levels]
    result = parts[-1]
    for part in parts[:-1]:
        result = result.unionByName(part.filter("ids IS NULL"))
    return result.drop("ids")


def _task_of(spark: SparkSession, path: str) -> int:
    """The largest task number whose windows are still open, plus one; 0 if none are."""
    top = spark.read.schema(SCHEMA).parquet(path).filter("ids IS NOT NULL")
    row = top.agg(F.max("sequence_id").alias("top")).first()
    return 0 if row["top"] is None else ((row["top"] >> 32) & ((1 << 27) - 1)) + 1


def _merger(level: int, window: int) -> Callable[[tuple, pa.Table], pa.Table]:
    """Merge the open windows of some partitions: all but the last become full."""

    def merge(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        columns = [table.column(n).to_pylist() for n in ("doc_id", "start", "ids", "doc_tokens")]
        found = _rows(_pack(zip(*columns), window, 1), _first_id(level, key[0].as_py()))
        return pa.Table.from_batches(list(found), schema=_FIELDS)

    return merge


def padding(pieces: DataFrame, window: int = WINDOW) -> DataFrame:
    """Sequences, tokens and the share of padding when short sequences are filled up."""
    by = pieces.groupBy("sequence_id").agg(F.sum("length").alias("tokens"))
    return by.agg(
        F.count(F.lit(1)).alias("sequences"),
        F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"),
        (1 - F.sum("tokens") / (window * F.count(F.lit(1)))).alias("padding"),
    )


@query("op3_pack_windows")
def op3_pack_windows(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    documents = load(spark, folder, "documents")
    return pack(documents, public_tokenizers.path("word_bpe_49k.json"))
