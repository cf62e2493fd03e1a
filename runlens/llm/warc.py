"""WARC archives compressed record by record with a dictionary of their own.

Each writing task makes archives in the shared folder: a leading skippable frame holds a
Zstandard dictionary built from the archive's first records, and every record is one
Zstandard frame, so a reader can start at any record.  Of rows with equal payloads the
one with the largest page id is written as a response and the others as revisits of it.

Null html is an empty payload.  Rows that share page id and payload are all responses; a
row without a page id revisits an equal payload that has one.  A null url is left out.
An empty table gives no archives and reads back as no rows.  Columns other than the three
named are not archived.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from runlens.llm.registry import query
from runlens.llm.shared import file_system, load, new_folder
from runlens.operators.skew import lookup_join

# Fixed values of the formats.
SKIPPABLE = 0x184D2A5D
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"

DICTIONARY_BYTES = 64 << 10
#: Records an archive's dictionary is built from: the first ones, up to so many bytes.
SAMPLE_BYTES = 4 << 20
#: An archive is closed when it has grown to this size.
ARCHIVE_BYTES = 256 << 20
CAPTURED = "2024-01-01T00:00:00Z"
LEVEL = 3
_READ = 256 << 10

MANIFEST = "path string, records long, bytes long"
READ_BACK = (
    "page_id long, payload_bytes long, payload_digest string, record_type string, "
    "refers_to long, url string"
)


def _base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def _header_text(value: str) -> str:
    """A value that fits on one header line."""
    return "".join(c if c.isprintable() and c != " " else "%%%02X" % ord(c) for c in value)


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, refers: int | None, revisit: bool
) -> bytes:
    """One WARC record; a revisit holds the HTTP head only."""
    head = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = head if revisit else head + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{RECORD_ID}{'' if page_id is None else page_id}>",
        f"WARC-Date: {CAPTURED}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_header_text(url)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD_ID}{refers}>"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def build_dictionary(samples: list[bytes]) -> zstandard.ZstdCompressionDict:
    """Trained on the samples; too few to train on become the dictionary's own content."""
    if len(samples) >= 8:
        try:
            return zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=512, d=8)
        except zstandard.ZstdError:
            pass
    content = b"".join(samples)[:DICTIONARY_BYTES].ljust(8, b"\0")
    return zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)


class Archive:
    """One file: the dictionary in a skippable frame, then a frame for each record."""

    def __init__(self, root: str) -> None:
        self.path = f"{root}/{uuid.uuid4().hex}.warc.zst"
        self.held: list[bytes] = []
        self.held_bytes = self.records = self.bytes = 0
        self.out = self.compressor = None

    def add(self, raw: bytes) -> None:
        self.records += 1
        if self.compressor is not None:
            self._put(self.compressor.compress(raw))
            return
        self.held.append(raw)
        self.held_bytes += len(raw)
        if self.held_bytes >= SAMPLE_BYTES:
            self._start()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def _start(self) -> None:
        dictionary = build_dictionary(self.held)
        system, path = file_system(self.path)
        self.out = system.open_output_stream(path, compression=None)
        content = dictionary.as_bytes()
        self._put(struct.pack("<II", SKIPPABLE, len(content)) + content)
        self.compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary)
        for raw in self.held:
            self._put(self.compressor.compress(raw))
        self.held = []

    def close(self) -> tuple[str, int, int]:
        if self.compressor is None:
            self._start()
        self.out.close()
        return self.path, self.records, self.bytes


def _writer(root: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, archive = [], None
        for batch in batches:
            for page, url, html, sha, refers, revisit in zip(*(c.to_pylist() for c in batch.columns)):
                archive = archive or Archive(root)
                payload = (html or "").encode()
                archive.add(record(page, url, payload, _base32(sha), refers, revisit))
                if archive.bytes >= ARCHIVE_BYTES:
                    done.append(archive.close())
                    archive = None
        if archive is not None:
            done.append(archive.close())
        columns = list(zip(*done)) if done else [(), (), ()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64()))],
            names=["path", "records", "bytes"],
        )

    return write


def shared_uri(spark: SparkSession, folder: str) -> str:
    """The folder with its file system named, made if it isn't there."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.mkdirs(path)
    full = system.makeQualified(path).toString()
    return full.replace("file:/", "file:///", 1) if not full.startswith("file:///") else full


def write_archives(pages: DataFrame, folder: str, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``(page_id, url, html)`` rows; returns the written archives, one row each.

    Payload digests alone are aggregated to find the responses; a lost task's archive is
    in no row of the result, so a reader never sees it.
    """
    spark = pages.sparkSession
    root = shared_uri(spark, f"{folder}/archives")
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        html.alias("html"),
        F.sha1(html.cast("binary")).alias("sha"),
    )
    sizes = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.sha1(html.cast("binary")).alias("sha"),
        F.octet_length(html).alias("size"),
    )
    copies = (
        sizes.filter(F.col("size") >= min_revisit_bytes)
        .groupBy("sha")
        .agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies"))
        .filter("copies > 1 AND refers_to IS NOT NULL")
        .drop("copies")
    )
    revisit = F.col("refers_to").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("refers_to"))
    copies.write.parquet(f"{folder}/copies")
    shared = spark.read.schema(copies.schema).parquet(f"{folder}/copies")
    # Payloads stay where they are read as long as the repeated digests are few enough.
    found = lookup_join(rows, shared, ["sha"], "left").select(
        "page_id", "url", "html", "sha", "refers_to", revisit.alias("revisit")
    )
    found.mapInArrow(_writer(root), MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def frames(path: str) -> Iterator[bytes]:
    """The records of an archive in turn, reading it piece by piece."""
    system, name = file_system(path)
    with system.open_input_stream(name, compression=None) as source:
        magic, size = struct.unpack("<II", source.read(8))
        if magic != SKIPPABLE:
            raise ValueError(f"no dictionary frame at the start of {path}")
        content = source.read(size)
        decoder = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
        buffer = source.read(_READ)
        while buffer:
            frame, parts = decoder.decompressobj(), []
            while True:
                parts.append(frame.decompress(buffer))
                if frame.eof:
                    break
                buffer = source.read(_READ)
                if not buffer:
                    raise ValueError(f"{path} ends inside a record")
            yield b"".join(parts)
            buffer = frame.unused_data or source.read(_READ)


def parse(raw: bytes) -> tuple:
    """A record as (page id, payload bytes, digest, type, refers to, url), payload checked."""
    head, _, block = raw.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = block[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    stated = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(http.rpartition(b"Content-Length: ")[2])
    revisit = fields["WARC-Type"] == "revisit"
    if not revisit:
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        if digest != stated or len(payload) != size:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    number = lambda name: fields[name][1:-1].removeprefix(RECORD_ID)
    own = number("WARC-Record-ID")
    return (
        int(own) if own else None,
        size,
        stated,
        fields["WARC-Type"],
        int(number("WARC-Refers-To")) if revisit else None,
        fields.get("WARC-Target-URI"),
    )


def read_archives(archives: DataFrame) -> DataFrame:
    """Every record of the archives named in the column ``path``."""
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) if rows else [()] * len(names)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=names
        )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for raw in frames(path):
                    rows.append(parse(raw))
                    if len(rows) == 4096:
                        yield as_batch(rows)
                        rows = []
                yield as_batch(rows)

    many = max(1, archives.count())
    return archives.select("path").repartition(many).mapInArrow(read, READ_BACK)


@query("op2_warc_dictionary")
def op2_warc_dictionary(spark: SparkSession, folder: str) -> DataFrame:
    """Write all pages, read the archives back."""
    archives = write_archives(load(spark, folder, "pages"), new_folder(spark, "warc"))
    return read_archives(archives).drop("url")
