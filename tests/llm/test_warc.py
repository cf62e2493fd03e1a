import base64
import hashlib
import io
import struct

import pytest
import zstandard

from runlens.llm.shared import drop, new_folder
from runlens.llm.warc import Archive, frames, parse, read_archives, record, write_archives

PAGES = [
    (1, "http://a/1", "<p>same</p>"),
    (2, "http://a/2", "<p>same</p>"),
    (5, None, "<p>same</p>"),
    (5, "http://a/5", "<p>same</p>"),
    (6, "http://a/6 b\r\nX: y", "<p>é ü</p>" * 50),
    (7, "http://a/7", None),
    (8, "http://a/8", ""),
    (None, "http://a/n", "<p>same</p>"),
    (None, "http://a/m", "<p>alone</p>\r\n\r\nContent-Length: 3"),
    (9, "http://a/9", "x" * 3_000_000),
]
SCHEMA = "page_id long, url string, html string"


def digest(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


def expected(pages, least):
    rows = []
    for page, _, html in pages:
        size = len((html or "").encode())
        same = [p for p, _, h in pages if digest(h) == digest(html) and p is not None]
        revisit = size >= least and len(same) > 0 and page != max(same)
        rows.append((page, size, digest(html), "revisit" if revisit else "response", max(same) if revisit else None))
    return rows


@pytest.mark.parametrize("least", [0, 5, 10**9])
def test_round_trip(spark, least):
    folder = new_folder(spark, "warc-test")
    pages = spark.createDataFrame(PAGES, SCHEMA).selectExpr("*", "'x' AS sha", "1 AS size").repartition(3)
    found = read_archives(write_archives(pages, folder, least)).collect()
    got = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found]
    assert sorted(got, key=str) == sorted(expected(PAGES, least), key=str)
    assert {r["url"] for r in found if r["page_id"] == 6} == {"http://a/6%20b%0D%0AX:%20y"}
    drop(spark, folder)


def test_empty_table(spark):
    folder = new_folder(spark, "warc-test")
    archives = write_archives(spark.createDataFrame([], SCHEMA), folder)
    assert read_archives(archives).count() == 0
    drop(spark, folder)


@pytest.mark.parametrize("count", [1, 500])
def test_any_reader_of_zstandard_finds_the_dictionary_and_the_frames(tmp_path, count):
    archive = Archive(f"file://{tmp_path}")
    raw = [record(i, f"http://a/{i}", b"<html>%d</html>" % i * 40, digest("x"), None, False) for i in range(count)]
    for one in raw:
        archive.add(one)
    path, records, size = archive.close()
    data = open(path.removeprefix("file://"), "rb").read()
    magic, length = struct.unpack("<II", data[:8])
    assert 0x184D2A50 <= magic <= 0x184D2A5F and records == count and size == len(data)
    dictionary = zstandard.ZstdCompressionDict(data[8 : 8 + length])
    reader = zstandard.ZstdDecompressor(dict_data=dictionary)
    whole = reader.stream_reader(io.BytesIO(data[8 + length :]), read_across_frames=True).read()
    assert whole == b"".join(raw)
    assert list(frames(path)) == raw


def test_a_changed_payload_is_noticed():
    raw = record(1, None, b"abc", digest("abc"), None, False)
    assert parse(raw)[1] == 3
    with pytest.raises(ValueError):
        parse(raw.replace(b"\r\n\r\nabc", b"\r\n\r\nabd"))


def test_paths_of_object_stores():
    """Spark's s3a is Arrow's s3; other schemes stay."""
    from pyarrow import fs

    from runlens.llm.shared import file_system

    system, path = file_system("file:///tmp/x")
    assert isinstance(system, fs.LocalFileSystem) and path == "/tmp/x"
    try:
        system, path = file_system("s3a://bucket/x?region=us-east-1")
    except (OSError, NotImplementedError):  # no network or no such support: the scheme was understood
        return
    assert path == "bucket/x" and type(system).__name__ == "S3FileSystem"


def test_payloads_are_not_shuffled(spark, tmp_path):
    """Repeated digests within the bound are broadcast: the writing task reads the pages."""
    from runlens.llm import shared

    before = spark.conf.get(shared.SETTING, None)
    pages = spark.createDataFrame([(i, "u", f"page {i % 7}") for i in range(50)], "page_id long, url string, html string")
    archives = write_archives(pages, shared.new_folder(spark, "warc"))
    found = {r["page_id"]: (r["record_type"], r["refers_to"]) for r in read_archives(archives).collect()}
    top = {k: max(i for i in range(50) if i % 7 == k) for k in range(7)}
    assert found == {i: ("response", None) if top[i % 7] == i else ("revisit", top[i % 7]) for i in range(50)}
    assert spark.conf.get(shared.SETTING, None) == before
