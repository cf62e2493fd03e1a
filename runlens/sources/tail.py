"""Streaming source over growing text files: every appended line arrives once.

The stream offset is a ledger of file *generations*.  Each holds a name of its own, the
inode (0 where there are none), the length and hash of a prefix that grows with the file,
the last path and a byte position just after a line end, so an unfinished last line waits
for its end.  A file continues a generation if it still begins with that prefix, is at
least as long as the position, and has the generation's inode, or else its path, or else
(no inodes: HDFS, object stores) is a new path while the generation's own path is gone.
So a renamed file goes on where it was, a path whose file was replaced or cut starts anew,
and a new file never takes the place of one that is still there, however alike they begin.
Generations whose file is gone stay in the ledger, the last ``keepMissing`` of them, so a
file that comes back unchanged gives nothing again.

With ``maxBytes`` a micro-batch takes about so many bytes, shared out evenly among the
files that have more; a longer line is taken whole.  Spark tells a new or restarted source
nothing when it asks for the next offset, so with the option ``ledger`` (a folder that
nothing else uses, given from the first start on) each offset is also written there before
Spark hears of it, and read back after a restart: the first micro-batch then takes two
budgets at most.  Without it there is no budget, and a file that is away during a restart
is forgotten.

Files must be on storage that every executor can read (any file system Arrow opens:
local or mounted paths, ``hdfs://``, ``s3://`` …).  A path that does not exist yet is
an empty file.

Options: ``path`` (a file, a directory, or several separated by commas), ``splitBytes``
(the size of one input partition, 64 MB by default), ``maxBytes``, ``ledger`` and
``keepMissing`` (1000).

Rows: ``file``, ``range`` (start of the input partition), ``pos`` (byte position of
the line in the file), ``value`` (the line without its end).
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "runlens_tail"
SCHEMA = "file STRING, range BIGINT, pos BIGINT, value STRING"
SPLIT_BYTES = 64 << 20

#: Generations of missing files that the ledger keeps, the last ones.
KEEP_MISSING = 1000

# Longest prefix by which a file is known.
_PREFIX = 64 << 10
_BLOCK = 1 << 20
_ARROW = pa.schema(
    [("file", pa.string()), ("range", pa.int64()), ("pos", pa.int64()), ("value", pa.string())]
)


@dataclass
class FileRange(InputPartition):
    """Lines of ``file`` that start in ``[start, end)``; ``limit`` ends the last one.

    ``first`` is the start of the whole new part of the file, which is a line start.
    """

    file: str
    first: int
    start: int
    end: int
    limit: int


def _open_fs(path: str) -> tuple[fs.FileSystem, str]:
    if "://" in path:
        # Spark says s3a where Arrow says s3.
        return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))
    path = path.removeprefix("file:")
    return fs.LocalFileSystem(), path


def _files(paths: list[str]) -> Iterator[tuple[str, int]]:
    """Path and size of every file; directories with all that lies below them."""
    for path in paths:
        system, inner = _open_fs(path)
        info = system.get_file_info(inner)
        if info.type == fs.FileType.File:
            yield path, info.size
        elif info.type == fs.FileType.Directory:
            top = inner.rstrip("/")
            for child in system.get_file_info(fs.FileSelector(inner, recursive=True)):
                below = child.path[len(top) :].lstrip("/")
                hidden = any(part.startswith((".", "_")) for part in below.split("/"))
                if child.type == fs.FileType.File and not hidden:
                    yield f"{path.rstrip('/')}/{below}", child.size


def _inode(path: str) -> int:
    """Inode of a local file, 0 elsewhere."""
    system, inner = _open_fs(path)
    return os.stat(inner).st_ino if isinstance(system, fs.LocalFileSystem) else 0


def _prefix_hash(path: str, size: int) -> str:
    system, inner = _open_fs(path)
    with system.open_input_file(inner) as f:
        return hashlib.blake2b(f.read(size), digest_size=8).hexdigest()


def _after_last_newline(path: str, size: int) -> int:
    """Byte after the last line end; only the tail of the file is read."""
    system, inner = _open_fs(path)
    with system.open_input_file(inner) as f:
        end = size
        while end > 0:
            start = max(0, end - _BLOCK)
            at = f.read_at(end - start, start).rfind(b"\n")
            if at >= 0:
                return start + at + 1
            end = start
    return 0


def _line_end(path: str, begin: int, at: int, stop: int) -> int:
    """The last line end in ``(begin, at]``, or the first one after; ``stop`` is one."""
    system, inner = _open_fs(path)
    with system.open_input_file(inner) as f:
        end = at
        while end > begin:
            low = max(begin, end - _BLOCK)
            found = f.read_at(end - low, low).rfind(b"\n")
            if found >= 0:
                return low + found + 1
            end = low
        while at < stop:
            block = f.read_at(min(_BLOCK, stop - at), at)
            found = block.find(b"\n")
            if found >= 0:
                return at + found + 1
            if not block:
                break
            at += len(block)
    return stop


@dataclass(frozen=True)
class Generation:
    """A file's place: what it is known by, where it was last, and how far it was read."""

    name: str
    inode: int
    length: int
    prefix: str
    path: str
    position: int

    @classmethod
    def of(cls, key: str, place: list) -> Generation:
        name, inode, length, prefix = key.split("-")
        return cls(name, int(inode), int(length), prefix, *place)

    @property
    def key(self) -> str:
        return f"{self.name}-{self.inode}-{self.length}-{self.prefix}"


@dataclass(frozen=True)
class _File:
    """A file as listed, with the byte after its last line end."""

    path: str
    size: int
    inode: int
    stop: int

    def continues(self, old: Generation) -> bool:
        alike = old.position <= self.stop and old.length <= self.size
        return alike and _prefix_hash(self.path, old.length) == old.prefix


def _ledger(offset: dict) -> dict[str, Generation]:
    """Generations of an offset by name, in its order."""
    return {g.name: g for g in (Generation.of(k, v) for k, v in offset.items())}


def _matched(
    files: dict[str, _File], known: list[Generation], there: set[str] | None = None
) -> dict[str, Generation]:
    """Which known generation each path continues; each is continued once.

    ``there`` has the paths of all files, if there are others.
    """
    there = set(files) if there is None else there
    found: dict[str, Generation] = {}
    open_ = {g.name: g for g in known}

    def take(path: str, candidates: list[Generation]) -> None:
        for g in candidates:
            if path not in found and g.name in open_ and files[path].continues(g):
                found[path] = open_.pop(g.name)

    by_inode: dict[int, list[Generation]] = {}
    by_path: dict[str, list[Generation]] = {}
    for g in reversed(known):  # the last ones first
        by_inode.setdefault(g.inode, []).append(g)
        by_path.setdefault(g.path, []).append(g)
    for path in sorted(files):
        if files[path].inode:
            # Its own path first, should two generations have had that inode.
            own = by_inode.get(files[path].inode, [])
            take(path, sorted(own, key=lambda g: g.path != path))
    for path in sorted(files):
        take(path, by_path.get(path, []))
    # Without inodes a renamed file is known by its beginning alone.
    moved = [g for g in reversed(known) if not g.inode and g.position]
    for path in sorted(files):
        if path not in by_path and not files[path].inode:
            take(path, [g for g in moved if g.path not in there])
    return found


class TailReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        if not options.get("path"):
            raise ValueError("the tail source needs a path")

        def option(name: str, default=None):
            return options.get(name.lower(), options.get(name, default))

        self.paths = [p.strip() for p in options["path"].split(",") if p.strip()]
        self.split = int(option("splitBytes", SPLIT_BYTES))
        self.budget = int(option("maxBytes") or 0)
        self.keep = int(option("keepMissing", KEEP_MISSING))
        self.folder = option("ledger")
        if self.budget and not self.folder:
            raise ValueError("maxBytes needs a ledger")
        self.asked = False
        # The generations as of the last offset; None until that is known.
        self.ledger: dict[str, Generation] | None = None
        self.looked: dict[str, _File] = {}
        self.held: dict[str, tuple[_File, str]] = {}
        self.written = 0

    def initialOffset(self) -> dict:
        """Spark asks for the latest offset first, and for this one at a first start."""
        if not self.asked:
            self.ledger = {}
            self._write({})
        return {}

    def latestOffset(self) -> dict:
        """``{generation: [path, position]}`` of all files and the last missing ones."""
        self.asked = True
        if self.ledger is None and self.folder:
            self.ledger = self._read()
        known = self.ledger
        files = self._look()
        # A file that is as it was last time is not read to know it.
        found = {
            path: known[name]
            for path, (file, name) in self.held.items()
            if known and name in known and files.get(path) is file
        }
        taken = {g.name for g in found.values()}
        others = {p: f for p, f in files.items() if p not in found}
        known_others = [g for g in (known or {}).values() if g.name not in taken]
        found |= _matched(others, known_others, set(files))
        starts = {
            path: found.get(path) or Generation(uuid.uuid4().hex[:12], file.inode, 0, "", path, 0)
            for path, file in files.items()
        }
        stops = self._within_budget(files, starts) if known is not None else {p: f.stop for p, f in files.items()}
        now = {}
        for path, old in starts.items():
            position = max(stops[path], old.position)
            if position:
                now[old.name] = self._grown(old, files[path], position)
        gone = [g for n, g in (known or {}).items() if n not in now and g.position]
        kept = gone[-self.keep :] if self.keep else []
        ledger = {g.name: g for g in kept} | now
        if known is not None:
            self.ledger = ledger
            self.held = {path: (files[path], old.name) for path, old in starts.items()}
        offset = {g.key: [g.path, g.position] for g in ledger.values()}
        if known is not None and ledger != known:
            self._write(offset)
        return offset

    def _look(self) -> dict[str, _File]:
        """All files; one that has not changed is not opened."""
        now = {}
        for path, size in _files(self.paths):
            try:
                inode, before = _inode(path), self.looked.get(path)
                if before is None or (before.size, before.inode) != (size, inode):
                    before = _File(path, size, inode, _after_last_newline(path, size))
                now[path] = before
            except FileNotFoundError:  # renamed or removed since it was listed
                continue
        self.looked = now
        return now

    def _grown(self, old: Generation, file: _File, position: int) -> Generation:
        """The generation at a new position, known by a longer prefix where there is one."""
        length = min(position, _PREFIX)
        if length == old.length and (old.inode, old.path) == (file.inode, file.path):
            return replace(old, position=position)
        return Generation(
            old.name, file.inode, length, _prefix_hash(file.path, length), file.path, position
        )

    def _within_budget(self, files: dict[str, _File], starts: dict[str, Generation]) -> dict[str, int]:
        """Where the next micro-batch stops in each file: an equal share for each, or all."""
        stops = {p: f.stop for p, f in files.items()}
        more = {p: f.stop - starts[p].position for p, f in files.items()}
        if not self.budget or sum(more.values()) <= self.budget:
            return stops
        left, behind = self.budget, sorted((n, p) for p, n in more.items() if n > 0)
        for i, (n, path) in enumerate(behind):
            share = max(left, 0) // (len(behind) - i)
            if n > share:
                begin = starts[path].position
                stops[path] = _line_end(path, begin, begin + share, stops[path])
            left -= stops[path] - starts[path].position
        return stops

    def _read(self) -> dict[str, Generation]:
        """The last ledger written before a restart; empty at a first start."""
        found = [p for p, _ in _files([self.folder]) if p.endswith(".json")]
        if not found:
            return {}
        last = max(found)
        self.written = int(last.rsplit("/", 1)[-1].removesuffix(".json"))
        system, inner = _open_fs(last)
        with system.open_input_file(inner) as f:
            return _ledger(json.loads(f.read()))

    def _write(self, offset: dict) -> None:
        """Keep an offset before Spark hears of it; the last two stay."""
        if not self.folder:
            return
        if not self.written:
            self._read()
        self.written += 1
        system, inner = _open_fs(self.folder)
        system.create_dir(inner, recursive=True)

        def name(n: int) -> str:
            return f"{inner.rstrip('/')}/{n:020d}.json"

        # Hidden until whole: a listing never shows half a ledger.
        part = f"{inner.rstrip('/')}/.{self.written:020d}"
        with system.open_output_stream(part) as f:
            f.write(json.dumps(offset).encode())
        system.move(part, name(self.written))
        if self.written > 2 and system.get_file_info(name(self.written - 2)).type == fs.FileType.File:
            system.delete_file(name(self.written - 2))

    def partitions(self, start: dict, end: dict) -> list[FileRange]:
        before, after = _ledger(start), _ledger(end)
        # After a restart without a ledger the files have new names for their generations.
        new = {g.path: g for n, g in after.items() if n not in before}
        lost = [g for n, g in before.items() if n not in after]
        alike = {}
        if new and lost:
            looked = {p: _File(p, g.position, g.inode, g.position) for p, g in new.items()}
            there = {g.path for g in after.values()}
            alike = {new[p].name: g for p, g in _matched(looked, lost, there).items()}
        if self.ledger is None:
            here = {g.name for g in alike.values()}
            self.ledger = {g.name: g for g in lost if g.name not in here} | after
        ranges = []
        for name, g in sorted(after.items(), key=lambda e: e[1].path):
            old = before.get(name) or alike.get(name)
            begin = old.position if old else 0
            for at in range(begin, g.position, self.split):
                ranges.append(FileRange(g.path, begin, at, min(at + self.split, g.position), g.position))
        return ranges

    def read(self, partition: FileRange) -> Iterator[pa.RecordBatch]:
        for positions, lines in _lines(partition):
            n = len(lines)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([partition.file] * n, pa.string()),
                    pa.array(np.full(n, partition.start), pa.int64()),
                    pa.array(positions, pa.int64()),
                    _text(lines),
                ],
                schema=_ARROW,
            )

    def commit(self, end: dict) -> None:
        pass


def _lines(part: FileRange) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """Blocks of lines that start in the range, with their positions.

    The last line may run past the range.  A range that starts inside the new part of
    a file is read from one byte early: what lies before its first line end belongs to
    the range before.
    """
    pos = part.start - 1 if part.start > part.first else part.start
    system, inner = _open_fs(part.file)
    with system.open_input_file(inner) as f:
        f.seek(pos)
        done, pending = pos, []
        while pos < part.end and done < part.limit:
            block = f.read(min(_BLOCK, part.limit - done))
            if not block:
                break
            done += len(block)
            cut = block.rfind(b"\n") + 1
            pending.append(block[:cut] if cut else block)
            if not cut:
                continue
            body = b"".join(pending)
            pending = [block[cut:]]
            lines = body.split(b"\n")[:-1]
            ends = np.cumsum(np.fromiter(map(len, lines), np.int64, len(lines)) + 1)
            starts = pos + np.append(0, ends[:-1])
            pos += len(body)
            low, high = np.searchsorted(starts, [part.start, part.end])
            starts, lines = starts[low:high], lines[low:high]
            if b"\r" in body:
                starts, lines = _split_returns(starts, lines)
            if len(lines):
                yield starts, lines


def _split_returns(starts: np.ndarray, lines: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """Lines cut at carriage returns; one right before the line feed cuts nothing."""
    positions, out = [], []
    for start, line in zip(starts, lines):
        for piece in line.removesuffix(b"\r").split(b"\r"):
            positions.append(start)
            out.append(piece)
            start += len(piece) + 1
    return np.array(positions, np.int64), out


def _text(lines: list[bytes]) -> pa.Array:
    """UTF-8 text; bytes that are none become replacement characters."""
    try:
        return pa.array(lines, pa.binary()).cast(pa.string())
    except pa.ArrowInvalid:
        return pa.array([line.decode("utf-8", "replace") for line in lines], pa.string())


class TailSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return SCHEMA

    def streamReader(self, schema) -> TailReader:
        return TailReader(dict(self.options))


def read_tail(
    spark: SparkSession,
    path: str,
    split_bytes: int = SPLIT_BYTES,
    max_bytes: int | None = None,
    ledger: str | None = None,
):
    """Stream of the lines appended to the files at ``path``, from their start.

    ``max_bytes`` bounds a micro-batch; ``ledger`` is a folder that keeps the offsets
    through restarts.
    """
    spark.dataSource.register(TailSource)
    reader = spark.readStream.format(FORMAT).option("path", path).option("splitBytes", split_bytes)
    if max_bytes is not None:
        reader = reader.option("maxBytes", max_bytes)
    if ledger is not None:
        reader = reader.option("ledger", ledger)
    return reader.load()
