"""Columns over lines of text, paths and JSON messages."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, functions as F


def split_lines(text: Column) -> Column:
    """Lines of a text as an array; line ends are LF, CR LF or CR.

    A final line end does not open another line, and an empty text has no lines.
    """
    plain = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    closed = F.left(plain, F.length(plain) - 1)
    return (
        F.when(text == "", F.array().cast("array<string>"))
        .when(plain.endswith("\n"), F.split(closed, "\n"))
        .otherwise(F.split(plain, "\n"))
    )


def leading_text(col: Column, n: int) -> Column:
    """First ``n`` characters of the text of a value."""
    return F.substring(col.cast("string"), 1, n)


def mask_home(line: Column, home: str, mark: str = "~") -> Column:
    """Replace every occurrence of the home directory in a line."""
    if not home:
        return line
    return F.replace(line, F.lit(home), F.lit(mark))


def mask_home_prefix(path: Column, home: str, mark: str = "~") -> Column:
    """Replace the home directory only where the path starts with it."""
    tail = F.substring(path, F.lit(len(home) + 1), F.length(path))
    return F.when(path.startswith(home), F.concat(F.lit(mark), tail)).otherwise(path)


def with_prefix(line: Column, prefix: Column | str | None) -> Column:
    """Put an optional prefix in front of a line; a null prefix counts as empty."""
    if prefix is None:
        return line
    head = F.lit(prefix) if isinstance(prefix, str) else F.coalesce(prefix, F.lit(""))
    return F.concat(head, line)


def encode_data(lines: Column) -> Column:
    """JSON message ``{"data": [line, ...]}``."""
    return F.to_json(F.struct(lines.alias("data")))


def encode_open(file_name: Column, prefix: Column | None = None) -> Column:
    """JSON message ``{"file_name": ..., "prefix": ...}``; a null prefix is left out."""
    fields = [file_name.alias("file_name")]
    if prefix is not None:
        fields.append(prefix.alias("prefix"))
    return F.to_json(F.struct(*fields))


def decode_field(message: Column, field: str, dtype: str = "int") -> Column:
    """One field of a JSON message; null when the message does not decode."""
    return F.from_json(message, f"`{field}` {dtype}")[field]


def every(predicates: Iterable[Column]) -> Column:
    """AND of all predicates; true when there is none."""
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def any_prefix(path: Column, prefixes: Iterable[str]) -> Column:
    """True when the path lies under one of the directories."""
    heads = (p if p.endswith("/") else p + "/" for p in prefixes)
    return reduce(lambda a, b: a | b, (path.startswith(h) for h in heads), F.lit(False))


def is_shippable_jar(uri: Column) -> Column:
    """Binary jar files, plain (``file:``) or nested in another archive (``jar:``)."""
    scheme = F.lower(F.substring_index(uri, ":", 1))
    rest = F.substring(uri, F.length(scheme) + 2, F.length(uri))
    no_ref = F.substring_index(rest, "#", 1)
    path = F.substring_index(no_ref, "?", 1)
    plain = (scheme == "file") & path.endswith(".jar") & ~path.endswith("-sources.jar")
    nested = (
        (scheme == "jar") & no_ref.endswith(".jar!/") & ~path.endswith("-sources.jar!/")
    )
    return plain | nested
