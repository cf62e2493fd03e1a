"""Sinks: HTML fragments, JSON messages, plain lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runlens.functions.text import encode_data, encode_open, mask_home_prefix
from runlens.operators.preview import html_fragments


def write_html_rows(df: DataFrame, path: str) -> None:
    """Write one ``<tr>`` fragment per row; line ends inside a cell become ``&#10;``."""
    fragments = html_fragments(df)
    flat = F.replace(F.replace("fragment", F.lit("\r"), F.lit("&#13;")), F.lit("\n"), F.lit("&#10;"))
    fragments.select(flat.alias("value")).write.text(path)


def write_messages(batches: DataFrame, path: str, lines: str = "lines", home: str = "") -> None:
    """Write one JSON message per batch of lines.  Repeating a write replaces it.

    Batches with a ``file`` and ``pos`` go to a folder for each file, and the message that
    announces the file comes right before its first batch.
    """
    data = encode_data(F.col(lines))
    if not {"file", "pos"} <= set(batches.columns):
        batches.select(data.alias("value")).write.mode("overwrite").text(path)
        return
    name = mask_home_prefix(F.col("file"), home) if home else F.col("file")
    both = F.when(F.col("pos") == 0, F.array(encode_open(name, None), data)).otherwise(F.array(data))
    messages = batches.select("file", F.explode(both).alias("value"))
    messages.write.mode("overwrite").partitionBy("file").text(path)


def write_lines(df: DataFrame, path: str, value: str = "value") -> None:
    """Write lines as they are."""
    df.select(F.col(value).alias("value")).write.mode("overwrite").text(path)


def print_lines(stream: DataFrame, value: str = "value"):
    """A writer, not started yet, that prints the lines of a stream."""
    return (
        stream.select(value).writeStream.format("console").option("truncate", "false")
    )
