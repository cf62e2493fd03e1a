"""Tail, mask, prefix, batch and ship log lines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter

from runlens.functions.text import encode_open, mask_home, mask_home_prefix, with_prefix
from runlens.operators.lines import BATCH_LINES, batch_adjacent
from runlens.sources.sinks import write_messages
from runlens.streaming.backoff import retrying


def masked_lines(lines: DataFrame, home: str = "", prefix: Column | str | None = None):
    """Lines with the home directory masked and an optional prefix in front."""
    return lines.withColumn("value", with_prefix(mask_home(F.col("value"), home), prefix))


def line_messages(lines: DataFrame, home: str = "", size: int = BATCH_LINES) -> DataFrame:
    """Batches of tailed lines ready to send: ``(file, range, pos, lines)``.

    Batches are cut where the lines are read, so nothing is shuffled.
    """
    return batch_adjacent(masked_lines(lines, home), ["file", "range"], "pos", size=size)


def open_messages(lines: DataFrame, home: str = "", prefix: Column | None = None) -> DataFrame:
    """One message per file that announces it, when its first line comes by.

    ``lines`` are tailed lines or their batches; nothing has to be remembered.
    """
    name = mask_home_prefix(F.col("file"), home) if home else F.col("file")
    first = lines.filter(F.col("pos") == 0)
    return first.select("file", encode_open(name, prefix).alias("message"))


def ship(batches: DataFrame, path: str, home: str = "", **retry) -> DataStreamWriter:
    """Write each micro-batch of messages under ``path/batch=<id>/file=<file>``.

    A file is announced by an open message before its first lines.  A repeated micro-batch replaces its folder, so every message is there once.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_messages(batch, f"{path}/batch={batch_id}", home=home)

    return batches.writeStream.foreachBatch(retrying(write, **retry))


def ship_with(batches: DataFrame, write: Callable, **retry) -> DataStreamWriter:
    """Hand each micro-batch to ``write(batch, batch_id)`` with retries."""
    return batches.writeStream.foreachBatch(retrying(write, **retry))


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """Shipped lines, decoded: ``(batch, file, data)``, without the open messages."""
    decoded = F.from_json("value", "data ARRAY<STRING>")["data"]
    found = spark.read.text(path).select("batch", "file", decoded.alias("data"))
    return found.filter(F.col("data").isNotNull())
