"""Tables that a job writes between two steps, in the folder all executors share."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_made: list[str] = []
_local_root: tempfile.TemporaryDirectory | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    Where the setting is missing on a local master, as in tests, a temporary folder takes
    its place until the process ends; on a cluster the setting is required.
    """
    global _local_root
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.TemporaryDirectory(prefix="runlens-llm-")
        atexit.register(_local_root.cleanup)
    return f"file://{_local_root.name}"


def file_system(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system of a path as Spark writes it, and the path in it."""
    # Spark says s3a where Arrow says s3.
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", uri))


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder in the shared one that nothing else uses."""
    path = f"{shared_root(spark)}/runlens-llm/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Remove this process's folders, once no frame that reads them is needed."""
    while _made:
        drop(spark, _made.pop())


def drop(spark: SparkSession, path: str) -> None:
    """Remove a folder written by this module's callers."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of the files in a folder written by this module's callers."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target)
    return found.getLength()


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")
