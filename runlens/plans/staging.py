"""Tables written between two steps of a job.

A step whose result must not be computed twice (row positions, key lists, sink
output) is written to the shared folder named by ``spark.checkpoint.dir`` and read
back, so that lost executors cannot change it.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTING = "spark.checkpoint.dir"
_local_root: tempfile.TemporaryDirectory | None = None
_written: list[str] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder of the cluster.

    Where the setting is missing on a local master, as in tests, a temporary folder takes
    its place and is removed at the end of the process.
    """
    global _local_root
    root = spark.conf.get(SETTING, None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError(f"set {SETTING} to a folder that every executor can reach")
    if _local_root is None:
        _local_root = tempfile.TemporaryDirectory(prefix="runlens-")
        atexit.register(_local_root.cleanup)
    return _local_root.name


def new_folder(spark: SparkSession, name: str) -> str:
    """Path of a folder under the shared root that nothing else uses."""
    path = f"{shared_root(spark)}/runlens/{name}-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def release(spark: SparkSession) -> None:
    """Remove the folders this process has written; no frame that reads them works then."""
    while _written:
        path = spark._jvm.org.apache.hadoop.fs.Path(_written.pop())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return the written table (columns stay prunable)."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
