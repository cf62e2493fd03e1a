"""Connected components of a graph given as a table of edges."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from runlens.llm.shared import drop, new_folder


def _min_of(edges: DataFrame) -> DataFrame:
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def components(edges: DataFrame, files: int | None = None) -> DataFrame:
    """``(node, component)`` for every node of the edges ``(u, v)``; the smallest node names it.

    Large-star and small-star steps in turn until nothing changes.  Minima are combined
    before the shuffle and joined back, so a node with many edges is no task's list; each
    step's edges are written, so a lost executor costs one step; in at most ``files`` files,
    by default four for each core.
    """
    spark = edges.sparkSession
    files = files or 4 * spark.sparkContext.defaultParallelism
    folder = new_folder(spark, "components")
    step, last = 0, None
    now = edges.select("u", "v").filter("u <> v").distinct()
    while True:
        path = f"{folder}/{step}"
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = _min_of(both).withColumn("m", F.least("u", "m"))
        large = both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        down = large.filter("u <> v").distinct()
        small = _min_of(down)
        linked = down.join(small, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        heads = small.select("u", F.col("m").alias("v"))
        made = linked.unionByName(heads).distinct()
        made.coalesce(files).write.parquet(path)
        now = spark.read.schema("u long, v long").parquet(path)
        mark = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if step:
            drop(spark, f"{folder}/{step - 1}")
        if mark == last:
            break
        step, last = step + 1, mark
    roots = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        roots.select("node", F.col("node").alias("component"))
    )
