"""Prefix scans and as-of joins against windows and plain loops."""

import datetime
import random

import pytest
from pyspark.sql import Window, functions as F

from runlens.operators.scan import asof_join, last, prefix_scan, running_max, running_min, running_sum

T0 = datetime.datetime(2024, 1, 1)


def rows_of(n, seed=1):
    """Rows of a hot key within one hour, a few other keys, nulls and ties."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = "hot" if i % 3 else rng.choice(["a", "b", None])
        at = None if i % 50 == 7 else T0 + datetime.timedelta(seconds=rng.randrange(3600))
        rows.append((i, key, at, rng.choice([None, None, rng.randrange(-9, 9)])))
    return rows


@pytest.fixture
def unmerged(spark):
    """Small partitions stay as they are, as they would with more rows."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.unset(name)


def test_scans_equal_windows(spark, unmerged):
    df = spark.createDataFrame(rows_of(400), "i long, key string, ts timestamp_ntz, v long").repartition(5)
    scans = {"last": last("v"), "sum": running_sum("v"), "max": running_max("v"), "min": running_min("v")}
    found = prefix_scan(df, ["key"], ["ts", "i"], scans)
    w = Window.partitionBy("key").orderBy("ts", "i").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select(
        "*", F.last("v", True).over(w).alias("last"), F.sum("v").over(w).alias("sum"),
        F.max("v").over(w).alias("max"), F.min("v").over(w).alias("min"),
    )
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_a_hot_key_spreads_over_tasks(spark, unmerged, monkeypatch):
    """All rows of one key in one hour: no partition of the scan holds half of them."""
    from runlens.operators import scan

    kept = []
    laid = scan.range_laid
    monkeypatch.setattr(scan, "range_laid", lambda *a: kept.append(laid(*a)) or kept[-1])
    df = spark.range(20_000).select(F.lit("hot").alias("key"), F.col("id").alias("i"), (F.col("id") * 7 % 3600).alias("s"))
    found = prefix_scan(df, ["key"], ["s", "i"], {"n": running_sum("i")})
    assert found.agg(F.max("n")).first()[0] == sum(range(20_000))
    sizes = [r["count"] for r in kept[0].groupBy("key", "_part").count().collect()]
    assert len(sizes) == 4 and max(sizes) < 10_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    # The rows move by partition and key; only a row per partition and key moves by key.
    assert "hashpartitioning(_part" in plan


def plain_asof(left, right):
    out = []
    for i, key, at, _ in left:
        best = None
        for j, other, when, value in right:
            if key == other and at is not None and when is not None and when <= at and value is not None:
                if best is None or (when, value) > best:
                    best = (when, value)
        out.append((i, best and best[1]))
    return sorted(out)


@pytest.mark.parametrize("n, m", [(150, 80), (60, 0), (0, 60)])
def test_asof_equals_a_loop(spark, unmerged, n, m):
    schema = "i long, key string, ts timestamp_ntz, v long"
    left, right = rows_of(n, 2), rows_of(m, 3)
    # Many rows at the same time on both sides.
    left = [(i, k, t and t.replace(second=0), v) for i, k, t, v in left]
    right = [(i, k, t and t.replace(second=0), v) for i, k, t, v in right]
    a = spark.createDataFrame(left, schema).withColumnRenamed("v", "_v").repartition(3)
    b = spark.createDataFrame(right, schema).repartition(2)
    found = asof_join(a, b, ["key"], "ts", "v", "found")
    assert found.columns == ["i", "key", "ts", "_v", "found"]
    assert sorted((r["i"], r["found"]) for r in found.collect()) == plain_asof(left, right)


def test_scan_without_groups_and_without_rows(spark, unmerged):
    df = spark.createDataFrame([(i, i % 5) for i in range(40)], "i long, v long").repartition(3)
    found = prefix_scan(df, [], ["i"], {"n": running_sum("v")}).orderBy("i").collect()
    assert [r["n"] for r in found] == [sum(j % 5 for j in range(i + 1)) for i in range(40)]
    assert prefix_scan(df.limit(0), ["v"], ["i"], {"n": last("v")}).count() == 0
