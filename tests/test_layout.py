import pytest
from pyspark import StorageLevel
from pyspark.sql import functions as F

from runlens.operators.layout import (
    balance_summary, cached, partition_balance, replicated, size_deviation,
)
from runlens.plans import staging


def cached_partitions(spark):
    infos = spark.sparkContext._jsc.sc().getRDDStorageInfo()
    return sum(i.numCachedPartitions() for i in infos)


def test_replicated_blocks(spark):
    df = spark.range(1, 101, 1, 10).select(F.struct("id").alias("foo"))
    with replicated(df) as held:
        assert held.storageLevel == StorageLevel.MEMORY_AND_DISK_2
        assert held.count() == 100
        assert cached_partitions(spark) == 10
    assert cached_partitions(spark) == 0


def test_cache_is_released_on_errors(spark):
    with pytest.raises(ZeroDivisionError), cached(spark.range(5)) as held:
        held.count()
        1 / 0
    assert cached_partitions(spark) == 0


def test_balance(spark):
    df = spark.range(0, 100, 1, 4)
    report = partition_balance(df, F.lit(8)).orderBy("partition").collect()
    assert [tuple(r) for r in report] == [(i, 25, 200) for i in range(4)]
    total = balance_summary(partition_balance(df)).first()
    assert (total["partitions"], total["rows"], total["worst_deviation"]) == (4, 100, 0.0)
    assert total["bytes"] == 190


def test_repartitioned_rows_keep_their_size(spark):
    df = spark.createDataFrame([("hel",), ("hel",), ("hel",)], "s string")
    found = size_deviation(partition_balance(df), partition_balance(df.repartition(3))).first()
    assert (found["rows_before"], found["rows_after"], found["deviation"]) == (3, 3, 0.0)


class Conf(dict):
    @property
    def conf(self):
        return self


def test_shared_folder_comes_from_the_session():
    assert staging.shared_root(Conf({"spark.checkpoint.dir": "s3a://b/x/"})) == "s3a://b/x"
    local = staging.shared_root(Conf({"spark.master": "local[2]"}))
    assert local == staging.shared_root(Conf({"spark.master": "local[2]"}))
    with pytest.raises(ValueError):
        staging.shared_root(Conf({"spark.master": "yarn"}))
