import pytest
from pyspark.sql import functions as F

from runlens.operators.ranks import dense_ids, random_ids, with_position
from runlens.operators.skew import hot_hashes, is_small, lookup_join, salted_join


def test_positions_in_a_hot_group(spark):
    # One group holds two thirds of the rows; nulls are a group of their own.
    rows = [("hot", i % 50, i) for i in range(2000)]
    rows += [(None, i, i) for i in range(10)] + [(f"g{i}", 1, i) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(7)
    got = with_position(df, ["g"], ["v"]).collect()
    by_group = {}
    for r in got:
        by_group.setdefault(r["g"], []).append((r["position"], r["v"]))
    for found in by_group.values():
        found.sort()
        assert [p for p, _ in found] == list(range(len(found)))
        assert [v for _, v in found] == sorted(v for _, v in found)
    assert len(got) == len(rows) and len(by_group["hot"]) == 2000


def test_the_hot_group_is_spread(spark):
    df = spark.range(0, 8000, 1, 4).select(F.lit(1).alias("g"), "id")
    laid = df.repartitionByRange(4, "g", "id").select(F.spark_partition_id().alias("p"))
    assert laid.groupBy("p").count().agg(F.max("count")).first()[0] < 4000


def test_dense_ids(spark):
    df = spark.range(100, 0, -1, 6).filter("id % 2 = 0").unionByName(spark.range(0))
    ids = {r["id"]: r["number"] for r in dense_ids(df, ["id"], name="number").collect()}
    assert [ids[k] for k in sorted(ids)] == [str(222223 + i) for i in range(50)]


def test_dense_ids_in_any_order(spark):
    df = spark.range(0, 1000, 1, 7).filter("id % 3 = 0")
    rows = dense_ids(df, name="number").collect()
    assert sorted(int(r["number"]) for r in rows) == list(range(222223, 222223 + 334))
    assert len({r["id"] for r in rows}) == 334


def test_rows_with_maps_and_equal_rows(spark):
    df = spark.range(0, 400, 1, 3).select(F.lit(1).alias("k"), F.create_map(F.lit(1), F.lit(2)).alias("m"))
    found = with_position(df, ["k"], ["k"]).collect()
    assert sorted(r["position"] for r in found) == list(range(400))
    table = spark.createDataFrame([(1, "x")], "k int, name string")
    assert salted_join(df, table, ["k"], salts=4).count() == 400


def test_random_ids(spark):
    ids = [r["u"] for r in random_ids(spark.range(50), "u").collect()]
    assert len(set(ids)) == 50 and all(len(i) == 36 for i in ids)


def skewed(spark):
    hot = spark.range(3000).select(F.lit(0).alias("k"), F.col("id").alias("v"))
    rest = spark.range(500).select((F.col("id") % 100).cast("int").alias("k"), "id")
    none = spark.range(5).select(F.lit(None).cast("int").alias("k"), "id")
    return hot.union(rest).union(none)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_is_the_plain_join(spark, how):
    table = spark.range(80).select(F.col("id").cast("int").alias("k"), (F.col("id") * 2).alias("w"))
    big = skewed(spark)
    want = sorted(map(str, big.join(table, "k", how).collect()))
    assert sorted(map(str, salted_join(big, table, ["k"], how, salts=5).collect())) == want
    assert sorted(map(str, lookup_join(big, table, ["k"], how).collect())) == want
    assert sorted(map(str, lookup_join(big, table, ["k"], how, max_rows=3).collect())) == want


TYPES = ["smallint", "int", "bigint", "decimal(9,0)", "decimal(20,2)", "double"]


@pytest.mark.parametrize("a,b", [(a, b) for a in TYPES for b in TYPES if a < b] + [("date", "timestamp")])
def test_keys_of_different_types_join_like_a_plain_join(spark, a, b):
    key = lambda n, kind: (
        F.expr(f"cast(date_add(date'2024-01-01', cast({n} AS int)) AS {kind})")
        if kind in ("date", "timestamp")
        else F.expr(f"cast({n} AS {kind})")
    )
    big = spark.range(400).select(key("if(id < 300, 5, id % 20)", a).alias("k"), "id")
    table = spark.range(12).select(key("id", b).alias("k"), F.col("id").alias("w"))
    for how in ("inner", "left"):
        want = sorted((r["id"], r["w"] or -1) for r in big.join(table, "k", how).collect())
        got = salted_join(big, table, ["k"], how, salts=4).collect()
        assert sorted((r["id"], r["w"] or -1) for r in got) == want


def test_text_keys_need_text_keys(spark):
    with pytest.raises(TypeError):
        salted_join(spark.range(3), spark.range(3).selectExpr("string(id) AS id"), ["id"])


def test_other_joins_are_refused(spark):
    with pytest.raises(ValueError):
        lookup_join(skewed(spark), skewed(spark), ["k"], "full")


def test_bounds(spark):
    df = spark.range(10).select("id", F.lit("x" * 100).alias("text"))
    assert is_small(df, 10) and not is_small(df, 9) and not is_small(df, 10, 500)
    zero = spark.range(1).select(F.xxhash64(F.lit(0))).first()[0]
    assert hot_hashes(skewed(spark), ["k"], 0.5) == [zero]
    assert hot_hashes(skewed(spark).filter("k > 1000"), ["k"]) == []
