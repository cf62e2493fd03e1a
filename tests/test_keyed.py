"""Steps with known results, on their original small inputs."""

import pandas as pd
import pytest
from pyspark.sql import functions as F, types as T

from runlens.functions.text import leading_text
from runlens.operators.keyed import (
    aggregate_by_key,
    captured,
    combine_by_key,
    group_lists,
    lookup,
    observed,
    sum_fields,
    total,
    user_function,
)
from runlens.sources.files import catalog_table, int_range, literal_rows


@pytest.fixture(scope="module")
def ten(spark):
    return int_range(spark, 1, 10, 4)


def first_sum(df, column):
    return total(df, F.col(column)).first()["sum_0"]


def test_accumulated_sum(ten):
    assert observed(ten, total=F.sum("id"), n=F.count(F.lit(1))) == {"total": 55, "n": 10}


def test_captured_value_is_bound_when_the_plan_is_built(ten):
    v = 7
    first = captured(ten, "v", v)
    v = 10
    assert (first_sum(first, "v"), first_sum(captured(ten, "v", v), "v")) == (70, 100)


def test_user_functions(ten):
    class Five:
        def value(self):
            return 5

    five = user_function(lambda x: pd.Series([Five().value()] * len(x)), "int")
    double = user_function(lambda x: x + x, "bigint")
    assert first_sum(ten.select(five("id").alias("x")), "x") == 50
    assert first_sum(ten.select(double("id").alias("x")), "x") == 110


def test_range_plus_one(spark):
    hundred = int_range(spark, 1, 100, 10)
    assert hundred.rdd.getNumPartitions() == 10
    assert total(hundred, F.col("id") + 1).first()["sum_0"] == 5150


def test_lookup_reads_the_table_of_its_plan(spark):
    slots = [(x, 0) for x in range(5)]
    index = spark.range(5).select(F.col("id").cast("int").alias("x"))
    table = literal_rows(spark, slots, "x int, value int")
    found = lookup(index, table, ["x"])
    before = sorted(found.collect())
    slots[0] = (0, 5)
    assert [r["value"] for r in before] == [0] * 5
    assert [r["value"] for r in sorted(found.collect())] == [0] * 5


def test_struct_match(spark):
    df = literal_rows(spark, [(("A", "B"),), (None,)], "s struct<exp:string,exp2:string>")
    ok = df.select(F.when(F.col("s").isNotNull(), "OK"), F.col("s.exp2")).collect()
    assert [tuple(r) for r in ok] == [("OK", "B"), (None, None)]


def test_struct_of_numbers(ten):
    got = ten.select(F.struct(F.col("id").alias("value")).alias("s")).select("s.value")
    assert sorted(r[0] for r in got.collect()) == list(range(1, 11))


def test_groups_of_structs(spark):
    df = literal_rows(spark, [(1, (2,)), (1, (1,))], "k int, v struct<i:int>")
    rows = group_lists(df, "k", "v").collect()
    assert [(r["k"], r["run"], [x["i"] for x in r["items"]]) for r in rows] == [(1, 0, [1, 2])]


def test_large_groups_come_in_runs(spark):
    ids = int_range(spark, 1, 10_000, 200).select((F.col("id") + 1).alias("n"))
    keyed = ids.select(leading_text(F.col("n"), 1).alias("k"), "n")
    rows = group_lists(keyed, "k", "n", run_rows=500).collect()
    lists = {}
    for r in sorted(rows, key=lambda r: (r["k"], r["run"])):
        assert len(r["items"]) <= 500
        lists.setdefault(r["k"], []).extend(r["items"])
    want = {}
    for n in range(2, 10_002):
        want.setdefault(str(n)[0], []).append(n)
    assert lists == want
    assert lists["1"][:3] == [10, 11, 12]


def test_lists_keep_nulls(spark):
    rows = [(None, 1), (None, None), ("a", None), ("a", 3), ("a", 2)]
    df = spark.createDataFrame(rows, "k string, v int")
    for bound in (1, 2, 100):
        found = {}
        for r in sorted(group_lists(df, "k", "v", bound).collect(), key=lambda r: r["run"]):
            found.setdefault(r["k"], []).extend(r["items"])
        assert found == {None: [None, 1], "a": [None, 2, 3]}


WEIGHTS = {
    "1": (246, 46.0), "2": (247, 47.0), "3": (348, 48.0), "4": (449, 49.0), "5": (550, 50.0),
    "6": (651, 51.0), "7": (752, 52.0), "8": (853, 53.0), "9": (954, 54.0),
}


def pairs(spark):
    n = F.col("id")
    return int_range(spark, 1, 100, 10).select(
        leading_text(n, 1).alias("k"), n.alias("n"), (n % 10).cast("double").alias("weight")
    )


def test_struct_sums(spark):
    df = pairs(spark).select("k", F.struct("n", "weight").alias("v"))
    got = {r["k"]: tuple(r["v"]) for r in sum_fields(df, "k", "v").collect()}
    assert got == WEIGHTS


def test_user_combine(spark):
    plus = lambda a, b: (a[0] + b[0], a[1] + b[1])
    got = combine_by_key(pairs(spark), "k", ["n", "weight"], plus).collect()
    assert {r["k"]: (r["n"], r["weight"]) for r in got} == WEIGHTS


def simple_sum(df, keys):
    long = T.StructType().add("total", T.LongType())
    return aggregate_by_key(
        df,
        keys,
        ["value"],
        (0,),
        lambda b, frame: (b[0] + int(frame["value"].sum()),),
        lambda a, b: (a[0] + b[0],),
        lambda b: b,
        long,
        long,
    )


def test_user_aggregate_without_keys(spark):
    four = literal_rows(spark, [(1,), (2,), (3,), (4,)], "value int").repartition(3)
    assert [r["total"] for r in simple_sum(four, []).collect()] == [10]
    assert [r["total"] for r in simple_sum(four.filter("value > 9"), []).collect()] == [0]


def test_user_aggregate_keys_are_exact(spark, monkeypatch):
    from runlens.operators import keyed

    monkeypatch.setattr(keyed, "MAX_BUFFERS", 3)
    big = 2**60
    rows = [(None if i % 7 == 0 else big + i % 7, float("nan") if i % 2 else 1.0, i)
            for i in range(200)]
    df = spark.createDataFrame(rows, "a bigint, b double, value int").repartition(5)
    want = {}
    for a, b, v in rows:
        key = (a, "nan" if b != b else b)
        want[key] = want.get(key, 0) + v
    got = {
        (r["a"], "nan" if r["b"] != r["b"] else r["b"]): r["total"]
        for r in simple_sum(df, ["a", "b"]).collect()
    }
    assert got == want


def test_catalog_table(spark, tmp_path):
    spark.range(3).write.mode("overwrite").option("path", str(tmp_path / "t")).saveAsTable("three")
    try:
        assert catalog_table(spark, "three").count() == 3
    finally:
        spark.sql("DROP TABLE three")
