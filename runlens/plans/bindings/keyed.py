"""Keyed and whole-table steps."""

import pandas as pd
from pyspark.sql import functions as F, types as T

from runlens.functions.text import leading_text
from runlens.operators import layout
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
from runlens.operators.ranks import dense_ids, random_ids
from runlens.operators.skew import lookup_join
from runlens.plans.bindings.registry import joined, query
from runlens.plans.tables import load
from runlens.sources.files import int_range, literal_rows

RUN = 1000


@query(
    "captured_scalar",
    """
    SELECT l_orderkey, l_linenumber, 7 + 1 AS first_value, 10 + 1 AS second_value FROM lineitem
    """,
)
def captured_scalar(spark, folder):
    items = load(spark, folder, "lineitem").select("l_orderkey", "l_linenumber")
    value = 7
    items = captured(items, "first_value", value)
    value = 10
    items = captured(items, "second_value", value)
    return items.withColumns(
        {c: F.col(c) + 1 for c in ("first_value", "second_value")}
    )


@query("scalar_udf", "SELECT l_orderkey, l_linenumber * 2 AS doubled FROM lineitem")
def scalar_udf(spark, folder):
    double = user_function(lambda x: x + x, "int")
    return load(spark, folder, "lineitem").select(
        "l_orderkey", double("l_linenumber").alias("doubled")
    )


@query(
    "struct_match",
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE 'OK' END AS matched,
           CASE WHEN o_orderstatus <> 'P' THEN o_custkey ELSE -1 END AS customer
    FROM orders
    """,
)
def struct_match(spark, folder):
    orders = load(spark, folder, "orders")
    pair = F.struct(F.col("o_custkey").alias("customer"), "o_orderstatus")
    made = orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", pair).alias("pair"))
    return made.select(
        "o_orderkey",
        F.when(F.col("pair").isNotNull(), "OK").otherwise("none").alias("matched"),
        F.coalesce("pair.customer", F.lit(-1)).alias("customer"),
    )


@query(
    "sum_reduce",
    """
    SELECT count(*) AS rows, sum(l_linenumber)::BIGINT AS sum_0, sum(l_suppkey + 1)::BIGINT AS sum_1
    FROM lineitem
    """,
)
def sum_reduce(spark, folder):
    items = load(spark, folder, "lineitem")
    return total(items, F.col("l_linenumber"), F.col("l_suppkey") + 1)


@query("observed_sum", "SELECT sum(l_linenumber)::BIGINT AS total, count(*) AS seen FROM lineitem")
def observed_sum(spark, folder):
    items = load(spark, folder, "lineitem").select("l_linenumber")
    found = observed(items, total=F.sum("l_linenumber"), seen=F.count(F.lit(1)))
    return literal_rows(spark, [(found["total"], found["seen"])], "total BIGINT, seen BIGINT")


@query(
    "broadcast_lookup",
    """
    SELECT o_orderkey, n_name FROM orders JOIN nation ON o_custkey % 25 = n_nationkey
    """,
)
def broadcast_lookup(spark, folder):
    orders = load(spark, folder, "orders").select(
        "o_orderkey", (F.col("o_custkey") % 25).cast("int").alias("n_nationkey")
    )
    nation = load(spark, folder, "nation").select("n_nationkey", "n_name")
    return lookup(orders, nation, ["n_nationkey"]).select("o_orderkey", "n_name")


@query(
    "salted_lookup",
    "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey",
)
def salted_lookup(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", F.col("o_custkey").alias("k"))
    customer = load(spark, folder, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    return lookup(orders, customer, ["k"], max_rows=0).select("o_orderkey", "c_name")


@query(
    "prefix_groups",
    f"""
    WITH k AS (SELECT substr(CAST(o_orderkey AS VARCHAR), 1, 1) AS k, o_orderkey AS v FROM orders),
    s AS (SELECT k, count(*) AS n FROM k GROUP BY k),
    r AS (SELECT k.k, v, CASE WHEN n <= {RUN} THEN 0
              ELSE (row_number() OVER (PARTITION BY k.k ORDER BY v) - 1) // {RUN} END AS run
          FROM k JOIN s ON k.k = s.k)
    SELECT k, run, string_agg(v, ',' ORDER BY v) AS items FROM r GROUP BY k, run
    """,
)
def prefix_groups(spark, folder):
    orders = load(spark, folder, "orders")
    keyed = orders.select(leading_text(F.col("o_orderkey"), 1).alias("k"), "o_orderkey")
    found = group_lists(keyed, "k", "o_orderkey", run_rows=RUN)
    return found.withColumn("items", joined("items")).orderBy("k", "run")


@query(
    "customer_orders",
    """
    SELECT o_custkey, CAST(0 AS BIGINT) AS run,
           string_agg(o_orderkey, ',' ORDER BY o_orderkey) AS items
    FROM orders GROUP BY o_custkey
    """,
)
def customer_orders(spark, folder):
    found = group_lists(load(spark, folder, "orders"), "o_custkey", "o_orderkey")
    return found.withColumn("items", joined("items"))


@query(
    "struct_sum",
    """
    SELECT l_returnflag, sum(l_linenumber)::BIGINT AS n, sum(l_quantity::BIGINT)::BIGINT AS weight
    FROM lineitem GROUP BY l_returnflag
    """,
)
def struct_sum(spark, folder):
    pair = F.struct(
        F.col("l_linenumber").alias("n"), F.col("l_quantity").cast("bigint").alias("weight")
    )
    items = load(spark, folder, "lineitem").select("l_returnflag", pair.alias("v"))
    return sum_fields(items, "l_returnflag", "v").select("l_returnflag", "v.*")


@query(
    "udaf_sum",
    """
    SELECT user_id, sum(event_id)::BIGINT AS total, max(event_id) - min(event_id) AS spread
    FROM events GROUP BY user_id
    """,
)
def udaf_sum(spark, folder):
    def reduce(buffer: tuple, frame: pd.DataFrame) -> tuple:
        ids = frame["event_id"]
        return merge(buffer, (int(ids.sum()), int(ids.min()), int(ids.max())))

    def merge(a: tuple, b: tuple) -> tuple:
        if a[1] is None or b[1] is None:
            return b if a[1] is None else a
        return a[0] + b[0], min(a[1], b[1]), max(a[2], b[2])

    def finish(buffer: tuple) -> tuple:
        return buffer[0], buffer[2] - buffer[1]

    long = T.LongType()
    return aggregate_by_key(
        load(spark, folder, "events"),
        ["user_id"],
        ["event_id"],
        (0, None, None),
        reduce,
        merge,
        finish,
        T.StructType().add("total", long).add("low", long).add("high", long),
        T.StructType().add("total", long).add("spread", long),
    )


@query(
    "semigroup_sum",
    """
    SELECT event_type, count(*) AS n, max(user_id) AS top FROM events GROUP BY event_type
    """,
)
def semigroup_sum(spark, folder):
    events = load(spark, folder, "events").select(
        "event_type", F.lit(1).cast("bigint").alias("n"), F.col("user_id").alias("top")
    )
    return combine_by_key(
        events, "event_type", ["n", "top"], lambda a, b: (a[0] + b[0], max(a[1], b[1]))
    )


@query(
    "range_sum",
    """
    SELECT count(*) AS rows, sum(l_linenumber + 1)::BIGINT AS sum_0
    FROM lineitem
    """,
)
def range_sum(spark, folder):
    items = load(spark, folder, "lineitem").select(F.col("l_linenumber").alias("id"))
    low, high = items.agg(F.min("id"), F.max("id")).first()
    numbers = int_range(spark, low or 0, high or 0, 10)
    return total(lookup_join(items, numbers, ["id"]), F.col("id") + 1)


@query(
    "dense_ids",
    """
    SELECT o_orderkey, CAST(222222 + row_number() OVER (ORDER BY o_orderdate, o_orderkey)
           AS VARCHAR) AS id
    FROM orders
    """,
)
def numbered_orders(spark, folder):
    orders = load(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return dense_ids(orders, ["o_orderdate", "o_orderkey"]).select("o_orderkey", "id")


@query("random_ids", "SELECT o_orderkey, 36 AS id_length, true AS versioned FROM orders")
def random_order_ids(spark, folder):
    made = random_ids(load(spark, folder, "orders").select("o_orderkey"))
    return made.select(
        "o_orderkey",
        F.length("id").alias("id_length"),
        (F.substring("id", 15, 1) == "4").alias("versioned"),
    )


@query(
    "cached_counts",
    """
    SELECT count(*) AS first_count, count(*) AS second_count, count(*) AS third_count
    FROM documents
    """,
)
def cached_counts(spark, folder):
    with layout.cached(load(spark, folder, "documents").select("doc_id", "lang")) as held:
        counts = [held.count() for _ in range(3)]
    return literal_rows(
        spark, [counts], "first_count BIGINT, second_count BIGINT, third_count BIGINT"
    )


@query(
    "partition_balance",
    """
    SELECT 16 AS partitions, count(*) AS rows,
           sum(length(CAST(o_orderkey AS VARCHAR)))::BIGINT AS bytes, true AS even
    FROM orders
    """,
)
def partition_balance(spark, folder):
    # An explicit partition count is kept as it is, also by the adaptive planner.
    spread = load(spark, folder, "orders").select("o_orderkey").repartition(16)
    summary = layout.balance_summary(layout.partition_balance(spread))
    return summary.select(
        F.col("partitions").cast("int").alias("partitions"),
        "rows",
        "bytes",
        (F.col("worst_deviation") < 0.2).alias("even"),
    )


@query(
    "repartition_size",
    """
    SELECT count(*) AS rows_before, count(*) AS rows_after, true AS same_size FROM documents
    """,
)
def repartition_size(spark, folder):
    heads = load(spark, folder, "documents").select(leading_text(F.col("text"), 3).alias("s"))
    found = layout.size_deviation(
        layout.partition_balance(heads), layout.partition_balance(heads.repartition(8))
    )
    return found.select(
        "rows_before", "rows_after", (F.col("deviation") < 0.2).alias("same_size")
    )
