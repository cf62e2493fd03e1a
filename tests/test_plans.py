"""The physical plans are the ones meant."""

import pytest
from pyspark.sql import functions as F

from runlens.operators.lines import batch_text
from runlens.operators.manifest import manifest_diff
from runlens.operators.progress import stage_progress
from runlens.operators.skew import lookup_join
from runlens.plans.tables import item_events, load, order_events
from runlens.sources.eventlog import read_event_log, task_events
from test_queries import FOLDER, QUERIES


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream")))
def test_no_pairing_of_all_rows(spark, name):
    plan = plan_of(QUERIES[name](spark, FOLDER))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_progress_aggregates_before_it_shuffles(spark):
    tasks = item_events(load(spark, FOLDER, "lineitem"))
    plan = plan_of(stage_progress(order_events(load(spark, FOLDER, "orders")), tasks))
    # One shuffle per side, none for the join.
    assert plan.count("Exchange hashpartitioning") == 2
    assert "partial_count" in plan
    assert "l_orderkey:bigint,l_linenumber:int,l_linestatus:string,l_shipdate" in plan


def test_manifest_difference_is_one_shuffle(spark):
    pages = load(spark, FOLDER, "pages").select(F.col("url").alias("uri"))
    plan = plan_of(manifest_diff([pages, pages], [pages], keep=[F.col("uri").startswith("https")]))
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert "StringStartsWith(url,https)" in plan


def test_text_batches_do_not_shuffle(spark):
    assert "Exchange" not in plan_of(batch_text(load(spark, FOLDER, "documents"), ["doc_id"]))


def test_lookups_broadcast_only_within_the_bound(spark):
    orders = load(spark, FOLDER, "orders").select(F.col("o_custkey").alias("k"))
    customer = load(spark, FOLDER, "customer").select(F.col("c_custkey").alias("k"), "c_name")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan_of(lookup_join(orders, customer, ["k"]))
        assert "SortMergeJoin" in plan_of(lookup_join(orders, customer, ["k"], max_rows=5))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_json_is_parsed_once_a_line(spark, event_log_dir):
    plan = plan_of(task_events(read_event_log(spark, event_log_dir)).filter("task_index > 1"))
    assert plan.count("from_json") == 1
    assert "StringContains(value,SparkListenerTaskEnd)" in plan
