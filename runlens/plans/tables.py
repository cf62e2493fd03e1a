"""The given tables, and run events derived from them.

Orders stand for stages and line items for tasks: an order is submitted on its date
and, with status ``F``, completed 90 days later; a line item starts on its ship date
and, with status ``F``, ends as many days later as its line number says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runlens.operators.progress import COMPLETED, SUBMITTED, TASK_END, TASK_START

NAMES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def load(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def load_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The same table as a stream of its files."""
    schema = load(spark, folder, name).schema
    # A glob, because a file stream takes a single file only by pattern.
    return spark.readStream.schema(schema).parquet(f"{folder}/{{{name}.parquet}}")


def load_all(spark: SparkSession, folder: str, names: str) -> dict[str, DataFrame]:
    return {name: load(spark, folder, name) for name in names.split()}


def app_of_key(key: str) -> Column:
    return F.concat(F.lit("app-"), (F.col(key) % 8).cast("string")).alias("app_id")


def order_events(orders: DataFrame) -> DataFrame:
    """Stage events of orders (batch or streaming)."""
    submitted = F.struct(F.lit(SUBMITTED).alias("kind"), F.col("o_orderdate").alias("ts"))
    completed = F.struct(
        F.lit(COMPLETED).alias("kind"), F.expr("o_orderdate + INTERVAL 90 DAYS").alias("ts")
    )
    found = F.when(F.col("o_orderstatus") == "F", F.array(submitted, completed)).otherwise(
        F.array(submitted)
    )
    return orders.select(
        app_of_key("o_orderkey"),
        F.col("o_orderkey").alias("stage_id"),
        F.explode(found).alias("event"),
        (F.col("o_custkey") % 8).cast("int").alias("num_tasks"),
        F.concat(
            F.lower("o_orderpriority"), F.lit(" at customer "), F.col("o_custkey").cast("string")
        ).alias("stage_name"),
    ).select("app_id", "stage_id", "event.*", "num_tasks", "stage_name")


def item_events(lineitem: DataFrame) -> DataFrame:
    """Task events of line items (batch or streaming)."""
    start = F.struct(F.lit(TASK_START).alias("kind"), F.col("l_shipdate").alias("ts"))
    end = F.struct(
        F.lit(TASK_END).alias("kind"),
        F.expr("l_shipdate + make_dt_interval(l_linenumber)").alias("ts"),
    )
    found = F.when(F.col("l_linestatus") == "F", F.array(start, end)).otherwise(F.array(start))
    return lineitem.select(
        app_of_key("l_orderkey"),
        F.col("l_orderkey").alias("stage_id"),
        F.explode(found).alias("event"),
        F.col("l_linenumber").alias("task_index"),
        (F.col("l_returnflag") != "R").alias("ok"),
    ).select("app_id", "stage_id", "event.*", "task_index", "ok")


def mixed_events(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Stage and task events in one frame."""
    tasks = item_events(lineitem).select(
        "app_id",
        "stage_id",
        "kind",
        "ts",
        F.lit(None).cast("int").alias("num_tasks"),
        F.lit(None).cast("string").alias("stage_name"),
    )
    return order_events(orders).unionByName(tasks)


def event_log_lines(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """The same events as JSON lines of a Spark event log: ``(app, value)``."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    submitted = F.col("kind") == SUBMITTED
    stages = order_events(orders).select(
        F.col("app_id").alias("app"),
        F.to_json(
            F.struct(
                F.when(submitted, "SparkListenerStageSubmitted")
                .otherwise("SparkListenerStageCompleted")
                .alias("Event"),
                F.struct(
                    F.col("stage_id").alias("Stage ID"),
                    F.col("stage_name").alias("Stage Name"),
                    F.col("num_tasks").alias("Number of Tasks"),
                    F.when(submitted, millis).alias("Submission Time"),
                    F.when(~submitted, millis).alias("Completion Time"),
                ).alias("Stage Info"),
            )
        ).alias("value"),
    )
    started = F.col("kind") == TASK_START
    tasks = item_events(lineitem).select(
        F.col("app_id").alias("app"),
        F.to_json(
            F.struct(
                F.when(started, "SparkListenerTaskStart")
                .otherwise("SparkListenerTaskEnd")
                .alias("Event"),
                F.col("stage_id").alias("Stage ID"),
                F.struct(
                    F.col("task_index").alias("Index"),
                    F.when(started, millis).alias("Launch Time"),
                    F.when(~started, millis).alias("Finish Time"),
                    (~F.col("ok")).alias("Failed"),
                ).alias("Task Info"),
            )
        ).alias("value"),
    )
    return stages.unionByName(tasks)
