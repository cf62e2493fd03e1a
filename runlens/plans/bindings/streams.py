"""Streaming jobs, run until the given tables are used up."""

from datetime import timedelta

from pyspark.sql import functions as F

from runlens.operators.lines import text_lines
from runlens.plans.bindings.lines import LINES_SQL
from runlens.plans.bindings.registry import query
from runlens.plans.bindings.stages import COUNTERS, ON_TIME_SQL, progress_sql
from runlens.plans.staging import new_folder, stage
from runlens.plans.tables import load, load_stream, mixed_events
from runlens.sources.committed import read_committed, write_committed
from runlens.sources.sinks import write_lines
from runlens.sources.tail import read_tail
from runlens.streaming.changelog import latest_changes, write_changes
from runlens.streaming.lifecycle import run_available, run_to_the_end
from runlens.streaming.logs import line_messages, read_messages, ship
from runlens.streaming.progress import (
    latest_progress,
    progress_updates,
    write_strict_progress,
    write_updates,
)
from runlens.streaming.sessions import bursts
from runlens.streaming.stagestate import rocksdb_state, stage_updates


def _event_stream(spark, folder):
    return mixed_events(
        load_stream(spark, folder, "orders"), load_stream(spark, folder, "lineitem")
    )


@query("stream_stage_progress", progress_sql())
def stream_stage_progress(spark, folder):
    out = new_folder(spark, "progress")
    updates = progress_updates(_event_stream(spark, folder))
    run_available(write_updates(updates, f"{out}/rows"), f"{out}/checkpoint")
    return latest_progress(spark, f"{out}/rows").select(*COUNTERS)


@query("stream_stage_progress_strict", ON_TIME_SQL)
def stream_stage_progress_strict(spark, folder):
    out = new_folder(spark, "strict-progress")
    writer = write_strict_progress(_event_stream(spark, folder), out)
    run_available(writer, f"{out}/checkpoint")
    return latest_progress(spark, f"{out}/rows").select(*COUNTERS)


@query(
    "stream_stage_state",
    """
    WITH first AS (
        SELECT o_custkey, min(o_orderdate) AS since,
               min([o_orderdate::VARCHAR, lower(o_orderpriority)])[2] AS priority,
               bool_or(o_orderstatus = 'F') AS stage_done
        FROM orders GROUP BY o_custkey
    )
    SELECT 'app-' || (f.o_custkey % 8) AS app_id, f.o_custkey AS stage_id,
           any_value(priority) || ' at customer ' || f.o_custkey AS stage_name,
           (f.o_custkey % 8)::INT AS num_tasks,
           count(*) FILTER (l_shipdate >= since) AS started,
           count(*) FILTER (l_linestatus = 'F' AND l_shipdate + to_days(l_linenumber) >= since)
               AS done,
           any_value(stage_done) AS stage_done
    FROM first f JOIN orders o ON o.o_custkey = f.o_custkey
    LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY f.o_custkey
    """,
)
def stream_stage_state(spark, folder):
    """Keyed state over five runs of the stream, each with a later part of the events.

    A customer is a stage, submitted with the first order; items may ship years after an
    order that completes it, so completed ones are not forgotten here.
    """
    out = new_folder(spark, "stage-state")
    orders = load(spark, folder, "orders")
    owner = orders.select("o_orderkey", "o_custkey")
    items = load(spark, folder, "lineitem").join(owner, F.col("l_orderkey") == F.col("o_orderkey"))
    events = mixed_events(
        orders.withColumn("o_orderkey", F.col("o_custkey")),
        items.withColumn("l_orderkey", F.col("o_custkey")),
    )
    events = stage(events, "stage-events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts = events.agg(F.percentile_approx(at, [0.2, 0.4, 0.6, 0.8]).alias("c")).first()["c"]
    if cuts is None:  # no events at all
        return events.select(*(F.lit(None).alias(c) for c in COUNTERS)).limit(0)
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = events.filter(at > low) if low is not None else events
        part = part.filter(at <= high) if high is not None else part
        part.write.mode("append").parquet(f"{out}/in")
        arriving = spark.readStream.schema(events.schema).parquet(f"{out}/in")
        with rocksdb_state(spark):
            changed = stage_updates(arriving, timedelta(days=36500))
            run_available(write_updates(changed, f"{out}/rows"), f"{out}/checkpoint")
    return latest_progress(spark, f"{out}/rows").select(*COUNTERS)


TAIL_SQL = f"""
    SELECT replace(value, 'the', '~') AS line, count(*) AS n, true AS bounded
    FROM ({LINES_SQL}) GROUP BY ALL
    """


@query("stream_log_tail", TAIL_SQL)
def stream_log_tail(spark, folder):
    out = new_folder(spark, "tail")
    write_lines(text_lines(load(spark, folder, "documents"), []), f"{out}/logs")
    messages = line_messages(read_tail(spark, f"{out}/logs"), home="the")
    run_available(ship(messages, f"{out}/sent"), f"{out}/checkpoint")
    return _sent_lines(spark, out)


@query("stream_log_tail_budget", TAIL_SQL)
def stream_log_tail_budget(spark, folder):
    """The same in several runs, each a restart that takes a part of what is there."""
    out = new_folder(spark, "tail-budget")
    lines = text_lines(load(spark, folder, "documents"), [])
    write_lines(lines, f"{out}/logs")
    size = lines.agg(F.sum(F.octet_length("value") + 1)).first()[0] or 0

    def writer():
        tailed = read_tail(
            spark, f"{out}/logs", max_bytes=size // 3 + 1, ledger=f"{out}/ledger"
        )
        return ship(line_messages(tailed, home="the"), f"{out}/sent")

    run_to_the_end(writer, f"{out}/checkpoint")
    return _sent_lines(spark, out)


def _sent_lines(spark, out):
    sent = read_messages(spark, f"{out}/sent")
    rows = sent.select((F.size("data") <= 11).alias("fits"), F.explode("data").alias("line"))
    return rows.groupBy("line").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("fits").alias("bounded")
    )


# Rows of the given tables that make up one file of a stream's input.
FILE_ROWS = 500_000


def files_per_batch(rows: int, batches: int) -> int:
    """Files of each micro-batch, so that no task's share grows with the tables."""
    return max(1, -(-rows // (FILE_ROWS * batches)))


@query("stream_progress_compacted", progress_sql())
def stream_progress_compacted(spark, folder):
    """Six micro-batches into a change log that merges two segments of a level."""
    out = new_folder(spark, "changelog")
    orders, items = load(spark, folder, "orders"), load(spark, folder, "lineitem")
    events = mixed_events(orders, items)
    files = files_per_batch(orders.count() + items.count(), 6)
    events.repartition(6 * files, "stage_id").write.parquet(f"{out}/in")
    arriving = (
        spark.readStream.schema(events.schema).option("maxFilesPerTrigger", files).parquet(f"{out}/in")
    )
    with rocksdb_state(spark):
        run_available(write_changes(progress_updates(arriving), f"{out}/log", fanout=2), f"{out}/checkpoint")
    return latest_changes(spark, f"{out}/log").select(*COUNTERS)


@query(
    "stream_bursts",
    """
    WITH steps AS (
        SELECT user_id, ts, CASE WHEN ts > lag(ts) OVER w + INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS fresh
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    islands AS (SELECT user_id, ts, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts) AS i FROM steps),
    found AS (SELECT user_id, min(ts) AS first, max(ts) AS last, count(*) AS n
              FROM islands GROUP BY user_id, i)
    SELECT user_id, first, last, n FROM found
    WHERE last + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE
    """,
)
def stream_bursts(spark, folder):
    """Bursts of a user's events that are over when the stream has read all of them."""
    out = new_folder(spark, "bursts")
    found = bursts(load_stream(spark, folder, "events"), ["user_id"], "ts", "30 minutes", "10 minutes")
    run_available(
        found.writeStream.format("parquet").option("path", f"{out}/rows").outputMode("append"),
        f"{out}/checkpoint",
    )
    return spark.read.schema(found.schema).parquet(f"{out}/rows")


@query(
    "stream_committed_messages",
    """
    SELECT event_id, event_type, user_id FROM events
    """,
)
def stream_committed_messages(spark, folder):
    """Events as messages through the sink with two-phase commit."""
    out = new_folder(spark, "committed")
    events = load_stream(spark, folder, "events")
    message = F.to_json(F.struct("event_id", "event_type", "user_id"))
    run_available(write_committed(events.select(message.alias("value")), f"{out}/sent"), f"{out}/checkpoint")
    fields = "event_id BIGINT, event_type STRING, user_id BIGINT"
    return read_committed(spark, f"{out}/sent").select(F.from_json("value", fields).alias("m")).select("m.*")
