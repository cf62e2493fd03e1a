"""Stage progress, labels, requests."""

from datetime import datetime

from pyspark.sql import functions as F

from runlens.functions.stages import call_site, stage_action, stage_title_html
from runlens.operators.progress import (
    TASK_END,
    TASK_START,
    active,
    event_progress,
    stage_progress,
    with_labels,
)
from runlens.operators.requests import answer_requests, decode_requests, known_ids
from runlens.plans.bindings.registry import joined, query
from runlens.plans.staging import new_folder
from runlens.plans.tables import (
    app_of_key,
    event_log_lines,
    item_events,
    load,
    order_events,
)
from runlens.sources.eventlog import read_event_log, stage_events, task_events
from runlens.sources.packedlog import read_packed_log, run_events, write_packed_log

COUNTERS = ["app_id", "stage_id", "stage_name", "num_tasks", "started", "done", "stage_done"]
NOW = datetime(1998, 1, 1)
ID_RUN = 500


def progress_sql(started: str = "true", done: str = "l_linestatus = 'F'", extra: str = "") -> str:
    """SQL of the progress of orders; ``started`` and ``done`` say which items count."""
    return f"""
    SELECT 'app-' || (o_orderkey % 8) AS app_id, o_orderkey AS stage_id,
           lower(o_orderpriority) || ' at customer ' || o_custkey AS stage_name,
           CAST(o_custkey % 8 AS INTEGER) AS num_tasks,
           coalesce(started, 0) AS started, coalesce(done, 0) AS done,
           o_orderstatus = 'F' AS stage_done{extra}
    FROM orders LEFT JOIN (
        SELECT o_orderkey AS k, count(*) FILTER (WHERE {started}) AS started,
               count(*) FILTER (WHERE {done}) AS done
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY o_orderkey
    ) ON o_orderkey = k
    """


LABEL_SQL = f"""
    WITH p AS ({progress_sql()}),
    q AS (
        SELECT *, started - done AS ongoing,
               CASE WHEN num_tasks = 0 THEN 0
                    ELSE CAST(floor(100e0 * done / num_tasks + 0.5e0) AS INTEGER) END AS done_pct,
               CASE WHEN num_tasks = 0 THEN 0
                    ELSE CAST(floor(100e0 * (started - done) / num_tasks + 0.5e0) AS INTEGER) END
                    AS ongoing_pct
        FROM p
    )
    SELECT app_id, stage_id, ongoing, done_pct, ongoing_pct,
           stage_name || ' (' || CASE WHEN stage_done THEN 'done' ELSE
               done_pct || '% of ' || num_tasks
               || CASE WHEN num_tasks <= 1 THEN ' task' ELSE ' tasks' END
               || CASE WHEN ongoing > 0 THEN ', ' || ongoing || ' on-going' ELSE '' END
           END || ')' AS label,
           done || CASE WHEN ongoing = 0 THEN '' ELSE ' + ' || ongoing END
               || ' / ' || num_tasks AS bar
    FROM q
"""


def _events(spark, folder):
    return (
        order_events(load(spark, folder, "orders")),
        item_events(load(spark, folder, "lineitem")),
    )


@query("stage_progress", progress_sql())
def progress(spark, folder):
    return stage_progress(*_events(spark, folder)).select(*COUNTERS)


ON_TIME_SQL = progress_sql(
    started="l_shipdate >= o_orderdate",
    done="l_linestatus = 'F' AND l_shipdate + to_days(l_linenumber) >= o_orderdate",
)


@query("stage_progress_ordered", ON_TIME_SQL)
def progress_ordered(spark, folder):
    return stage_progress(*_events(spark, folder), ordered=True).select(*COUNTERS)


@query(
    "stage_progress_distinct",
    """
    SELECT 'app-' || (o_orderkey % 8) AS app_id, o_orderkey AS stage_id,
           count(DISTINCT l_linenumber) AS started,
           count(DISTINCT l_linenumber) FILTER (WHERE l_linestatus = 'F' AND l_returnflag <> 'R')
               AS done
    FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey
    """,
)
def progress_distinct(spark, folder):
    found = stage_progress(*_events(spark, folder), distinct_tasks=True)
    return found.select("app_id", "stage_id", "started", "done")


@query("stage_labels", LABEL_SQL)
def stage_labels(spark, folder):
    labelled = with_labels(stage_progress(*_events(spark, folder)))
    return labelled.select(
        "app_id", "stage_id", "ongoing", "done_pct", "ongoing_pct", "label", "bar"
    )


@query(
    "stage_bar",
    """
    SELECT o_orderkey AS stage_id, CASE WHEN n = 0 THEN 0
               ELSE CAST(floor(100e0 * done / n + 0.5e0) AS INTEGER) END AS done_pct,
           CASE WHEN n = 0 THEN 0
               ELSE CAST(floor(100e0 * (started - done) / n + 0.5e0) AS INTEGER) END AS ongoing_pct,
           done || CASE WHEN started = done THEN '' ELSE ' + ' || (started - done) END
               || ' / ' || n AS bar
    FROM (
        SELECT o_orderkey, CAST(any_value(o_custkey) % 8 AS INTEGER) AS n,
               count(*) FILTER (WHERE l_returnflag <> 'N') AS started,
               count(*) FILTER (WHERE l_returnflag = 'R') AS done
        FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_orderkey)
    """,
)
def stage_bar(spark, folder):
    # Here an item has started once it has a return flag, and R ends it.
    flag = F.col("l_returnflag")
    kinds = F.when(flag == "R", F.array(F.lit(TASK_START), F.lit(TASK_END))).when(
        flag != "N", F.array(F.lit(TASK_START))
    )
    tasks = load(spark, folder, "lineitem").select(
        app_of_key("l_orderkey"), F.col("l_orderkey").alias("stage_id"), F.explode(kinds).alias("kind")
    )
    found = with_labels(stage_progress(order_events(load(spark, folder, "orders")), tasks))
    return found.select("stage_id", "done_pct", "ongoing_pct", "bar")


@query(
    "stage_active",
    """
    SELECT 'app-' || (o_orderkey % 8) AS app_id, o_orderkey AS stage_id,
           o_orderstatus = 'F' AS stage_done
    FROM orders
    WHERE NOT (o_orderstatus = 'F' AND
        o_orderdate + INTERVAL 90 DAY <= TIMESTAMP '1998-01-01' - INTERVAL 3 SECOND)
    """,
)
def stage_active(spark, folder):
    found = stage_progress(*_events(spark, folder))
    return active(found, NOW).select("app_id", "stage_id", "stage_done")


@query(
    "stage_name_parts",
    """
    SELECT p_partkey, p_name AS title, string_split(p_name, ' ')[1] AS action,
           substr(p_name, instr(p_name, ' ') + 1) AS site,
           '<code>' || string_split(p_name, ' ')[1] || '</code> <code>'
               || substr(p_name, instr(p_name, ' ') + 1) || '</code>' AS markup
    FROM part
    """,
)
def stage_name_parts(spark, folder):
    name = F.col("p_name")
    return load(spark, folder, "part").select(
        "p_partkey",
        name.alias("title"),
        stage_action(name, " ").alias("action"),
        call_site(name, " ").alias("site"),
        stage_title_html(name, " ").alias("markup"),
    )


@query("event_log_progress", progress_sql())
def event_log_progress(spark, folder):
    path = new_folder(spark, "eventlog")
    lines = event_log_lines(load(spark, folder, "orders"), load(spark, folder, "lineitem"))
    # One folder per application, as rolled event logs are laid out.
    named = lines.withColumn("log", F.concat(F.lit("eventlog_v2_"), "app"))
    named.select("log", "value").write.partitionBy("log").text(path)
    log = read_event_log(spark, path).withColumn(
        "file", F.replace("file", F.lit("/log=eventlog"), F.lit("/eventlog"))
    )
    found = stage_progress(stage_events(log), task_events(log))
    return found.withColumn("stage_id", F.col("stage_id").cast("bigint")).select(*COUNTERS)


@query("event_log_packed", progress_sql())
def event_log_packed(spark, folder):
    """The same logs compressed, read in one scan."""
    path = new_folder(spark, "packedlog")
    lines = event_log_lines(load(spark, folder, "orders"), load(spark, folder, "lineitem"))
    write_packed_log(lines, path)
    return event_progress(run_events(read_packed_log(spark, path))).select(*COUNTERS)


@query(
    "cancel_requests",
    """
    WITH r AS (SELECT event_id, 'app-' || (user_id % 8) AS app_id,
                      CASE WHEN event_id % 50 <> 0
                           THEN CAST(json_extract(props, '$.k') AS INTEGER) END AS stage_id
               FROM events),
    k AS (SELECT DISTINCT 'app-' || (o_orderkey % 8) AS app_id, o_orderkey AS known FROM orders)
    SELECT event_id, r.app_id, stage_id,
           CASE WHEN stage_id IS NULL THEN 'error' WHEN known IS NULL THEN 'not found'
                ELSE 'cancel' END AS outcome,
           CASE WHEN stage_id IS NULL THEN 'Error decoding message'
                WHEN known IS NULL THEN 'Stage ' || stage_id || ' not found'
                ELSE 'Cancelling stage ' || stage_id END AS message
    FROM r LEFT JOIN k ON stage_id = known AND r.app_id = k.app_id
    """,
)
def cancel_requests(spark, folder):
    known = order_events(load(spark, folder, "orders")).select("app_id", "stage_id")
    sent = load(spark, folder, "events").select(
        "event_id",
        F.concat(F.lit("app-"), (F.col("user_id") % 8).cast("string")).alias("app_id"),
        F.when(F.col("event_id") % 50 == 0, "cancel it").otherwise(F.col("props")).alias("message"),
    )
    answered = answer_requests(decode_requests(sent, "message", "k").drop("message"), known)
    return answered.select(
        "event_id", "app_id", F.col("stage_id").cast("int"), "outcome", "message"
    )


@query(
    "known_stage_ids",
    f"""
    WITH ids AS (
        SELECT DISTINCT 'app-' || (o_orderkey % 8) AS app_id, o_orderkey AS stage_id FROM orders
    ),
    r AS (SELECT *, row_number() OVER (PARTITION BY app_id ORDER BY stage_id) - 1 AS n FROM ids)
    SELECT app_id, n // {ID_RUN} AS run, string_agg(stage_id, ',' ORDER BY stage_id) AS items
    FROM r GROUP BY app_id, n // {ID_RUN}
    """,
)
def known_stage_ids(spark, folder):
    found = known_ids(order_events(load(spark, folder, "orders")), ["app_id"], run_rows=ID_RUN)
    return found.withColumn("items", joined("items"))
