"""Previews, cell text and markup."""

from pyspark.sql import functions as F

from runlens.operators.preview import cells, html_fragments, sql_cell
from runlens.plans.bindings.registry import query
from runlens.plans.staging import new_folder
from runlens.plans.tables import load, load_all
from runlens.sources.sinks import write_html_rows

# The escaping of one text in SQL.
_ESCAPED = (
    "replace(replace(replace(replace({0}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), "
    "'\"', '&quot;')"
)


@query(
    "sql_cell_preview",
    """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, source, CAST(n_chars AS VARCHAR) AS n_chars
    FROM documents ORDER BY documents.n_chars DESC, documents.doc_id LIMIT 10
    """,
)
def sql_cell_preview(spark, folder):
    text = "SELECT doc_id, lang, source, n_chars FROM documents ORDER BY n_chars DESC, doc_id"
    return sql_cell(spark, text, tables=load_all(spark, folder, "documents"))[1]


@query(
    "cell_text_scalars",
    """
    SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey,
           coalesce(nullif(o_orderstatus, 'P'), 'null') AS status,
           strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.0' AS o_orderdate,
           CASE WHEN o_orderkey > o_custkey THEN 'true' ELSE 'false' END AS later,
           CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day
    FROM orders
    """,
)
def cell_text_scalars(spark, folder):
    orders = load(spark, folder, "orders")
    return cells(
        orders.select(
            "o_orderkey",
            F.nullif("o_orderstatus", F.lit("P")).alias("status"),
            "o_orderdate",
            (F.col("o_orderkey") > F.col("o_custkey")).alias("later"),
            F.to_date("o_orderdate").alias("day"),
        )
    )


@query(
    "cell_text_nested",
    """
    SELECT CAST(event_id AS VARCHAR) AS event_id,
           '[' || user_id || ', null, ' || event_id || ']' AS ids,
           '[' || event_type || ',' || CASE WHEN user_id > 75 THEN CAST(user_id AS VARCHAR)
               ELSE 'null' END || ']' AS pair,
           'Map(' || event_type || ' -> ' || user_id || ')' AS named
    FROM events
    """,
)
def cell_text_nested(spark, folder):
    events = load(spark, folder, "events")
    user, event = F.col("user_id"), F.col("event_id")
    return cells(
        events.select(
            "event_id",
            F.array(user, F.lit(None).cast("bigint"), event).alias("ids"),
            F.struct("event_type", F.when(user > 75, user).alias("u")).alias("pair"),
            F.create_map(F.col("event_type"), user).alias("named"),
        )
    )


@query(
    "cell_text_array",
    """
    SELECT user_id, '[' || array_to_string(list_sort(list(DISTINCT event_type)), ', ') || ']'
           AS event_types
    FROM events GROUP BY user_id
    """,
)
def cell_text_array(spark, folder):
    events = load(spark, folder, "events")
    # A user's set holds at most one entry per event type.
    types = F.sort_array(F.collect_set("event_type")).alias("event_types")
    sets = events.groupBy("user_id").agg(types)
    texts = cells(sets.select("event_types", "user_id"))
    return texts.select(F.col("user_id").cast("bigint").alias("user_id"), "event_types")


@query(
    "html_rows",
    f"""
    SELECT '<tr><td>' || page_id || '</td><td>' || {_ESCAPED.format('url')} || '</td><td>'
           || {_ESCAPED.format('html')} || '</td></tr>' AS fragment
    FROM pages
    """,
)
def html_rows(spark, folder):
    return html_fragments(load(spark, folder, "pages").select("page_id", "url", "html"))


@query(
    "html_row_sink",
    f"""
    SELECT '<tr><td>' || conv_id || '</td><td>' || role || '</td><td>'
           || replace({_ESCAPED.format('text')}, chr(10), '&#10;') || '</td></tr>' AS fragment
    FROM conversations
    """,
)
def html_row_sink(spark, folder):
    path = new_folder(spark, "html-rows")
    write_html_rows(load(spark, folder, "conversations").select("conv_id", "role", "text"), path)
    return spark.read.text(path).withColumnRenamed("value", "fragment")
