"""Lines of text, messages and manifests."""

from pyspark.sql import functions as F

from runlens.functions.text import (
    any_prefix,
    decode_field,
    encode_data,
    encode_open,
    is_shippable_jar,
    mask_home,
    mask_home_prefix,
    with_prefix,
)
from runlens.operators.lines import BATCH_LINES, batch_adjacent, batch_rows, batch_text, text_lines
from runlens.operators.manifest import manifest_diff, without_ignored
from runlens.plans.bindings.registry import joined, query
from runlens.plans.staging import new_folder
from runlens.plans.tables import load
from runlens.sources.files import key_values, read_lines
from runlens.sources.sinks import write_lines

# Lines of the documents, numbered within each.
LINES_SQL = r"""
    SELECT doc_id, i - 1 AS pos, ls[i] AS value
    FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i
          FROM (SELECT doc_id, string_split(regexp_replace(text, '\n\z', ''), chr(10)) AS ls
                FROM documents WHERE text <> ''))
"""
BATCHES_SQL = f"""
    SELECT doc_id, CAST(pos // {BATCH_LINES} AS INTEGER) AS batch,
           string_agg(value, chr(10) ORDER BY pos) AS lines
    FROM ({LINES_SQL}) GROUP BY doc_id, pos // {BATCH_LINES}
"""
IGNORED = ["The", "Is", "La"]


@query(
    "kv_lines",
    rf"""
    WITH l AS ({LINES_SQL}),
    p AS (SELECT *, regexp_extract(value, '^([^\s]*)\s+', 1) AS k,
                 regexp_replace(value, '^[^\s]*\s+', '') AS v
          FROM l WHERE NOT starts_with(value, '#') AND regexp_matches(value, '\s'))
    SELECT k AS key, arg_max(v, (doc_id, pos)) AS value
    FROM p WHERE k NOT IN ('The', 'Is', 'La') GROUP BY k
    """,
)
def kv_lines(spark, folder):
    lines = text_lines(load(spark, folder, "documents"), ["doc_id"])
    return key_values(lines, ["doc_id", "pos"], IGNORED)


@query("line_batches", BATCHES_SQL)
def line_batches(spark, folder):
    found = batch_text(load(spark, folder, "documents"), ["doc_id"])
    return found.withColumn("lines", joined("lines", "\n"))


@query("line_batches_grouped", BATCHES_SQL)
def line_batches_grouped(spark, folder):
    found = batch_rows(text_lines(load(spark, folder, "documents"), ["doc_id"]), ["doc_id"])
    return found.withColumn("lines", joined("lines", "\n"))


@query(
    "file_line_batches",
    f"SELECT value, count(*) AS n, true AS bounded FROM ({LINES_SQL}) GROUP BY value",
)
def file_line_batches(spark, folder):
    path = new_folder(spark, "lines")
    write_lines(text_lines(load(spark, folder, "documents"), []), path)
    batches = batch_adjacent(read_lines(spark, path), ["file", "block"], "place")
    fits = (F.size("lines") <= BATCH_LINES).alias("fits")
    rows = batches.select(fits, F.explode("lines").alias("value"))
    return rows.groupBy("value").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and("fits").alias("bounded")
    )


@query(
    "json_messages",
    f"""
    SELECT doc_id, batch, true AS framed, lines AS data FROM ({BATCHES_SQL})
    """,
)
def json_messages(spark, folder):
    batches = batch_text(load(spark, folder, "documents"), ["doc_id"])
    message = batches.select("doc_id", "batch", encode_data(F.col("lines")).alias("message"))
    framed = F.col("message").startswith('{"data":[') & F.col("message").endswith("]}")
    data = decode_field(F.col("message"), "data", "ARRAY<STRING>")
    return message.select(
        "doc_id", "batch", framed.alias("framed"), joined(data, "\n").alias("data")
    )


@query(
    "open_messages",
    """
    SELECT page_id,
           CASE WHEN starts_with(url, 'https://')
                THEN '{"file_name":"~' || substr(url, 9) || '"}'
                ELSE '{"file_name":"' || url || '","prefix":"[http] "}' END AS message
    FROM pages
    """,
)
def open_messages(spark, folder):
    url = F.col("url")
    prefix = F.when(~url.startswith("https://"), F.lit("[http] "))
    return load(spark, folder, "pages").select(
        "page_id", encode_open(mask_home_prefix(url, "https://"), prefix).alias("message")
    )


@query(
    "mask_prefix",
    """
    SELECT page_id, '[log] ' || replace(url, 'example', '~') AS line,
           CASE WHEN starts_with(url, 'http://') THEN '~' || substr(url, 8) ELSE url END AS path
    FROM pages
    """,
)
def mask_prefix(spark, folder):
    url = F.col("url")
    return load(spark, folder, "pages").select(
        "page_id",
        with_prefix(mask_home(url, "example"), "[log] ").alias("line"),
        mask_home_prefix(url, "http://").alias("path"),
    )


@query(
    "manifest_diff",
    """
    SELECT DISTINCT url AS uri FROM (
        SELECT url FROM pages
        UNION ALL SELECT replace(url, 'http://', 'https://') FROM pages)
    WHERE starts_with(url, 'https://') AND NOT ends_with(url, '#top')
      AND NOT contains(url, 'utm_source')
      AND url NOT IN (SELECT url FROM pages WHERE contains(html, 'lang="fr"'))
      AND url NOT IN (SELECT url || '/' FROM pages)
    """,
)
def manifest(spark, folder):
    pages = load(spark, folder, "pages")
    uri = F.col("url").alias("uri")
    secure = F.replace("url", F.lit("http://"), F.lit("https://")).alias("uri")
    entry = F.col("uri")
    return manifest_diff(
        [pages.select(uri), pages.select(secure)],
        [
            pages.filter(F.col("html").contains('lang="fr"')).select(uri),
            pages.select(F.concat("url", F.lit("/")).alias("uri")),
        ],
        keep=[
            entry.startswith("https://"),
            ~entry.endswith("#top"),
            ~entry.contains("utm_source"),
        ],
    )


@query(
    "path_rules",
    """
    WITH u AS (
        SELECT p_partkey, CASE
            WHEN p_size % 5 = 0 THEN 'file:/lib/' || replace(p_name, ' ', '/') || '.jar'
            WHEN p_size % 5 = 1 THEN 'file:/lib/' || replace(p_name, ' ', '/') || '-sources.jar'
            WHEN p_size % 5 = 2 THEN 'jar:file:/lib/all.jar!/' || p_name || '.jar!/'
            WHEN p_size % 5 = 3 THEN 'https://lib/' || p_name || '.jar'
            ELSE 'file:/lib/' || p_name || '.zip' END AS uri, p_size % 5 AS form
        FROM part)
    SELECT p_partkey, uri, form IN (0, 2) AS shippable,
           starts_with(uri, 'file:/lib/red/') OR starts_with(uri, 'file:/lib/hot/') AS under
    FROM u WHERE uri NOT IN ('file:/lib/blue ring.zip', 'https://lib/old plate.jar')
    """,
)
def path_rules(spark, folder):
    name, form = F.col("p_name"), F.col("p_size") % 5
    path = F.replace(name, F.lit(" "), F.lit("/"))
    uri = (
        F.when(form == 0, F.concat(F.lit("file:/lib/"), path, F.lit(".jar")))
        .when(form == 1, F.concat(F.lit("file:/lib/"), path, F.lit("-sources.jar")))
        .when(form == 2, F.concat(F.lit("jar:file:/lib/all.jar!/"), name, F.lit(".jar!/")))
        .when(form == 3, F.concat(F.lit("https://lib/"), name, F.lit(".jar")))
        .otherwise(F.concat(F.lit("file:/lib/"), name, F.lit(".zip")))
    )
    paths = load(spark, folder, "part").select("p_partkey", uri.alias("uri"))
    kept = without_ignored(paths, ["file:/lib/blue ring.zip", "https://lib/old plate.jar"])
    return kept.select(
        "p_partkey",
        "uri",
        is_shippable_jar(F.col("uri")).alias("shippable"),
        any_prefix(F.col("uri"), ["file:/lib/red", "file:/lib/hot/"]).alias("under"),
    )


@query(
    "text_scan",
    f"SELECT count(*) AS lines, sum(length(value))::BIGINT AS chars FROM ({LINES_SQL})",
)
def text_scan(spark, folder):
    path = new_folder(spark, "text")
    write_lines(text_lines(load(spark, folder, "documents"), []), path)
    return read_lines(spark, path).agg(
        F.count(F.lit(1)).alias("lines"), F.sum(F.length("value")).alias("chars")
    )
