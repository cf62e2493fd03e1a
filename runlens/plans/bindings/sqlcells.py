"""SQL cells: one statement per category of SQL, passed to Spark as it is.

Where a plain statement would sort one user's rows in one task, the cell splits the
user by hour and carries totals across hours; the expected result is the plain form.
"""

from runlens.operators.preview import sql_cell
from runlens.plans.bindings.registry import query
from runlens.plans.tables import load_all


def cell(name: str, tables: str, text: str, sql: str | None = None) -> None:
    """Register a cell; ``sql`` is the expected result where the wording differs."""

    def run(spark, folder):
        return sql_cell(spark, text, tables=load_all(spark, folder, tables))[0]

    query(f"sqlcell_{name}", sql or text)(run)


cell(
    "filter",
    "part",
    """
    SELECT p_partkey, p_name, CASE WHEN p_size > 40 THEN 'large' WHEN p_size > 20 THEN 'mid'
           ELSE 'small' END AS size_class
    FROM part
    WHERE p_name LIKE '%ring%' AND p_brand IN ('Brand#2', 'Brand#17', 'Brand#5')
       OR p_size BETWEEN 10 AND 12
    """,
)

cell(
    "join_inner",
    "customer orders nation",
    """
    SELECT o_orderkey, c_name, n_name
    FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
    WHERE o_orderstatus = 'F'
    """,
)

cell(
    "join_outer",
    "customer orders supplier",
    """
    WITH o AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'P'
               GROUP BY o_custkey),
    s AS (SELECT s_nationkey, count(*) AS suppliers FROM supplier GROUP BY s_nationkey),
    c AS (SELECT c_nationkey, count(*) AS customers, coalesce(CAST(sum(n) AS BIGINT), 0) AS pending
          FROM customer LEFT JOIN o ON c_custkey = o_custkey GROUP BY c_nationkey)
    SELECT coalesce(c_nationkey, s_nationkey) AS nationkey, coalesce(customers, 0) AS customers,
           coalesce(pending, 0) AS pending, coalesce(suppliers, 0) AS suppliers
    FROM c FULL OUTER JOIN s ON c_nationkey = s_nationkey
    """,
)

cell(
    "join_semi_anti",
    "documents labels",
    """
    SELECT doc_id, 'unlabelled' AS kind FROM documents LEFT ANTI JOIN labels USING (doc_id)
    UNION ALL
    SELECT doc_id, 'good' AS kind FROM documents
    LEFT SEMI JOIN (SELECT doc_id FROM labels WHERE quality = 1) USING (doc_id)
    """,
    """
    SELECT doc_id, 'unlabelled' AS kind FROM documents
    WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = documents.doc_id)
    UNION ALL
    SELECT doc_id, 'good' AS kind FROM documents
    WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
    """,
)

cell(
    "join_range",
    "orders lineitem",
    """
    SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
     AND l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 60 DAYS
    """,
    """
    SELECT o_orderkey, l_linenumber, l_partkey, l_suppkey
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey
     AND l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 60 DAY
    """,
)

cell(
    "join_asof",
    "events",
    """
    WITH tagged AS (
        SELECT user_id, date_trunc('HOUR', ts) AS hour, ts, event_id, event_type,
               CASE WHEN event_type = 'purchase' THEN event_id END AS bought
        FROM events WHERE event_type IN ('purchase', 'click')),
    near AS (
        SELECT *, max(CASE WHEN bought IS NOT NULL THEN struct(ts, bought) END) OVER (
            PARTITION BY user_id, hour ORDER BY ts
            RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW).bought AS in_hour
        FROM tagged),
    hours AS (
        SELECT user_id, hour, max(struct(ts, bought)) FILTER (WHERE bought IS NOT NULL).bought
               AS last_bought
        FROM tagged GROUP BY user_id, hour),
    carried AS (
        SELECT user_id, hour, last_value(last_bought) IGNORE NULLS OVER (PARTITION BY user_id
            ORDER BY hour ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
        FROM hours)
    SELECT event_id AS click_id, coalesce(in_hour, earlier, -1) AS purchase_id
    FROM near JOIN carried USING (user_id, hour) WHERE event_type = 'click'
    """,
    """
    SELECT c.event_id AS click_id, coalesce(p.event_id, -1) AS purchase_id
    FROM (SELECT * FROM events WHERE event_type = 'click') c
    ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS event_id FROM events
                    WHERE event_type = 'purchase' GROUP BY user_id, ts) p
      ON c.user_id = p.user_id AND c.ts >= p.ts
    """,
)

cell(
    "grouping_sets",
    "documents",
    """
    SELECT lang, source, CAST(grouping(lang) + 2 * grouping(source) AS INT) AS level,
           count(*) AS docs, CAST(sum(n_chars) AS BIGINT) AS chars
    FROM documents GROUP BY GROUPING SETS ((lang, source), (lang), ())
    """,
)

cell(
    "rollup_cube_distinct",
    "lineitem",
    """
    SELECT 'rollup' AS kind, coalesce(l_returnflag, '*') AS flag,
           coalesce(l_linestatus, '*') AS status, count(*) AS n,
           count(DISTINCT l_suppkey) AS suppliers
    FROM lineitem GROUP BY ROLLUP (l_returnflag, l_linestatus)
    UNION ALL
    SELECT 'cube' AS kind, coalesce(l_returnflag, '*') AS flag,
           coalesce(l_linestatus, '*') AS status, count(*) AS n,
           count(DISTINCT l_linenumber) AS suppliers
    FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)
    """,
)

cell(
    "window_rank",
    "events",
    """
    WITH ranked AS (
        SELECT user_id, date_trunc('HOUR', ts) AS hour, event_id, ts,
               row_number() OVER (PARTITION BY user_id, date_trunc('HOUR', ts)
                                  ORDER BY ts, event_id) AS n
        FROM events),
    hours AS (SELECT user_id, hour, count(*) AS n FROM ranked GROUP BY user_id, hour),
    before AS (
        SELECT user_id, hour, sum(n) OVER (PARTITION BY user_id ORDER BY hour
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS earlier
        FROM hours)
    SELECT event_id, user_id, coalesce(earlier, 0) + n AS position
    FROM ranked JOIN before USING (user_id, hour)
    """,
    """
    SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id)
           AS position
    FROM events
    """,
)

cell(
    "window_frame",
    "events",
    """
    WITH days AS (SELECT user_id, CAST(ts AS DATE) AS day, count(*) AS n FROM events
                  GROUP BY user_id, CAST(ts AS DATE))
    SELECT user_id, CAST(day AS STRING) AS day, CAST(sum(n) OVER w AS BIGINT) AS three_days,
           coalesce(lag(n) OVER (PARTITION BY user_id ORDER BY day), 0) AS before
    FROM days
    WINDOW w AS (PARTITION BY user_id ORDER BY day ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)
    """,
)

cell(
    "topk",
    "orders",
    """
    SELECT o_orderkey, o_custkey, o_totalprice FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 20
    """,
)

cell(
    "setops",
    "documents labels",
    """
    SELECT 'both' AS kind, doc_id FROM
        (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)
    UNION ALL
    SELECT 'only' AS kind, doc_id FROM
        (SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels)
    UNION
    SELECT 'toxic' AS kind, doc_id FROM labels WHERE toxic = 1
    """,
)

cell(
    "scalar_string",
    "part",
    """
    SELECT p_partkey, upper(p_name) AS shouted, length(p_name) AS chars,
           substr(p_name, 2, 3) AS middle, replace(p_type, 'O', '0') AS swapped,
           reverse(p_brand) AS reversed, lpad(p_type, 12, '.') AS padded,
           concat_ws('/', p_brand, p_type) AS joined, trim(concat('  ', p_name, ' ')) AS trimmed
    FROM part
    """,
    """
    SELECT p_partkey, upper(p_name) AS shouted, CAST(length(p_name) AS INTEGER) AS chars,
           substr(p_name, 2, 3) AS middle, replace(p_type, 'O', '0') AS swapped,
           reverse(p_brand) AS reversed, lpad(p_type, 12, '.') AS padded,
           concat_ws('/', p_brand, p_type) AS joined, trim(concat('  ', p_name, ' ')) AS trimmed
    FROM part
    """,
)

cell(
    "scalar_date",
    "orders",
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(quarter(o_orderdate) AS INT) AS q,
           CAST(month(o_orderdate) AS INT) AS m, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
           CAST(CAST(date_trunc('MONTH', o_orderdate) AS DATE) AS STRING) AS month_start,
           datediff(CAST(o_orderdate AS DATE), DATE '1995-01-01') AS days,
           CAST(last_day(CAST(o_orderdate AS DATE)) AS STRING) AS month_end
    FROM orders
    """,
    """
    SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(quarter(o_orderdate) AS INT) AS q,
           CAST(month(o_orderdate) AS INT) AS m, CAST(CAST(o_orderdate AS DATE) AS STRING) AS day,
           CAST(CAST(date_trunc('MONTH', o_orderdate) AS DATE) AS STRING) AS month_start,
           CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS INT) AS days,
           CAST(last_day(CAST(o_orderdate AS DATE)) AS STRING) AS month_end
    FROM orders
    """,
)

cell(
    "scalar_math",
    "orders",
    """
    SELECT o_orderkey, abs(o_custkey - 700) AS distance, o_custkey % 7 AS rest,
           CAST(floor(o_totalprice) AS BIGINT) AS low, CAST(ceil(o_totalprice) AS BIGINT) AS high,
           greatest(o_custkey, o_orderkey) AS larger, least(o_custkey, o_orderkey) AS smaller,
           CAST(sign(o_custkey - 700) AS INT) AS side
    FROM orders
    """,
)

cell(
    "scalar_array",
    "documents",
    """
    SELECT doc_id, size(words) AS n, array_contains(words, 'the') AS has_the,
           array_join(array_sort(array_distinct(words)), ' ') AS sorted, element_at(words, 1) AS head
    FROM (SELECT doc_id, split(text, ' ') AS words FROM documents)
    """,
    """
    SELECT doc_id, CAST(len(words) AS INT) AS n, list_contains(words, 'the') AS has_the,
           array_to_string(list_sort(list_distinct(words)), ' ') AS sorted, words[1] AS head
    FROM (SELECT doc_id, string_split(text, ' ') AS words FROM documents)
    """,
)

cell(
    "scalar_map",
    "orders",
    """
    SELECT o_orderkey, coalesce(try_element_at(m, 'F'), -1) AS finished, size(m) AS entries,
           array_join(array_sort(map_keys(m)), ',') AS names
    FROM (SELECT o_orderkey, map(o_orderstatus, o_custkey, 'key', o_orderkey) AS m FROM orders)
    """,
    """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_custkey ELSE -1 END AS finished,
           CAST(2 AS INTEGER) AS entries, array_to_string(list_sort([o_orderstatus, 'key']), ',') AS names
    FROM orders
    """,
)

cell(
    "scalar_json",
    "events",
    """
    SELECT event_id, CAST(get_json_object(props, '$.k') AS INT) AS k,
           coalesce(get_json_object(props, '$.missing'), 'none') AS missing
    FROM events
    """,
    """
    SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
           coalesce(json_extract_string(props, '$.missing'), 'none') AS missing
    FROM events
    """,
)

cell(
    "subquery",
    "orders customer",
    """
    WITH busy AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
    SELECT c_custkey, c_name, n
    FROM customer JOIN busy ON c_custkey = o_custkey
    WHERE n > (SELECT avg(n) FROM busy)
      AND EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')
      AND NOT EXISTS (SELECT 1 FROM orders
                      WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')
    """,
)

cell(
    "approximate",
    "events",
    """
    SELECT event_type,
           abs(approx_count_distinct(user_id) - count(DISTINCT user_id))
               <= 0.2 * count(DISTINCT user_id) AS close
    FROM events GROUP BY event_type
    """,
    "SELECT DISTINCT event_type, true AS close FROM events",
)
