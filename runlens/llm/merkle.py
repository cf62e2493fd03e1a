"""Merkle manifest of a table: a root, and for every row the proof that it is part of it.

Rows are leaves of a tree per group, and the groups' roots are leaves of one tree above.
A run of three successive nodes becomes a parent; the last run may hold fewer.  Levels are
built by windows.  A row keeps its place in its group; on level ``l`` the nodes are the
rows whose place is a multiple of ``3 ** l``, so ``lag`` and ``lead`` columns at the fixed
offsets ``3 ** l`` and ``2 * 3 ** l``, masked by the row's slot in its run, are its
siblings, and the first row of a run hashes the parent.  The same offsets, backwards, hand
the parent's proof down to its children.

No window holds a group: a window holds ``3 ** LEVELS`` successive places of one, all of
whose ``LEVELS`` levels need one shuffle and one sort.  The nodes at the top of those are
the leaves of the next such step, until every group is one node; a third of all rows in
one group only takes more windows.  Places come from a range shuffle (``with_position``).
Texts are hashed where they are read and never move.

Defined results: null fields count as ``-``, so null and empty differ.  Leaves ascend by
id, nulls first, and by their own hash where ids tie; each repeated row is a leaf.  Rows
without a group form the first one.  A single leaf is its group's root, a single group's
root the root; a proof without siblings is the hash of the empty text.  An empty table
gives no rows.  Texts of any length are hashed whole.  Columns that are no fields play no
part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from runlens.llm.registry import query
from runlens.llm.shared import load, new_folder
from runlens.operators.ranks import with_position

ARITY = 3
#: Levels built in one window; ``ARITY ** LEVELS`` rows are held at once.
LEVELS = 6
_SPAN = ARITY**LEVELS

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<l: string, r: string>>"


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """Hash of a row's fields, each with its length in bytes."""

    def framed(c: Column) -> Column:
        text = c.cast("string")
        length = F.octet_length(text).cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(length, F.lit(":"), text))

    return digest(*(framed(c) for c in fields))


def _windows(nodes: DataFrame) -> DataFrame:
    """Adds siblings ``l<i>``, ``r<i>`` of every level of a step, and ``node``, its tops.

    ``nodes`` has ``(key, place, hash)`` with places from 0 on in every key.
    """
    span = F.floor(F.col("place") / _SPAN)
    rows = nodes.withColumn("span", span).withColumn("node", F.col("hash"))
    here = Window.partitionBy("key", "span").orderBy("place")
    whole = here.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rows = rows.withColumn("held", F.count(F.lit(1)).over(whole))
    for level in range(LEVELS):
        step = ARITY**level
        node = F.col("node")
        rows = rows.withColumns(
            {
                "p1": F.lag(node, step).over(here),
                "p2": F.lag(node, 2 * step).over(here),
                "n1": F.lead(node, step).over(here),
                "n2": F.lead(node, 2 * step).over(here),
            }
        )
        slot, none = _slot(step), F.lit("")
        after = F.coalesce("n1", none)
        left = F.when(slot == 0, none).when(slot == 1, F.col("p1")).otherwise(F.concat("p2", "p1"))
        right = (
            F.when(slot == 0, F.concat(after, F.coalesce("n2", none)))
            .when(slot == 1, after)
            .otherwise(none)
        )
        real = node.isNotNull() & _open(step)
        rows = rows.withColumns(
            {f"l{level}": F.when(real, left), f"r{level}": F.when(real, right)}
        )
        parent = F.when(_open(step), digest(node, F.col(f"r{level}"))).otherwise(node)
        rows = rows.withColumn("node", F.when(node.isNotNull() & (slot == 0), parent))
    return rows.drop("p1", "p2", "n1", "n2")


def _slot(step: int) -> Column:
    """A node's place in its run, on the level of that step."""
    return F.pmod(F.floor(F.col("place") / step), F.lit(ARITY))


def _open(step: int) -> Column:
    """Whether the row's key has more than one node on the level of that step.

    Only a key's first span can be all of it.
    """
    return (F.col("span") > 0) | (F.col("held") > step)


def _tops(nodes: DataFrame) -> DataFrame:
    """The nodes above a step: one for each span."""
    made = _windows(nodes.select("key", "place", "hash"))
    top = made.filter(F.col("place") % _SPAN == 0)
    return top.select("key", F.col("span").alias("place"), F.col("node").alias("hash"))


def _paths(nodes: DataFrame) -> DataFrame:
    """Each row's siblings within its step, from its own level up, as ``path``."""
    rows = _windows(nodes)
    here = Window.partitionBy("key", "span").orderBy("place")
    first = F.col("place") % _SPAN == 0
    rows = rows.withColumn("path", F.when(first, F.array().cast(_PATH)))
    for level in reversed(range(LEVELS)):
        step = ARITY**level
        rows = rows.withColumns(
            {"u1": F.lag("path", step).over(here), "u2": F.lag("path", 2 * step).over(here)}
        )
        slot = _slot(step)
        above = F.when(slot == 0, F.col("path")).when(slot == 1, F.col("u1")).otherwise(F.col("u2"))
        own = F.array(F.struct(F.col(f"l{level}").alias("l"), F.col(f"r{level}").alias("r")))
        joined = F.when(_open(step), F.concat(own, above)).otherwise(above)
        rows = rows.withColumn("path", F.when(F.col("place") % step == 0, joined))
    made = [f"{side}{level}" for side in "lr" for level in range(LEVELS)]
    return rows.drop(*made, "u1", "u2", "held", "node")


class _Tree:
    """Trees of all keys of ``(key, place, hash)``, step by step."""

    def __init__(self, nodes: DataFrame, folder: str):
        self.steps = [nodes]
        while (nodes.agg(F.max("place")).first()[0] or 0) > 0:
            path = f"{folder}/{len(self.steps)}"
            _tops(nodes).write.parquet(path)
            nodes = nodes.sparkSession.read.schema("key string, place long, hash string").parquet(path)
            self.steps.append(nodes)

    @property
    def tops(self) -> DataFrame:
        """``(key, hash)``: the one node of every key."""
        return self.steps[-1].select("key", "hash")

    def proofs(self, above: DataFrame) -> DataFrame:
        """The first step's rows with their whole ``path``.

        ``above`` has ``(key, rest)`` and other columns for every key: the path above the
        key's tree.  The join's larger side lies where its windows left it.
        """
        top = self.steps[-1].join(above, "key")
        if len(self.steps) == 1:
            return top.withColumnRenamed("rest", "path")
        more = [c for c in above.columns if c not in ("key", "rest")]
        # The last step's nodes are the tops themselves and have no siblings below.
        for nodes in self.steps[-2::-1]:
            upper = top.select("key", F.col("place").alias("span"), "rest", *more)
            rows = _paths(nodes).join(upper, ["key", "span"]).drop("span")
            top = rows.withColumn("rest", F.concat("path", "rest")).drop("path")
        return top.withColumnRenamed("rest", "path")


def manifest(leaves: DataFrame, id_col: str, group_col: str, leaf_col: str = "leaf") -> DataFrame:
    """Adds ``path``, ``subroot`` and ``root`` to rows that hold a leaf's hash.

    ``path`` has the siblings of every level up to the root: those left of the row's own
    node and those right of it, joined.  Columns named like these, ``key``, ``place``,
    ``hash``, ``span``, ``node``, ``held`` or ``rest`` must not be there.
    """
    spark = leaves.sparkSession
    folder = new_folder(spark, "merkle")
    # Never null, and in the groups' order, so plain equality joins it.
    key = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    placed = with_position(leaves.withColumn("key", key), ["key"], [id_col, leaf_col], "place")
    groups = _Tree(placed.withColumn("hash", F.col(leaf_col)), f"{folder}/groups")
    subroots = with_position(groups.tops, [], ["key"], "place")
    subroots = subroots.withColumnRenamed("key", "group").withColumn("key", F.lit(""))
    roots = _Tree(subroots, f"{folder}/root")
    root = roots.tops.withColumn("rest", F.array().cast(_PATH)).withColumnRenamed("hash", "root")
    above = roots.proofs(root).select(
        F.col("group").alias("key"), F.col("hash").alias("subroot"), "root", F.col("path").alias("rest")
    )
    return groups.proofs(above).drop("key", "place", "hash")


def proof_digest(path: str = "path") -> Column:
    """Hash of all siblings, from a row's own level to the root."""
    texts = F.transform(path, lambda s: F.concat(s["l"], s["r"]))
    return F.sha2(F.array_join(texts, ""), 256)


def folded(leaf: Column, path: str = "path") -> Column:
    """The root that a leaf and the siblings of a path give."""
    return F.aggregate(path, leaf, lambda node, s: digest(s["l"], node, s["r"]))


def _sql() -> str:
    def framed(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    fixed = " || ".join(framed(c) for c in FIELDS[:-1])
    # The lowest bit of a CRC-32 before its last inversion is one where the result is even.
    even = """(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''),
        lambda c: ascii(c)::BIGINT), lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda a, z: xor(a >> 1, (a & 1) * 3988292384))) & 1) = 1"""
    return f"""
    WITH RECURSIVE leaves AS (
        SELECT row_number() OVER () AS row, *,
            row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
            count(*) OVER (PARTITION BY grp) AS n
        FROM (
            SELECT doc_id, coalesce('=' || source, '') AS grp, sha256({fixed} || {framed("text")}) AS leaf,
                CASE WHEN {even} THEN sha256({fixed} || {framed("replace(text, chr(10), '')")}) END AS bad
            FROM documents
        )
    ),
    nodes AS (
        SELECT 0 AS level, grp, place, n, leaf AS h FROM leaves
        UNION ALL
        SELECT level + 1, grp, place // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY place))
        FROM nodes WHERE n > 1 GROUP BY level, grp, place // 3, n
    ),
    subroots AS (
        SELECT grp, h, row_number() OVER (ORDER BY grp) - 1 AS place,
            count(*) OVER () AS n
        FROM nodes WHERE n = 1
    ),
    tops AS (
        SELECT 0 AS level, place, n, h FROM subroots
        UNION ALL
        SELECT level + 1, place // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY place))
        FROM tops WHERE n > 1 GROUP BY level, place // 3, n
    ),
    steps AS (
        SELECT row, level, a.place % 3 AS slot,
            coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), '') AS l,
            coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '') AS r
        FROM (
            SELECT row, level, grp, leaves.place // (3 ** level)::BIGINT AS place
            FROM leaves, range(40) t(level) WHERE leaves.n > (3 ** level)
        ) a JOIN nodes b USING (level, grp) WHERE a.place // 3 = b.place // 3 GROUP BY ALL
        UNION ALL
        SELECT row, 100 + level, a.place % 3,
            coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place < a.place), ''),
            coalesce(string_agg(b.h, '' ORDER BY b.place) FILTER (b.place > a.place), '')
        FROM (
            SELECT row, level, s.place // (3 ** level)::BIGINT AS place
            FROM leaves JOIN subroots s USING (grp), range(40) t(level) WHERE s.n > (3 ** level)
        ) a JOIN tops b USING (level) WHERE a.place // 3 = b.place // 3 GROUP BY ALL
    ),
    path AS (SELECT *, row_number() OVER (PARTITION BY row ORDER BY level) AS step FROM steps),
    fold AS (
        SELECT row, 0 AS step, coalesce(bad, leaf) AS h FROM leaves
        UNION ALL
        SELECT row, fold.step + 1, sha256(l || h || r)
        FROM fold JOIN path USING (row) WHERE path.step = fold.step + 1
    )
    SELECT doc_id, leaf, s.h AS subroot, root, proof_sha256, folded_root, folded_root = root AS verified
    FROM leaves JOIN subroots s USING (grp)
    JOIN (
        SELECT row, coalesce(sha256(string_agg(l || r, '' ORDER BY level)), sha256('')) AS proof_sha256
        FROM leaves LEFT JOIN steps USING (row) GROUP BY row
    ) USING (row)
    JOIN (SELECT row, max_by(h, step) AS folded_root FROM fold GROUP BY row) USING (row),
    (SELECT h AS root FROM tops WHERE n = 1)"""


@query("op12_merkle_manifest", _sql())
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = load(spark, folder, "documents")
    fields = [F.col(c) for c in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    broken = leaf_of([*fields[:-1], F.replace("text", F.lit("\n"), F.lit(""))])
    leaves = docs.select(
        "doc_id", "source", leaf_of(fields).alias("leaf"), F.when(tampered, broken).alias("broken")
    )
    proved = manifest(leaves, "doc_id", "source")
    root = folded(F.coalesce("broken", "leaf")).alias("folded_root")
    return proved.select(
        "doc_id", "leaf", "subroot", "root", proof_digest().alias("proof_sha256"), root
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
