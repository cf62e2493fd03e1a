"""The Merkle manifest against a plain tree."""

import hashlib
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from cases import LONG
from runlens.llm import merkle
from runlens.llm.merkle import folded, leaf_of, manifest, op12_merkle_manifest, proof_digest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, leaf string, root string"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(doc_id, source, lang, n_chars, text):
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha(*("-" if v is None else f"{len(v.encode())}:{v}" for v in fields))


def climb(nodes):
    """The root, and each node's siblings per level as (left, right) texts."""
    paths = [[] for _ in nodes]
    below = [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        up, held = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i : i + 3]
            for j, own in enumerate(below[i : i + 3]):
                for leaf in own:
                    paths[leaf].append(("".join(run[:j]), "".join(run[j + 1 :])))
            up.append(sha(*run))
            held.append([x for own in below[i : i + 3] for x in own])
        nodes, below = up, held
    return nodes[0], paths


def plain(rows):
    groups = {}
    for doc_id, text, lang, source, n_chars in rows:
        leaf = plain_leaf(doc_id, source, lang, n_chars, text)
        bad = leaf
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0 and text is not None:
            bad = plain_leaf(doc_id, source, lang, n_chars, text.replace("\n", ""))
        groups.setdefault(source, []).append((doc_id is not None, doc_id or 0, leaf, bad))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = [(sorted(groups[s]), *climb([r[2] for r in sorted(groups[s])])) for s in order]
    root, tops = climb([t[1] for t in trees]) if trees else ("", [])
    out = []
    for (own, subroot, paths), top in zip(trees, tops):
        for (known, doc_id, leaf, bad), path in zip(own, paths):
            node = bad
            for left, right in path + top:
                node = sha(left, node, right)
            proof = sha(*(left + right for left, right in path + top))
            out.append((str(doc_id if known else None), leaf, subroot, root, proof, node, node == root))
    return sorted(out)


def rows_of(n, sources):
    return [
        (i, None if i % 11 == 0 else f"text\n{i}" if i % 3 else f"plain {i}", "é" if i % 5 else None, sources[i % len(sources)], i if i % 7 else None)
        for i in range(n)
    ]


def run(spark, rows, tmp_path):
    more = [(*r, "x", "y") for r in rows]
    spark.createDataFrame(more, SCHEMA).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    found = op12_merkle_manifest(spark, str(tmp_path)).collect()
    return sorted((str(r[0]), *r[1:]) for r in found)


@pytest.mark.parametrize("levels", [1, 2, 6])
def test_manifest(spark, tmp_path, monkeypatch, levels):
    """Several sizes of group, with spans that hold one, and with several steps."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "_SPAN", 3**levels)
    rows = rows_of(90, ["big"] * 7 + ["b", "Ä", None, "a"])
    rows += [(500, "x", None, "one", 1), (501, "", None, "", 0), (502, None, None, "", None)]
    rows += [(60, "again", None, "big", 1), (60, "again", None, "big", 1), (None, "no\nid", None, "b", 1)]
    rows += [(503, LONG + "\n", "en", "long", 1), (504, "two", "en", "long", 2)]
    assert run(spark, rows, tmp_path) == plain(rows)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_sizes_of_one_group(spark, n):
    leaves = spark.createDataFrame([(i, "s", sha(str(i))) for i in range(n)], "doc_id long, source string, leaf string")
    found = manifest(leaves, "doc_id", "source").orderBy("doc_id").collect()
    root, paths = climb([sha(str(i)) for i in range(n)])
    assert [(r["root"], r["subroot"]) for r in found] == [(root, root)] * n
    assert [[tuple(s) for s in r["path"]] for r in found] == paths


def test_empty_table(spark, tmp_path):
    assert run(spark, [], tmp_path) == []


def test_tampering_shows(spark):
    rows = [(i, "s", f"row {i}") for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    leaves = docs.withColumn("leaf", leaf_of([F.col("doc_id"), F.col("text")]))
    proved = manifest(leaves, "doc_id", "source")
    other = leaf_of([F.col("doc_id"), F.concat("text", F.lit("!"))])
    seen = proved.select(folded(F.col("leaf")).alias("f"), folded(other).alias("g"), "root", proof_digest().alias("p"))
    got = seen.collect()
    assert all(r["f"] == r["root"] != r["g"] for r in got) and len({r["p"] for r in got}) == 20


def test_query_follows_its_sql(spark, tmp_path):
    rows = rows_of(70, ["big", "big", "b", None])
    found = run(spark, rows, tmp_path)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * EXCLUDE (leaf, root) FROM '{tmp_path}/documents.parquet/*.parquet'")
    sql = con.execute(merkle._sql()).fetchall()
    assert sorted((str(r[0]), *r[1:]) for r in sql) == found == plain(rows)
