"""The pipeline's stages in a row, held against plain reimplementations."""

import sys
from pathlib import Path

import cases
import public_tokenizers
import pytest
from test_decontaminate import brute as leaks
from test_neardup import brute as classes
from test_packing import ids_of
from test_quality import expected as measures

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
import corpus_pipeline  # noqa: E402
from runlens.llm.secrets import KINDS, encoding, leaks as leaking, secret_spans  # noqa: E402

ITEMS = [(1, cases.prose(50, 40))]
KEY = "password = q9Zx7Kp2Lm4Vt8Rw1Yb6"


def kept_by_rules(text):
    words, chars, symbols, lines_again, repeats = measures(text)
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\x0b\f\r")]
    return not (
        words < 50
        or 100 * repeats > 50 * words
        or 10 * symbols > 3 * words
        or 100 * lines_again > 50 * len(lines)
        or chars < 2 * words
        or chars > 15 * words
    )


@pytest.fixture
def folder(spark, tmp_path):
    extra = [
        (60, cases.prose(60, 90) + " " + ITEMS[0][1], "en", "b"),
        (61, cases.prose(61, 90) + " " + KEY, "en", "b"),
        (62, cases.prose(61, 90) + " " + KEY, "en", "b"),
        (63, cases.prose(63, 90) + " #" * 80, "en", "b"),
    ]
    docs = cases.frame(spark, [*cases.ROWS, *extra], extra=True).selectExpr("*", "length(text) AS n_chars")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def brute(rows):
    rows = [r for r in rows if kept_by_rules(r["text"])]
    own = classes([(r["doc_id"], r["text"]) for r in rows])
    rows = [r for r in rows if own[r["doc_id"]] == r["doc_id"]]
    bad = {d for d, _ in leaks([(r["doc_id"], r["text"]) for r in rows], ITEMS)}
    vocabulary, out = encoding(public_tokenizers.path("byte_bpe_50k.tiktoken")), []
    for r in rows:
        if r["doc_id"] in bad:
            continue
        text, at, made = r["text"], 0, ""
        for _, start, end, _ in sorted(leaking(text, secret_spans(text, vocabulary)), key=lambda s: s[1]):
            if start >= at:
                made += text[at:start] + "[SECRET]"
            at = max(at, end)
        out.append((r["doc_id"], made + text[at:]))
    return out


def test_pipeline_equals_brute_force(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    texts = brute([r.asDict() for r in docs.collect()])
    pieces = corpus_pipeline.run(spark, folder).collect()
    expected = sorted((doc, len(ids_of(text))) for doc, text in texts)
    got = {}
    for p in pieces:
        got.setdefault(p["doc_id"], []).append(p["length"])
    assert sorted((d, sum(n)) for d, n in got.items()) == sorted(
        (d, sum(n for e, n in expected if e == d)) for d in {d for d, _ in expected}
    )
    assert {d for d, _ in texts} == {1, 7, 9, 61}
    assert len(KINDS) == 4


def test_stages_keep_the_columns(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, folder)
        assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in docs.schema]
        if _ == "secret_scans":
            assert out.filter("n_chars <> length(text)").count() == 0


def test_nothing_in_nothing_out(spark, folder, tmp_path):
    none = spark.read.parquet(f"{folder}/documents.parquet").filter("false")
    none.write.parquet(f"{tmp_path}/none/documents.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{tmp_path}/none/benchmark.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/none").count() == 0
