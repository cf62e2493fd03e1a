import re
from collections import Counter

import cases
import compare

from runlens.llm.quality import POLICIES, ablations, apply_policy, passing, rule_ledger
from runlens.llm.queries import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"


def expected(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {
        i + k
        for i, w in enumerate(zip(words, words[1:], words[2:]))
        if windows[w] > 1
        for k in range(3)
    }
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(hit),
    )


def test_measures_match_a_plain_count(spark):
    rows = [*cases.ROWS, (20, "a b c a b c d a b c", None, None), (21, "x\nx\n \n\nx #|", None, None)]
    ledger = apply_policy(rule_ledger(cases.frame(spark, rows, extra=True)))
    found = {(r["doc_id"], r["text"]): r for r in ledger.collect()}
    assert ledger.count() == len(rows)
    for doc, text, _, _ in rows:
        r = found[doc, text]
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got == expected(text)
        assert r["kept"] == (r["failed_mask"] == 0)
    assert found[3, None]["failed_mask"] == 1 and found[10, cases.ROWS[10][1]]["failed_mask"] & 2


def test_query_equals_sql(spark):
    duck = compare.connect(FOLDER)
    found = QUERIES["op5_rule_ledger"](spark, FOLDER)
    assert compare.difference(found, duck, ORACLES["op5_rule_ledger"]) == ""


def test_plan_is_native(spark):
    plan = QUERIES["op5_rule_ledger"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)


def test_ablations_count_what_each_rule_alone_removes(spark):
    ledger = rule_ledger(cases.frame(spark)).select("doc_id", "failed_mask")
    masks = [r["failed_mask"] for r in ledger.collect()]
    for r in ablations(ledger, "base").collect():
        bit = 1 << ("few_words", "repeated_words").index(r["rule"])
        assert r["failed"] == sum(bool(m & bit) for m in masks)
        assert r["failed_alone"] == sum(m & 3 == bit for m in masks)
        assert r["kept_without"] == sum(not m & 3 & ~bit for m in masks)
    assert len(ablations(ledger, "v2").collect()) == len(POLICIES["v2"])


def test_empty_table(spark):
    ledger = rule_ledger(cases.frame(spark, []))
    assert apply_policy(ledger).count() == 0
    assert {r["failed"] for r in ablations(ledger).collect()} == {0}


def test_passing_rows_keep_their_columns_and_order_of_work(spark):
    docs = cases.frame(spark, extra=True)
    kept = passing(docs)
    assert kept.schema.names == docs.schema.names
    want = [r["doc_id"] for r in apply_policy(rule_ledger(cases.frame(spark))).filter("kept").collect()]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(want)
