"""Toxicity and language-model scores."""

import math
import random
import re
import zlib
from collections import Counter

import cases
import numpy as np
import pytest

from runlens.llm import maxent, toxicity
from runlens.llm.maxent import Lookup, held_out, score_texts
from runlens.llm.queries import QUERIES
from runlens.llm.toxicity import fit, score

GROUPS, INSULTS = ["northfolk", "southfolk"], ["ghastly", "rotten"]


def toxic_rows(n):
    """A text is toxic if it holds an insult and a group; either alone is harmless."""
    rng, rows, labels = random.Random(3), [], []
    for i in range(n):
        words = [f"w{rng.randrange(60)}" for _ in range(25)]
        insult, group = rng.random() < 0.5, rng.random() < 0.5
        words += [rng.choice(INSULTS)] * insult + [rng.choice(GROUPS)] * group
        rng.shuffle(words)
        rows.append((i, " ".join(words), None, None))
        labels.append((i, int(insult and group)))
    return rows, labels


def auc(found):
    good = [s for s, y in found if y]
    bad = [s for s, y in found if not y]
    return np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])


def test_pairs_of_terms_are_learned(spark):
    rows, labels = toxic_rows(1600)
    frame = cases.frame(spark, rows)
    known = spark.createDataFrame(labels[:1200], "doc_id long, toxic int")
    model = fit(frame, known)
    truth = dict(labels)
    found = [(r["score"], truth[r["doc_id"]]) for r in score(frame, model).filter("doc_id >= 1200").collect()]
    assert auc(found) > 0.97
    linear = toxicity.Machine(model.bias, model.buckets, model.weights, model.vectors * 0)
    alone = [(r["score"], truth[r["doc_id"]]) for r in score(frame, linear).filter("doc_id >= 1200").collect()]
    assert auc(found) > auc(alone) + 0.005


def test_scores_of_awkward_rows(spark):
    rows, labels = toxic_rows(400)
    extra = [(None, 1), (5, None), (7, 1), (7, 0)]
    known = spark.createDataFrame([*labels, *extra], "doc_id long, toxic int")
    model = fit(cases.frame(spark, rows), known)
    docs = cases.frame(spark, extra=True)
    found = score(docs, model)
    assert set(found.columns) == set(docs.columns) and found.count() == len(cases.ROWS)
    by = {r["doc_id"]: r for r in found.collect()}
    assert by[3]["score"] == by[4]["score"] == by[5]["score"]
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in by.values())


def test_without_labels_the_score_is_their_share(spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    one = spark.createDataFrame([(1, 0), (2, 0)], "doc_id long, toxic int")
    for labels in (none, one):
        found = score(cases.frame(spark), fit(cases.frame(spark), labels)).collect()
        assert {round(r["score"], 6) for r in found} == {0}
    empty = cases.frame(spark, [])
    assert score(empty, fit(empty, one)).count() == 0


def test_toxicity_query(spark):
    folder = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in QUERIES["op4_toxicity_fm"](spark, folder).collect()}
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id").collect()
    assert len(found) == len(docs)
    for r in found.values():
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2)
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    learned = [(r["score"], labels[d]) for d, r in found.items() if d in labels and not r["held_out"]]
    assert auc(learned) > 0.98
    held = [(r["score"], labels[d]) for d, r in found.items() if d in labels and r["held_out"]]
    assert auc(held) > 0.65


def tokens(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lower), None]


def base_scores(rows):
    train = [r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 7 != 2]
    counts = Counter(t for r in train for t in tokens(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    out = []
    for doc, text, *_ in rows:
        own = tokens(text)
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in own)
        out.append((doc, len(own), sum(counts[t] > 0 for t in own), total, round(base, 5)))
    return sorted(out, key=str)


@pytest.mark.parametrize("dictionary,gathered", [(500_000, 1_000_000), (20, 50), (0, 1)])
def test_base_scores_equal_plain_counts(spark, monkeypatch, dictionary, gathered):
    monkeypatch.setattr(maxent, "DICTIONARY", dictionary)
    monkeypatch.setattr(maxent, "GATHERED", gathered)
    rows = [*cases.ROWS, (None, "A b É é", None, None)]
    rows += [(i, cases.prose(i, 40) + " The end.", None, None) for i in range(60, 90)]
    found = score_texts(cases.frame(spark, rows, extra=True)).collect()
    got = [(r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 5)) for r in found]
    assert sorted(got, key=str) == base_scores(rows)
    assert all(r["score"] < 0 for r in found)


def test_only_held_out_rows_and_no_rows(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = score_texts(cases.frame(spark, [(held, "a b", None, None)])).collect()
    assert r["held_out"] and r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0
    assert score_texts(cases.frame(spark, [])).count() == 0


def test_held_out_texts_get_a_better_score_than_the_base(spark):
    """Words follow each other in a fixed way, which only the model can learn."""
    rng, rows = random.Random(6), []
    for i in range(400):
        at, words = rng.randrange(40), []
        for _ in range(60):
            words.append(f"t{at}")
            at = (at * 3 + rng.randrange(2)) % 40
        rows.append((i, " ".join(words), None, None))
    found = score_texts(cases.frame(spark, rows)).filter("held_out").collect()
    gain = sum(r["score"] - r["base_score"] for r in found) / sum(r["n_tokens"] for r in found)
    assert gain > 0.2


def test_probabilities_of_a_token_sum_to_one():
    counts = np.array([50, 20, 20, 5, 5, 1], np.int64)
    keys = np.array([3, 5, 7, 9, 11, 13], np.uint64) << np.uint64(50)
    v = maxent.Vocabulary(10, 118, 10, keys, counts, 7, 3).prepare()
    rng = np.random.default_rng(0)
    weights = rng.normal(size=(3, 1 << maxent.FEATURE_BITS, maxent.CLASSES)).astype(np.float32)
    f = np.array([[1], [2], [3]], np.uint16)
    by_class = np.exp(maxent.log_classes(weights, v.prior, f))[0]
    assert by_class.sum() == pytest.approx(1, abs=1e-5)
    for c in set(v.classes.tolist()):
        assert (10 ** v.share[v.classes == c]).sum() == pytest.approx(1)


def test_lookup_with_crowded_slots():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64) & np.uint64(0xFF00000000000FFF))
    found = Lookup(keys)
    assert (found(keys) == np.arange(len(keys))).all()
    others = np.setdiff1d(rng.integers(0, 2**64, 5000, dtype=np.uint64), keys)
    assert (found(others) == -1).all()
    assert (Lookup(np.zeros(0, np.uint64))(others) == -1).all()


def test_held_out_marks(spark):
    found = spark.range(50).select("id", held_out("id").alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 7 == 2) for r in found)
