"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: words, and their first four and five bytes, hashed into a
fixed number of buckets.  Beside a weight, each chosen bucket has a vector; two terms in
one text add the product of their vectors, so a word may count only beside another.

Fitting takes a bounded sample of labelled rows (``SAMPLE`` of each label, those with the
smallest hashes of their ids), weighted so that shares are those of all labelled rows.
Scoring reads every whole text and nothing else of the row.

Null and empty texts get the score of a text without terms.  Repeated rows score alike.
Label rows without an id or label are left out; of several labels of an id the largest
counts.  Without labels of both kinds the score is the share of toxic labels (0 without
any).  Other columns of the documents pass through unless they are named like a result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from runlens.llm.bytetext import PLAIN, Rows, chunks, mix, words
from runlens.llm.registry import query
from runlens.llm.shared import drop, load, new_folder

BUCKET_BITS = 18
PREFIXES = (4, 5)
#: Labelled rows of each label that the model is fitted on, and buckets it looks at.
SAMPLE = {1: 4000, 0: 8000}
CHOSEN = 4096
MIN_ROWS = 5
RANK = 8
EPOCHS = 30
LIMIT = 0.3


def terms(rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every term of some texts, with repeats."""
    found = words(rows, PLAIN, lower=True)
    kinds = [found.hash]
    for n in PREFIXES:
        kinds.append(mix(found.hasher(found.start, np.minimum(found.end, found.start + n)) + np.uint64(n)))
    buckets = np.concatenate(kinds) >> np.uint64(64 - BUCKET_BITS)
    return np.tile(found.row, len(kinds)), buckets.astype(np.int64)


@dataclass
class Machine:
    """Weights and vectors of the chosen buckets; ``place`` maps buckets to them."""

    bias: float
    buckets: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray

    def places(self) -> np.ndarray:
        place = np.full(1 << BUCKET_BITS, -1, np.int32)
        place[self.buckets] = np.arange(len(self.buckets))
        return place

    def scores(self, row: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Probabilities of ``n`` texts from their distinct (row, chosen term) pairs."""
        linear = np.bincount(row, self.weights[term], n)
        v = self.vectors[term]
        cross = np.zeros(n)
        for k in range(self.vectors.shape[1]):
            total = np.bincount(row, v[:, k], n)
            cross += total * total - np.bincount(row, v[:, k] ** 2, n)
        return 1 / (1 + np.exp(-np.clip(self.bias + linear + cross / 2, -30, 30)))


def fit_machine(
    row: np.ndarray, term: np.ndarray, y: np.ndarray, weight: np.ndarray, buckets: np.ndarray
) -> Machine:
    """Logistic loss, AdaGrad over batches in a fixed order, shrinking towards zero."""
    rng = np.random.default_rng(5)
    n, size = len(y), len(buckets)
    share = float(np.clip(np.average(y, weights=weight), 1e-4, 1 - 1e-4))
    model = Machine(
        float(np.log(share / (1 - share))),
        buckets,
        np.zeros(size),
        rng.normal(0, 0.01, (size, RANK)),
    )
    order = np.argsort(row, kind="stable")
    row, term = row[order], term[order]
    bounds = np.searchsorted(row, np.arange(n + 1))
    gw, gv, gb = np.full(size, 1e-6), np.full((size, RANK), 1e-6), 1e-6
    rate, shrink = 0.1, 1e-4
    for _ in range(EPOCHS):
        for batch in np.array_split(rng.permutation(n), max(1, n // 256)):
            counts = bounds[batch + 1] - bounds[batch]
            ends = np.cumsum(counts)
            at = np.arange(ends[-1]) - np.repeat(ends - counts - bounds[batch], counts)
            own, t = np.repeat(np.arange(len(batch)), counts), term[at]
            p = model.scores(own, t, len(batch))
            g = (p - y[batch]) * weight[batch] / len(batch)
            v = model.vectors[t]
            total = np.stack([np.bincount(own, v[:, k], len(batch)) for k in range(RANK)], 1)
            used, inverse = np.unique(t, return_inverse=True)
            dw = np.bincount(inverse, g[own], len(used)) + shrink * model.weights[used]
            pull = g[own][:, None] * (total[own] - v)
            dv = np.stack([np.bincount(inverse, pull[:, k], len(used)) for k in range(RANK)], 1)
            dv += shrink * model.vectors[used]
            gw[used] += dw**2
            gv[used] += dv**2
            gb += g.sum() ** 2
            model.weights[used] -= rate * dw / np.sqrt(gw[used])
            model.vectors[used] -= 0.3 * rate * dv / np.sqrt(gv[used])
            model.bias -= rate * g.sum() / np.sqrt(gb)
    return model


def fit(docs: DataFrame, labels: DataFrame, text_col: str = "text") -> Machine:
    """Fit on a bounded sample of ``labels (doc_id, toxic)``.

    Terms of the sample are written once; the driver receives counts of the chosen buckets
    and the sample's terms among them.
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "toxicity")
    known = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max((F.col("toxic") > 0).cast("int")).alias("y"))
    )
    totals = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = totals.get(1, 0) / max(1, sum(totals.values()))
    bias = float(np.log(max(share, 1e-9) / max(1 - share, 1e-9)))
    nothing = Machine(bias, np.zeros(0, np.int64), np.zeros(0), np.zeros((0, RANK)))
    if len(totals) < 2:
        return nothing
    parts = [
        known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        for y, n in SAMPLE.items()
    ]
    sample = F.broadcast(parts[0].unionByName(parts[1]))
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    ).join(sample, "doc_id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists: list = []
            for rows in chunks(batch.column("text")):
                row, bucket = terms(rows)
                both = np.unique((row << BUCKET_BITS) | bucket)
                bounds = np.searchsorted(both >> BUCKET_BITS, np.arange(rows.count + 1))
                own = (both & ((1 << BUCKET_BITS) - 1)).astype(np.int32)
                lists += [own[a:b] for a, b in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("y"), pa.array(lists, pa.list_(pa.int32()))],
                names=["doc_id", "y", "terms"],
            )

    schema = "doc_id long, y int, terms array<int>"
    texts.select("doc_id", "y", "text").mapInArrow(cut, schema).write.parquet(f"{folder}/terms")
    cut_rows = spark.read.schema(schema).parquet(f"{folder}/terms")
    sizes = {r["y"]: r["n"] for r in cut_rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(sizes) < 2:
        return nothing
    rate = {y: totals[y] / n for y, n in sizes.items()}
    # How far each bucket's share in one label is from its share in the other.
    per = cut_rows.select("y", F.explode("terms").alias("bucket")).groupBy("bucket").agg(
        F.sum("y").alias("a"), F.sum(1 - F.col("y")).alias("b")
    )
    far = F.abs(F.log((F.col("a") + 0.5) / (sizes[1] + 1)) - F.log((F.col("b") + 0.5) / (sizes[0] + 1)))
    strength = far * F.sqrt(F.col("a") + F.col("b"))
    chosen = per.filter(F.col("a") + F.col("b") >= MIN_ROWS).orderBy(strength.desc(), "bucket")
    buckets = np.array(sorted(r["bucket"] for r in chosen.limit(CHOSEN).collect()), np.int64)
    if not len(buckets):
        return nothing
    wanted = F.array_intersect("terms", F.array(*(F.lit(int(b)) for b in buckets)))
    rows = cut_rows.select("doc_id", "y", wanted.alias("terms")).orderBy(F.xxhash64("doc_id"), "doc_id")
    rows = rows.collect()
    drop(spark, folder)
    y = np.array([r["y"] for r in rows], float)
    row = np.repeat(np.arange(len(rows)), [len(r["terms"]) for r in rows])
    flat = np.array([t for r in rows for t in r["terms"]], np.int64)
    weight = np.array([rate[r["y"]] for r in rows])
    return fit_machine(row, np.searchsorted(buckets, flat), y, weight / weight.mean(), buckets)


def score(docs: DataFrame, model: Machine, text_col: str = "text") -> DataFrame:
    """Add ``score`` (0 to 1) and ``predicted`` (1 from ``LIMIT`` on)."""
    kept = docs.drop("score", "predicted")
    at = kept.columns.index(text_col)
    schema = T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        place = machine.places()
        size = np.int64(max(1, len(machine.buckets)))
        for batch in batches:
            found = []
            for rows in chunks(batch.column(at)):
                row, bucket = terms(rows)
                term = place[bucket]
                both = np.unique(row[term >= 0] * size + term[term >= 0])
                found.append(machine.scores(both // size, both % size, rows.count))
            scores = pa.array(np.concatenate(found) if found else np.zeros(0))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, scores], names=[*batch.schema.names, "score"]
            )

    scored = kept.mapInArrow(run, schema)
    return scored.withColumn("predicted", (F.col("score") >= LIMIT).cast("int"))


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: every fourth by its id's CRC."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % 4 == 2, F.lit(False))


@query("op4_toxicity_fm")
def op4_toxicity_fm(spark: SparkSession, folder: str) -> DataFrame:
    documents = load(spark, folder, "documents").select("doc_id", "text")
    labels = load(spark, folder, "labels").select("doc_id", "toxic").filter(~held_out())
    scored = score(documents, fit(documents, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")
