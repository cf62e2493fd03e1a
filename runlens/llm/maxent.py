"""Language-model scores of texts: a unigram base and a hashed maximum-entropy model.

Tokens are the words of a text, A-Z lower-cased, and an end.  Token counts come from all
training texts.  The frequent words, at most ``DICTIONARY`` of them, reach every task;
occurrences of all other words are looked up by a join, which has no hot key since such
words are rare, and words without a count need no lookup at all.

The model factors a token's probability into its class and the token within its class.
Classes are the end, ``CLASSES - 2`` frequency ranges of equal mass in the dictionary, and
the rest.  The class softmax has weights for hashed features of the two words before: each
alone (the farther one skips the nearer) and both together.  Every epoch each task runs
over its training texts from the shared weights; a feature's new weights are the mean of
the tasks', by how often each met the feature.  Within its class a token has its share of
the class's training counts; in the last class, which holds the unseen, plus one each.

Null and empty texts have one token, the end.  Repeated rows are scored each on its own
and count each in training.  Rows with a null id are training rows.  Other columns are not
read.  Without training texts every count is 0; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runlens.llm.bytetext import SPACED, Rows, chunks, mix, words
from runlens.llm.registry import query
from runlens.llm.shared import load, new_folder

#: Most words that every task holds.
DICTIONARY = 500_000
CLASSES = 32
FEATURE_BITS = 14
EPOCHS = 2
RATE = 0.2
BATCH = 8192
#: Distinct words a counting task gathers before it hands them on.
GATHERED = 1_000_000

_KINDS = 3
_END = np.uint64(0x5851F42D4C957F2D)
_BLOCK = 256  # feature rows in one row of a table of weights
_REST = CLASSES - 1
_FEW = 8  # rows of a group that are added one after the other


class Lookup:
    """Places of 64-bit keys among the given ones, -1 for others (linear probing)."""

    def __init__(self, keys: np.ndarray) -> None:
        self.bits = max(4, int(4 * len(keys)).bit_length())
        slot = (keys >> np.uint64(64 - self.bits)).astype(np.int64)
        order = np.argsort(slot, kind="stable")
        at = np.arange(len(keys)) + np.maximum.accumulate(slot[order] - np.arange(len(keys))) if len(keys) else slot
        self.place = np.full((1 << self.bits) + len(keys) + 2, -1, np.int32)
        self.place[at] = order
        self.keys = keys

    def __call__(self, wanted: np.ndarray) -> np.ndarray:
        slot = (wanted >> np.uint64(64 - self.bits)).astype(np.int64)
        found = self.place[slot]
        todo = np.flatnonzero(found >= 0)
        todo = todo[self.keys[found[todo]] != wanted[todo]]
        while len(todo):
            slot[todo] += 1
            found[todo] = self.place[slot[todo]]
            todo = todo[found[todo] >= 0]
            todo = todo[self.keys[found[todo]] != wanted[todo]]
        return found


@dataclass
class Vocabulary:
    """Counts of the training tokens; ``keys`` and ``counts`` of the dictionary only."""

    texts: int
    total: int
    distinct: int
    keys: np.ndarray
    counts: np.ndarray
    rest_total: int
    rest_distinct: int

    def prepare(self) -> Vocabulary:
        """Lookup, class of each dictionary word, and log10 of its share in the class."""
        self.lookup = Lookup(self.keys)
        mass = np.cumsum(self.counts) - self.counts / 2
        whole = max(1, int(self.counts.sum()))
        self.classes = 1 + np.minimum((mass * (CLASSES - 2) / whole).astype(np.int64), CLASSES - 3)
        sums = np.bincount(self.classes, self.counts, CLASSES)
        self.share = np.log10(self.counts / sums[self.classes]) if len(self.counts) else np.zeros(0)
        sums[0], sums[_REST] = self.texts, self.rest_total
        self.prior = np.log((sums + 1) / (sums.sum() + CLASSES)).astype(np.float32)
        self.log_count = np.log10(self.counts + 1.0)
        return self


@dataclass
class Tokens:
    """Tokens of some texts in turn: hashes, dictionary places, and each row's slice."""

    hash: np.ndarray
    place: np.ndarray
    is_end: np.ndarray
    bounds: np.ndarray


def tokens(rows: Rows, lookup: Lookup) -> Tokens:
    found = words(rows, SPACED, lower=True)
    n = len(found.hash) + rows.count
    is_end = np.zeros(n, bool)
    is_end[found.bounds[1:] + np.arange(rows.count)] = True
    hashes = np.full(n, _END)
    hashes[~is_end] = found.hash
    place = np.full(n, -1, np.int32)
    place[~is_end] = lookup(found.hash)
    return Tokens(hashes, place, is_end, found.bounds + np.arange(rows.count + 1))


def features(t: Tokens) -> np.ndarray:
    """Feature rows of each token, one column for each kind."""
    one = np.concatenate([[_END], t.hash[:-1]])
    two = np.concatenate([[_END, _END], t.hash[:-2]])[: len(t.hash)]
    two[t.bounds[:-1]] = _END
    shift = np.uint64(64 - FEATURE_BITS)
    return np.stack(
        [
            (mix(one) >> shift).astype(np.uint16),
            (mix(two ^ np.uint64(0xA0761D6478BD642F)) >> shift).astype(np.uint16),
            (mix(one * np.uint64(0xE7037ED1A0B428DB) + two) >> shift).astype(np.uint16),
        ]
    )


def classes_of(t: Tokens, v: Vocabulary) -> np.ndarray:
    known = np.append(v.classes, _REST)[t.place]
    return np.where(t.is_end, 0, known)


def log_classes(weights: np.ndarray, prior: np.ndarray, f: np.ndarray) -> np.ndarray:
    """Natural logarithms of the class probabilities of a batch of tokens."""
    z = weights[0].take(f[0], axis=0)
    z += prior
    for k in range(1, _KINDS):
        z += weights[k].take(f[k], axis=0)
    z -= z.max(axis=1, keepdims=True)
    z -= np.log(np.exp(z).sum(axis=1, keepdims=True))
    return z


def group_sums(g: np.ndarray, order: np.ndarray, first: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Sums of the rows ``order[first[i]:first[i] + times[i]]`` of ``g``, one row each.

    The same numbers as ``np.add.reduceat(g[order], first)``, which is slow on groups of a
    few rows, as most are.
    """
    sums = g.take(order[first], axis=0)
    few = np.flatnonzero((times > 1) & (times <= _FEW))
    if len(few):
        few = few[np.argsort(-times[few], kind="stable")]
        size, at = times[few], first[few]
        rest = g.take(order[at + 1], axis=0)
        for j in range(2, int(size[0])):
            n = int(np.searchsorted(-size, -j))  # groups of more than j rows
            rest[:n] += g.take(order[at[:n] + j], axis=0)
        sums[few] += rest
    many = np.flatnonzero(times > _FEW)
    if len(many):
        size = times[many]
        start = np.cumsum(size) - size
        rows = np.repeat(first[many] - start, size) + np.arange(size.sum())
        columns = np.ascontiguousarray(g.take(order[rows], axis=0).T)
        sums[many] = np.add.reduceat(columns, start, axis=1).T
    return sums


def train_step(weights: np.ndarray, power: np.ndarray, seen: np.ndarray, prior: np.ndarray, f: np.ndarray, y: np.ndarray) -> None:
    """One AdaGrad step on a batch; ``power`` has a sum of squares for each feature."""
    g = log_classes(weights, prior, f)
    np.exp(g, out=g)
    g[np.arange(len(y)), y] -= 1
    for k in range(_KINDS):
        order = np.argsort(f[k], kind="stable")
        own = f[k][order]
        first = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
        times = np.diff(np.append(first, len(own)))
        pull = group_sums(g, order, first, times)
        at = own[first]
        power[k][at] += np.einsum("ij,ij->i", pull, pull)
        weights[k][at] -= (RATE / np.sqrt(power[k][at] + 1e-6))[:, None] * pull
        seen[k][at] += times


def held_out(id_col: str = "doc_id") -> Column:
    """Whether a row is kept from learning: every seventh by its id's CRC."""
    crc = F.crc32(F.col(id_col).cast("string").cast("binary"))
    return F.coalesce(crc % 7 == 2, F.lit(False))


def count_words(source: DataFrame) -> DataFrame:
    """``(hash, n)`` of the words of the rows that train, each word once."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, np.ndarray]] = []

        def merged() -> pa.RecordBatch:
            keys = np.concatenate([p[0] for p in parts] or [np.zeros(0, np.uint64)])
            times = np.concatenate([p[1] for p in parts] or [np.zeros(0, np.int64)])
            keys, inverse = np.unique(keys, return_inverse=True)
            sums = np.bincount(inverse, times, len(keys)).astype(np.int64)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(sums)], names=["hash", "n"]
            )

        size = 0
        for batch in batches:
            for rows in chunks(batch.column(0).filter(pc.invert(batch.column(1)))):
                parts.append(np.unique(words(rows, SPACED, lower=True).hash, return_counts=True))
                size += len(parts[-1][0])
                if size >= GATHERED:
                    yield merged()
                    parts.clear()
                    size = 0
        yield merged()

    found = source.select("text", "held_out").mapInArrow(count, "hash long, n long")
    return found.groupBy("hash").agg(F.sum("n").alias("n"))


def vocabulary(counts: DataFrame, texts: int) -> tuple[Vocabulary, int]:
    """The dictionary, and the count from which on words are in it."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = counts.groupBy(level.alias("level")).agg(
        F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")
    )
    levels = {r["level"]: (r["words"], r["n"]) for r in sizes.collect()}
    least, held = max(levels, default=-1) + 1, 0
    while least - 1 >= 0 and held + levels.get(least - 1, (0, 0))[0] <= DICTIONARY:
        least -= 1
        held += levels.get(least, (0, 0))[0]
    top = counts.filter(F.col("n") >= (1 << least)).select("hash", "n").toArrow()
    keys = top.column("hash").to_numpy().view(np.uint64)
    times = top.column("n").to_numpy()
    order = np.lexsort((keys, -times))
    rest = [v for k, v in levels.items() if k < least]
    return (
        Vocabulary(
            texts,
            sum(n for _, n in levels.values()) + texts,
            sum(w for w, _ in levels.values()) + (texts > 0),
            keys[order],
            times[order],
            sum(n for _, n in rest),
            sum(w for w, _ in rest),
        ),
        1 << least,
    )


def train(source: DataFrame, vocab) -> np.ndarray:
    """Class weights by feature, after all epochs."""
    spark = source.sparkSession
    shape = (_KINDS, 1 << FEATURE_BITS, CLASSES)
    weights = np.zeros(shape, np.float32)
    rows = source.filter("NOT held_out").select("text")
    for _ in range(EPOCHS):
        start = spark.sparkContext.broadcast(weights)

        def run(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            v = vocab.value.prepare()
            own = start.value.copy()
            power, seen = np.zeros(shape[:2], np.float32), np.zeros(shape[:2], np.float32)
            for batch in batches:
                for part in chunks(batch.column(0)):
                    t = tokens(part, v.lookup)
                    f, y = features(t), classes_of(t, v)
                    for a in range(0, len(y), BATCH):
                        train_step(own, power, seen, v.prior, f[:, a : a + BATCH], y[a : a + BATCH])
            flat, times = own.reshape(-1, _BLOCK * CLASSES), seen.reshape(-1, _BLOCK)
            used = np.flatnonzero(times.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(used.astype(np.int32)),
                    pa.array([flat[b].tobytes() for b in used], pa.binary()),
                    pa.array([times[b].tobytes() for b in used], pa.binary()),
                ],
                names=["block", "weights", "seen"],
            )

        schema = "block int, weights binary, seen binary"
        made = rows.mapInArrow(run, schema).withColumn("part", F.floor(F.spark_partition_id() / 64))
        # A bounded number of tasks' tables meet in one place, then those means.
        found = made.groupBy("block", "part").applyInArrow(_mean, schema)
        found = found.groupBy("block").applyInArrow(_mean, schema)
        flat = weights.reshape(-1, _BLOCK * CLASSES)
        for r in found.select("block", "weights").toLocalIterator():
            flat[r["block"]] = np.frombuffer(r["weights"], np.float32)
        start.unpersist()
    return weights


def _mean(key: tuple, table: pa.Table) -> pa.Table:
    """Mean of the weights of a block, by how often each task met the feature."""
    total, times = np.zeros((_BLOCK, CLASSES)), np.zeros(_BLOCK)
    for w, n in zip(table.column("weights").to_pylist(), table.column("seen").to_pylist()):
        seen = np.frombuffer(n, np.float32)
        total += np.frombuffer(w, np.float32).reshape(_BLOCK, CLASSES) * seen[:, None]
        times += seen
    mean = (total / np.maximum(times, 1)[:, None]).astype(np.float32)
    return pa.table(
        {
            "block": pa.array([key[0].as_py()], pa.int32()),
            "weights": pa.array([mean.tobytes()], pa.binary()),
            "seen": pa.array([times.astype(np.float32).tobytes()], pa.binary()),
        }
    )


_SCORED = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, base double, "
    "model double, hashes array<long>, times array<int>"
)


def _scorer(vocab, weights):
    """In-task parts of the scores, and each row's words outside the dictionary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocab.value.prepare()
        w = weights.value
        end_log = np.log10(v.texts + 1.0)
        rest_log = np.log10(v.rest_total + v.rest_distinct + 1.0)
        first = TaskContext.get().partitionId() << 33
        for batch in batches:
            columns: list[list[np.ndarray]] = [[] for _ in range(4)]
            hashes, times = [], []
            for part in chunks(batch.column("text")):
                t = tokens(part, v.lookup)
                f, y = features(t), classes_of(t, v)
                logs = np.empty(len(y))
                for a in range(0, len(y), BATCH):
                    own = log_classes(w, v.prior, f[:, a : a + BATCH])
                    logs[a : a + BATCH] = own[np.arange(len(own)), y[a : a + BATCH]]
                logs /= np.log(10)
                inside = t.place >= 0
                rest = ~inside & ~t.is_end
                base = np.where(t.is_end, end_log, np.append(v.log_count, 0.0)[t.place])
                logs += np.where(rest, -rest_log, np.append(v.share, 0.0)[t.place])
                known = inside | (t.is_end & (v.texts > 0))
                row = np.repeat(np.arange(part.count), np.diff(t.bounds))
                columns[0].append(np.diff(t.bounds))
                for i, x in enumerate((known, base, logs)):
                    columns[i + 1].append(np.bincount(row, x, part.count))
                # Distinct words outside the dictionary of each row.
                order = np.lexsort((t.hash[rest], row[rest]))
                h, r = t.hash[rest][order], row[rest][order]
                fresh = np.ones(len(h), bool)
                fresh[1:] = (h[1:] != h[:-1]) | (r[1:] != r[:-1])
                at = np.flatnonzero(fresh)
                n = np.diff(np.append(at, len(h))).astype(np.int32)
                bounds = np.searchsorted(r[at], np.arange(part.count + 1))
                hashes.append((h[at].view(np.int64), bounds))
                times.append((n, bounds))
            made = [np.concatenate(c) if c else np.zeros(0) for c in columns]
            size = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(first, first + size)),
                    batch.column("doc_id"),
                    batch.column("held_out"),
                    pa.array(made[0].astype(np.int64)),
                    pa.array(made[1].astype(np.int64)),
                    pa.array(made[2]),
                    pa.array(made[3]),
                    _lists(hashes, np.int64),
                    _lists(times, np.int32),
                ],
                names=[c.split()[0] for c in _SCORED.split(", ")],
            )
            first += size

    return run


def _lists(parts: list[tuple[np.ndarray, np.ndarray]], dtype) -> pa.Array:
    """Lists of consecutive rows, from the values and bounds of each chunk."""
    values = np.concatenate([p[0] for p in parts] or [np.zeros(0, dtype)]).astype(dtype)
    counts = np.concatenate([np.diff(p[1]) for p in parts] or [np.zeros(0, np.int64)])
    offsets = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base and model scores of every row, learned from the rows not held out."""
    spark = docs.sparkSession
    folder = new_folder(spark, "maxent")
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        held_out(id_col).alias("held_out"),
    )
    texts = source.filter("NOT held_out").count()
    count_words(source).write.parquet(f"{folder}/counts")
    counts = spark.read.schema("hash long, n long").parquet(f"{folder}/counts")
    made, least = vocabulary(counts, texts)
    vocab = spark.sparkContext.broadcast(made)
    weights = spark.sparkContext.broadcast(train(source, vocab))
    source.mapInArrow(_scorer(vocab, weights), _SCORED).write.parquet(f"{folder}/scored")
    scored = spark.read.schema(_SCORED).parquet(f"{folder}/scored")
    rest = scored.select(
        "row", F.explode(F.arrays_zip("hashes", "times")).alias("w")
    ).select("row", F.col("w.hashes").alias("hash"), F.col("w.times").alias("times"))
    rare = counts.filter(F.col("n") < least)
    looked = (
        rest.join(rare, "hash")
        .groupBy("row")
        .agg(
            F.sum("times").alias("rest_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rest_log"),
        )
    )
    below = float(np.log10(made.total + made.distinct + 1))
    rest_log = F.coalesce("rest_log", F.lit(0.0))
    return scored.drop("hashes", "times").join(looked, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("rest_known", F.lit(0))).alias("n_known"),
        F.lit(made.total).cast("long").alias("train_tokens"),
        (F.col("base") + rest_log - F.col("n_tokens") * F.lit(below)).alias("base_score"),
        (F.col("model") + rest_log).alias("score"),
    )


@query("op9_maxent_lm")
def op9_maxent_lm(spark: SparkSession, folder: str) -> DataFrame:
    return score_texts(load(spark, folder, "documents"))
