"""Near duplicates by consistent weighted sampling over TF-IDF shingles.

A document is a weighted set: each run of five words weighs its occurrences times the
mean inverse document frequency of its words, counted over all documents.  Improved
consistent weighted sampling draws ``SAMPLES`` samples of that set, such that two
documents draw the same sample with a probability equal to their weighted Jaccard
similarity; ``ROWS`` samples make a band key.  Documents that share a key are compared
exactly, and those of similarity 0.8 or more are linked; a class is a connected component.

Not every pair under a key is compared.  First one pivot per key is compared with the
rest.  Then, where the documents of a key lie in several components, those outside the
largest meet all documents of other components, ``BLOCK`` documents at a time and without
their texts.  Shingles have a common order, rarest first.  The first shingle of that order
that two documents share bounds their similarity: nothing before it is shared, so at most
the lesser of what is left of each one's weight is.  Pairs whose bound is below 0.8 are
out; so a document keeps its rarest shingles up to 0.2 of its weight, with the weight
before each.  That is exact, whatever the order, for which counts in buckets do.  Where
similar texts differ in rare shingles, the bound is close to the similarity itself.  Each
pair is looked at under the first key it shares, and what is left is compared exactly.  No
number of documents changes what is compared.

Nor are documents compared if they agree in fewer than ``AGREE`` of all samples.  A link of
similarity 0.8 is missed with a probability of 0.0002 by the bands and 0.0001 by ``AGREE``;
higher similarities more rarely.  Copies (equal words) are one node from the start.

Words are runs of ASCII letters (lower-cased), digits and characters beyond ASCII.  A
text of fewer than five words is one shingle; texts without words (null and empty ones
too) are copies of each other.  Rows with equal ids are one document.  Rows without an id
have no class (null) and take part in nothing.  An empty table gives no rows.  Texts of any
length are read whole.  Other columns play no part, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from runlens.llm.bytetext import PLAIN, Rows, chunks, mix, shingles, words
from runlens.llm.components import components
from runlens.llm.registry import query
from runlens.llm.shared import drop, load, new_folder, size_of

SHINGLE = 5
SIMILARITY = 0.8
BANDS = 16
ROWS = 4
#: Samples of a document: those of the bands and more to tell near from similar texts.
SAMPLES = 90
#: Word frequencies are kept for so many hash buckets: their size never grows.
BUCKET_BITS = 18
#: Members of a pivot that one task compares before the next takes over.
SALT_SIZE = 64
#: Documents, and rarest shingles of all of them, of a block of a key.
BLOCK = 1024
BLOCK_SHINGLES = 1 << 21
#: Bytes of signed documents for each file of the tables made from them.
FILE_BYTES = 4 << 20
#: Fewest equal samples, of ``SAMPLES``, of two documents worth comparing.
AGREE = 58

_BLOCK = 1 << 14  # buckets in one row of the frequency table
_NUMBERS = SAMPLES // 15
_BITS = [f"bits{i}" for i in range(_NUMBERS)]
_CHUNK = 1 << 18  # what is drawn from at once stays in the processor's cache
_TABLE = 1 << 16


def _gamma2(n: int) -> np.ndarray:
    """Quantiles of the gamma distribution of shape 2, at the middle of ``n`` steps."""
    p = (np.arange(n) + 0.5) / n
    x = np.sqrt(2 * p) + p
    for _ in range(60):  # Newton on 1 - (1 + x) exp(-x) = p
        e = np.exp(-x)
        x = np.maximum(x - (1 - (1 + x) * e - p) / np.maximum(x * e, 1e-300), x / 4)
    return x


_quantiles: list[np.ndarray] = []


def _tables() -> tuple[np.ndarray, np.ndarray]:
    if not _quantiles:
        g = _gamma2(_TABLE)
        _quantiles.extend([g.astype(np.float32), np.log(g).astype(np.float32)])
    return _quantiles[0], _quantiles[1]


def weighted_sets(rows: Rows, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each row's distinct shingles and weights: ids, weights, row bounds, row signatures.

    The signature, two numbers, stands for the words in their order; both are 0 for a row
    without words.
    """
    found = words(rows, PLAIN, lower=True)
    grams, bounds = shingles(found, SHINGLE)
    counts = np.diff(found.bounds)
    rare = idf[found.hash >> np.uint64(64 - BUCKET_BITS)]
    at = np.arange(bounds[-1]) + np.repeat(found.bounds[:-1] - bounds[:-1], np.diff(bounds))
    mean = sum(rare[at + k] for k in range(SHINGLE)) / np.float32(SHINGLE)
    row = np.repeat(np.arange(rows.count), np.diff(bounds))
    # The place of a word in its row enters its row's signature.
    place = np.arange(len(found.hash)) - np.repeat(found.bounds[:-1], counts)
    turn = mix(place.astype(np.uint64) + np.uint64(1))
    signature = np.zeros((rows.count, 2), np.uint64)
    for side, placed in enumerate((mix(found.hash ^ turn), mix(found.hash + turn))):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(placed, dtype=np.uint64)])
        signature[:, side] = sums[found.bounds[1:]] - sums[found.bounds[:-1]]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        grams = np.concatenate([grams, mix(signature[short, 0])])
        own = np.array([rare[found.bounds[r] : found.bounds[r + 1]].mean() for r in short])
        mean = np.concatenate([mean, own.astype(np.float32)])
        row = np.concatenate([row, short])
    signature = np.where(counts[:, None] > 0, signature | np.uint64(1), np.uint64(0))
    ids = grams >> np.uint64(16)
    key = (row.astype(np.uint64) << np.uint64(48)) | ids
    order = np.argsort(key)
    key = key[order]
    fresh = np.ones(len(key), bool)
    fresh[1:] = key[1:] != key[:-1]
    first = np.flatnonzero(fresh)
    times = np.diff(np.append(first, len(key))).astype(np.float32)
    kept = order[first]
    bounds = np.searchsorted(row[kept], np.arange(rows.count + 1))
    return ids[kept], times * mean[kept], bounds, signature


def band_keys(
    ids: np.ndarray, weights: np.ndarray, bounds: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Band keys of each row's weighted set, and four bits of each sample, 15 to a number.

    Rows with an empty set have zeros.
    """
    gamma, log_gamma = _tables()
    full = np.flatnonzero(np.diff(bounds))
    starts = bounds[full]
    row = np.repeat(np.arange(len(full)), np.diff(bounds)[full])
    log_w = np.log(weights).astype(np.float32)
    keys = np.zeros((len(bounds) - 1, BANDS), np.uint64)
    bits = np.zeros((len(bounds) - 1, _NUMBERS), np.uint64)
    for k in range(SAMPLES):
        z = (ids ^ np.uint64((k + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
        z ^= z >> np.uint64(29)
        z *= np.uint64(0x94D049BB133111EB)
        z ^= z >> np.uint64(32)
        z *= np.uint64(0xD6E8FEB86659FD93)
        r = gamma[z >> np.uint64(48)]
        log_c = log_gamma[(z >> np.uint64(32)) & np.uint64(0xFFFF)]
        beta = (z & np.uint64(0xFFFFFFFF)).astype(np.float32) * np.float32(2.0**-32)
        t = np.floor(log_w / r + beta)
        a = log_c - r * (t - beta + np.float32(1))
        least = np.minimum.reduceat(a, starts) if len(full) else a
        at = np.flatnonzero(a == least[row])
        _, one = np.unique(row[at], return_index=True)
        pick = at[one]
        sample = mix(ids[pick] ^ mix(t[pick].astype(np.int64).astype(np.uint64) + np.uint64(k)))
        bits[full, k % _NUMBERS] |= (sample >> np.uint64(60)) << np.uint64(4 * (k // _NUMBERS))
        band = k // ROWS
        if band < BANDS:
            keys[full, band] = mix(keys[full, band] + sample + np.uint64(band + 1))
    return keys, bits


def frequencies(source: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Two tables over all rows of ``text``, by hash bucket.

    The inverse document frequency of words, and the number of shingles.  Tasks count into
    tables of fixed size and hand them on in blocks that are summed by shuffle; the driver
    receives ``2 ** BUCKET_BITS`` numbers of each.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, n = np.zeros(1 << BUCKET_BITS, np.int64), 0
        runs = np.zeros(1 << BUCKET_BITS, np.int64)
        for batch in batches:
            for rows in chunks(batch.column(0)):
                found = words(rows, PLAIN, lower=True)
                bucket = found.hash >> np.uint64(64 - BUCKET_BITS)
                own = np.unique((found.row.astype(np.uint64) << np.uint64(BUCKET_BITS)) | bucket)
                seen = (own & np.uint64((1 << BUCKET_BITS) - 1)).astype(np.int64)
                table += np.bincount(seen, minlength=1 << BUCKET_BITS)
                grams = shingles(found, SHINGLE)[0] >> np.uint64(64 - BUCKET_BITS)
                runs += np.bincount(grams.astype(np.int64), minlength=1 << BUCKET_BITS)
                n += rows.count
        blocks = np.concatenate([table, runs]).astype("<i4").reshape(-1, _BLOCK)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(range(-1, len(blocks)), pa.int32()),
                pa.array([np.array([n], "<i4").tobytes(), *(b.tobytes() for b in blocks)], pa.binary()),
            ],
            names=["block", "counts"],
        )

    counted = source.select("text").mapInArrow(count, "block int, counts binary")
    # Sums of a bounded number of tasks first, so that no task gathers all of them.
    level = counted.withColumn("part", F.floor(F.spark_partition_id() / 256))
    schema = "block int, counts binary"
    summed = level.groupBy("block", "part").applyInArrow(_adder("<i4"), schema)
    found = summed.groupBy("block").applyInArrow(_adder("<i8"), schema)
    table, n = np.zeros(2 << BUCKET_BITS, np.int64), 0
    for r in found.collect():
        own = np.frombuffer(r["counts"], "<i8")
        if r["block"] < 0:
            n = int(own[0])
        else:
            table[r["block"] * _BLOCK :][:_BLOCK] = own
    words_, runs = table[: 1 << BUCKET_BITS], table[1 << BUCKET_BITS :]
    return (np.log((n + 1) / (words_ + 1)) + 1).astype(np.float32), runs


def _adder(dtype: str):
    """Sum of the count blocks of a group."""

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(1, np.int64)
        for raw in table.column("counts").to_pylist():
            total = total + np.frombuffer(raw, dtype)
        return pa.table(
            {
                "block": pa.array([key[0].as_py()], pa.int32()),
                "counts": pa.array([total.astype("<i8").tobytes()], pa.binary()),
            }
        )

    return add


_SIGNED = (
    "doc_id long, signature long, second long, keys array<long>, rare array<int>, before array<float>, weight double, "
    + ", ".join(f"{b} long" for b in _BITS)
)


def rarest(
    ids: np.ndarray, weights: np.ndarray, bounds: np.ndarray, often: np.ndarray, least: float
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's rarest shingles with just over ``1 - least`` of its weight, as 32 bits each.

    In the common order, with the weight before each; and how many each row has.
    """
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    # Ids are the upper 48 bits of the hashes that the counts are by.
    order = np.lexsort((ids, often[ids >> np.uint64(48 - BUCKET_BITS)], row))
    sums = np.append(0.0, np.cumsum(weights[order], dtype=np.float64))
    before = sums[:-1] - np.repeat(sums[bounds[:-1]], np.diff(bounds))
    whole = np.repeat(sums[bounds[1:]] - sums[bounds[:-1]], np.diff(bounds))
    kept = before <= (1 - least + 1e-6) * whole
    counts = np.bincount(row[kept], minlength=len(bounds) - 1)
    names = mix(ids[order[kept]]).astype(np.uint32).view(np.int32)
    return names, before[kept].astype(np.float32), counts


def _signer(idf, often, least):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for rows in chunks(batch.column(1), _CHUNK):
                ids, weights, bounds, signature = weighted_sets(rows, idf.value)
                sums = np.append(0.0, np.cumsum(weights, dtype=np.float64))
                whole = sums[bounds[1:]] - sums[bounds[:-1]]
                rare = rarest(ids, weights, bounds, often.value, least)
                parts.append((signature, *band_keys(ids, weights, bounds), whole, *rare))
            signature = np.concatenate([p[0] for p in parts] or [np.zeros((0, 2), np.uint64)])
            keys = np.concatenate([p[1] for p in parts] or [np.zeros((0, BANDS), np.uint64)])
            bits = np.concatenate([p[2] for p in parts] or [np.zeros((0, _NUMBERS), np.uint64)])
            weight = np.concatenate([p[3] for p in parts] or [np.zeros(0)])
            rare = np.concatenate([p[4] for p in parts] or [np.zeros(0, np.int32)])
            before = np.concatenate([p[5] for p in parts] or [np.zeros(0, np.float32)])
            ends = np.cumsum(np.concatenate([[0], *(p[6] for p in parts)])).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    *(pa.array(np.ascontiguousarray(s).view(np.int64)) for s in signature.T),
                    pa.FixedSizeListArray.from_arrays(
                        pa.array(np.ascontiguousarray(keys).view(np.int64).ravel()), BANDS
                    ).cast(pa.list_(pa.int64())),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(rare)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(before)),
                    pa.array(weight),
                    *(pa.array(np.ascontiguousarray(b).view(np.int64)) for b in bits.T),
                ],
                names=["doc_id", "signature", "second", "keys", "rare", "before", "weight", *_BITS],
            )

    return sign


def _comparer(idf, least: float):
    """Compare rows sorted by pivot and salt, the pivot's own row first."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, pivot = None, None
        for batch in batches:
            out: list[tuple[int, int]] = []
            pivots, salts, roles, docs = (batch.column(i).to_pylist() for i in range(4))
            for rows in chunks(batch.column(4)):
                ids, weights, bounds, _ = weighted_sets(rows, idf.value)
                for r in range(rows.count):
                    at = rows.first + r
                    own = ids[bounds[r] : bounds[r + 1]], weights[bounds[r] : bounds[r + 1]]
                    if roles[at] == 0:
                        group, pivot = (pivots[at], salts[at]), (own[0].copy(), own[1].copy())
                    elif group == (pivots[at], salts[at]) and jaccard(*pivot, *own) >= least:
                        out.append((pivots[at], docs[at]))
            columns = list(zip(*out)) if out else [(), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in columns], names=["u", "v"]
            )

    return compare


def jaccard(a: np.ndarray, wa: np.ndarray, b: np.ndarray, wb: np.ndarray) -> float:
    """Weighted Jaccard similarity of two sets with sorted ids."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    at = np.searchsorted(a, b)
    at[at == len(a)] = 0
    both = a[at] == b
    shared = float(np.minimum(wa[at[both]], wb[both]).sum(dtype=np.float64))
    return shared / (float(wa.sum(dtype=np.float64)) + float(wb.sum(dtype=np.float64)) - shared)


def _links(pairs: DataFrame, texts: DataFrame, idf, least: float) -> DataFrame:
    """The pairs ``(u, v)`` that are similar; ``u`` is the pivot.

    A pivot with many partners is met by several tasks, ``SALT_SIZE`` partners each.
    """
    many = pairs.groupBy("u").agg(F.count(F.lit(1)).alias("n"))
    salts = F.ceil(F.col("n") / SALT_SIZE)
    spread = F.pmod(F.xxhash64("v"), salts).cast("int")
    members = (
        pairs.join(many, "u")
        .select("u", spread.alias("salt"), F.lit(1).alias("role"), F.col("v").alias("doc_id"))
    )
    heads = many.select(
        "u",
        F.explode(F.sequence(F.lit(0), (salts - 1).cast("int"))).alias("salt"),
        F.lit(0).alias("role"),
        F.col("u").alias("doc_id"),
    )
    rows = members.unionByName(heads).hint("merge").join(texts, "doc_id")
    return (
        rows.select("u", "salt", "role", "doc_id", "text")
        .repartition(F.col("u"), F.col("salt"))
        .sortWithinPartitions("u", "salt", "role")
        .mapInArrow(_comparer(idf, least), "u long, v long")
    )


def _agree(a: str, b: str, least: float) -> Column:
    """Whether two documents' weights and samples are close enough to compare the documents."""
    x, y = F.col(f"{a}.weight"), F.col(f"{b}.weight")
    # Sums of the same numbers may differ in their last digits.
    sizes = F.least(x, y) >= F.greatest(x, y) * (least - 1e-6)
    equal = F.lit(0)
    for side in _BITS:
        x = F.col(f"{a}.{side}").bitwiseXOR(F.col(f"{b}.{side}"))
        for shift in (1, 2):
            x = x.bitwiseOR(F.shiftright(x, shift))
        differ = F.bit_count(x.bitwiseAND(F.lit(0x1111111111111111)))
        equal = equal + (F.lit(15) - differ)
    return sizes & (equal >= AGREE)


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: float = SIMILARITY,
) -> DataFrame:
    """``(id, class_id)`` for every row; the smallest id of a class names it."""
    found, files = _classes(docs, id_col, text_col, least)
    return found.coalesce(files)


def _classes(
    docs: DataFrame, id_col: str, text_col: str, least: float
) -> tuple[DataFrame, int]:
    """Classes, and the number of files that tables of the size of ``docs`` are worth.

    Tables are written in files by their bytes, not one for each shuffle partition: every
    file has its price (on a local file system without Hadoop's native library, several
    processes forked from the executor's JVM).
    """
    spark = docs.sparkSession
    folder = new_folder(spark, "neardup")
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    known = source.filter("doc_id IS NOT NULL")
    words_, runs = frequencies(source)
    idf, often = spark.sparkContext.broadcast(words_), spark.sparkContext.broadcast(runs)

    def written(df: DataFrame, name: str, most: int | None = None) -> DataFrame:
        (df.coalesce(most) if most else df).write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    signed = written(known.mapInArrow(_signer(idf, often, least), _SIGNED), "signed")
    cores = spark.sparkContext.defaultParallelism
    files = max(cores, -(-size_of(spark, f"{folder}/signed") // FILE_BYTES))
    few = min(4 * cores, files)
    nodes = signed.groupBy("signature", "second").agg(
        F.min("doc_id").alias("node"),
        F.first("keys").alias("keys"),
        *(F.first(c).alias(c) for c in ("rare", "before", "weight", *_BITS)),
    )
    nodes = written(nodes, "nodes", files)
    one = F.struct("node", "weight", *_BITS).alias("d")
    placed = nodes.filter("signature <> 0").select(one, F.posexplode("keys").alias("band", "key"))
    placed = placed.select(F.xxhash64("band", "key").alias("key"), "band", "d")
    heads = placed.groupBy("key").agg(F.min("d").alias("p"), F.count(F.lit(1)).alias("n"))
    members = written(placed.join(heads.filter("n > 1"), "key").drop("n"), "members", files)
    others = members.filter("d.node <> p.node")
    pairs = others.filter(_agree("p", "d", least)).select(
        F.col("p.node").alias("u"), F.col("d.node").alias("v")
    )
    wanted = members.select(F.col("d.node").alias("doc_id")).distinct()
    texts = written(known.join(wanted.hint("merge"), "doc_id", "left_semi"), "texts", files)
    links = written(_links(pairs.distinct(), texts, idf, least), "links-0", files)
    parts = written(components(links, few), "parts-0", few)
    opened = written(_open_pairs(members, parts, nodes, least), "open", files)
    if opened.limit(1).count():
        links = written(_links(opened, texts, idf, least), "links-1", files)
        parts = written(components(links.unionByName(_as_edges(parts)), few), "parts-1", few)
    drop(spark, f"{folder}/texts")
    named = nodes.select("signature", "second", "node").join(parts, "node", "left")
    classes = named.select("signature", "second", F.coalesce("component", "node").alias("class_id"))
    copies = signed.select("doc_id", "signature", "second").join(classes, ["signature", "second"])
    found = copies.select("doc_id", "class_id")
    lost = source.filter("doc_id IS NULL").select("doc_id", F.lit(None).cast("long").alias("class_id"))
    return found.unionByName(lost).withColumnRenamed("doc_id", id_col), files


def _as_edges(parts: DataFrame) -> DataFrame:
    return parts.select(F.col("node").alias("u"), F.col("component").alias("v"))


def _open_pairs(members: DataFrame, parts: DataFrame, nodes: DataFrame, least: float) -> DataFrame:
    """Pairs ``(u, v)`` of a key in different components that may be similar.

    The documents of a key outside its largest component are laid out in blocks, those
    inside in others; a block of the first kind meets every block.
    """
    named = parts.withColumnRenamed("node", "_n")
    own = members.select("key", "band", F.col("d.node").alias("node"))
    size = nodes.select(F.col("node").alias("_m"), F.size("rare").cast("long").alias("held"))
    own = (
        own.join(named, F.col("node") == F.col("_n"), "left")
        .join(size, F.col("node") == F.col("_m"))
        .select("key", "band", "node", "held", F.coalesce("component", "node").alias("part"))
    )
    sizes = own.groupBy("key", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("held").alias("held")
    )
    keys = sizes.groupBy("key").agg(
        F.max(F.struct("n", "part", "held")).alias("top"),
        F.sum("n").alias("n"),
        F.sum("held").alias("held"),
        F.count(F.lit(1)).alias("several"),
    )

    def blocks(n: Column, held: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.ceil(held / BLOCK_SHINGLES), F.lit(1))

    one = (F.col("n") <= BLOCK) & (F.col("held") <= BLOCK_SHINGLES)
    out = blocks(F.col("n") - F.col("top.n"), F.col("held") - F.col("top.held"))
    inside = blocks(F.col("top.n"), F.col("top.held"))
    keys = keys.filter("several > 1").select(
        "key",
        F.when(~one, F.col("top.part")).alias("main"),
        F.when(one, 1).otherwise(out).alias("out"),
        F.when(one, 1).otherwise(out + inside).alias("all"),
    )
    spread = F.xxhash64("node")
    mine = F.when(
        F.col("part").eqNullSafe(F.col("main")), F.col("out") + F.pmod(spread, F.col("all") - F.col("out"))
    ).otherwise(F.pmod(spread, F.col("out")))
    met = own.join(keys, "key").withColumn("block", mine)
    # A block of the largest component meets those outside only.
    others = F.when(F.col("block") < F.col("out"), F.col("all")).otherwise(F.col("out"))
    met = met.select(
        "key", "band", "node", "part", "block", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)).alias("other")
    )
    fields = ["weight", *_BITS, "keys", "rare", "before"]
    marks = nodes.select(F.col("node").alias("_n"), *fields)
    rows = met.join(marks, F.col("node") == F.col("_n")).select(
        "key",
        F.least("block", "other").alias("a"),
        F.greatest("block", "other").alias("b"),
        "block",
        "band",
        "node",
        "part",
        *fields,
    )
    laid = rows.repartition("key", "a", "b").sortWithinPartitions("key", "a", "b", "node")
    return laid.mapInArrow(_meeter(least), "u long, v long")


def _meeter(least: float):
    """Pairs worth comparing of rows sorted by key and pair of blocks."""

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        group = None

        def done() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(x, pa.int64()) for x in _worth(table, least)], names=["u", "v"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            marks = np.stack([batch.column(i).to_numpy() for i in range(3)])
            starts = np.flatnonzero(np.append(True, (marks[:, 1:] != marks[:, :-1]).any(axis=0)))
            for start, end in zip(starts, [*starts[1:], batch.num_rows]):
                own = tuple(marks[:, start])
                if held and own != group:
                    yield done()
                group = own
                held.append(batch.slice(start, end - start))
        if held:
            yield done()

    return meet


def first_shared(rare: np.ndarray, before: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For rows ``i`` and ``j`` the weight of ``i`` before the first shingle that ``j`` has too.

    Infinite where they share none of the given ones.
    """
    found = np.full((n, n), np.inf, np.float32)
    order = np.argsort(rare, kind="stable")
    rare, before, row = rare[order], before[order], row[order]
    starts = np.flatnonzero(np.append(True, rare[1:] != rare[:-1])) if len(rare) else []
    for start, end in zip(starts, [*starts[1:], len(rare)]):
        if end - start > 1:
            at = row[start:end]
            both = np.ix_(at, at)
            found[both] = np.minimum(found[both], before[start:end, None])
    return found


def _worth(table: pa.Table, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of the pairs of a pair of blocks that are neither connected nor ruled out."""
    column = {c: table.column(c).combine_chunks() for c in table.column_names}
    node, part, block, weight = (column[c].to_numpy() for c in ("node", "part", "block", "weight"))
    n = len(node)
    bounds = column["rare"].offsets.to_numpy()
    row = np.repeat(np.arange(n), np.diff(bounds))
    before = column["before"].flatten().to_numpy()
    apart = first_shared(column["rare"].flatten().to_numpy(), before, row, n)
    left = weight[:, None] * (1 + 1e-5) - apart
    enough = least / (1 + least) * (weight[:, None] + weight[None, :])
    worth = (np.minimum(left, left.T) >= enough) & (part[:, None] != part[None, :])
    if column["a"][0].as_py() != column["b"][0].as_py():
        worth &= block[:, None] != block[None, :]
    u, v = np.nonzero(np.triu(worth, 1))
    # Under the first key that both have, and only if enough samples agree.
    keys = column["keys"].flatten().to_numpy().reshape(n, BANDS)
    first = (keys[u] == keys[v]).argmax(axis=1) == column["band"].to_numpy()[0]
    u, v = u[first], v[first]
    equal = np.zeros(len(u), np.int64)
    for name in _BITS:
        bits = column[name].to_numpy().view(np.uint64)
        differ = bits[u] ^ bits[v]
        differ |= differ >> np.uint64(1)
        differ |= differ >> np.uint64(2)
        equal += 15 - np.bitwise_count(differ & np.uint64(0x1111111111111111)).astype(np.int64)
    near = equal >= AGREE
    return node[u[near]], node[v[near]]


def first_of_class(docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents without those that have a near duplicate with a smaller id.

    Of rows that share id and text all stay.
    """
    found, files = _classes(docs, id_col, "text", SIMILARITY)
    later = found.filter(F.col(id_col) != F.col("class_id")).select(id_col).distinct()
    left = docs.join(later, id_col, "left_anti").select(*(f"`{c}`" for c in docs.columns))
    return left.coalesce(files)


@query("op10_icws_near_dups")
def op10_icws_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(load(spark, folder, "documents"))
