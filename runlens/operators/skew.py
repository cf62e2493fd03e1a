"""Joins against a lookup table when some key of the big side may be hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 32 << 20
HOT_SHARE = 0.001
SALTS = 64
# Items the frequent-items sketch follows; well above 1 / HOT_SHARE.
_TRACKED = 16_384


def is_small(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` stays within both bounds; counting stops soon after the bound."""
    df = df.limit(max_rows + 1)
    width = sum(
        (F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns),
        F.lit(0),
    )
    size = df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(width.cast("bigint")), F.lit(0)).alias("bytes"),
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def hot_hashes(df: DataFrame, on: Sequence[str], share: float = HOT_SHARE) -> list[int]:
    """Hashes of the keys that hold about ``share`` of the rows or more.

    A frequent-items sketch finds them, so only sketches are shuffled; there are never
    more than 1 / share.  Which keys are found changes how a join is spread over
    tasks, never its result.
    """
    most = max(1, int(1 / share))
    key = F.xxhash64(*on)
    top = f"approx_top_k(_key, {most}, {_TRACKED})"
    found = df.select(key.alias("_key")).agg(
        F.expr(top).alias("top"), F.count(F.lit(1)).alias("rows")
    )
    row = found.first()
    floor = max(row["rows"] * share, 1)
    return [t["item"] for t in row["top"] or () if t["count"] > floor]


def lookup_join(
    big: DataFrame,
    table: DataFrame,
    on: Sequence[str],
    how: str = "inner",
    max_rows: int = MAX_BROADCAST_ROWS,
) -> DataFrame:
    """Equi-join with a lookup table: broadcast if checked small, else shuffled.

    Beyond the broadcast bound Spark's adaptive skew join splits the hot keys of the big
    side, without a pass over it; where that is switched off, :func:`salted_join` does
    it by hand.  ``how`` is ``inner`` or ``left``.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"unsupported join type {how!r}")
    if is_small(table, max_rows):
        return big.join(F.broadcast(table), list(on), how)
    return big.join(table, list(on), how)


def same_types(a: DataFrame, b: DataFrame, on: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both frames with their keys in one type, the one that a plain join compares in.

    Text against another type is refused: whether it compares as text or as the other
    type depends on the session.
    """
    for key in on:
        kinds = {a.schema[key].dataType, b.schema[key].dataType}
        if len(kinds) == 1:
            continue
        if any(isinstance(k, (T.StringType, T.BinaryType, T.BooleanType)) for k in kinds):
            raise TypeError(f"keys {key!r} of types {sorted(map(str, kinds))} have no common type")
        empty = a.select(f"`{key}`").limit(0).union(b.select(f"`{key}`").limit(0))
        common = empty.schema[key].dataType
        a = a.withColumn(key, F.col(f"`{key}`").cast(common))
        b = b.withColumn(key, F.col(f"`{key}`").cast(common))
    return a, b


def row_hash(df: DataFrame) -> Column:
    """Hash of a row's content (map columns left out, as they have no hash).

    A lost task that runs again gives each of its rows the same value, whatever order
    they come in; a row number would not.
    """

    def hashable(dtype: T.DataType) -> bool:
        if isinstance(dtype, T.ArrayType):
            return hashable(dtype.elementType)
        if isinstance(dtype, T.StructType):
            return all(hashable(f.dataType) for f in dtype.fields)
        return not isinstance(dtype, (T.MapType, T.VariantType))

    return F.xxhash64(*(F.col(f"`{f.name}`") for f in df.schema.fields if hashable(f.dataType)))


def salted_join(
    big: DataFrame, table: DataFrame, on: Sequence[str], how: str = "inner", salts: int = SALTS
) -> DataFrame:
    """Shuffled equi-join that spreads each hot key of ``big`` over ``salts`` tasks.

    Keys are compared in their common type, so equal keys have equal hashes.  Finding the
    hot keys is a pass of its own over the keys of ``big``.
    """
    on = list(on)
    big, table = same_types(big, table, on)
    hot = F.xxhash64(*on).isin(hot_hashes(big, on))
    # Equal rows of different tasks are spread by their tasks' numbers.
    place = F.pmod(row_hash(big), F.lit(salts)) + F.spark_partition_id()
    spread = F.pmod(place, F.lit(salts)).cast("int")
    left = big.withColumn("_salt", F.when(hot, spread).otherwise(F.lit(0)))
    copies = F.when(hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    right = table.withColumn("_salt", F.explode(copies))
    return left.join(right, [*on, "_salt"], how).drop("_salt")
