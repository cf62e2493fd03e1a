"""Awkward documents for every operator, and plain reimplementations to hold against."""

from __future__ import annotations

import re
from collections import Counter

WORDS = (
    "river stone lantern quiet harbour winter candle meadow orchard silver engine letter "
    "garden mountain shadow copper village morning thunder basket window feather bridge "
    "island forest marble kettle pepper saddle needle"
).split()


def prose(seed: int, n: int) -> str:
    """Text without much repetition, the same for a seed."""
    x, out = seed * 7919 + 17, []
    for _ in range(n):
        x = (x * 1103515245 + 12345) % 2**31
        out.append(WORDS[(x >> 8) % len(WORDS)] + str((x >> 16) % 50))
    return " ".join(out)


LONG = prose(3, 30_000)

ROWS = [
    (1, prose(1, 200), "en", "a"),
    (2, prose(1, 200), None, "a"),
    (3, None, "en", "a"),
    (4, "", "en", None),
    (5, " \n\t ", "en", "a"),
    (6, "one two", "en", "a"),
    (7, prose(2, 200), "en", "a"),
    (7, prose(2, 200), "en", "a"),
    (8, prose(2, 200).replace("river", "RIVER", 1) + " tail", "en", "a"),
    (9, LONG, "en", "a"),
    (10, prose(4, 60) + "\n" + prose(4, 60), "en", "a"),
    (11, "é" * 500 + " ünïcode " * 40, "fr", "a"),
]

SCHEMA = "doc_id long, text string, lang string, source string"
#: Names that operators use for columns of their own.
CLASHING = ["n_words", "failed_mask", "kept", "score", "predicted", "spans", "class_id"]


def frame(spark, rows=None, extra: bool = False):
    """The rows above, or the given ones, spread over partitions."""
    df = spark.createDataFrame(ROWS if rows is None else rows, SCHEMA)
    if extra:
        for name in CLASHING:
            df = df.selectExpr("*", f"'x' AS {name}")
    return df.repartition(3)


def plain_words(text: str | None) -> list[str]:
    """Words as the shingling operators cut them."""
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", lower)


def shingle_bag(words: list[str], size: int = 5) -> Counter:
    if 0 < len(words) < size:
        return Counter([tuple(words)])
    return Counter(zip(*(words[i:] for i in range(size))))
