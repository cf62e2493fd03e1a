"""Spans found in whole texts: adding them as a column, digesting them, removing them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

# A span is (kind, start, end, whether a base pattern found it), in code points.
Span = tuple[str, int, int, bool]
Finder = Callable[[str], list[Span]]

_SPAN = pa.struct(
    [("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]
)
_SPARK_SPANS = T.ArrayType(
    T.StructType()
    .add("kind", T.StringType())
    .add("start", T.LongType())
    .add("end", T.LongType())
    .add("base", T.BooleanType())
)


class Taken:
    """The code points of a text that some span covers; asking and adding cost its length."""

    def __init__(self, spans: list[Span] = ()):
        self.marks = bytearray(max((e for _, _, e, _ in spans), default=0))
        for _, start, end, _ in spans:
            self.add(start, end)

    def add(self, start: int, end: int) -> None:
        if end > len(self.marks):
            self.marks.extend(bytes(end - len(self.marks)))
        self.marks[start:end] = b"\1" * (end - start)

    def free(self, start: int, end: int) -> bool:
        """Whether no span covers any of these code points."""
        return self.marks.find(1, start, end) < 0


def cut_out(text: str, spans: list[tuple[int, int]], mark: str) -> str:
    """The text with every span, overlapping ones together, replaced by ``mark``."""
    at, pieces = 0, []
    for start, end in sorted(spans):
        if start >= at:
            pieces += [text[at:start], mark]
        at = max(at, end)
    return "".join([*pieces, text[at:]])


def add_spans(
    df: DataFrame,
    text_col: str,
    maker: Callable[[], tuple[Callable[[pa.Array], pa.Array], Finder]],
    column: str = "spans",
) -> DataFrame:
    """Add the spans of each text as an array of structs; a null text has none.

    ``maker`` is called once per task and returns a quick test of a whole column, which
    may say yes too often but never no too often, and the function that lists the spans
    of one text.  Other columns pass through unchanged; one named like ``column`` goes.
    """
    kept = df.drop(column)
    at = kept.columns.index(text_col)
    schema = T.StructType([*kept.schema.fields, T.StructField(column, _SPARK_SPANS)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test, find = maker()
        for batch in batches:
            texts = batch.column(at)
            flags = test(texts)
            found = [
                [dict(zip(("kind", "start", "end", "base"), s)) for s in find(texts[i].as_py())]
                if flag
                else []
                for i, flag in enumerate(flags.to_pylist())
            ]
            spans = pa.array(found, pa.list_(_SPAN))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, spans], names=[*batch.schema.names, column]
            )

    return kept.mapInArrow(run, schema)


def cut_spans(
    df: DataFrame,
    text_col: str,
    maker: Callable[[], tuple[Callable[[pa.Array], pa.Array], Finder]],
    mark: str,
) -> DataFrame:
    """The same rows and columns, every span of a text replaced by ``mark``.

    ``maker`` is that of ``add_spans``.  Finding and cutting are one pass, so that a task
    needs one Python worker.
    """
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test, find = maker()
        for batch in batches:
            texts = batch.column(at)
            flags = test(texts)
            some = (t.as_py() for t in texts.filter(flags))
            made = [cut_out(t, [s[1:3] for s in find(t)], mark) for t in some]
            columns = list(batch.columns)
            columns[at] = pc.replace_with_mask(texts, flags, pa.array(made, texts.type))
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return df.mapInArrow(run, df.schema)


def joined(kinds: tuple[str, ...], by_kind: bool, base_only: bool, column: str = "spans") -> Column:
    """``kind:start:end`` of the spans, comma-joined, by start and kind or kind and start."""
    spans = F.col(column)
    if base_only:
        spans = F.filter(spans, lambda s: s["base"])
    order = F.array(*(F.lit(k) for k in kinds))

    def keyed(s: Column) -> Column:
        rank = F.array_position(order, s["kind"])
        keys = (rank, s["start"]) if by_kind else (s["start"], rank)
        text = F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        return F.struct(keys[0].alias("a"), keys[1].alias("b"), s["end"].alias("c"), text.alias("t"))

    return F.array_join(F.array_sort(F.transform(spans, keyed))["t"], ",")


def count_of(kind: str, column: str = "spans") -> Column:
    """Number of base spans of a kind."""
    return F.size(F.filter(column, lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def without(text_col: str, mark: str, column: str = "spans") -> Column:
    """The text with every span, overlapping ones together, replaced by ``mark``."""

    @F.arrow_udf("string")
    def cut(texts: pa.Array, spans: pa.Array) -> pa.Array:
        rows = zip(texts.to_pylist(), spans.to_pylist())
        return pa.array(
            [t if t is None else cut_out(t, [(s["start"], s["end"]) for s in own], mark) for t, own in rows],
            pa.string(),
        )

    text, some = F.col(f"`{text_col}`"), F.size(column) > 0
    # Only texts with spans go to Python.
    return F.when(some, cut(F.when(some, text), F.when(some, F.col(column)))).otherwise(text)
