"""Text and markup of one table cell, driven by the column type.

The text is the JVM ``toString`` of the value where that text is well defined:

* null is ``null``; scalars are their cast to string;
* arrays are ``[a, b]``; structs ``[a,b]`` (no blank); maps ``Map(k -> v)``;
* timestamps keep at least one fraction digit (``2020-01-01 00:00:00.0``).

Known deviations, because the JVM text is not reproducible or depends on the Scala
version: a collection inside a collection uses the same text as at the top level,
decimals never use an exponent, binary is upper-case hex, and a timestamp without
zone prints like one with a zone.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T

# The characters markup text may not hold verbatim.
HTML_ENTITIES = (
    ("&", "&amp;"),
    ("<", "&lt;"),
    (">", "&gt;"),
    ('"', "&quot;"),
)

# Control characters other than tab, line feed and carriage return are dropped.
_DROPPED = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"


def cell_text(col: Column, dtype: T.DataType) -> Column:
    """Text of ``col`` (of type ``dtype``) as shown in a table cell; never null."""
    return F.coalesce(_text(col, dtype), F.lit("null"))


def _text(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return col
    if isinstance(dtype, T.ArrayType):
        parts = F.transform(col, lambda x: cell_text(x, dtype.elementType))
        return F.concat(F.lit("["), F.array_join(parts, ", "), F.lit("]"))
    if isinstance(dtype, T.MapType):
        pairs = F.transform(
            F.map_entries(col),
            lambda e: F.concat(
                cell_text(e["key"], dtype.keyType),
                F.lit(" -> "),
                cell_text(e["value"], dtype.valueType),
            ),
        )
        return F.concat(F.lit("Map("), F.array_join(pairs, ", "), F.lit(")"))
    if isinstance(dtype, T.StructType):
        parts = [cell_text(col[f.name], f.dataType) for f in dtype.fields]
        text = F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
        return F.when(col.isNotNull(), text)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        text = col.cast("string")
        return F.when(text.contains("."), text).otherwise(F.concat(text, F.lit(".0")))
    if isinstance(dtype, T.BinaryType):
        return F.hex(col)
    return col.cast("string")


def html_escape(text: Column) -> Column:
    """Escape markup characters and drop control characters."""
    out = F.regexp_replace(text, _DROPPED, "")
    for char, entity in HTML_ENTITIES:
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def html_row(texts: Sequence[Column]) -> Column:
    """One ``<tr>`` fragment from cell texts that are not escaped yet."""
    cells = [F.concat(F.lit("<td>"), html_escape(t), F.lit("</td>")) for t in texts]
    return F.concat(F.lit("<tr>"), *cells, F.lit("</tr>"))


def html_header(names: Sequence[str]) -> str:
    """The header ``<tr>`` of a table."""
    cells = []
    for name in names:
        name = re.sub(_DROPPED, "", name)
        for char, entity in HTML_ENTITIES:
            name = name.replace(char, entity)
        cells.append(f"<th>{name}</th>")
    return "<tr>" + "".join(cells) + "</tr>"
