"""SQL cells and formatted previews of a DataFrame."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, functions as F

from runlens.functions.cells import cell_text, html_header, html_row

# Fixed value: rows shown by default.
DEFAULT_LIMIT = 10


def _numbered(df: DataFrame) -> DataFrame:
    """The same rows under positional names, so that repeated names are no problem."""
    return df.toDF(*(f"_{i}" for i in range(len(df.columns))))


def _texts(df: DataFrame) -> list:
    return [cell_text(F.col(f.name), f.dataType) for f in df.schema.fields]


def first_rows(df: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The first rows; a limit below zero gives none."""
    return df.limit(max(limit, 0))


def cells(df: DataFrame) -> DataFrame:
    """Every column as cell text, names kept."""
    flat = _numbered(df)
    return flat.select(*(t.alias(c) for t, c in zip(_texts(flat), df.columns)))


def preview(df: DataFrame, limit: int = DEFAULT_LIMIT) -> DataFrame:
    """The first rows as cell text.  The limit comes first, so only they are formatted."""
    return cells(first_rows(df, limit))


def html_fragments(df: DataFrame, name: str = "fragment") -> DataFrame:
    """One escaped ``<tr>`` fragment per row."""
    flat = _numbered(df)
    return flat.select(html_row(_texts(flat)).alias(name))


def render(df: DataFrame, limit: int = DEFAULT_LIMIT) -> str:
    """The first rows as an HTML table; at most ``limit`` fragments reach the driver."""
    rows = [r[0] for r in html_fragments(first_rows(df, limit)).collect()]
    return "<table>" + html_header(df.columns) + "".join(rows) + "</table>"


def register_views(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    for name, table in tables.items():
        table.createOrReplaceTempView(name)


def sql_cell(
    spark: SparkSession,
    text: str,
    limit: int = DEFAULT_LIMIT,
    tables: Mapping[str, DataFrame] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Run one statement; return the whole result and the preview of its first rows."""
    register_views(spark, tables or {})
    df = spark.sql(text)
    return df, preview(df, limit)


class SqlCells:
    """SQL cell magics for a notebook: ``%%sql`` and ``%%sparksql``.

    ``limit`` is read each time a cell runs; the rest of the magic line is ignored.
    """

    names = ("sql", "sparksql")

    def __init__(self, spark: SparkSession, limit: int = DEFAULT_LIMIT):
        self.spark = spark
        self.limit = limit

    def run(self, line: str, text: str) -> str:
        return render(self.spark.sql(text), self.limit)

    def install(self, shell) -> None:
        """Register the magics with an interactive shell."""
        for name in self.names:
            shell.register_magic_function(self._shown, "cell", name)

    def _shown(self, line: str, text: str):
        return _Markup(self.run(line, text))


class _Markup:
    """A string a notebook shows as HTML."""

    def __init__(self, text: str):
        self.text = text

    def __str__(self) -> str:
        return self.text

    def _repr_html_(self) -> str:
        return self.text


def session() -> SparkSession:
    """The current session, or a new one built from the environment's settings."""
    return SparkSession.builder.getOrCreate()


def load_ipython_extension(shell) -> None:
    """Entry point of ``%load_ext runlens.operators.preview``."""
    SqlCells(session()).install(shell)
