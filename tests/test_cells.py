import datetime
import decimal

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from runlens.operators.preview import SqlCells, cells, preview, render, sql_cell


def one(spark, schema, value):
    return cells(spark.createDataFrame([(value,)], f"c {schema}")).first()[0]


def test_cell_text_by_type(spark):
    utc = datetime.datetime
    cases = [
        ("int", None, "null"),
        ("int", 5, "5"),
        ("double", 1e10, "1.0E10"),
        ("boolean", True, "true"),
        ("string", "a", "a"),
        ("date", datetime.date(2020, 1, 2), "2020-01-02"),
        ("array<string>", ["a", None], "[a, null]"),
        ("array<int>", [], "[]"),
        ("array<int>", None, "null"),
        ("array<array<int>>", [[1], [2, 3]], "[[1], [2, 3]]"),
        ("struct<a:int,b:string,c:int>", (1, "a", None), "[1,a,null]"),
        ("array<struct<a:int,b:string>>", [(1, "x")], "[[1,x]]"),
        ("struct<`a.b`:int>", (1,), "[1]"),
        ("struct<a:int>", None, "null"),
        ("map<string,int>", {"a": 1}, "Map(a -> 1)"),
        ("map<string,int>", {"a": None}, "Map(a -> null)"),
        ("timestamp", utc(2020, 1, 1), "2020-01-01 00:00:00.0"),
        ("timestamp", utc(2020, 1, 1, 0, 0, 0, 120000), "2020-01-01 00:00:00.12"),
        ("timestamp_ntz", utc(2020, 1, 1, 5), "2020-01-01 05:00:00.0"),
        ("array<timestamp>", [utc(2020, 1, 1)], "[2020-01-01 00:00:00.0]"),
        ("decimal(20,2)", decimal.Decimal("1.50"), "1.50"),
        ("binary", b"\x01\xab", "01AB"),
    ]
    assert [(s, one(spark, s, v)) for s, v, _ in cases] == [(s, t) for s, _, t in cases]


def test_render_escapes_and_marks_up(spark):
    df = spark.createDataFrame([(1, '<a & "b">\x00\x07\t'), (2, None)], "n int, `x<y` string")
    assert render(df) == (
        "<table><tr><th>n</th><th>x&lt;y</th></tr>"
        "<tr><td>1</td><td>&lt;a &amp; &quot;b&quot;&gt;\x00\t</td></tr>"
        "<tr><td>2</td><td>null</td></tr></table>"
    ).replace("\x00", "")


def test_limits(spark):
    df = spark.range(30)
    assert [preview(df, n).count() for n in (-1, 0, 3, 50)] == [0, 0, 3, 30]
    assert render(df, -1) == "<table><tr><th>id</th></tr></table>"
    assert preview(df).count() == 10


def test_repeated_and_odd_column_names(spark):
    df = spark.sql("SELECT 1 AS a, 'x' AS a, 2 AS `b.c`, 3 AS `d``e`")
    assert preview(df).columns == ["a", "a", "b.c", "d`e"]
    assert tuple(preview(df).first()) == ("1", "x", "2", "3")


def test_statement_without_rows(spark):
    df, shown = sql_cell(spark, "CREATE OR REPLACE TEMP VIEW nothing AS SELECT 1 AS a;")
    assert df.columns == [] and shown.count() == 0
    assert render(df) == "<table><tr></tr></table>"


def test_sql_cell_keeps_the_whole_result(spark):
    tables = {"numbers": spark.range(100)}
    df, shown = sql_cell(spark, "SELECT id FROM numbers ORDER BY id DESC", 2, tables)
    assert df.count() == 100
    assert [r[0] for r in shown.collect()] == ["99", "98"]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_preview_limits_before_it_formats(spark):
    folder = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang")
    assert "CollectLimit" in plan_of(preview(df))
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan_of(preview(df))
    assert "TakeOrderedAndProject" in plan_of(preview(df.orderBy("doc_id")))


def test_magics(spark):
    class Shell:
        magics = {}

        def register_magic_function(self, fn, kind, name):
            self.magics[kind, name] = fn

    shell, sql = Shell(), SqlCells(spark)
    sql.install(shell)
    assert set(shell.magics) == {("cell", "sql"), ("cell", "sparksql")}
    text = 'SELECT """x""" AS q UNION ALL SELECT \'y\''
    assert "<td>&quot;x&quot;</td>" in shell.magics["cell", "sql"]("ignored --words", text)._repr_html_()
    sql.limit = 1
    shown = str(shell.magics["cell", "sparksql"]("", "SELECT id FROM range(5)"))
    assert shown.count("<td>") == 1


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.lists(st.one_of(st.none(), st.integers(-9, 9))), min_size=1, max_size=30))
def test_array_text_property(spark, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i int, a array<int>")
    got = [r[1] for r in cells(df).orderBy(F.col("i").cast("int")).collect()]
    want = ["[" + ", ".join("null" if x is None else str(x) for x in r) + "]" for r in rows]
    assert got == want
