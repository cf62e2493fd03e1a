import json
import re

from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from runlens.functions import (
    any_prefix, decode_field, encode_data, encode_open, every, is_shippable_jar, leading_text,
    mask_home, mask_home_prefix, split_lines, with_prefix,
)
from runlens.operators.lines import batch_adjacent, batch_rows, batch_text, text_lines
from runlens.operators.manifest import distinct_union, manifest_diff, without_ignored
from runlens.sources.files import key_values, read_lines
from runlens.sources.sinks import write_html_rows, write_lines, write_messages


def lines_of(spark, *values):
    return spark.createDataFrame(list(enumerate(values)), "pos int, value string")


def pairs(df, ignore=()):
    return {r["key"]: r["value"] for r in key_values(df, ["pos"], ignore).collect()}


def test_key_values(spark):
    cases = {
        "a b c": {"a": "b c"}, "a": {}, "a ": {"a": ""}, " a b": {"": "a b"}, "": {},
        "#x y": {}, "a\t \tb": {"a": "b"}, "k #v": {"k": "#v"},
    }
    for line, want in cases.items():
        assert pairs(lines_of(spark, line)) == want, line
    many = lines_of(spark, "a 1", "b 1", "a 2", "c 3", "a", "b  x y")
    assert pairs(many.repartition(3), {"c"}) == {"a": "2", "b": "x y"}


SMALL = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SMALL
@given(st.lists(st.text(alphabet="ab# \t", max_size=6), min_size=1, max_size=40))
def test_key_values_property(spark, lines):
    want = {}
    for line in lines:
        parts = re.split(r"\s+", line, maxsplit=1)
        if not line.startswith("#") and len(parts) == 2:
            want[parts[0]] = parts[1]
    assert pairs(lines_of(spark, *lines)) == want


def test_split_lines(spark):
    cases = {
        "": [], "\n": [""], "a": ["a"], "a\n": ["a"], "a\n\n": ["a", ""], "a\r\nb\rc\n": ["a", "b", "c"],
        "\na": ["", "a"], None: None,
    }
    for text, want in cases.items():
        df = spark.createDataFrame([(text,)], "t string")
        assert df.select(split_lines(F.col("t"))).first()[0] == want, text


def test_batches_hold_at_most_eleven_lines(spark):
    counts = [0, 1, 11, 12, 100]
    texts = [(n, "\n".join(f"l{i}" for i in range(n))) for n in counts]
    df = spark.createDataFrame(texts, "n int, text string")
    want = {
        (n, b): [f"l{i}" for i in range(n)][b * 11 : b * 11 + 11]
        for n in counts
        for b in range((n + 10) // 11)
    }
    cut = batch_text(df, ["n"])
    grouped = batch_rows(text_lines(df, ["n"]).repartition(3), ["n"])
    for found in (cut, grouped):
        assert {(r["n"], r["batch"]): r["lines"] for r in found.collect()} == want
    upper = batch_text(df, ["n"], each=F.upper).filter("n = 1").first()["lines"]
    assert upper == ["L0"]


@SMALL
@given(st.lists(st.integers(0, 30), min_size=1, max_size=6), st.integers(1, 12))
def test_adjacent_batches_property(spark, lengths, size):
    rows = [(f"f{f}", i, f"{f}:{i}") for f, n in enumerate(lengths) for i in range(n)]
    df = spark.createDataFrame(rows, "file string, pos bigint, value string").coalesce(1)
    found = batch_adjacent(df, ["file"], "pos", size=size).collect()
    assert all(1 <= len(r["lines"]) <= size for r in found)
    back = {}
    for r in sorted(found, key=lambda r: (r["file"], r["pos"])):
        assert r["lines"][0] == f"{r['file'][1:]}:{r['pos']}"
        back.setdefault(r["file"], []).extend(r["lines"])
    assert back == {f"f{f}": [f"{f}:{i}" for i in range(n)] for f, n in enumerate(lengths) if n}


def test_text_file(spark, tmp_path):
    file = tmp_path / "input.txt"
    file.write_text("hello\nhello hello\nhello hello hello")
    lines = read_lines(spark, str(file))
    held = lines.cache()
    assert [held.count() for _ in range(3)] == [3, 3, 3]
    held.unpersist()
    batches = batch_adjacent(lines, ["file", "block"], "place").collect()
    assert [len(r["lines"]) for r in batches] == [3]
    assert {r[0] for r in lines.select(leading_text(F.col("value"), 3)).collect()} == {"hel"}


def test_masks_and_prefix(spark):
    df = spark.createDataFrame(
        [("/home/u/a /home/u/b",), ("none",), ("",), (None,)], "value string"
    )
    line = F.col("value")
    got = df.select(
        mask_home(line, "/home/u"),
        mask_home_prefix(line, "/home/u"),
        with_prefix(line, "> "),
        with_prefix(line, F.lit(None).cast("string")),
        with_prefix(line, None),
        mask_home(line, ""),
    ).collect()
    assert tuple(got[0]) == (
        "~/a ~/b", "~/a /home/u/b", "> /home/u/a /home/u/b", *["/home/u/a /home/u/b"] * 3,
    )
    assert tuple(got[1]) == ("none", "none", "> none", "none", "none", "none")
    assert tuple(got[2]) == ("", "", "> ", "", "", "")
    assert tuple(got[3]) == (None,) * 6


def test_messages(spark, tmp_path):
    rows = [(["a", 'q"', "é\t\\"],), ([],)]
    df = spark.createDataFrame(rows, "lines array<string>")
    sent = [r[0] for r in df.select(encode_data(F.col("lines"))).collect()]
    assert [json.loads(m) for m in sent] == [{"data": r[0]} for r in rows]
    back = df.select(decode_field(encode_data(F.col("lines")), "data", "array<string>"))
    assert [r[0] for r in back.collect()] == [r[0] for r in rows]
    write_messages(df, str(tmp_path / "m"))
    write_messages(df, str(tmp_path / "m"))
    assert spark.read.text(str(tmp_path / "m")).count() == 2
    opened = spark.range(1).select(
        encode_open(F.lit("~/x")), encode_open(F.lit("y"), F.lit("p ")),
        encode_open(F.lit("z"), F.lit(None).cast("string")),
    ).first()
    assert [json.loads(m) for m in opened] == [
        {"file_name": "~/x"}, {"file_name": "y", "prefix": "p "}, {"file_name": "z"},
    ]


@SMALL
@given(st.lists(st.one_of(st.integers(-(2**40), 2**40), st.text(max_size=4), st.none()), min_size=1))
def test_decode_property(spark, values):
    messages = [json.dumps({"stageId": v}) for v in values]
    df = spark.createDataFrame(list(enumerate(messages)), "i int, m string")
    got = df.orderBy("i").select(decode_field(F.col("m"), "stageId")).collect()
    fits = lambda v: isinstance(v, int) and -(2**31) <= v < 2**31
    assert [r[0] for r in got] == [v if fits(v) else None for v in values]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb & c")], "n int, t string")
    write_html_rows(df, str(tmp_path / "h"))
    rows = spark.read.text(str(tmp_path / "h")).collect()
    assert [r[0] for r in rows] == ["<tr><td>1</td><td>a&#10;b &amp; c</td></tr>"]
    write_lines(df.select(F.col("n").cast("string").alias("value")), str(tmp_path / "l"))
    assert [r[0] for r in spark.read.text(str(tmp_path / "l")).collect()] == ["1"]


def uris(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "uri string")


def found(df):
    return sorted((r[0] for r in df.collect()), key=str)


def test_manifest_diff(spark):
    a, b = uris(spark, "x", "x", "y", None), uris(spark, "y", "z", "w")
    assert set(found(distinct_union([a, b]))) == {None, "w", "x", "y", "z"}
    assert set(found(manifest_diff([a, b], [uris(spark, "y")]))) == {None, "w", "x", "z"}
    assert set(found(manifest_diff([a, b], [uris(spark, "y"), uris(spark, None, "w")]))) == {"x", "z"}
    assert set(found(manifest_diff([a], []))) == {None, "x", "y"}
    keep = [F.col("uri") != "x", F.col("uri") != "w"]
    assert found(manifest_diff([a, b], [uris(spark, "y")], keep=keep)) == ["z"]
    assert set(found(without_ignored(a, ["y"]).distinct())) == {None, "x"}
    assert without_ignored(a, []).count() == 4


def test_path_rules(spark):
    cases = {
        "file:/a/b.jar": True, "file:/a/b-sources.jar": False, "file:/a/b.zip": False,
        "http://h/b.jar": False, "jar:file:/a/b.jar!/c.jar!/": True, "jar:file:/a.jar!/x": False,
        "jar:file:/a/b-sources.jar!/": False, "file:/a/b.jar?x": True, "file:/a/b.jar#x": True,
    }
    df = uris(spark, *cases)
    got = df.select("uri", is_shippable_jar(F.col("uri")), any_prefix(F.col("uri"), ["file:/a"]))
    for uri, shippable, under in got.collect():
        assert (shippable, under) == (cases[uri], uri.startswith("file:/a/")), uri
    assert df.filter(every([])).count() == len(cases)
    assert df.filter(any_prefix(F.col("uri"), [])).count() == 0
