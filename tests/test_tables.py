"""Table functions in SQL cells against plain loops."""

import random

import pyarrow as pa

from runlens.functions.tables import IdleGaps, register_tables
from runlens.operators.preview import sql_cell

SCHEMA = "key long, s long, e long"


def plain(rows):
    out = []
    for key in {k for k, _, _ in rows}:
        until = None
        own = sorted((s, e) for k, s, e in rows if k == key and s is not None for e in [s if e is None else e])
        for s, e in own:
            if until is not None and s > until:
                out.append((key, until, s, s - until))
            until = max(x for x in (until, s, e) if x is not None)
    return sorted(out)


def rows_of(n, seed):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        s = rng.randrange(5000)
        e = rng.choice([None, s, s - 5, s + rng.randrange(40)])
        rows.append((rng.choice([1, 1, 1, 2, 3]), rng.choice([s, s, s, s, None]), e))
    return rows


def test_idle_gaps_in_a_cell(spark):
    register_tables(spark)
    rows = rows_of(600, 1)
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    text = "SELECT * FROM idle_gaps(TABLE(SELECT key, s, e FROM t) PARTITION BY key ORDER BY s)"
    found, shown = sql_cell(spark, text, tables={"t": df})
    assert found.columns == ["key", "idle_from", "idle_to", "idle"]
    assert sorted(map(tuple, found.collect())) == plain(rows) != []
    assert 0 < shown.count() <= 10
    assert sql_cell(spark, text, tables={"t": df.limit(0)})[0].count() == 0


def test_a_partition_is_streamed():
    """Whatever the batches, the gaps are those of all rows; one number is kept between."""
    rows = sorted((s, e) for k, s, e in rows_of(900, 2) if k == 1 and s is not None for e in [s if e is None else e])
    for size in (1, 7, 1000):
        gaps, found = IdleGaps(), []
        for i in range(0, len(rows), size):
            part = rows[i : i + size]
            batch = pa.RecordBatch.from_arrays(
                [pa.array([1] * len(part)), pa.array([s for s, _ in part]), pa.array([e for _, e in part])],
                names=["key", "s", "e"],
            )
            for table in gaps.eval(batch):
                found += zip(*table.to_pydict().values())
        assert found == plain([(1, s, e) for s, e in rows])
        assert vars(gaps).keys() == {"busy_until"} and isinstance(gaps.busy_until, int)
