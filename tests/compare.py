"""Compare a Spark result with DuckDB's answer to the oracle SQL."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter

import duckdb

from runlens.plans.tables import NAMES


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in NAMES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, decimal.Decimal):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return round(value, 9)
    if isinstance(value, datetime.datetime) and value.tzinfo:
        return value.replace(tzinfo=None)
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(plain(r[c]) for c in names) for r in df.collect())


def oracle_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    columns = [d[0] for d in result.description]
    names = sorted(columns)
    at = [columns.index(n) for n in names]
    return names, Counter(tuple(plain(r[i]) for i in at) for r in result.fetchall())


def difference(df, con, sql: str) -> str:
    """Empty when both sides agree, else a short description."""
    names, ours = spark_rows(df)
    expected_names, theirs = oracle_rows(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if ours == theirs:
        return ""
    extra, missing = ours - theirs, theirs - ours
    return (
        f"{sum(ours.values())} rows against {sum(theirs.values())}; "
        f"{sum(extra.values())} only in Spark, e.g. {str(list(extra)[:2])[:400]}; "
        f"{sum(missing.values())} only in SQL, e.g. {str(list(missing)[:2])[:400]}"
    )
