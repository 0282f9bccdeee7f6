"""Run a registered query in Spark and its SQL in DuckDB, and compare rows regardless of their order."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple((type(r[i]).__name__, _plain(r[i])) for i in order) for r in rows)


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, plan, sql: str, folder: str) -> str:
    """Empty text when equal, else what differs."""
    df = plan(spark, folder)
    got_columns, got = df.columns, [tuple(r) for r in df.collect()]
    result = con.execute(sql)
    want_columns = [d[0] for d in result.description]
    want = result.fetchall()
    if sorted(got_columns) != sorted(want_columns):
        return f"columns {sorted(got_columns)} != {sorted(want_columns)}"
    a, b = _rows(got_columns, got), _rows(want_columns, want)
    if a == b:
        return "" if got else "no rows on either side"
    extra, lacking = list((a - b).items())[:3], list((b - a).items())[:3]
    return f"{len(got)} rows vs {len(want)}; only Spark: {extra}; only SQL: {lacking}"
