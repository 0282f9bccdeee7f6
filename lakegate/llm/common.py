"""Helpers shared by the operators."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math
import re
import sys
import types
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.session import materialised  # noqa: F401

ASCII_SPACE = b" \t\n\x0b\x0c\r"
SMALL_ROWS = 500_000  # rows of at most 64 bytes that may be broadcast


def text_column(name: str) -> Column:
    """Whole text of a row; null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def free_names(df: DataFrame, *names: str) -> list[str]:
    """The names, lengthened until ``df`` has no such columns."""
    used = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name in used:
            name += "_"
        out.append(name)
    return out


def per_process(kind: str, data: bytes, make: Callable[[bytes], Any]) -> Any:
    """``make(data)``, made once in each Python worker and kept until :func:`release`."""
    store = sys.modules.setdefault("_lakegate_llm_cache", types.ModuleType("_lakegate_llm_cache"))
    key = (len(data), zlib.crc32(data))
    if getattr(store, kind, (None,))[0] != key:
        setattr(store, kind, (key, make(data)))
    return getattr(store, kind)[1]


def release() -> None:
    """At the end of a task: give back what its worker keeps, as workers outlive tasks and share the executor's memory."""
    sys.modules.pop("_lakegate_llm_cache", None)
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after bounding the Arrow batches of its session: texts are far longer than the rows Spark's default expects.

    The bound holds when the plan runs, so it stays in the session; smaller ones that the session has stay as well.
    """
    conf = df.sparkSession.conf
    for name, most in (("maxRecordsPerBatch", 2000), ("maxBytesPerBatch", 8 << 20)):
        key = f"spark.sql.execution.arrow.{name}"
        now = int(re.match(r"-?\d+", conf.get(key)).group())
        if now <= 0 or now > most:
            conf.set(key, str(most))
    return df


def arrow_rows(
    df: DataFrame, columns: list[Column], rows: Callable[[list[list]], Iterable[tuple]], schema: str
) -> DataFrame:
    """Map batches of the given columns to rows, Arrow batch by Arrow batch; row counts may differ.

    ``rows`` gets the columns of one batch as lists and returns an iterable of tuples in the order of ``schema``.
    Batches are bounded by Spark in rows and bytes.
    """
    source = small_batches(df).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)])
    target = source.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(target)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = list(rows([c.to_pylist() for c in batch.columns]))
            columns_made = list(zip(*made, strict=True)) if made else [[] for _ in arrow]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, type=f.type) for c, f in zip(columns_made, arrow, strict=True)], schema=arrow
            )
            del batch, made, columns_made
        release()

    return source.mapInArrow(run, target)


def sized(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` written, and marked for broadcast if it was counted to have few (and short) rows; else joins shuffle it."""
    written = materialised(df, "side")
    return F.broadcast(written) if written.count() <= rows else written


def pieces_of_bytes(raw: bytes, size: int = 1 << 20) -> Iterator[bytes]:
    """Cut bytes at ASCII white space into pieces of about ``size``; a longer word stays whole."""
    start = 0
    while len(raw) - start > size:
        cut = start + size
        while cut < len(raw) and raw[cut] not in ASCII_SPACE:
            cut += 1
        yield raw[start:cut]
        start = cut
    yield raw[start:]


def words_of(raw: bytes) -> Iterator[list[bytes]]:
    """Words between ASCII white space, in lists of bounded size."""
    for piece in pieces_of_bytes(raw):
        yield piece.split()


def ceil_div(a: float, b: float) -> int:
    return max(1, math.ceil(a / b))
