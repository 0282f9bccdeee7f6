"""Column profile of a frame in one aggregation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.functions.base import quoted

# Fixed value: rows of a bounded look.
SCAN_ROWS = 1000


def column_profile(df: DataFrame, rows: int | None = None) -> DataFrame:
    """One row per column: position, name, type, rows seen, nulls, and whether the look was bounded.

    The whole frame is profiled, or exactly the first ``rows`` rows of it.

    All null counts are computed in a single partial aggregation, then turned into rows.
    """
    scanned = df if rows is None else df.limit(rows)
    counts = scanned.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(F.col(quoted(c)).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column_name"),
                F.lit(f.dataType.simpleString()).alias("column_type"),
                F.col(f"n{i}").alias("null_count"),
            )
            for i, f in enumerate(df.schema.fields)
        ]
    )
    bounded = F.lit(False) if rows is None else F.col("rows") >= rows
    return counts.select("rows", bounded.alias("bounded"), F.inline(entries))


def sample_rows(df: DataFrame, rows: int) -> DataFrame:
    return df.limit(rows)
