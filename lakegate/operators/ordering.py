"""Ordered passes over data of any size: no single-partition window, no window over a hot key.

Rows are range-partitioned on their full order once and written to reliable storage. Every partition is then a block
whose number is a fixed column. A pass is: summarise each block, carry the summaries forward over the few blocks, and
add the carry to a pass inside each block. A key with a third of all rows simply spans many blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lakegate.session import materialised, partitions_for

BLOCK = "_block"
POSITION = "_position"
_PARTITION_BITS = 33  # monotonically_increasing_id: partition number above, row in partition below


def ordered_blocks(df: DataFrame, order: Sequence[str], blocks: int | None = None) -> DataFrame:
    """``df`` with a block number that grows along ``order`` and the position of each row inside its block.

    The range bounds and the numbers are frozen by the written table, so all later passes agree on them even when
    executors are lost. Block and position come with the sorted partition: no second shuffle is needed for them.
    """
    keys = [F.col(c) for c in order]
    ranged = df.repartitionByRange(blocks or partitions_for(df), *keys)
    numbered = ranged.sortWithinPartitions(*keys).withColumn("_row", F.monotonically_increasing_id())
    return materialised(
        numbered.select(
            *df.columns,
            F.shiftright("_row", _PARTITION_BITS).alias(BLOCK),
            F.col("_row").bitwiseAND((1 << _PARTITION_BITS) - 1).alias(POSITION),
        )
    )


def within_block(keys: Sequence[str]) -> WindowSpec:
    """Running window of one key inside one block, at most one partition long."""
    return Window.partitionBy(BLOCK, *keys).orderBy(POSITION).rowsBetween(Window.unboundedPreceding, 0)


def carry(summaries: DataFrame, keys: Sequence[str], columns: dict[str, Column]) -> DataFrame:
    """Running values over the blocks before each block (one row per key and block, so this window is small).

    Its block and key columns are prefixed, for :func:`same_block`.
    """
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    return summaries.select(
        *[F.col(c).alias(f"_c_{c}") for c in (BLOCK, *keys)], *[c.over(before).alias(n) for n, c in columns.items()]
    )


def same_block(keys: Sequence[str]) -> Column:
    """Join condition between rows of a block and what is carried into it; NULL is a key like any other."""
    return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_c_{c}")) for c in (BLOCK, *keys)])


def with_row_number(df: DataFrame, order: Sequence[str], name: str = "row_index") -> DataFrame:
    """Global zero-based position along ``order`` (which must be unique to be well defined)."""
    blocks = ordered_blocks(df, order)
    sizes = blocks.groupBy(BLOCK).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(BLOCK, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return blocks.join(offsets, BLOCK).withColumn(name, F.col("offset") + F.col(POSITION)).select(*df.columns, name)
