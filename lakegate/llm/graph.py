"""Connected components by joins and minima."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.llm.common import materialised


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable from every node that has an edge to another.

    Alternating large-star and small-star rounds: each points nodes at the smallest node they know of, so rounds grow
    with the logarithm of the longest chain. A round's edges are a table in the shared folder; only its count and
    checksum come to the driver. Rows with nulls and loops are left out; without edges the result is empty.
    """
    now = materialised(
        edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "edges"
    )
    before = None
    while (state := _state(now)) != before and state[0]:
        before = state
        both = now.select(F.col("u").alias("x"), F.col("v").alias("y")).union(now.select("v", "u"))
        least = both.groupBy("x").agg(F.min(F.least("x", "y")).alias("m"))
        large = both.where("y > x").join(least, "x").select(F.col("y").alias("u"), F.col("m").alias("v")).distinct()
        # A written table here keeps the round's plan short: the next half reads it twice.
        large = materialised(large, "edges")
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = materialised(small.union(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
        now.select("v", "v").distinct()
    )
