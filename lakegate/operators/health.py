"""Failure runs and operational metrics over event logs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from lakegate.operators.ordering import BLOCK, carry, ordered_blocks, same_block, within_block

# Fixed values.
FAILURE_THRESHOLD = 3


def status_effect(status: Column) -> tuple[Column, Column]:
    """A status of 500 and above, or none at all, is a failure; 2xx and 3xx reset; anything else changes nothing."""
    return status.isNull() | (status >= 500), status.between(200, 399)


def _running(events: DataFrame, window: WindowSpec) -> DataFrame:
    """Resets so far, failures so far, and the failures at the last reset, within a window."""
    counted = events.withColumn("_lr", F.sum("_r").over(window)).withColumn("_lf", F.sum("_f").over(window))
    return counted.withColumn("_base", F.max(F.when(F.col("_r") == 1, F.col("_lf"))).over(window))


def _marked(columns: Sequence[Column | str], events: DataFrame, failure: Column, reset: Column) -> DataFrame:
    return events.select(*columns, failure.cast("long").alias("_f"), reset.cast("long").alias("_r"))


def _blockwise_log(marked: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Run and failure count of every event, block by block."""
    local = _running(ordered_blocks(marked, [*keys, *order]), within_block(keys))
    summary = (
        local.groupBy(BLOCK, *keys)
        .agg(F.sum("_r").alias("resets"), F.sum("_f").alias("failures"), F.max("_base").alias("at_reset"))
        .withColumn("after_reset", F.col("failures") - F.coalesce("at_reset", F.lit(0)))
    )
    # Failures that had happened before a block, and before the last reset ahead of it: one row per block and key.
    upto = Window.partitionBy(*keys).orderBy(BLOCK)
    total = F.sum("failures").over(upto.rowsBetween(Window.unboundedPreceding, 0))
    floors = summary.withColumn("_floor", F.when(F.col("resets") > 0, total - F.col("after_reset")))
    carried = carry(
        floors,
        keys,
        {"runs_before": F.sum("resets"), "fails_before": F.sum("failures"), "base_before": F.max("_floor")},
    )
    before = F.coalesce("fails_before", F.lit(0))
    start = F.coalesce(before + F.col("_base"), F.col("base_before"), F.lit(0))
    return local.join(carried, same_block(keys), "left").select(
        *marked.columns,
        (F.coalesce("runs_before", F.lit(0)) + F.col("_lr")).alias("run"),
        (before + F.col("_lf") - start).alias("failure_count"),
    )


def health_log(
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    failure: Column,
    reset: Column,
    threshold: int = FAILURE_THRESHOLD,
) -> DataFrame:
    """Every event with the run it belongs to, the failures so far in that run, and whether the circuit is open.

    Events go block by block (see :mod:`lakegate.operators.ordering`) whatever their number: a key with most of them spans
    many blocks, and one short row per block is carried on.
    """
    log = _blockwise_log(_marked(events.columns, events, failure, reset), keys, order).drop("_f", "_r")
    return log.withColumn("open", F.col("failure_count") >= threshold)


def _run_counts(
    events: DataFrame, keys: Sequence[str], order: Sequence[str], failure: Column, reset: Column
) -> DataFrame:
    """Failures per run, also of runs without any.

    Events are only numbered inside their block; what is carried and joined are run counters.
    """
    blocks = ordered_blocks(_marked([*keys, *order], events, failure, reset), [*keys, *order])
    local = blocks.withColumn("_lr", F.sum("_r").over(within_block(keys)))
    pieces = local.groupBy(BLOCK, *keys, "_lr").agg(F.sum("_f").alias("_failures"))
    resets = pieces.groupBy(BLOCK, *keys).agg(F.max("_lr").alias("resets"))
    before = carry(resets, keys, {"runs_before": F.sum("resets")})
    run = F.coalesce("runs_before", F.lit(0)) + F.col("_lr")
    joined = pieces.join(before, same_block(keys)).select(*keys, run.alias("run"), "_failures")
    return joined.groupBy(*keys, "run").agg(F.sum("_failures").alias("failures"))


def health_runs(
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    failure: Column,
    reset: Column,
    threshold: int = FAILURE_THRESHOLD,
) -> DataFrame:
    """One row per run of failures between resets: its length and whether it opened the circuit."""
    counts = _run_counts(events, keys, order, failure, reset).where("failures > 0")
    return counts.withColumn("opened", F.col("failures") >= threshold)


def health_state(
    events: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    failure: Column,
    reset: Column,
    threshold: int = FAILURE_THRESHOLD,
) -> DataFrame:
    """The last known state per key: the failures of its last run."""
    counts = _run_counts(events, keys, order, failure, reset)
    last = counts.groupBy(*keys).agg(F.max_by("failures", "run").alias("failure_count"))
    return last.withColumn("open", F.col("failure_count") >= threshold)


def retry_metrics(
    events: DataFrame, keys: Sequence[str] = ("operation_id", "platform", "outcome"), bounds: Sequence[float] = ()
) -> DataFrame:
    """Retries, breaker changes and budget use per operation, platform and outcome, in one aggregation.

    ``bounds`` are the upper limits of the budget histogram; the last bucket is open.
    """
    used = F.when(F.col("budget_usage") >= 0, F.col("budget_usage"))
    buckets = []
    for i, high in enumerate([*bounds, None]):
        low = bounds[i - 1] if i else None
        inside = used.isNotNull()
        inside = inside if low is None else inside & (used > low)
        inside = inside if high is None else inside & (used <= high)
        buckets.append(F.count_if(inside).alias(f"budget_bucket_{i}"))
    return events.groupBy(*keys).agg(
        F.coalesce(F.sum(F.when(F.col("retry_count") > 0, F.col("retry_count"))), F.lit(0)).alias("retries"),
        F.count_if(F.col("outcome") == "breaker_state_change").alias("breaker_changes"),
        F.count(used).alias("budget_samples"),
        *buckets,
    )


def last_n_events(events: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The newest ``n`` events, oldest first (a distributed top-n, not a global sort)."""
    return events.orderBy(*[F.col(c).desc() for c in order]).limit(n).orderBy(*order)
