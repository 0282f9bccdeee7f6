"""Bulk plans, receipts and checkpoints as tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakegate.functions.base import case


def resume_pending(plan: DataFrame, receipts: DataFrame, keys: tuple[str, ...] = ("plan_id", "item_index")) -> DataFrame:
    """Plan items without a receipt."""
    return plan.join(receipts.select(*keys), list(keys), "left_anti")


def receipt_mismatch(
    plan: DataFrame, receipts: DataFrame, keys: tuple[str, ...] = ("plan_id", "item_index"), target: str = "target"
) -> DataFrame:
    """Receipts whose target is not the plan's item at that index."""
    planned = plan.select(*keys, F.col(target).alias("planned"))
    return (
        receipts.join(planned, list(keys))
        .where(~F.col(target).eqNullSafe(F.col("planned")))
        .select(*keys, "planned", F.col(target).alias("received"))
    )


def bulk_summary(plan: DataFrame, receipts: DataFrame) -> DataFrame:
    """Totals per plan in one conditional aggregation over plan and receipts together.

    ``receipts`` may carry a ``budget_exhausted`` flag; a plan with such a receipt ended for that reason, one with
    items left otherwise was cancelled.

    No join: both sides are reduced to counters first, so a plan with a third of all items stays cheap.
    """
    none = F.lit(None).cast("string")
    flag = F.col("budget_exhausted") if "budget_exhausted" in receipts.columns else F.lit(False)
    rows = plan.select(
        "plan_id", F.lit(1).alias("planned"), none.alias("outcome"), F.lit(0).alias("settled"), F.lit(False).alias("spent")
    ).unionAll(receipts.select("plan_id", F.lit(0), "outcome", F.lit(1), flag))
    counted = rows.groupBy("plan_id").agg(
        F.sum("planned").alias("total"),
        *[F.count_if(F.col("outcome") == o).alias(o) for o in ("succeeded", "failed", "skipped")],
        F.sum("settled").alias("settled"),
        F.coalesce(F.bool_or("spent"), F.lit(False)).alias("spent"),
    )
    state = case(
        [(F.col("spent"), F.lit("budget_exhausted")), (F.col("outstanding") > 0, F.lit("cancelled"))], F.lit("completed")
    )
    return (
        counted.withColumn("outstanding", F.col("total") - F.col("settled")).withColumn("state", state).drop("spent")
    )


def duplicate_plan_items(plan: DataFrame) -> DataFrame:
    """Items listed more than once, named ``platform/kind/value``."""
    return (
        plan.groupBy("plan_id", "platform", "resource_kind", "value")
        .agg(F.count(F.lit(1)).alias("copies"))
        .where("copies > 1")
        .select("plan_id", F.concat_ws("/", "platform", "resource_kind", "value").alias("item"), "copies")
    )


def prefix_ends(receipts: DataFrame) -> DataFrame:
    """(plan_id, last_index): where each plan's run of indices from 0 on ends; -1 if it does not begin. Others don't count."""
    present = receipts.select("plan_id", "item_index").where("item_index >= 0")
    successors = present.select("plan_id", (F.col("item_index") - 1).alias("item_index"))
    ends = present.join(successors, ["plan_id", "item_index"], "left_anti")
    prefix = ends.unionAll(
        present.groupBy("plan_id").agg(F.min("item_index").alias("first")).where("first > 0").select("plan_id", F.lit(-1))
    )
    return prefix.groupBy("plan_id").agg(F.min("item_index").alias("last_index"))


def contiguous_prefix(receipts: DataFrame) -> DataFrame:
    """Receipts that may be released: indices 0, 1, 2, ... up to the first hole, per plan.

    The prefix ends at the smallest index whose successor is missing, found by an anti join on (plan, index) and a
    ``min``; no window runs over a plan.
    """
    last = prefix_ends(receipts)
    return receipts.join(last, "plan_id").where(F.col("item_index").between(0, F.col("last_index"))).drop("last_index")


def checkpoint_violations(receipts: DataFrame, plan_sizes: DataFrame) -> DataFrame:
    """Receipts out of range or not above the one before them.

    ``position`` numbers the receipts of a checkpoint without holes, so the neighbour is found by an equi-join on
    (plan, position), which is unique and therefore spreads evenly.
    """
    previous = receipts.select(
        "plan_id", (F.col("position") + 1).alias("position"), F.col("item_index").alias("previous_index")
    )
    checked = receipts.join(previous, ["plan_id", "position"], "left").join(plan_sizes, "plan_id", "left")
    rule = case(
        [
            ((F.col("item_index") < 0) | (F.col("item_index") >= F.col("total")), F.lit("index out of range")),
            (F.col("item_index") == F.col("previous_index"), F.lit("duplicate index")),
            (F.col("item_index") < F.col("previous_index"), F.lit("not increasing")),
        ]
    )
    return checked.select("plan_id", "position", "item_index", rule.alias("rule")).where("rule IS NOT NULL")
