"""Shapes of plans, hot keys, and ordered passes against brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from lakegate.operators import bulk, digest, health
from lakegate.operators.digest import digest_tree, ordered_digest, table_fingerprint
from lakegate.operators.ordering import ordered_blocks, with_row_number
from lakegate.operators.transforms import Filter, NormalizeTimestamps, SelectColumns, compose
from lakegate.plans import QUERIES, intake
from lakegate.streaming import jobs

FOLDER = "/root/testdata/sf0.001"
ORDERS = f"{FOLDER}/orders.parquet"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def brute_force(rows, threshold=3):
    """The state machine, one event after the other."""
    state, out = {}, []
    for key, ts, kind in sorted(rows):
        run, count = state.get(key, (0, 0))
        if kind == "reset":
            run, count = run + 1, 0
        elif kind == "fail":
            count += 1
        state[key] = (run, count)
        out.append((key, ts, run, count, count >= threshold))
    return out


@pytest.mark.parametrize("seed, hot", [(1, 0.0), (2, 0.34), (3, 1.0), (4, 0.5)])
def test_health_equals_the_state_machine(spark, seed, hot):
    rng = random.Random(seed)
    kinds = ["fail"] * 5 + ["reset"] + ["other"] * 2
    rows = [(0 if rng.random() < hot else rng.randrange(40), ts, rng.choice(kinds)) for ts in range(3000)]
    want = brute_force(rows)
    # key 0 is stored as NULL: missing keys are a key like any other
    df = spark.createDataFrame([(k or None, ts, kind) for k, ts, kind in rows], "k int, ts int, kind string").repartition(7)
    args = (["k"], ["ts"], F.col("kind") == "fail", F.col("kind") == "reset")
    log = health.health_log(df, *args).select("k", "ts", "run", "failure_count", "open")
    assert sorted((r.k or 0, *r[1:]) for r in log.collect()) == want
    runs = health.health_runs(df, *args).collect()
    longest = {}
    for k, _, run, count, _ in want:
        longest[k, run] = max(count, longest.get((k, run), 0))
    assert {(r.k or 0, r.run): r.failures for r in runs} == {key: n for key, n in longest.items() if n}
    last = {k: (count, is_open) for k, _, _, count, is_open in want}
    state = health.health_state(df, *args).collect()
    assert {r.k or 0: (r.failure_count, r.open) for r in state} == last


def test_a_hot_key_spans_many_blocks(spark):
    df = spark.range(8000).select(F.lit(1).alias("k"), F.col("id").alias("ts"))
    blocks = ordered_blocks(df, ["k", "ts"], 8)
    sizes = [r["count"] for r in blocks.groupBy("_block").count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 8000 / 2


def test_row_numbers_follow_the_order(spark):
    df = spark.range(5000).select(((F.col("id") * 7919) % 5000).alias("v"))
    got = with_row_number(df, ["v"]).where("row_index <> v").count()
    assert got == 0


def test_digest_tree_is_the_nested_digest(spark):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    leaves = [sha(str(i)) for i in range(50)]
    level = leaves
    while len(level) > 1:
        level = [sha("".join(level[i : i + 4])) for i in range(0, len(level), 4)]
    df = spark.createDataFrame(list(enumerate(leaves)), "i bigint, h string").repartition(5)
    assert digest_tree(df, "i", "h", 4).first().ordered_digest == level[0]


def test_order_matters_only_to_the_ordered_digest(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string")
    b = spark.createDataFrame([(1, "y"), (2, "x")], "id int, v string")
    swapped = spark.createDataFrame([(2, "y"), (1, "x")], "id int, v string")
    one, two = (table_fingerprint(f).first().content_digest for f in (a, swapped))
    assert one == two
    assert ordered_digest(a, ["id"]).first().ordered_digest != ordered_digest(b, ["id"]).first().ordered_digest
    with pytest.raises(Exception, match="not unique"):
        ordered_digest(a.unionAll(a), ["id"]).collect()
    many = spark.range(100).selectExpr("id - CASE WHEN id = 64 THEN 1 ELSE 0 END AS id")
    for fan_in in (4, 64, 200):  # the equal pair sits inside a node, or on the border of two
        with pytest.raises(Exception, match="not unique"):
            ordered_digest(many, ["id"], fan_in).collect()


@pytest.mark.parametrize("indices", [[0, 1, 2, 4], [1, 2], [0], [3], [0, 1, 2, 3], [0, 2, 3, 5]])
def test_prefix_equals_brute_force(spark, indices):
    want = [i for n, i in enumerate(sorted(indices)) if n == i]
    df = spark.createDataFrame([(7, i) for i in indices], "plan_id int, item_index int")
    assert sorted(r.item_index for r in bulk.contiguous_prefix(df).collect()) == want


def test_filters_and_columns_reach_the_scan(spark):
    steps = compose([SelectColumns(["o_orderkey", "o_totalprice", "o_orderdate"]), NormalizeTimestamps(), Filter("o_totalprice > 5")])
    plan = plan_of(steps(spark.read.parquet(ORDERS)).select("o_orderkey"))
    assert "PushedFilters: [IsNotNull(o_totalprice), GreaterThan(o_totalprice,5.0)]" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double>" in plan


def test_fingerprint_is_one_partial_aggregation(spark):
    plan = plan_of(table_fingerprint(spark.read.parquet(ORDERS)))
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan
    assert "partial_sum" in plan and "Sort" not in plan


def test_proposals_are_reduced_before_they_meet_the_state(spark):
    from lakegate.operators.sync import conditional_merge

    state = spark.range(10).selectExpr("cast(id AS string) AS key", "'v' AS version", "id AS x")
    proposals = spark.range(100).selectExpr(
        "'1' AS key", "'w' AS version", "id AS x", "'v' AS expected", "id AS `order`", "false AS deleted"
    )
    merged, outcomes = conditional_merge(state, proposals)
    plan = plan_of(merged)
    assert "LeftSemi" not in plan and plan.count("partial_min_by") >= 1
    assert merged.where("key = '1' AND version = 'w' AND x = 0").count() == 1 and merged.count() == 10
    assert outcomes.where("outcome = 'committed'").count() == 1


NARROW = ["t_filter", "t_cast", "t_normalize_ts", "t_flatten", "unify", "sanitize_uri", "redact_text", "url_rules",
          "spec_violations", "case_outcomes", "fingerprint_pages", "mutation_policy", "dataset_records"]


@pytest.mark.parametrize("name", NARROW)
def test_row_wise_operators_do_not_shuffle(spark, name):
    plan = plan_of(entry.queries()[name](spark, FOLDER))
    if name == "dataset_records":  # its input pages are grouped from documents
        assert plan.count("Exchange") == 1
    else:
        assert "Exchange" not in plan


def test_no_registered_plan_is_cartesian(spark):
    streaming = {n for n in entry.queries() if n.endswith("_stream")}
    for name, plan in entry.queries().items():
        if name in streaming:
            continue
        text = plan_of(plan(spark, FOLDER))
        assert "CartesianProduct" not in text, name
        assert "BroadcastNestedLoopJoin" not in text, name


def test_digest_lanes_from_bytes_are_those_from_text(spark):
    rows = spark.range(0, 5000, 1, 3).select((F.col("id") % 7).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("h"))
    parts = [F.col(f"p.p{lane}") for lane in range(4)]
    for some in (rows, rows.where("k < 0")):
        fast = some.select("k", digest.lane_parts(F.col("h")).alias("p"))
        got = fast.groupBy("k").agg(*[c.alias(n) for n, c in digest.limb_sums(parts).items()])
        want = some.groupBy("k").agg(*[c.alias(n) for n, c in digest.lane_sums(F.col("h")).items()])
        assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect())
    plan = digest.table_fingerprint(rows, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "conv(" not in plan


def test_a_batch_of_one_row_group_is_staged_by_many_tasks(spark, tmp_path):
    spark.range(600_000).selectExpr("id", "uuid() AS u").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = jobs.file_stream(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, files_per_batch=1)
    jobs.sync_stream(stream, f"{tmp_path}/staged", f"{tmp_path}/checkpoint").awaitTermination()
    staged = spark.read.parquet(f"{tmp_path}/staged")
    assert len(staged.inputFiles()) > 2 and staged.select("id").distinct().count() == staged.count() == 600_000


@pytest.mark.parametrize("name", ["src_mixed_folder", "src_packed"])
def test_packed_files_hold_a_bounded_number_of_rows(spark, tmp_path, monkeypatch, name):
    spark.range(1, 201).selectExpr("id AS c_custkey", "'s' || id % 3 AS c_mktsegment").coalesce(1).write.parquet(
        f"{tmp_path}/tables/customer.parquet"
    )
    monkeypatch.setattr(intake, "FILE_ROWS", 60, raising=False)
    monkeypatch.setattr(intake, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    rows = QUERIES[name](spark, f"{tmp_path}/tables").collect()
    kinds = 1 if name == "src_mixed_folder" else 4
    assert sum(r.row_count for r in rows) == 200 * kinds and sum(r.key_sum for r in rows) == 20100 * kinds
    assert len([p for p in tmp_path.rglob("*") if p.is_file() and p.name.startswith(("feed", "part")) and "-" in p.name
                and "tables" not in p.parts and "." not in p.name]) == 16 * kinds
