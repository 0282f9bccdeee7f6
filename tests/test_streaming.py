from __future__ import annotations

import os
import random
import shutil
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.errors import IntakeError
from lakegate.operators.bulk import contiguous_prefix
from lakegate.operators.health import health_log, retry_metrics
from lakegate.operators.transforms import SelectColumns, compose
from lakegate.streaming import jobs


def test_interrupted_sync_publishes_every_row_once(spark, tmp_path):
    base = str(tmp_path)
    spark.range(400).selectExpr("id", "id * 2 AS v").repartition(4).write.parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    seen = []

    class Crash(Exception):
        pass

    def crashing(df):
        seen.append(1)
        if len(seen) == 3:
            raise Crash("stop here")
        return df.select("id")

    def run(step):
        stream = jobs.file_stream(spark, f"{base}/in", schema, files_per_batch=1)
        return jobs.sync_stream(stream, f"{base}/staged", f"{base}/checkpoint", compose([step]))

    with pytest.raises(Exception, match="stop here"):
        run(crashing).awaitTermination()
    partial = spark.read.parquet(f"{base}/staged").count()
    assert 0 < partial < 400
    run(SelectColumns(["id"])).awaitTermination()
    where = (f"{base}/out", "r", base, f"{base}/manifest")
    number = max(os.listdir(f"{base}/staged"))
    os.rename(f"{base}/staged/{number}", f"{base}/lost")
    with pytest.raises(IntakeError, match="lost"):
        jobs.publish_staged(spark, f"{base}/staged", f"{base}/checkpoint", *where)
    os.rename(f"{base}/lost", f"{base}/staged/{number}")
    published = jobs.publish_staged(spark, f"{base}/staged", f"{base}/checkpoint", *where)
    out = spark.read.parquet(published.uri)
    assert not os.path.exists(f"{base}/staged")
    assert out.columns == ["id"] and out.count() == 400 and out.distinct().count() == 400


def test_long_streams_publish_and_name_wrong_batches(spark, tmp_path):
    """More batches than the checkpoint remembers; what is lost, altered or damaged is named; nothing comes twice."""
    base, kept = str(tmp_path), "spark.sql.streaming.minBatchesToRetain"
    spark.range(600).selectExpr("id", "id % 7 AS v").repartition(30).write.parquet(f"{base}/in")
    schema = spark.read.parquet(f"{base}/in").schema
    folders = (f"{base}/staged", f"{base}/checkpoint")
    where = (f"{base}/out", "r", base, f"{base}/manifest")

    def run():
        stream = jobs.file_stream(spark, f"{base}/in", schema, files_per_batch=1)
        jobs.sync_stream(stream, *folders).awaitTermination()

    usual = spark.conf.get(kept)
    try:
        spark.conf.set(kept, "2")
        run()
    finally:
        spark.conf.set(kept, usual)
    assert len(os.listdir(f"{base}/checkpoint/commits")) < 30
    batch = f"{folders[0]}/{jobs.STAGED}=11"
    os.rename(batch, f"{base}/kept")
    for rows, fault in ((None, "lost"), (spark.range(20).selectExpr("id", "id AS v"), "altered")):
        if rows is not None:
            rows.write.parquet(batch)
        with pytest.raises(IntakeError, match=f"batch 11 is {fault}"):
            jobs.publish_staged(spark, *folders, *where)
    shutil.rmtree(batch)
    shutil.copytree(f"{base}/kept", batch)
    for name in os.listdir(batch):
        if name.endswith(".parquet"):
            open(f"{batch}/{name}", "wb").write(b"PAR1 no more")
            if os.path.exists(f"{batch}/.{name}.crc"):
                os.remove(f"{batch}/.{name}.crc")
    with pytest.raises(IntakeError, match="batch 11 is (lost|altered)"):
        jobs.publish_staged(spark, *folders, *where)
    shutil.rmtree(batch)
    os.rename(f"{base}/kept", batch)
    entry = f"{folders[1]}-ledger/staged/{jobs.STAGED}=5"
    os.rename(entry, f"{base}/entry")
    with pytest.raises(IntakeError, match="batch 5 has no entry"):
        jobs.publish_staged(spark, *folders, *where)
    os.rename(f"{base}/entry", entry)
    shutil.copytree(folders[0], f"{base}/again")
    first = jobs.publish_staged(spark, *folders, *where)
    assert spark.read.parquet(first.uri).distinct().count() == first.row_count == 600
    with pytest.raises(IntakeError, match="since the last publication"):
        jobs.publish_staged(spark, *folders, *where)
    os.rename(f"{base}/again", folders[0])  # batches staged once more after they were published
    spark.range(600, 610).selectExpr("id", "id % 7 AS v").coalesce(1).write.mode("append").parquet(f"{base}/in")
    run()
    second = jobs.publish_staged(spark, *folders, *where)
    assert sorted(r.id for r in spark.read.parquet(second.uri).collect()) == list(range(600, 610))


def test_a_ledger_of_another_stream_is_refused(spark, tmp_path):
    base = str(tmp_path)
    spark.range(10).coalesce(1).write.parquet(f"{base}/a")
    spark.range(20).coalesce(1).write.parquet(f"{base}/b")
    schema = spark.read.parquet(f"{base}/a").schema
    jobs.sync_stream(jobs.file_stream(spark, f"{base}/a", schema), f"{base}/s", f"{base}/c").awaitTermination()
    shutil.rmtree(f"{base}/c")
    with pytest.raises(Exception, match="another run of the stream"):
        jobs.sync_stream(jobs.file_stream(spark, f"{base}/b", schema), f"{base}/s", f"{base}/c").awaitTermination()
    shutil.rmtree(f"{base}/c")
    jobs.sync_stream(jobs.file_stream(spark, f"{base}/a", schema), f"{base}/s", f"{base}/c").awaitTermination()


def test_expired_keys_leave_no_state(spark, tmp_path, monkeypatch):
    """Every run brings new keys; with an expiry only those of the last runs are kept, and a key that comes again is new."""
    base = str(tmp_path)
    schema = "k long, ts long, kind string"
    rows = {}
    monkeypatch.setitem(jobs.STATE_STORE, "spark.sql.shuffle.partitions", "2")
    for expire in (None, 1):
        for run in range(3):
            events = spark.range(40).selectExpr(f"CASE WHEN id = 0 THEN NULL ELSE id + {run * 100} END AS k", f"id + {run} * 1000 AS ts", "'fail' AS kind")
            events.coalesce(1).write.mode("append").parquet(f"{base}/in-{expire}")
            query = jobs.health_stream(
                jobs.file_stream(spark, f"{base}/in-{expire}", T.StructType.fromDDL(schema)), f"{base}/out-{expire}", f"{base}/state-{expire}",
                f"{base}/check-{expire}", ["k"], ["ts"], lambda: F.col("kind") == "fail", lambda: F.col("kind") == "reset", 3, expire,
            )
            query.awaitTermination()
            time.sleep(0.05)
        rows[expire] = query.lastProgress.stateOperators[0].numRowsTotal
        out = spark.read.parquet(f"{base}/out-{expire}")
        again = sorted(r.failure_count for r in out.where("k IS NULL").collect())
        assert again == ([1, 2, 3] if expire is None else [1, 1, 1]) and out.count() == 120
    assert rows[None] == 3 * 39 + 1 and rows[1] <= 80


def test_replayed_health_batch_changes_nothing(spark, tmp_path):
    """The same input through many batches, with a crash between output and state, equals one batch pass."""
    base = str(tmp_path)
    rows = spark.range(300).selectExpr(
        "cast(id % 3 AS int) AS k", "id AS ts", "CASE id % 11 WHEN 0 THEN 'reset' WHEN 1 THEN 'other' ELSE 'fail' END AS kind"
    )
    failure, reset = (lambda: F.col("kind") == "fail"), (lambda: F.col("kind") == "reset")
    want = sorted(map(tuple, health_log(rows, ["k"], ["ts"], failure(), reset()).collect()))
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) == 2:
            raise RuntimeError("lost")
        return failure()

    def run(fail):
        stream = jobs.file_stream(spark, f"{base}/in", rows.schema)
        jobs.health_stream(
            stream, f"{base}/out", f"{base}/state", f"{base}/checkpoint", ["k"], ["ts"], fail, reset
        ).awaitTermination()

    for part in range(3):
        rows.where(F.col("ts").between(part * 100, part * 100 + 99)).coalesce(1).write.mode("append").parquet(f"{base}/in")
        try:
            run(flaky)
        except Exception:
            run(failure)
    got = spark.read.parquet(f"{base}/out").select("k", "ts", "kind", "run", "failure_count", "open")
    assert sorted(map(tuple, got.collect())) == want


def test_closed_windows_equal_the_batch_metrics(spark, tmp_path):
    base = str(tmp_path)
    events = spark.range(2000).selectExpr(
        "timestamp_seconds(1700000000 + id * 10) AS ts",
        "'op' AS operation_id",
        "'ckan' AS platform",
        "CASE WHEN id % 7 = 0 THEN 'breaker_state_change' ELSE 'ok' END AS outcome",
        "id % 3 AS retry_count",
        "cast(id % 5 AS double) - 1 AS budget_usage",
    )
    events.write.parquet(f"{base}/in")
    stream = jobs.file_stream(spark, f"{base}/in", events.schema)
    jobs.event_metrics_stream(stream, f"{base}/out", f"{base}/checkpoint", "10 minutes", "1 minute", [1.0]).awaitTermination()
    got = spark.read.parquet(f"{base}/out")
    batch = retry_metrics(
        events.withColumn("window_start", F.window("ts", "10 minutes").start),
        ["window_start", "operation_id", "platform", "outcome"],
        [1.0],
    )
    last = got.agg(F.max("window_start")).first()[0]
    columns = sorted(got.columns)
    assert got.count() > 40
    assert sorted(map(str, got.select(columns).collect())) == sorted(
        map(str, batch.where(F.col("window_start") <= last).select(columns).collect())
    )


def test_receipts_are_released_as_the_batch_operator_has_them(spark, tmp_path):
    """Random order, gaps, second receipts, indices that cannot be; a restart after every batch and one that fails."""
    rng, base = random.Random(3), str(tmp_path)
    sizes = {1: 60, 2: 8, 3: 1, 4: 12}
    rows = [(plan, i, f"{plan}-{i}") for plan, n in sizes.items() for i in range(n) if (plan, i) not in ((2, 5), (4, 0))]
    rows += [(1, 7, "again"), (1, 3, "again"), (2, 6, "again"), (None, 0, "no plan"), (1, None, "no index"), (1, -1, "negative")]
    rng.shuffle(rows)
    schema, so_far = "plan_id long, item_index int, note string", []

    def run():
        stream = jobs.file_stream(spark, f"{base}/in", T.StructType.fromDDL(schema))
        jobs.prefix_stream(stream, f"{base}/out", f"{base}/state", f"{base}/checkpoint").awaitTermination()

    for k in range(0, len(rows), 18):
        so_far += rows[k : k + 18]
        spark.createDataFrame(rows[k : k + 18], schema).coalesce(1).write.mode("append").parquet(f"{base}/in")
        run()
        if k == 36:  # as if the last batch had not been committed
            number = max(int(f) for f in os.listdir(f"{base}/checkpoint/commits") if f.isdigit())
            for name in (f"{number}", f".{number}.crc"):
                os.remove(f"{base}/checkpoint/commits/{name}")
            run()
        got = spark.read.schema(schema).parquet(f"{base}/out").select("plan_id", "item_index", "note").collect()
        have = {(p, i) for p, i, _ in so_far}
        want = [r for r in so_far if r[0] is not None and (r[1] or 0) >= 0 and r[1] is not None
                and all((r[0], i) in have for i in range(r[1] + 1))]
        assert sorted(map(tuple, got)) == sorted(want)
        batch = contiguous_prefix(spark.createDataFrame(so_far, schema)).select("plan_id", "item_index", "note")
        assert sorted(map(tuple, batch.collect())) == sorted(want)
    left = spark.read.parquet(f"{base}/state/waiting/{len(os.listdir(f'{base}/out')) - 1}").collect()
    assert {r.plan_id for r in left} == {2, 4} and len(os.listdir(f"{base}/state/waiting")) == 2
