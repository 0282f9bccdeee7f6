from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.errors import IntakeError
from lakegate.operators import sync
from lakegate.sources import readers, runs, sinks
from lakegate.sources.state import StateTable

ODD = ["a/b", "p:q", "50%", "a=b", "..", "'", "é x"]


def state(spark, base, kind=StateTable):
    return kind(spark, f"{base}/state", T.StructType.fromDDL(runs.STATE_SCHEMA))


def actions(done):
    return {r.key: r.action for r in done.collect()}


def newest(spark, base):
    return {r.resource_identity: r for r in sinks.latest_artifacts(spark, f"{base}/manifest").collect()}


def test_odd_keys_and_damaged_artifacts(spark, tmp_path):
    base = str(tmp_path)
    names = F.array(*[F.lit(k) for k in ODD])
    rows = spark.range(700).select(F.element_at(names, (F.col("id") % 7 + 1).cast("int")).alias("r"), "id")
    where = ("r", f"{base}/out", f"{base}/manifest", state(spark, base), "https://u:p@h/x?token=abc")
    assert set(actions(runs.sync_run(rows, *where)).values()) == {"written"}
    found = newest(spark, base)
    assert found.keys() == set(ODD) and not any(t in found[".."].source_locator for t in ("abc", "u:p"))
    for key, row in found.items():
        kept = spark.read.parquet(row.uri)
        assert kept.columns == ["r", "id"] and {r.r for r in kept.collect()} == {key} and kept.count() == row.row_count == 100
        assert (row.size, row.blob_digest) == sinks.blob_state(spark, row.uri)
    good, bad = sinks.decode_manifest(sinks.encode_manifest(sinks.latest_artifacts(spark, f"{base}/manifest")), "document")
    assert good.count() == len(ODD) and bad.isEmpty()
    shutil.rmtree(found["a/b"].uri)  # one lost, one with other bytes, one with other rows
    part = next(Path(found["p:q"].uri).glob("*.parquet"))
    part.write_bytes(b"PAR1 nothing")
    spark.range(5).selectExpr("'50%' AS r", "id").write.mode("append").parquet(found["50%"].uri)
    again = actions(runs.sync_run(rows, *where))
    assert {k for k, a in again.items() if a == "written"} == {"a/b", "p:q", "50%"}
    assert set(actions(runs.sync_run(rows, *where)).values()) == {"unchanged"}
    changed = rows.withColumn("id", F.when(F.col("r") == "..", F.col("id") + 1).otherwise(F.col("id")))
    assert set(actions(runs.sync_run(changed, *where, resume=True)).values()) == {"resumed"}
    assert [k for k, a in actions(runs.sync_run(changed, *where)).items() if a == "written"] == [".."]


def test_resources_without_a_key_are_refused(spark, tmp_path):
    for key in (None, ""):
        rows = spark.createDataFrame([("a", 1), (key, 2)], "r string, v int")
        with pytest.raises(Exception, match="without a key"):
            runs.sync_run(rows, "r", f"{tmp_path}/out", f"{tmp_path}/manifest", state(spark, tmp_path), "x")
    assert not (tmp_path / "manifest").exists()


def test_a_large_resource_is_written_by_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(runs, "ROWS_PER_FILE", 1000)
    rows = spark.range(8000).selectExpr("CASE WHEN id % 4 < 3 THEN 'hot' ELSE 'k' || id % 40 END AS r", "id")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # as with large partitions
    try:
        runs.sync_run(rows, "r", f"{tmp_path}/out", f"{tmp_path}/manifest", state(spark, tmp_path), "x")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = {k: len(list(Path(r.uri).glob("*.parquet"))) for k, r in newest(spark, tmp_path).items()}
    assert files.pop("hot") > 2 and set(files.values()) == {1}


def parquet_source(spark, base, keys=("a", "b c", "d")):
    for n, key in enumerate(keys):
        rows = spark.range(30_000 * (n + 1)).selectExpr("id", f"'{key}' AS k").repartition(2, "id")
        rows.write.option("parquet.block.size", 32 * 1024).parquet(f"{base}/in/{key}")
    return T.StructType.fromDDL("id bigint, k string")


class Breaking(StateTable):
    """Breaks off at a given swap."""

    def swap(self, rows, expected):
        if expected == int(Path(self.folder, "break-at").read_text()):
            raise ConnectionError("gone")
        return super().swap(rows, expected)


def test_a_stopped_run_goes_on_behind_its_cursors(spark, tmp_path):
    base = str(tmp_path)
    schema = parquet_source(spark, base)
    where = (f"{base}/in", f"{base}/staged", f"{base}/out", f"{base}/manifest")
    Path(base, "state").mkdir()
    Path(base, "state", "break-at").write_text("2")
    breaking = state(spark, base, Breaking)
    with pytest.raises(ConnectionError):
        runs.resume_run(spark, *where, breaking, schema, groups_at_once=2)
    cursors = {r.key: (r.status, r.row_group_index) for r in breaking.read()[0].collect()}
    assert cursors == dict.fromkeys(("a", "b c", "d"), ("in_progress", 4))
    staged = {p: p.stat().st_mtime_ns for p in Path(base, "staged").glob("*/*/__group=[0-3]/*.parquet")}
    assert len(staged) == 12
    Path(base, "state", "break-at").write_text("4")  # and once more, inside the rest
    with pytest.raises(ConnectionError):
        runs.resume_run(spark, *where, breaking, schema, groups_at_once=1)
    assert {p: p.stat().st_mtime_ns for p in staged} == staged  # finished row groups were not read again
    groups = {r.key: r.groups for r in runs.parquet_resources(spark, where[0])[0].collect()}
    done = {r.key: r for r in runs.resume_run(spark, *where, state(spark, base), schema).collect()}
    assert {k: (r.action, r.groups_read) for k, r in done.items()} == {k: ("resumed", n - 6) for k, n in groups.items()}
    assert not Path(base, "staged").exists()
    for n, key in enumerate(("a", "b c", "d"), 1):
        rows = spark.read.parquet(newest(spark, base)[key].uri)
        assert rows.columns == ["id", "k"] and rows.count() == rows.distinct().count() == 30_000 * n == done[key].row_count
    assert set(actions(runs.resume_run(spark, *where, state(spark, base), schema)).values()) == {"resumed"}


def test_waves_are_few_however_long_a_resource_is(spark, tmp_path):
    base = str(tmp_path)
    schema = parquet_source(spark, base, ("a",))
    where = (f"{base}/in", f"{base}/staged", f"{base}/out", f"{base}/manifest")
    groups = runs.parquet_resources(spark, where[0])[0].first().groups
    done = runs.resume_run(spark, *where, state(spark, base), schema, groups_at_once=1).first()
    assert groups > 4 and done.groups_read == groups and done.row_count == 30_000
    assert state(spark, base).read()[1] == 1 + (groups - 1).bit_length() + 1  # 1, 1, 2, 4, ... row groups, and the end
    rows = spark.read.parquet(newest(spark, base)["a"].uri)
    assert rows.count() == rows.distinct().count() == 30_000


def test_changed_damaged_and_empty_resources(spark, tmp_path):
    base = str(tmp_path)
    schema = parquet_source(spark, base, ("a", "b"))
    spark.createDataFrame([], schema).coalesce(1).write.parquet(f"{base}/in/empty")
    where = (f"{base}/in", f"{base}/staged", f"{base}/out", f"{base}/manifest", state(spark, base), schema)
    assert set(actions(runs.resume_run(spark, *where)).values()) == {"materialized"}
    empty = spark.read.parquet(newest(spark, base)["empty"].uri)
    assert empty.count() == 0 and empty.columns == schema.names
    assert set(actions(runs.resume_run(spark, *where, resume=False)).values()) == {"skipped-unchanged"}
    shutil.rmtree(newest(spark, base)["a"].uri)
    spark.range(7).selectExpr("id", "'b' AS k").write.mode("append").parquet(f"{base}/in/b")
    assert actions(runs.resume_run(spark, *where)) == {"a": "materialized", "b": "resumed", "empty": "resumed"}
    assert actions(runs.resume_run(spark, *where, resume=False))["b"] == "materialized"
    assert newest(spark, base)["b"].row_count == 60_007


def test_a_checkpoint_of_another_version_starts_anew(spark, tmp_path):
    base = str(tmp_path)
    schema = parquet_source(spark, base, ("a",))
    where = (f"{base}/in", f"{base}/staged", f"{base}/out", f"{base}/manifest")
    Path(base, "state").mkdir()
    Path(base, "state", "break-at").write_text("1")
    with pytest.raises(ConnectionError):
        runs.resume_run(spark, *where, state(spark, base, Breaking), schema, groups_at_once=3)
    spark.range(30_000, 30_050).selectExpr("id", "'a' AS k").write.mode("append").parquet(f"{base}/in/a")
    done = runs.resume_run(spark, *where, state(spark, base), schema).first()
    assert done.action == "materialized" and done.row_count == 30_050
    rows = spark.read.parquet(newest(spark, base)["a"].uri)
    assert rows.count() == rows.distinct().count() == 30_050


def test_positions_no_file_has_are_errors(spark, tmp_path):
    path = f"{tmp_path}/p"
    spark.range(1000).coalesce(1).write.parquet(path)
    place = readers.row_groups(spark, path).first()
    for group in (-1, 1):
        done = spark.createDataFrame([(place.file_path, group)], "file_path string, row_group int")
        with pytest.raises(IntakeError, match="no such row group"):
            readers.read_pending_row_groups(spark, path, done)
    gone = spark.createDataFrame([("file:/gone.parquet", 9)], "file_path string, row_group int")
    assert readers.read_pending_row_groups(spark, path, gone).count() == 1000


def test_proposals_need_a_key(spark):
    current = spark.createDataFrame([("a", "1")], "key string, version string")
    columns = "key string, version string, expected string, `order` int, deleted boolean"
    for order in (0, None):
        proposals = spark.createDataFrame([(None, "2", None, order, False), ("a", "3", "1", 0, False)], columns)
        for result in sync.conditional_merge(current, proposals):
            with pytest.raises(Exception, match="without a key"):
                result.collect()
