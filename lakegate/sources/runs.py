"""Sync runs: all due resources of a plan in one job, and the state that says what was done."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lakegate.errors import IntakeError
from lakegate.functions.urls import sanitize_uri
from lakegate.operators.digest import lane_sums, lane_totals, table_fingerprint
from lakegate.operators.ordering import with_row_number
from lakegate.operators.sync import STATE_COLUMNS, conditional_merge, destination_health, sync_plan
from lakegate.session import materialised, remove_path
from lakegate.sources.files import file_digests, list_files, publish_file
from lakegate.sources.readers import row_groups, rows_of_row_groups
from lakegate.sources.sinks import MANIFEST_SCHEMA
from lakegate.sources.state import StateTable

STATE_SCHEMA = (
    "key string, watermark string, status string, source_version string, destination_identity string,"
    " next_batch_index bigint, row_group_index bigint, last_synced_at timestamp, version string"
)
RUN, RESOURCE = "__run", "__resource"  # partitions of a destination: the run, and a digest of the resource's key
KEY, GROUP, VERSION = "__key", "__group", "__version"
ROWS_PER_FILE = 5_000_000
_PLACE = rf"{RUN}=[^/]+/{RESOURCE}=[^/]+"


def _folder_name(key: Column) -> Column:
    """A name for a resource that any file system takes, whatever its key."""
    return F.concat(F.lit("r"), F.substring(F.sha2(key, 256), 1, 32))


def _with_keys(rows: DataFrame, key: str) -> DataFrame:
    """``rows``, raising at a key that is NULL or empty: nothing could name such a resource again."""
    missing = F.raise_error(F.lit(f"a resource without a key: {key} is NULL or empty")).cast("string")
    return rows.withColumn(KEY, F.coalesce(F.nullif(F.col(key).cast("string"), F.lit("")), missing))


def manifest_rows(spark: SparkSession, manifest: str) -> DataFrame:
    """All rows of a manifest; none if nothing was published yet."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST_SCHEMA)


def artifact_contents(artifacts: DataFrame, destination: str, schema: T.StructType) -> DataFrame:
    """(uri, size, row_count, content_digest, blob_digest) of what lies below ``destination`` for each artifact's ``uri``.

    Two grouped aggregations over all artifacts at once: one over the bytes of their files, hashed in tasks, one over
    their rows, of which only the artifacts' partitions are read. What is missing has no row; damaged files have no rows,
    which the digests show.
    """
    spark = artifacts.sparkSession
    place = F.regexp_extract("uri", f"({_PLACE})/?$", 1)
    named = materialised(artifacts.select("uri", place.alias("place")).where("place <> ''").distinct(), "artifacts")
    inside = F.regexp_extract("path", f"({_PLACE})/[^/]+$", 1)
    try:
        listed = list_files(spark, destination, "*.parquet").select("path", "size", inside.alias("place"))
        stored = T.StructType([*schema.fields, T.StructField(RUN, T.StringType()), T.StructField(RESOURCE, T.StringType())])
        rows = spark.read.schema(stored).option("ignoreCorruptFiles", "true").parquet(destination)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], "uri string, size bigint, row_count bigint, content_digest string, blob_digest string")
    wanted = listed.join(named, "place", "left_semi")
    blobs = (
        file_digests(wanted)
        .withColumn("place", inside)
        .groupBy("place")
        .agg(
            F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
            F.count(F.lit(1)).cast("string").alias("files"),
            *[c.alias(n) for n, c in lane_sums(F.col("sha256")).items()],
        )
        .select("place", "size", F.sha2(F.concat_ws("|", "files", *lane_totals()), 256).alias("blob_digest"))
    )
    folders = named.select(
        F.regexp_extract("place", f"{RUN}=([^/]+)", 1).alias(RUN), F.regexp_extract("place", f"{RESOURCE}=([^/]+)", 1).alias(RESOURCE)
    )
    contents = table_fingerprint(rows.join(folders, [RUN, RESOURCE], "left_semi"), [RUN, RESOURCE], True, schema.names)
    placed = contents.withColumn("place", F.concat(F.lit(f"{RUN}="), F.col(RUN), F.lit(f"/{RESOURCE}="), F.col(RESOURCE)))
    empty = table_fingerprint(spark.createDataFrame([], schema), [], True).select("content_digest").first()[0]
    return (
        named.join(blobs, "place")
        .join(placed.select("place", "row_count", "content_digest"), "place", "left")
        .select(
            "uri",
            "size",
            F.coalesce("row_count", F.lit(0)).alias("row_count"),
            F.coalesce("content_digest", F.lit(empty)).alias("content_digest"),
            "blob_digest",
        )
    )


def stored_health(stored: DataFrame, manifest: str, destination: str, schema: T.StructType) -> DataFrame:
    """(key, healthy) of every completed resource: the artifact that its state names, against what lies there."""
    completed = stored.where("status = 'completed'").select("key", "destination_identity")
    rows = manifest_rows(stored.sparkSession, manifest)
    recorded = rows.select(
        F.col("resource_identity").alias("key"),
        F.sha2("uri", 256).alias("destination_identity"),
        "uri",
        "size",
        "content_digest",
        "blob_digest",
    )
    artifacts = materialised(completed.join(recorded, ["key", "destination_identity"], "left"), "recorded")
    if artifacts.isEmpty():
        return stored.sparkSession.createDataFrame([], "key string, healthy boolean")
    found = artifact_contents(artifacts.where("uri IS NOT NULL"), destination, schema)
    return destination_health(artifacts.withColumn("expected_uri", F.col("uri")), found).select("key", "healthy")


def _resources(seen: DataFrame, access: str, fmt: str, version: Column, target: Column, digest: Column) -> DataFrame:
    """The columns that :func:`lakegate.operators.sync.sync_plan` asks for, beside those of ``seen``."""
    nothing = F.lit(None).cast("string")
    return seen.select(
        *seen.columns,
        F.lit(access).alias("access_kind"),
        F.lit(fmt).alias("format"),
        version.cast("string").alias("live_version"),
        target.cast("string").alias("live_destination"),
        digest.cast("string").alias("live_digest"),
        F.lit(None).cast("int").alias("response_status"),
        nothing.alias("fresh_watermark"),
    ).withColumn("content_digest", F.col("live_digest")).drop("live_digest")


def _written(rows: DataFrame, columns: Sequence[str], due: DataFrame, destination: str) -> DataFrame:
    """Write the rows of the due resources, each into a folder of its own, and say what lies there now.

    ``due``: key, row_count. Rows are dealt out by resource and, for large ones, by pieces of it, so a resource with a
    third of all rows is written by many tasks and a small one is one file.
    """
    uri = f"{destination.rstrip('/')}/{RUN}={uuid.uuid4().hex}"
    pieces = F.ceil(F.col("row_count") / ROWS_PER_FILE).cast("long")
    named = due.select(F.col("key").alias(KEY), _folder_name(F.col("key")).alias(RESOURCE), F.greatest(pieces, F.lit(1)).alias("__pieces"))
    dealt = rows.join(named, KEY).withColumn("__piece", F.pmod(F.xxhash64(*columns), F.col("__pieces")))
    schema = T.StructType([f for f in rows.schema.fields if f.name in set(columns)])
    dealt.repartition(RESOURCE, "__piece").select(*columns, RESOURCE).write.partitionBy(RESOURCE).parquet(uri)
    artifacts = due.select("key", F.concat(F.lit(f"{uri}/{RESOURCE}="), _folder_name(F.col("key"))).alias("uri"))
    artifacts = materialised(artifacts, "targets")
    _fill_empty(artifacts.join(due.where("row_count = 0"), "key", "left_semi"), schema)
    return materialised(artifacts.join(artifact_contents(artifacts, destination, schema), "uri", "left"), "written")


def _fill_empty(artifacts: DataFrame, schema: T.StructType) -> None:
    """A file without rows, but with the columns, for each resource that has none."""
    arrow = to_arrow_schema(schema)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import pyarrow.parquet as pq

        for batch in batches:
            for uri in batch["uri"]:
                publish_file(f"{uri}/part-empty.parquet", lambda sink: pq.write_table(arrow.empty_table(), sink))
            yield batch

    artifacts.select("uri").mapInPandas(write, "uri string").count()


def _commit(written: DataFrame, stored: DataFrame, number: int, manifest: str, state: StateTable, locator: Column) -> None:
    """Manifest rows first, then the state, merged on each resource's version and swapped as a whole.

    ``written``: key, uri, size, row_count, content_digest, blob_digest, source_version.
    """
    entries = {
        "uri": F.col("uri"),
        "media_type": F.lit("application/x-parquet"),
        "size": F.col("size"),
        "content_digest": F.col("content_digest"),
        "blob_digest": F.col("blob_digest"),
        "source_locator": sanitize_uri(locator),
        "resource_identity": F.col("key"),
        "created_at": F.current_timestamp(),
        "mode": F.lit("parquet"),
        "transforms": F.array().cast("array<string>"),
        "row_count": F.col("row_count"),
    }
    kinds = dict(part.split() for part in MANIFEST_SCHEMA.split(", "))
    written.select(*[entries[c].cast(kind).alias(c) for c, kind in kinds.items()]).write.mode("append").parquet(manifest)
    values = {
        "key": F.col("key"),
        "watermark": F.col("content_digest"),
        "status": F.lit("completed"),
        "source_version": F.col("source_version"),
        "destination_identity": F.sha2("uri", 256),
        "last_synced_at": F.current_timestamp(),
        "version": F.sha2(F.concat_ws("|", "key", "content_digest", F.lit(str(number + 1))), 256),
    }
    _merge(written, values, stored, number, state)


def _merge(rows: DataFrame, values: dict[str, Column], stored: DataFrame, number: int, state: StateTable) -> None:
    expected = stored.select("key", F.col("version").alias("expected"))
    proposals = rows.join(expected, "key", "left").select(
        *[values.get(c, F.lit(None)).cast(stored.schema[c].dataType).alias(c) for c in STATE_COLUMNS],
        "expected",
        F.lit(0).alias("order"),
        F.lit(False).alias("deleted"),
    )
    merged, _ = conditional_merge(stored, proposals)
    state.swap(merged, number)


def sync_run(
    rows: DataFrame, key: str, destination: str, manifest: str, state: StateTable, locator: str, resume: bool = False
) -> DataFrame:
    """Publish every resource that the sync plan has due; one row per resource: key, row_count, action.

    ``rows`` holds the rows of all resources, told apart by ``key``. One aggregation fingerprints them all, the artifacts
    that the state names are checked in their own (:func:`stored_health`), and ``sync_plan`` decides: a resource is written
    if its content is not that of the stored watermark, or if its artifact is missing or damaged; else it is unchanged.
    With ``resume`` a completed resource whose artifact is healthy is left as it is (``resumed``), whatever its content.

    The rows of due resources are written by one job, into a folder per resource below a folder of this run, named by a
    digest of the key; then the manifest gets a row for each, then the state is merged by compare-and-swap on each
    resource's version and swapped as a whole. A source that changes while it is read stops the run. A run that breaks off
    leaves files that nothing refers to, or manifest rows that the state does not name; of two runs at once the later swap
    raises and its resources are due again. A key that is NULL or empty raises.
    """
    stored, number = state.read()
    columns = rows.columns
    keyed = _with_keys(rows, key)
    seen = table_fingerprint(keyed, [KEY], True, columns).select(F.col(KEY).alias("key"), "row_count", "content_digest")
    seen = materialised(seen, "fingerprints")
    health = stored_health(stored, manifest, destination, rows.schema)
    nothing = F.lit(None).cast("string")
    asked = _resources(seen, "table", "rows", nothing, nothing, F.col("content_digest"))
    action = {"materialized": "written", "skipped-unchanged": "unchanged"}
    plan = sync_plan(asked, stored, health, resume).replace(action, subset=["action"])
    plan = materialised(plan.select("key", "row_count", "content_digest", "action"), "plan")
    due = plan.where("action = 'written'")
    if not due.isEmpty():
        written = _written(keyed, columns, due, destination).withColumnRenamed("content_digest", "found_digest")
        checked = due.join(written.drop("row_count"), "key", "left").withColumn("source_version", nothing)
        # What the manifest and the state say of a resource was read back from its files, not from the plan.
        wrong = checked.where("NOT content_digest <=> found_digest").orderBy("key").first()
        if wrong is not None:  # the source changed between the two reads of this run: nothing is committed
            raise IntakeError(f"resource {wrong['key']!r} changed while it was read")
        _commit(checked, stored, number, manifest, state, F.lit(locator))
    return plan.select("key", "row_count", "action")


def parquet_resources(spark: SparkSession, source: str) -> tuple[DataFrame, DataFrame]:
    """Resources below ``source``, one for each file or folder in it, and the place of their row groups.

    Returns (key, source_version, groups, row_count) and (key, file_path, row_group, n_rows, position). A resource's
    version is a digest of the names, sizes and times of its files. Positions count the row groups of a resource in the
    order of its files, from 0; they are numbered by one ordered pass over all of them.
    """
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(source)
    root = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString().rstrip("/") + "/"
    below = lambda name: F.split(F.expr(f"substring({name}, {len(root) + 1})"), "/")[0]
    files = list_files(spark, source, "*.parquet")
    mark = F.sha2(F.concat_ws("|", "path", F.col("size").cast("string"), F.unix_micros("modified").cast("string")), 256)
    versions = files.select(below("path").alias("key"), mark.alias("mark")).groupBy("key").agg(
        F.count(F.lit(1)).cast("string").alias("files"), *[c.alias(n) for n, c in lane_sums(F.col("mark")).items()]
    )
    groups = row_groups(spark, source).withColumn("key", below("file_path"))
    numbered = materialised(with_row_number(groups, ["key", "file_path", "row_group"]), "row-groups")
    per_key = numbered.groupBy("key").agg(
        F.count(F.lit(1)).alias("groups"), F.sum("n_rows").alias("row_count"), F.min("row_index").alias("first")
    )
    resources = versions.join(per_key, "key", "left").select(
        "key",
        F.sha2(F.concat_ws("|", "files", *lane_totals()), 256).alias("source_version"),
        F.coalesce("groups", F.lit(0)).alias("groups"),
        F.coalesce("row_count", F.lit(0)).alias("row_count"),
    )
    positions = numbered.join(per_key.select("key", "first"), "key").select(
        "key", "file_path", "row_group", "n_rows", (F.col("row_index") - F.col("first")).alias("position")
    )
    return resources, positions


def resume_run(
    spark: SparkSession,
    source: str,
    staging: str,
    destination: str,
    manifest: str,
    state: StateTable,
    schema: T.StructType,
    resume: bool = True,
    groups_at_once: int = 1024,
) -> DataFrame:
    """Publish the Parquet resources below ``source`` that the plan has due, going on inside those begun earlier.

    One row per resource: key, action, row_count, groups_read (row groups that this run read). Each file or folder in
    ``source`` is a resource; all have the columns of ``schema``.

    A run goes in waves. A wave reads the next row groups of every due resource in one job, stages them in a folder for
    each row group, and then advances each resource's cursor in the state: one compare-and-swap snapshot for the whole
    wave. The first wave reads ``groups_at_once`` row groups of a resource, each further one as many as those before it
    together, so waves are few however long the resources are, and a run that breaks off loses no more than it keeps
    (or one first wave). A run that was stopped goes on behind the last finished wave; row groups before a cursor
    are not read again, and those of the broken wave replace what it staged. When the cursors are at the end, staged
    rows are published like those of :func:`sync_run` and the staging folder goes.

    ``sync_plan`` decides what is due: a checkpoint counts only for the version of the source that it was made for, and a
    resource that changes while it is read stops the run. A completed resource is read again if its artifact is missing
    or damaged, and without ``resume`` also if its files changed.
    """
    stored, number = state.read()
    resources, positions = (materialised(df, "resources") for df in parquet_resources(spark, source))
    health = stored_health(stored, manifest, destination, schema)
    target = F.sha2(F.concat_ws("|", F.lit(staging), F.col("key"), F.col("source_version")), 256)
    before = stored.select("key", F.col("source_version").alias("seen_version"), F.col("watermark").alias("seen_watermark"))
    same = F.when(F.col("seen_version") == F.col("source_version"), F.col("seen_watermark"))
    asked = _resources(
        resources.join(before, "key", "left"), "object_storage", "parquet", F.col("source_version"), target, same
    ).select("*", F.col("source_version").alias("at_version"), target.alias("target")).drop("source_version")
    plan = sync_plan(asked, stored, health, resume)
    cursors = stored.select("key", "status", F.col("row_group_index").alias("cursor"), F.col("next_batch_index").alias("batches"))
    going_on = (F.col("action") == "resumed") & (F.col("status") == "in_progress")
    plan = plan.join(cursors, "key", "left").select(
        "key",
        "action",
        "groups",
        "row_count",
        F.col("at_version").alias("source_version"),
        "target",
        (going_on | (F.col("action") == "materialized")).alias("due"),
        F.when(going_on, F.col("cursor")).otherwise(F.lit(0)).cast("long").alias("start"),
        F.when(going_on, F.col("batches")).otherwise(F.lit(0)).cast("long").alias("batch"),
    )
    plan = materialised(plan, "plan")
    due = plan.where("due")
    beyond = due.where("start < 0 OR start > groups").orderBy("key").first()
    if beyond is not None:
        raise IntakeError(f"the cursor of {beyond['key']!r} is at {beyond['start']}, of {beyond['groups']} row groups")
    longest = due.agg(F.max(F.col("groups") - F.col("start"))).first()[0] or 0
    wave, behind = 0, 0  # row groups of a resource that the waves before this one read
    while behind < longest:
        ahead = groups_at_once << wave
        first = F.col("start") + behind
        end = F.least(F.col("start") + ahead, F.col("groups"))
        window = due.where(first < F.col("groups")).select("*", first.alias("first"), end.alias("end"))
        chosen = positions.join(window.select("key", "first", "end", "source_version"), "key").where(
            "position >= first AND position < end"
        )
        places = chosen.select(
            "file_path",
            "row_group",
            _folder_name(F.col("key")).alias(RESOURCE),
            F.col("source_version").alias(VERSION),
            F.col("position").alias(GROUP),
        )
        writer = rows_of_row_groups(places, schema).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(RESOURCE, VERSION, GROUP).parquet(staging)
        values = {
            "key": F.col("key"),
            "status": F.lit("in_progress"),
            "source_version": F.col("source_version"),
            "destination_identity": F.col("target"),
            "next_batch_index": F.col("batch") + wave + 1,
            "row_group_index": F.col("end"),
            "last_synced_at": F.current_timestamp(),
            "version": F.sha2(F.concat_ws("|", "key", "source_version", F.col("end").cast("string"), F.lit(str(number + 1))), 256),
        }
        _merge(window, values, stored, number, state)
        stored, number = state.read()
        wave, behind = wave + 1, ahead
    if not due.isEmpty():
        live, _ = parquet_resources(spark, source)
        live = live.select("key", F.col("source_version").alias("live_version"))
        wrong = due.join(live, "key", "left").where("NOT source_version <=> live_version").orderBy("key").first()
        if wrong is not None:
            raise IntakeError(f"resource {wrong['key']!r} changed while it was read")
        kept = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in (RESOURCE, VERSION)]])
        names = due.select(
            F.col("key").alias(KEY), _folder_name(F.col("key")).alias(RESOURCE), F.col("source_version").alias(VERSION)
        )
        try:
            staged = spark.read.schema(kept).parquet(staging)
        except AnalysisException as problem:  # only resources without rows
            if problem.getCondition() != "PATH_NOT_FOUND":
                raise
            staged = spark.createDataFrame([], kept)
        written = _written(staged.join(names, [RESOURCE, VERSION]).drop(RESOURCE, VERSION), schema.names, due, destination)
        expected = due.select("key", "source_version", F.col("row_count").alias("expected_rows"))
        checked = materialised(expected.join(written, "key", "left"), "checked")
        wrong = checked.where("NOT row_count <=> expected_rows").orderBy("key").first()
        if wrong is not None:
            raise IntakeError(f"{wrong['key']!r} has {wrong['expected_rows']} rows, but {wrong['row_count']} were staged")
        _commit(checked, stored, number, manifest, state, F.concat(F.lit(source.rstrip("/") + "/"), F.col("key")))
        remove_path(spark, staging)
    read = F.when(F.col("due"), F.col("groups") - F.col("start")).otherwise(F.lit(0))
    return plan.select("key", "action", "row_count", read.alias("groups_read"))
