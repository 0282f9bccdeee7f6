"""Streaming jobs. Each one can be stopped at any point and started again with the same folders.

Exactly-once comes from Spark's checkpoint plus output that is keyed by the batch number: a replayed batch overwrites
its own folder and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from lakegate.errors import IntakeError
from lakegate.functions.redact import redact_map
from lakegate.operators.bulk import prefix_ends
from lakegate.operators.digest import table_fingerprint
from lakegate.operators.health import FAILURE_THRESHOLD, health_log, retry_metrics
from lakegate.operators.transforms import Steps
from lakegate.session import materialised, remove_path, scratch_scope
from lakegate.sources.sinks import Published, materialize, write_fingerprinted

STAGED = "__staged_batch"  # partition of the staging folder
LEDGER_SCHEMA = f"{STAGED} bigint, row_count bigint, lane_0 string, lane_1 string, lane_2 string, lane_3 string"
PUBLISHED_SCHEMA = f"{STAGED} bigint, uri string"
STATE_STORE = {  # what keyed state with an expiry needs; with one, batches without data would follow each other for ever
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.noDataMicroBatches.enabled": "false",
}


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """New Parquet files below ``path`` as a stream."""
    reader = spark.readStream.schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _start(writer: DataStreamWriter, checkpoint: str) -> StreamingQuery:
    """Take what is there now, then stop: the batch-like run of a stream."""
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _rows_below(spark: SparkSession, folder: str, schema: T.StructType | str) -> DataFrame:
    """The Parquet rows below ``folder``; none if it is not there yet."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _ledger(checkpoint: str) -> str:
    return f"{checkpoint.rstrip('/')}-ledger"


def _dealt(batch: DataFrame) -> DataFrame:
    """The rows of a batch dealt out to all tasks: a batch may be one file, and that one row group, which one task reads.

    Adaptive execution leaves a small batch in one part.
    """
    place = "__place"
    return batch.withColumn(place, F.monotonically_increasing_id()).repartition(place).drop(place)


def sync_stream(stream: DataFrame, staging: str, checkpoint: str, steps: Steps | None = None) -> StreamingQuery:
    """Stage a resource batch by batch; an interrupted run goes on after the last finished batch.

    Every batch has an entry in a ledger beside the checkpoint: its number, its rows and the fingerprint lanes that were
    added up while it was written. Entries are only ever added. A batch that is staged again after a crash must be the one
    that its entry describes; a checkpoint that was started anew over an old ledger is refused at that point.
    """
    ledger = _ledger(checkpoint)

    def stage(batch: DataFrame, batch_id: int) -> None:
        shaped = steps(batch) if steps else batch
        if STAGED in shaped.columns:
            raise IntakeError(f"a column cannot be named {STAGED!r}")
        found = write_fingerprinted(_dealt(shaped), f"{staging}/{STAGED}={batch_id}")
        place = f"{ledger}/staged/{STAGED}={batch_id}"
        entry = T.StructType(T.StructType.fromDDL(LEDGER_SCHEMA).fields[1:])
        known = _rows_below(batch.sparkSession, place, entry).first()
        if known is None:
            batch.sparkSession.createDataFrame([found], entry).coalesce(1).write.mode("overwrite").parquet(place)
        elif tuple(known) != found:
            raise IntakeError(f"batch {batch_id} is in the ledger with other rows: it belongs to another run of the stream")

    return _start(stream.writeStream.foreachBatch(stage), checkpoint)


def _staged_faults(entries: DataFrame, found: DataFrame) -> DataFrame:
    """Batches whose rows in the staging folder are not those that the ledger has, and what is wrong with them."""
    lanes = [f"lane_{i}" for i in range(4)]
    both = entries.select(STAGED, F.struct("row_count", *lanes).alias("entry")).join(
        found.select(STAGED, F.struct("row_count", *lanes).alias("rows")), STAGED, "full"
    )
    fault = (
        F.when(F.col("entry").isNull(), F.lit("staged without an entry in the ledger"))
        .when(F.col("rows").isNull() & (F.col("entry.row_count") > 0), F.lit("lost from the staging folder"))
        .when(F.col("rows").isNotNull() & (F.col("entry") != F.col("rows")), F.lit("altered in the staging folder"))
    )
    return both.select(STAGED, fault.alias("fault")).where("fault IS NOT NULL")


def publish_staged(
    spark: SparkSession,
    staging: str,
    checkpoint: str,
    destination: str,
    identity: str,
    source_locator: str,
    manifest: str,
    schema: T.StructType | None = None,
) -> Published:
    """Publish everything staged as one artifact, with its manifest row, then remove the staged batches.

    The ledger beside the checkpoint says what must be there, however long ago it was staged: its entries have no gaps, and
    the rows and fingerprint of each staged batch are those of its entry; else the first wrong batch is named and nothing
    is published. Published batches are recorded in the ledger, so a batch that a restarted stream stages once more is not
    published twice. A stream that saw no files is published as a table without rows, with the columns of ``schema``.
    """
    ledger = _ledger(checkpoint)
    entries = _rows_below(spark, f"{ledger}/staged", LEDGER_SCHEMA)
    done = materialised(_rows_below(spark, f"{ledger}/published", PUBLISHED_SCHEMA).select(STAGED).distinct(), "published")
    count, last = entries.agg(F.count(F.lit(1)), F.max(STAGED)).first()
    if count and count != last + 1:
        numbers = spark.range(last + 1).withColumnRenamed("id", STAGED)
        missing = numbers.join(entries, STAGED, "left_anti").agg(F.min(STAGED)).first()[0]
        raise IntakeError(f"batch {missing} has no entry in the ledger")
    due = materialised(entries.join(done, STAGED, "left_anti"), "due")
    try:  # rows of damaged files are missing, and so noticed
        rows = spark.read.option("ignoreCorruptFiles", "true").parquet(staging)
    except AnalysisException as problem:
        if problem.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        rows = spark.createDataFrame([], f"{STAGED} bigint")
    found = table_fingerprint(rows.withColumn(STAGED, F.col(STAGED).cast("bigint")), [STAGED])
    wrong = _staged_faults(due, found.join(done, STAGED, "left_anti")).orderBy(STAGED).first()
    if wrong is not None:
        raise IntakeError(f"batch {wrong[STAGED]} is {wrong['fault']}")
    if due.isEmpty():
        if count:
            raise IntakeError("nothing was staged since the last publication")
        if schema is None:
            raise IntakeError("nothing was staged, and no schema says what an empty table looks like")
        return materialize(spark.createDataFrame([], schema), destination, identity, source_locator, manifest)
    staged = spark.read.parquet(staging)
    if not done.isEmpty():
        staged = staged.join(done, STAGED, "left_anti")
    published = materialize(staged.drop(STAGED), destination, identity, source_locator, manifest)
    due.select(STAGED, F.lit(published.uri).alias("uri")).write.mode("append").parquet(f"{ledger}/published")
    remove_path(spark, staging)
    return published


def event_metrics_stream(
    events: DataFrame,
    output: str,
    checkpoint: str,
    window: str = "1 hour",
    delay: str = "10 minutes",
    bounds: Sequence[float] = (),
) -> StreamingQuery:
    """Retry, breaker and budget metrics per window; a window is written once the watermark has passed it.

    State is one counter row per window, operation, platform and outcome, whatever the number of events.
    """
    windowed = events.withWatermark("ts", delay).withColumn("window", F.window("ts", window))
    metrics = retry_metrics(windowed, ["window", "operation_id", "platform", "outcome"], bounds)
    flat = metrics.select(F.col("window.start").alias("window_start"), "*").drop("window")
    return _start(flat.writeStream.format("parquet").option("path", output).outputMode("append"), checkpoint)


class _RunsBefore(StatefulProcessor):
    """What was known of a key before each batch; its state is one row (run, failures), with an expiry if one is given."""

    def __init__(self, keys: Sequence[str], expire_ms: int | None):
        self.keys, self.expire_ms = list(keys), expire_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.counts = handle.getValueState("counts", "run bigint, failures bigint", self.expire_ms)

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        run, failures = self.counts.get() or (0, 0)
        before = []
        for row in sorted(rows, key=lambda r: r["batch_id"]):  # one row for each batch of the key
            named = {k: row[k] for k in self.keys}
            before.append(Row(**named, batch_id=row["batch_id"], run=run, failure_count=failures))
            failures = row["failure_count"] + (failures if row["run"] == 0 else 0)
            run += row["run"]
        self.counts.update((run, failures))
        return iter(before)

    def close(self) -> None:
        pass


@contextmanager
def _settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session while a query starts, which keeps them."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def health_stream(
    events: DataFrame,
    output: str,
    state: str,
    checkpoint: str,
    keys: Sequence[str],
    order: Sequence[str],
    failure: Callable[[], Column],
    reset: Callable[[], Column],
    threshold: int = FAILURE_THRESHOLD,
    expire_ms: int | None = None,
) -> StreamingQuery:
    """Failure runs over a stream whose batches arrive in order.

    Two queries follow each other. The first runs the block-wise pass of the batch operator over each batch, so a key with
    most of the events does not end up in one task, and leaves one row per batch and key. The second carries (run,
    failures) over those rows in keyed state: one state row per key, changed only for the keys of the batch, and dropped
    ``expire_ms`` of processing time after its last change, when the key starts anew. It joins what was known before to
    the events of the batch and writes them to ``output``, in one folder per batch, so a replay repeats the same result.
    What the first query left in ``state`` goes when the second has committed it. NULL is a key like any other.
    """
    spark = events.sparkSession
    fields = {f.name: f.dataType for f in events.schema.fields}
    counts = [T.StructField("run", T.LongType()), T.StructField("failure_count", T.LongType())]
    number = T.StructField("batch_id", T.LongType())
    key_fields = [T.StructField(k, fields[k]) for k in keys]
    log_schema = T.StructType([*events.schema.fields, *counts, T.StructField("open", T.BooleanType()), number])

    def reduced(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(batch.sparkSession):
            log = health_log(batch, keys, order, failure(), reset(), threshold)
            log.write.mode("overwrite").parquet(f"{state}/events/batch_id={batch_id}")
        written = batch.sparkSession.read.schema(log.schema).parquet(f"{state}/events/batch_id={batch_id}")
        last = F.max_by(F.struct("run", "failure_count"), F.struct(*order))
        latest = written.groupBy(*keys).agg(last.alias("s")).select(*keys, "s.run", "s.failure_count")
        latest.write.mode("overwrite").parquet(f"{state}/keys/batch_id={batch_id}")

    def finished(before: DataFrame, batch_id: int) -> None:
        spark = before.sparkSession
        if batch_id:  # the batch ahead of this one is committed
            settled = spark.read.parquet(f"{state}/before/{batch_id - 1}").select("batch_id").distinct()
            for row in settled.collect():
                remove_path(spark, f"{state}/events/batch_id={row['batch_id']}")
                remove_path(spark, f"{state}/keys/batch_id={row['batch_id']}")
            if batch_id > 1:
                remove_path(spark, f"{state}/before/{batch_id - 2}")
        place = f"{state}/before/{batch_id}"
        before.write.mode("overwrite").parquet(place)
        names = {**{k: f"_c_{k}" for k in keys}, "batch_id": "_batch", "run": "_run", "failure_count": "_failures"}
        carried = spark.read.schema(before.schema).parquet(place).withColumnsRenamed(names)
        numbers = [r["_batch"] for r in carried.select("_batch").distinct().collect()]
        log = spark.read.schema(log_schema).parquet(f"{state}/events").where(F.col("batch_id").isin(numbers))
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_c_{k}")) for k in keys])
        count = F.col("failure_count") + F.when(F.col("run") == 0, F.coalesce("_failures", F.lit(0))).otherwise(0)
        full = log.join(carried, same & (F.col("batch_id") == F.col("_batch")), "left").select(
            *events.columns,
            (F.col("run") + F.coalesce("_run", F.lit(0))).alias("run"),
            count.alias("failure_count"),
            (count >= threshold).alias("open"),
            "batch_id",
        )
        writer = full.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("batch_id").parquet(output)

    _start(events.writeStream.foreachBatch(reduced), checkpoint).awaitTermination()
    per_key = T.StructType([*key_fields, *counts, number])
    nothing = spark.createDataFrame([], T.StructType([*key_fields, *counts]))
    nothing.write.mode("ignore").parquet(f"{state}/keys/batch_id=-1")  # a stream needs a folder to look into
    mode = "None" if expire_ms is None else "ProcessingTime"
    carried = (
        file_stream(spark, f"{state}/keys", per_key)
        .groupBy(*keys)
        .transformWithState(_RunsBefore(keys, expire_ms), T.StructType([*key_fields, number, *counts]), "Append", mode)
    )
    with _settings(spark, STATE_STORE):
        return _start(carried.writeStream.outputMode("append").foreachBatch(finished), f"{checkpoint}-keys")


def prefix_stream(receipts: DataFrame, output: str, state: str, checkpoint: str) -> StreamingQuery:
    """Release receipts in the order of their plans, whatever the order they arrive in.

    A receipt (``plan_id``, ``item_index``) goes to ``output`` once all indices of its plan from 0 up to its own have
    arrived; until then it waits in ``state``. After each batch ``output`` holds what the batch operator
    (``contiguous_prefix``) gives for all receipts so far, one folder per batch. A second receipt of a released index is
    released at once. Receipts without a plan or with an index that is NULL or negative can never be released, and go.

    State is the index that each plan has reached and the receipts behind a gap. Both are tables, joined to the batch on
    equal keys, so a plan with most of the receipts is no single task. A batch reads the state of the batch before it and
    writes its own; a replay repeats the same result. Lost state is an error.
    """

    def release(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        reached_schema = T.StructType([batch.schema["plan_id"], T.StructField("reached", T.LongType())])
        if batch_id:
            waiting = spark.read.schema(batch.schema).parquet(f"{state}/waiting/{batch_id - 1}")
            reached = spark.read.schema(reached_schema).parquet(f"{state}/reached/{batch_id - 1}")
        else:
            waiting, reached = spark.createDataFrame([], batch.schema), spark.createDataFrame([], reached_schema)
        with scratch_scope(spark):
            fresh = batch.where("plan_id IS NOT NULL AND item_index >= 0")
            rows = materialised(waiting.unionByName(fresh), "receipts")
            ahead = rows.join(reached, "plan_id", "left").select(
                "plan_id", (F.col("item_index") - F.coalesce("reached", F.lit(-1)) - 1).alias("item_index")
            )
            ends = prefix_ends(ahead.where("item_index >= 0"))
            now = reached.join(ends, "plan_id", "full").select(
                "plan_id",
                (F.coalesce("reached", F.lit(-1)) + 1 + F.coalesce("last_index", F.lit(-1))).cast("long").alias("reached"),
            )
            now.write.mode("overwrite").parquet(f"{state}/reached/{batch_id}")
            now = spark.read.schema(reached_schema).parquet(f"{state}/reached/{batch_id}")
            # Every plan with a receipt has a row by now.
            both = rows.join(now, "plan_id")
            due = F.col("item_index") <= F.col("reached")
            both.where(~due).select(*batch.columns).write.mode("overwrite").parquet(f"{state}/waiting/{batch_id}")
            both.where(due).select(*batch.columns).write.mode("overwrite").parquet(f"{output}/batch_id={batch_id}")
        if batch_id > 1:  # the batch ahead of this one is committed, so nothing goes back behind its state
            remove_path(spark, f"{state}/waiting/{batch_id - 2}")
            remove_path(spark, f"{state}/reached/{batch_id - 2}")

    return _start(receipts.writeStream.foreachBatch(release), checkpoint)


def redact_stream(events: DataFrame, column: str, output: str, checkpoint: str) -> StreamingQuery:
    """Mask a metadata map of every event on its way through; no state."""
    masked = events.withColumn(column, redact_map(column))
    return _start(masked.writeStream.format("parquet").option("path", output).outputMode("append"), checkpoint)
