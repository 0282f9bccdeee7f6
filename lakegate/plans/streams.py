"""Streaming plans: each runs a stream to completion over the tables and returns what it wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.operators.transforms import SelectColumns, compose
from lakegate.plans.governance import _SQL_BULK, _SQL_METRICS, _SQL_NULL_USERS, _SQL_RUNS, _receipts, metric_events
from lakegate.plans.registry import query, table
from lakegate.plans.texts import _SQL_PROPS
from lakegate.errors import IntakeError
from lakegate.session import materialised, remove_path, scratch_path
from lakegate.streaming import jobs


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    return jobs.file_stream(spark, folder, table(spark, folder, "events").schema, "events.parquet")


@query(
    "sync_stream",
    "SELECT o_orderstatus, count(*) AS row_count, count(DISTINCT o_orderkey) AS keys, sum(o_orderkey)::BIGINT AS key_sum FROM orders GROUP BY 1",
)
def sync_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Four files arrive in two runs of the same stream; every row is published exactly once."""
    base = scratch_path(spark, "sync")
    orders = table(spark, folder, "orders")
    steps = compose([SelectColumns(["o_orderkey", "o_orderstatus", "o_custkey"])])
    for run, half in enumerate(("o_orderkey % 2 = 0", "o_orderkey % 2 = 1")):
        orders.where(half).repartition(2).write.mode("append").parquet(f"{base}/in")
        stream = jobs.file_stream(spark, f"{base}/in", orders.schema, files_per_batch=1)
        jobs.sync_stream(stream, f"{base}/staged", f"{base}/checkpoint", steps).awaitTermination()
    published = jobs.publish_staged(
        spark, f"{base}/staged", f"{base}/checkpoint", f"{base}/out", "orders", f"{base}/in", f"{base}/manifest"
    )
    return spark.read.parquet(published.uri).groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("o_orderkey").alias("keys"), F.sum("o_orderkey").alias("key_sum")
    )


@query(
    "sync_stream_broken",
    """SELECT 'lost batch' AS kind, count(*) AS row_count, 'refused' AS outcome FROM orders
       UNION ALL SELECT 'no files', 0, 'o_orderkey bigint, batch_id int' FROM (SELECT 1)""",
)
def sync_stream_broken(spark: SparkSession, folder: str) -> DataFrame:
    """A staged batch gets lost: nothing is published, and staging again gives every row. No files: an empty table."""
    base = scratch_path(spark, "sync")
    orders = table(spark, folder, "orders").selectExpr("o_orderkey", "CAST(o_orderkey % 5 AS INT) AS batch_id")
    orders.repartition(3).write.parquet(f"{base}/in")
    where = (f"{base}/out", "orders", f"{base}/in", f"{base}/manifest")

    def staged(name: str) -> tuple[str, str]:
        stream = jobs.file_stream(spark, f"{base}/in", orders.schema, files_per_batch=1)
        jobs.sync_stream(stream, f"{base}/{name}", f"{base}/{name}-checkpoint").awaitTermination()
        return f"{base}/{name}", f"{base}/{name}-checkpoint"

    folders = staged("first")
    remove_path(spark, f"{folders[0]}/{jobs.STAGED}=1")
    try:
        jobs.publish_staged(spark, *folders, *where)
        outcome = "published"
    except IntakeError:
        outcome = "refused"
    whole = spark.read.parquet(jobs.publish_staged(spark, *staged("second"), *where).uri)
    none = jobs.publish_staged(spark, f"{base}/none", f"{base}/none-checkpoint", *where, schema=orders.schema)
    empty = spark.read.parquet(none.uri)
    described = ", ".join(f"{c} {t}" for c, t in empty.dtypes)
    counted = F.count(F.lit(1)).alias("row_count")
    return whole.agg(F.lit("lost batch").alias("kind"), counted, F.lit(outcome).alias("outcome")).union(
        empty.agg(F.lit("no files").alias("kind"), counted, F.lit(described).alias("outcome"))
    )


@query(
    "sync_stream_long",
    """SELECT 'batch 7 is altered in the staging folder' AS refused, count(*) AS row_count, sum(o_orderkey)::BIGINT AS key_sum,
              2::BIGINT AS published FROM orders""",
)
def sync_stream_long(spark: SparkSession, folder: str) -> DataFrame:
    """Twelve batches, of which the checkpoint keeps the last two: the ledger knows them all, and names an altered one.

    What is published once is not published again with the batches that come later.
    """
    base, kept = scratch_path(spark, "sync"), "spark.sql.streaming.minBatchesToRetain"
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    orders.where("o_orderkey % 7 <> 0").repartition(12).write.parquet(f"{base}/in")
    where = (f"{base}/out", "orders", f"{base}/in", f"{base}/manifest")
    folders = (f"{base}/staged", f"{base}/checkpoint")
    usual = spark.conf.get(kept)

    def run() -> None:
        stream = jobs.file_stream(spark, f"{base}/in", orders.schema, files_per_batch=1)
        jobs.sync_stream(stream, *folders).awaitTermination()

    try:
        spark.conf.set(kept, "2")
        run()
        batch = f"{folders[0]}/{jobs.STAGED}=7"
        rows = materialised(spark.read.parquet(batch), "batch")
        rows.withColumn("o_orderstatus", F.lower("o_orderstatus")).write.mode("overwrite").parquet(batch)
        try:
            jobs.publish_staged(spark, *folders, *where)
            refused = "nothing"
        except IntakeError as problem:
            refused = str(problem)
        rows.write.mode("overwrite").parquet(batch)
        uris = [jobs.publish_staged(spark, *folders, *where).uri]
        orders.where("o_orderkey % 7 = 0").repartition(2).write.mode("append").parquet(f"{base}/in")
        run()
        uris.append(jobs.publish_staged(spark, *folders, *where).uri)
    finally:
        spark.conf.set(kept, usual)
    whole = spark.read.parquet(*uris).agg(F.count(F.lit(1)).alias("row_count"), F.sum("o_orderkey").alias("key_sum"))
    published = spark.read.parquet(f"{base}/manifest").agg(F.count_distinct("uri").alias("published"))
    return whole.select(F.lit(refused).alias("refused"), "row_count", "key_sum", published.scalar().alias("published"))


@query(
    "event_metrics_stream",
    f"""WITH {_SQL_METRICS}, w AS (SELECT max(ts) - INTERVAL '10 minutes' AS mark FROM events)
        SELECT epoch_us(date_trunc('hour', ts)) AS window_start, operation_id, platform, outcome,
          coalesce(sum(retry_count) FILTER (retry_count > 0), 0)::BIGINT AS retries,
          count(*) FILTER (outcome = 'breaker_state_change') AS breaker_changes, count(*) FILTER (budget_usage >= 0) AS budget_samples,
          count(*) FILTER (budget_usage >= 0 AND budget_usage <= 5) AS budget_bucket_0, count(*) FILTER (budget_usage > 5) AS budget_bucket_1
        FROM m, w WHERE date_trunc('hour', ts) + INTERVAL '1 hour' <= mark GROUP BY ALL""",
)
def event_metrics_stream(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "metrics")
    events = metric_events(_event_stream(spark, folder).withColumn("ts", F.col("ts").cast("timestamp")))
    jobs.event_metrics_stream(events, f"{base}/out", f"{base}/checkpoint", bounds=[5.0]).awaitTermination()
    return spark.read.parquet(f"{base}/out").withColumn("window_start", F.unix_micros("window_start"))


@query(
    "health_stream",
    f"WITH {_SQL_RUNS.replace('FROM events', _SQL_NULL_USERS)} SELECT event_id, run::BIGINT AS run, failure_count::BIGINT AS failure_count, failure_count >= 3 AS open FROM c",
)
def health_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Events arrive in three runs, the earliest first, a third of them without a user; as the batch operator has it."""
    base = scratch_path(spark, "health")
    user = F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("user_id")
    events = table(spark, folder, "events").select(user, "ts", "event_id", "event_type")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    cuts = [first + (last - first) * third / 3 for third in (1, 2)]
    run = F.when(F.col("ts") < cuts[0], 0).when(F.col("ts") < cuts[1], 1).otherwise(2)
    for number in range(3):
        events.where(run == number).write.mode("append").parquet(f"{base}/in")
        jobs.health_stream(
            jobs.file_stream(spark, f"{base}/in", events.schema),
            f"{base}/out",
            f"{base}/state",
            f"{base}/checkpoint",
            ["user_id"],
            ["ts", "event_id"],
            lambda: F.col("event_type") == "error",
            lambda: F.col("event_type").isin("signup", "purchase"),
        ).awaitTermination()
    return spark.read.parquet(f"{base}/out").select("event_id", "run", "failure_count", "open")


_ARRIVAL = "CASE WHEN item_index % 50 = 49 THEN 2 WHEN item_index % 20 = 19 THEN 1 ELSE 0 END"


@query(
    "prefix_stream",
    f"""WITH {_SQL_BULK}, s AS (SELECT unnest([0, 1, 2]) AS stage),
             n AS (SELECT stage, r.*, row_number() OVER (PARTITION BY stage, plan_id ORDER BY item_index) - 1 AS rn
                   FROM receipts r, s WHERE {_ARRIVAL} <= stage)
        SELECT stage, plan_id, count(*) AS released, max(item_index)::BIGINT AS last_index,
               count(*) FILTER (outcome = 'failed') AS failed FROM n WHERE rn = item_index GROUP BY ALL""",
)
def prefix_stream(spark: SparkSession, folder: str) -> DataFrame:
    """Receipts arrive in three runs with gaps; after each run that is released which the batch operator releases."""
    base = scratch_path(spark, "prefix")
    receipts = _receipts(spark, folder)
    stages = []
    for stage in range(3):
        receipts.where(f"{_ARRIVAL} = {stage}").repartition(2).write.mode("append").parquet(f"{base}/in")
        stream = jobs.file_stream(spark, f"{base}/in", receipts.schema, files_per_batch=1)
        jobs.prefix_stream(stream, f"{base}/out", f"{base}/state", f"{base}/checkpoint").awaitTermination()
        stages.append(
            materialised(
                spark.read.parquet(f"{base}/out")
                .groupBy(F.lit(stage).alias("stage"), "plan_id")
                .agg(
                    F.count(F.lit(1)).alias("released"),
                    F.max("item_index").cast("long").alias("last_index"),
                    F.count_if(F.col("outcome") == "failed").alias("failed"),
                ),
                "stage",
            )
        )
    return stages[0].union(stages[1]).union(stages[2])


@query(
    "redact_stream",
    f"""SELECT event_id, 'k=' || k || ',' || CASE WHEN event_id % 2 = 0 THEN 'X-Auth-Token=***'
            WHEN event_id % 3 = 0 THEN 'note=basic ***' ELSE 'note=' || v END AS shown FROM ({_SQL_PROPS})""",
)
def redact_stream(spark: SparkSession, folder: str) -> DataFrame:
    base = scratch_path(spark, "redacted")
    key = F.col("event_id").cast("string")
    extra = F.create_map(
        F.when(F.col("event_id") % 2 == 0, F.lit("X-Auth-Token")).otherwise(F.lit("note")),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("basic abcdefgh"), key)).otherwise(key),
    )
    events = _event_stream(spark, folder).select(
        "event_id", F.map_concat(F.from_json("props", "map<string,string>"), extra).alias("props")
    )
    jobs.redact_stream(events, "props", f"{base}/out", f"{base}/checkpoint").awaitTermination()
    shown = F.array_join(F.transform(F.map_entries("props"), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return spark.read.parquet(f"{base}/out").select("event_id", shown.alias("shown"))
