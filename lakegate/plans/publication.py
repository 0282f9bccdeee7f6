"""Digests, publication and incremental-sync plans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.functions.base import case
from lakegate.functions.rules import sanitize_table_name
from lakegate.operators import reports, sync
from lakegate.operators.catalog import name_collisions as collisions
from lakegate.operators.catalog import resource_metadata as metadata
from lakegate.operators.digest import ordered_digest as digest_in_order
from lakegate.operators.digest import schema_fingerprint, text_digests
from lakegate.operators.digest import table_fingerprint as fingerprint
from lakegate.operators.digest import LANES, row_digest
from lakegate.operators.transforms import compose, Filter, SelectColumns
from lakegate.plans.intake import HEADLINE_STEPS
from lakegate.plans.registry import query, table
from lakegate.session import remove_path, scratch_path
from lakegate.sources import files, runs, sinks
from lakegate.sources.state import StateTable


def _sql_value(column: str) -> str:
    """``name`` is a number, ``name:text`` a text."""
    name, _, kind = column.partition(":")
    value = f"length({name}) || ':' || {name}" if kind == "text" else f"{name} || ';'"
    return f"CASE WHEN {name} IS NULL THEN 'N' ELSE 'V' || {value} END"


def _sql_row_digest(columns: list[str]) -> str:
    return f"sha256({' || '.join(_sql_value(c) for c in columns)})"


def _sql_lanes(digest: str) -> str:
    return ", ".join(
        f"CAST(coalesce(sum(('0x' || substr({digest}, {start}, 15))::HUGEINT), 0) AS VARCHAR) AS lane_{i}"
        for i, start in enumerate(LANES)
    )


@query(
    "table_fingerprint",
    f"""SELECT o_orderstatus, count(*) AS row_count, {_sql_lanes("h")} FROM
        (SELECT o_orderstatus, {_sql_row_digest(["o_orderkey", "o_custkey", "priority:text"])[:-1]} || 'Vi' || epoch_us(o_orderdate) || ';') AS h FROM
         (SELECT *, nullif(o_orderpriority, '5-LOW') AS priority FROM orders)) GROUP BY o_orderstatus""",
)
def table_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all partitions of a table in one aggregation (the lanes are what SQL can check)."""
    orders = table(spark, folder, "orders").select(
        "o_orderstatus",
        "o_orderkey",
        "o_custkey",
        F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority"),
        F.col("o_orderdate").cast("timestamp").alias("ordered"),
    )
    return fingerprint(orders, ["o_orderstatus"]).drop("content_digest")


_SQL_VARIANTS = f"""SELECT v AS variant, count(*) AS row_count, {_sql_lanes("h")} FROM
    (SELECT v, {_sql_row_digest(["o_orderkey", "o_custkey"])} AS h FROM
     (SELECT v, o_orderkey, o_custkey + CASE WHEN v = 'one cell' AND o_orderkey = top THEN 1 ELSE 0 END AS o_custkey
      FROM orders, (VALUES ('as it is'), ('one cell'), ('one row twice')) t(v), (SELECT max(o_orderkey) AS top FROM orders),
           range(2) r(copy) WHERE copy = 0 OR (v = 'one row twice' AND o_orderkey = top))) GROUP BY v"""


@query("fingerprint_detects", _SQL_VARIANTS)
def fingerprint_detects(spark: SparkSession, folder: str) -> DataFrame:
    """A table, the same with one cell changed, and with one row twice, all in another order: one grouped aggregation."""
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    last = F.col("o_orderkey") == orders.agg(F.max("o_orderkey")).scalar()
    variants = F.array(F.lit("as it is"), F.lit("one cell"), F.lit("one row twice"), F.when(last, F.lit("one row twice")))
    tagged = orders.select("*", F.explode(F.array_compact(variants)).alias("variant"))
    changed = F.when((F.col("variant") == "one cell") & last, F.col("o_custkey") + 1).otherwise(F.col("o_custkey"))
    shuffled = tagged.withColumn("o_custkey", changed).repartition("o_custkey")
    return fingerprint(shuffled, ["variant"]).drop("content_digest")


_FAN_IN = 512
_SQL_ORDERED = f"""WITH h AS (SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS i,
        sha256('Vt' || strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || ';'
               || {_sql_value('o_orderkey')} || {_sql_value('o_custkey')}) AS d FROM orders),
    l1 AS (SELECT i // {_FAN_IN} AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM h GROUP BY 1),
    l2 AS (SELECT i // {_FAN_IN} AS i, sha256(string_agg(d, '' ORDER BY i)) AS d FROM l1 GROUP BY 1)
    SELECT (SELECT count(*) FROM orders) AS row_count, d AS ordered_digest FROM l2"""


@query("ordered_digest", _SQL_ORDERED)
def ordered_digest(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_custkey")
    return digest_in_order(orders, ["o_orderdate", "o_orderkey"], fan_in=_FAN_IN)


@query("text_digests", "SELECT doc_id, sha256(text) AS sha256, md5(text) AS md5 FROM documents")
def document_digests(spark: SparkSession, folder: str) -> DataFrame:
    digests = text_digests(F.col("text"))
    return table(spark, folder, "documents").select("doc_id", *[c.alias(n) for n, c in digests.items()])


@query("file_digests", "SELECT count(*) AS row_count, true AS digest_matches, true AS version_matches FROM orders")
def file_digests(spark: SparkSession, folder: str) -> DataFrame:
    """Streamed digests of all tables' files against Spark's own over the same bytes.

    Spark's own need the bytes in one cell. A file of more than a piece is compared piece by piece: its digests are the
    streamed ones that were taken together with those of its pieces.
    """
    path = folder
    listed = files.list_files(spark, path)
    streamed = files.file_digests(listed, pieces=True).select("path", "sha256", "md5", "pieces")
    fits, own = F.col("length") <= files.PIECE, [F.sha2("content", 256), F.md5("content")]
    single = F.concat_ws(":", F.lit(0), "length", *own)
    direct = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).where(fits).select(
        "path", own[0].alias("want_sha"), own[1].alias("want_md5"), F.array(single).alias("want")
    )
    piece = F.struct("start", F.concat_ws(":", "start", F.length("content"), *own).alias("piece"))
    cut = files.file_pieces(listed.where(F.col("size") > files.PIECE)).select("path", piece.alias("p")).groupBy("path").agg(
        F.sort_array(F.collect_list("p"))["piece"].alias("want")
    )
    want = direct.unionByName(cut, allowMissingColumns=True)
    version = files.source_version(listed)
    same = (F.col("sha256") == F.col("want_sha")) & (F.col("md5") == F.col("want_md5"))
    checked = streamed.join(want, "path").join(version, "path").agg(
        F.bool_and((F.col("pieces") == F.col("want")) & (same | F.col("want_sha").isNull())).alias("digest_matches"),
        F.bool_and(F.col("source_version") == F.coalesce("want_sha", "sha256")).alias("version_matches"),
    )
    rows = table(spark, folder, "orders").agg(F.count(F.lit(1)).alias("row_count"))
    found = checked.select(F.struct("*")).scalar()  # one subquery, so that the files are read for both together
    return rows.select("*", *[found[name].alias(name) for name in checked.columns])


@query(
    "verify_checksums",
    """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'unexpected file'
            WHEN l.doc_id % 5 = 0 THEN 'mismatch' ELSE 'ok' END AS status
       FROM documents d LEFT JOIN labels l USING (doc_id)""",
)
def verify_checksums(spark: SparkSession, folder: str) -> DataFrame:
    """Document digests against an expectation list covering the labelled ones, some of it wrong, in upper case."""
    documents = table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    labelled = table(spark, folder, "labels").select("doc_id")
    expected = documents.join(labelled, "doc_id", "left_semi").select(
        "doc_id",
        F.when(F.col("doc_id") % 5 == 0, F.reverse("digest")).otherwise(F.upper("digest")).alias("digest"),
    )
    return sync.verify_checksums(documents, expected, "doc_id")


@query(
    "orphan_files",
    """SELECT DISTINCT sha256(text) AS digest FROM documents
       WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents JOIN labels USING (doc_id))""",
)
def orphan_files(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    indexed = documents.join(table(spark, folder, "labels").select("doc_id"), "doc_id", "left_semi")
    return sync.orphan_files(documents, indexed)


@query(
    "largest_member",
    """SELECT source, first(doc_id ORDER BY n_chars DESC, doc_id DESC) AS member, max(n_chars) AS size FROM documents GROUP BY source""",
)
def largest_member(spark: SparkSession, folder: str) -> DataFrame:
    members = table(spark, folder, "documents").select("source", F.col("doc_id").alias("member"), F.col("n_chars").alias("size"))
    return files.largest_member(members, "source")


@query(
    "duplicate_identities",
    """WITH r AS (SELECT lower(regexp_extract(url, '^(https?://[^/]*)', 1)) || '/' || (page_id % 3) AS scope, page_id % 3 AS id FROM pages)
       SELECT sha256(scope) AS identity, CAST(id AS VARCHAR) AS id, count(*) AS copies, count(*) AS claims, 1::BIGINT AS ids
       FROM r GROUP BY scope, id HAVING count(*) > 1""",
)
def duplicate_identities(spark: SparkSession, folder: str) -> DataFrame:
    from lakegate.functions.urls import canonical_identity

    short = (F.col("page_id") % 3).cast("string")
    resources = table(spark, folder, "pages").select(
        short.alias("id"), canonical_identity(short, "url", F.lit(None).cast("string")).alias("identity")
    )
    return sync.duplicate_identities(resources)


@query(
    "name_collisions",
    """WITH n AS (SELECT p_name AS id, lower(regexp_replace(CASE WHEN p_partkey % 50 = 0 THEN 'Resources' ELSE replace(p_name, ' ', '-') END, '[^A-Za-z0-9_]', '_', 'g')) AS t,
               CASE WHEN p_partkey % 50 = 0 THEN 'Resources' ELSE replace(p_name, ' ', '-') END AS raw FROM part)
       SELECT t AS table_name, count(*) AS claims, min(raw) AS first_id, max(raw) AS last_id, t = 'resources' AS reserved
       FROM n GROUP BY t HAVING count(*) > 1 OR t = 'resources'""",
)
def name_collisions(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 50 == 0, F.lit("Resources")).otherwise(F.replace("p_name", F.lit(" "), F.lit("-")))
    return collisions(table(spark, folder, "part").select(raw.alias("id")), "id")


@query(
    "resource_metadata",
    """SELECT CAST(page_id AS VARCHAR) AS id, regexp_extract(url, '^https?://([^/]*)', 1) AS dataset_id,
              '_' || page_id AS name, url FROM pages""",
)
def resource_metadata(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages")
    return metadata(
        pages.select(
            F.col("page_id").cast("string").alias("id"),
            F.regexp_extract("url", "^https?://([^/]*)", 1).alias("dataset_id"),
            sanitize_table_name(F.col("page_id").cast("string")).alias("name"),
            "url",
            "html",
        )
    )


@query(
    "materialize",
    """SELECT count(*) AS row_count, 'Filter>SelectColumns>RenameColumns>NormalizeTimestamps>CastSchema' AS transforms,
              'https://data.example.org/orders.parquet?token=***' AS source_locator, 'parquet' AS mode, true AS healthy
       FROM orders WHERE o_totalprice > 100000""",
)
def materialize(spark: SparkSession, folder: str) -> DataFrame:
    """Clean, publish and verify; the manifest row with its provenance comes back."""
    target = scratch_path(spark, "published")
    published = sinks.materialize(
        table(spark, folder, "orders"),
        target,
        "orders",
        "https://user:pw@data.example.org/orders.parquet?token=abc",
        f"{target}/_manifest",
        HEADLINE_STEPS,
    )
    healthy = sinks.is_healthy(spark, published.uri, published.content_digest)
    return sinks.latest_artifacts(spark, f"{target}/_manifest").select(
        "row_count",
        F.array_join("transforms", ">").alias("transforms"),
        "source_locator",
        "mode",
        F.lit(healthy).alias("healthy"),
    )


@query(
    "materialize_unchanged",
    """SELECT 1 AS run, count(*) AS row_count, true AS written FROM lineitem WHERE l_quantity > 25
       UNION ALL SELECT 2, count(*), false FROM lineitem WHERE l_quantity > 25
       UNION ALL SELECT 3, count(*), true FROM lineitem WHERE l_quantity > 30""",
)
def materialize_unchanged(spark: SparkSession, folder: str) -> DataFrame:
    """Three runs: the second finds its content already published and writes nothing."""
    target, lines = scratch_path(spark, "published"), table(spark, folder, "lineitem")

    def steps(bound: int):
        return compose([Filter(f"l_quantity > {bound}"), SelectColumns(["l_orderkey", "l_linenumber", "l_partkey"])])

    runs, stored = [], None
    for bound in (25, 25, 30):
        stored = sinks.materialize(lines, target, "lines", "file:///lines", f"{target}/_manifest", steps(bound), stored)
        runs.append(stored)
    rows = table(spark, folder, "region").limit(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(i + 1).alias("run"),
                        F.lit(r.row_count).cast("bigint").alias("row_count"),
                        F.lit(r.written).alias("written"),
                    )
                    for i, r in enumerate(runs)
                ]
            )
        )
    )
    return rows


@query(
    "sync_run",
    """WITH r AS (SELECT l_shipdate, l_orderkey, l_suppkey % 20 AS resource FROM lineitem)
       SELECT 1 AS run, 'written' AS action, count(DISTINCT resource) AS resources, count(*) AS row_count FROM r
       UNION ALL SELECT 2, 'unchanged', count(DISTINCT resource), count(*) FROM r
       UNION ALL SELECT 3, CASE WHEN resource % 7 = 3 THEN 'written' ELSE 'unchanged' END, count(DISTINCT resource), count(*) FROM r GROUP BY 2
       UNION ALL SELECT 4, 'published', count(DISTINCT resource), count(*) FROM r""",
)
def sync_run(spark: SparkSession, folder: str) -> DataFrame:
    """Twenty resources: a first run writes all, a second none, a third those that changed; what is published is whole."""
    base = scratch_path(spark, "run")
    lines = table(spark, folder, "lineitem").select((F.col("l_suppkey") % 20).alias("resource_no"), "l_orderkey", "l_linenumber", "l_quantity")
    changed = lines.withColumn(
        "l_quantity", F.when(F.col("resource_no") % 7 == 3, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    )
    state = StateTable(spark, f"{base}/state", T.StructType.fromDDL(runs.STATE_SCHEMA))
    parts = []
    for number, rows in enumerate((lines, lines, changed), 1):
        done = runs.sync_run(rows, "resource_no", f"{base}/out", f"{base}/manifest", state, "file:///lines")
        parts.append(
            done.groupBy(F.lit(number).alias("run"), "action").agg(
                F.count(F.lit(1)).alias("resources"), F.sum("row_count").alias("row_count")
            )
        )
    newest = sinks.latest_artifacts(spark, f"{base}/manifest")
    whole = newest.agg(F.count(F.lit(1)).alias("resources"), F.sum("row_count").alias("row_count"))
    parts.append(whole.select(F.lit(4).alias("run"), F.lit("published").alias("action"), "resources", "row_count"))
    return parts[0].union(parts[1]).union(parts[2]).union(parts[3])


_ODD_KEYS = ("a/b", "p:q", "50%", "a=b", "..", "x y", "é", "r 8")


@query(
    "sync_run_repair",
    """WITH r AS (SELECT l_suppkey % 8 AS resource FROM lineitem)
       SELECT 1 AS run, 'written' AS action, count(DISTINCT resource) AS resources, count(*) AS row_count FROM r
       UNION ALL SELECT 2, CASE WHEN resource IN (0, 2) THEN 'written' ELSE 'unchanged' END, count(DISTINCT resource), count(*) FROM r GROUP BY 2
       UNION ALL SELECT 3, 'resumed', count(DISTINCT resource), count(*) FROM r
       UNION ALL SELECT 4, 'opened', count(DISTINCT resource), count(*) FROM r
       UNION ALL SELECT 5, 'decoded', count(DISTINCT resource), count(*) FROM r""",
)
def sync_run_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Resources with odd keys. One artifact gets lost and one damaged: the next run writes these two and no other; one
    that resumes leaves changed content alone. Every manifest row can be opened, and survives as an envelope."""
    base = scratch_path(spark, "run")
    name = F.element_at(F.array(*[F.lit(k) for k in _ODD_KEYS]), (F.col("l_suppkey") % 8 + 1).cast("int"))
    lines = table(spark, folder, "lineitem").select(name.alias("resource"), "l_orderkey", "l_linenumber", "l_quantity")
    state = StateTable(spark, f"{base}/state", T.StructType.fromDDL(runs.STATE_SCHEMA))
    parts = []

    def run(rows: DataFrame, resume: bool = False) -> None:
        done = runs.sync_run(rows, "resource", f"{base}/out", f"{base}/manifest", state, "file:///lines", resume)
        total = [F.count(F.lit(1)).alias("resources"), F.sum("row_count").alias("row_count")]
        parts.append(done.groupBy(F.lit(len(parts) + 1).alias("run"), "action").agg(*total))

    run(lines)
    newest = sinks.latest_artifacts(spark, f"{base}/manifest").where(F.col("resource_identity").isin("a/b", "50%"))
    lost, damaged = (r["uri"] for r in newest.orderBy(F.desc("resource_identity")).collect())
    remove_path(spark, lost)
    spark.read.parquet(damaged).limit(1).write.mode("append").parquet(damaged)
    run(lines)
    run(lines.withColumn("l_quantity", F.col("l_quantity") + 1), resume=True)
    newest = sinks.latest_artifacts(spark, f"{base}/manifest")
    opened = spark.read.parquet(*[r["uri"] for r in newest.select("uri").collect()])
    decoded, _ = sinks.decode_manifest(sinks.encode_manifest(newest), "document")
    named = decoded.join(newest.select("uri", "row_count"), "uri")
    parts.append(opened.agg(F.lit(4).alias("run"), F.lit("opened").alias("action"), F.count_distinct("resource"), F.count(F.lit(1))))
    parts.append(named.agg(F.lit(5).alias("run"), F.lit("decoded").alias("action"), F.count(F.lit(1)), F.sum("row_count")))
    return reduce(DataFrame.union, parts)


class _Interrupted(StateTable):
    """A state that lets some swaps through and then breaks off, as if the driver had died."""

    def swap(self, rows: DataFrame, expected: int) -> int:
        if expected == 1:
            raise ConnectionError("the driver is gone")
        return super().swap(rows, expected)


@query(
    "resume_run",
    """SELECT CAST(l_linenumber % 3 AS VARCHAR) AS key, 'resumed' AS action, count(*) AS row_count, true AS rest_only,
              sum(l_orderkey)::BIGINT AS key_sum, count(DISTINCT (l_orderkey, l_linenumber)) AS keys FROM lineitem GROUP BY 1""",
)
def resume_run(spark: SparkSession, folder: str) -> DataFrame:
    """A run over three Parquet resources breaks off behind its first wave of row groups; the next one reads the rest."""
    base = scratch_path(spark, "resume")
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    for key in range(3):
        part = lines.where(F.col("l_linenumber") % 3 == key).repartition(2)
        part.write.option("parquet.block.size", 64 * 1024).parquet(f"{base}/in/{key}")
    where = (f"{base}/in", f"{base}/staged", f"{base}/out", f"{base}/manifest")
    schema = T.StructType.fromDDL(runs.STATE_SCHEMA)
    try:
        runs.resume_run(spark, *where, _Interrupted(spark, f"{base}/state", schema), lines.schema, groups_at_once=2)
    except ConnectionError:
        pass
    state = StateTable(spark, f"{base}/state", schema)
    done = runs.resume_run(spark, *where, state, lines.schema, groups_at_once=2)
    groups = runs.parquet_resources(spark, f"{base}/in")[0].select("key", "groups")
    newest = sinks.latest_artifacts(spark, f"{base}/manifest")
    rows = spark.read.parquet(*[r["uri"] for r in newest.select("uri").collect()])
    found = rows.groupBy((F.col("l_linenumber") % 3).cast("string").alias("key")).agg(
        F.sum("l_orderkey").alias("key_sum"), F.count_distinct("l_orderkey", "l_linenumber").alias("keys")
    )
    rest = F.col("groups_read") == F.col("groups") - F.least(F.col("groups"), F.lit(2))
    return done.join(groups, "key").join(found, "key").select("key", "action", "row_count", rest.alias("rest_only"), "key_sum", "keys")


# --- sync state, derived from orders and customers -------------------------------------------------------------------


def _state(spark: SparkSession, folder: str) -> DataFrame:
    """State of two thirds of the customers: some open checkpoints, some completed."""
    key = F.col("c_custkey")
    k = key.cast("string")
    is_open = key % 5 == 0
    return table(spark, folder, "customer").where("c_custkey % 3 <> 0").select(
        k.alias("key"),
        F.when(~is_open, F.sha2(F.concat(F.lit("c"), k), 256)).alias("watermark"),
        F.when(is_open, F.lit("in_progress")).otherwise(F.lit("completed")).alias("status"),
        F.when(is_open, F.sha2(F.concat(F.lit("v"), k), 256)).alias("source_version"),
        F.when(is_open, F.sha2(F.lit("dest"), 256)).alias("destination_identity"),
        F.when(is_open, key % 7).alias("next_batch_index"),
        F.when(is_open, key % 7).alias("row_group_index"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("last_synced_at"),
        F.sha2(F.concat(F.lit("s"), k), 256).alias("version"),
    )


_SQL_SYNC = """WITH r AS (SELECT c_custkey AS c, CASE c_custkey % 11 WHEN 0 THEN 'query' WHEN 1 THEN 'stream' WHEN 2 THEN 'http_download'
            WHEN 3 THEN 'object_storage' ELSE 'local_file' END AS kind, c_custkey % 2 = 0 AS parquet,
            c_custkey % 13 = 0 AS source_changed, c_custkey % 17 = 0 AS content_changed, c_custkey % 4 = 0 AS not_modified,
            c_custkey % 3 <> 0 AS has_state, c_custkey % 3 <> 0 AND c_custkey % 5 = 0 AS open,
            c_custkey % 3 <> 0 AND c_custkey % 5 <> 0 AS completed, c_custkey % 7 <> 0 AS is_healthy FROM customer),
   s AS (SELECT *, parquet AND kind IN ('local_file', 'object_storage') AS pq FROM r),
   t AS (SELECT *, open AND NOT (pq AND source_changed) AS usable, completed AND is_healthy AS healthy FROM s),
   v AS (SELECT *, pq AND (usable OR NOT completed OR NOT healthy) AS ck FROM t)"""


def _sql_action(resume: bool) -> str:
    resumed = "WHEN completed AND healthy THEN 'resumed'" if resume else ""
    partial = "WHEN ck AND usable THEN 'resumed'" if resume else ""
    return f"""CASE WHEN kind IN ('query', 'stream') THEN 'skipped-unsupported' {resumed}
        WHEN kind = 'http_download' AND NOT completed AND not_modified AND healthy THEN 'skipped-unchanged' {partial}
        WHEN ck THEN 'materialized'
        WHEN completed AND NOT content_changed AND healthy THEN 'skipped-unchanged' ELSE 'materialized' END"""


def _sync_inputs(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    key = F.col("c_custkey")
    k = key.cast("string")
    kind = key % 11
    customers = table(spark, folder, "customer")
    resources = customers.select(
        k.alias("key"),
        case(
            [
                (kind == 0, F.lit("query")),
                (kind == 1, F.lit("stream")),
                (kind == 2, F.lit("http_download")),
                (kind == 3, F.lit("object_storage")),
            ],
            F.lit("local_file"),
        ).alias("access_kind"),
        F.when(key % 2 == 0, F.lit("parquet")).otherwise(F.lit("CSV")).alias("format"),
        F.sha2(F.concat(F.when(key % 13 == 0, F.lit("w")).otherwise(F.lit("v")), k), 256).alias("live_version"),
        F.sha2(F.lit("dest"), 256).alias("live_destination"),
        F.sha2(F.concat(F.when(key % 17 == 0, F.lit("d")).otherwise(F.lit("c")), k), 256).alias("content_digest"),
        F.when(key % 4 == 0, F.lit(304)).alias("response_status"),
        F.lit(None).cast("string").alias("fresh_watermark"),
    )
    health = customers.where("c_custkey % 3 <> 0 AND c_custkey % 5 <> 0").select(
        k.alias("key"), (key % 7 != 0).alias("healthy")
    )
    return resources, _state(spark, folder), health


@query(
    "sync_plan",
    f"""{_SQL_SYNC} SELECT CAST(c AS VARCHAR) AS key, {_sql_action(True)} AS action, ck AS checkpointed,
        open AND NOT usable AS checkpoint_dropped FROM v""",
)
def sync_plan(spark: SparkSession, folder: str) -> DataFrame:
    resources, state, health = _sync_inputs(spark, folder)
    return sync.sync_plan(resources, state, health).select("key", "action", "checkpointed", "checkpoint_dropped")


@query(
    "sync_plan_restart",
    f"{_SQL_SYNC} SELECT action, count(*) AS resources FROM (SELECT {_sql_action(False)} AS action FROM v) GROUP BY action",
)
def sync_plan_restart(spark: SparkSession, folder: str) -> DataFrame:
    """The same without resuming, as totals per action."""
    resources, state, health = _sync_inputs(spark, folder)
    return sync.sync_plan(resources, state, health, resume=False).groupBy("action").agg(
        F.count(F.lit(1)).alias("resources")
    )


@query(
    "destination_health",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, o_orderkey % 11 <> 1 AS uri_ok, e AS exists, e AND o_orderkey % 7 <> 2 AS size_ok,
              e AND o_orderkey % 13 <> 3 AS content_ok, o_orderkey % 2 = 0 OR (e AND o_orderkey % 17 <> 4) AS blob_ok,
              o_orderkey % 11 <> 1 AND e AND o_orderkey % 7 <> 2 AND o_orderkey % 13 <> 3
                AND (o_orderkey % 2 = 0 OR o_orderkey % 17 <> 4) AS healthy
       FROM (SELECT o_orderkey, o_orderkey % 5 <> 0 AS e FROM orders)""",
)
def destination_health(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    k = key.cast("string")
    uri = F.concat(F.lit("s3://out/"), k, F.lit(".parquet"))
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    artifacts = orders.select(
        k.alias("key"),
        uri.alias("uri"),
        F.when(key % 11 == 1, F.lit("s3://other")).otherwise(uri).alias("expected_uri"),
        F.col("o_custkey").alias("size"),
        F.md5(k).alias("content_digest"),
        F.when(key % 2 == 1, F.sha1(k)).alias("blob_digest"),
    )
    listing = orders.where("o_orderkey % 5 <> 0").select(
        uri.alias("uri"),
        (F.col("o_custkey") + F.when(key % 7 == 2, 1).otherwise(0)).alias("size"),
        F.when(key % 13 == 3, F.lit("x")).otherwise(F.md5(k)).alias("content_digest"),
        F.when(key % 17 == 4, F.lit("x")).otherwise(F.sha1(k)).alias("blob_digest"),
    )
    return sync.destination_health(artifacts, listing)


_PROPOSALS = """p AS (SELECT c_custkey AS c, n AS ord, n = 1 AND c_custkey % 10 = 0 AS deleted,
        CASE WHEN c_custkey % 4 = 0 THEN sha256('stale') WHEN c_custkey % 3 <> 0 THEN sha256('s' || c_custkey) END AS expected
        FROM customer, (VALUES (1), (2)) v(n) WHERE n = 1 OR c_custkey % 6 = 1),
    j AS (SELECT *, (expected IS NOT DISTINCT FROM CASE WHEN c % 3 <> 0 THEN sha256('s' || c) END) AS ok FROM p)"""


def _proposals(spark: SparkSession, folder: str) -> DataFrame:
    """One or two proposals per customer; some expect a stale version, some delete."""
    key, k = F.col("c_custkey"), F.col("c_custkey").cast("string")
    expected = F.when(key % 4 == 0, F.sha2(F.lit("stale"), 256)).when(key % 3 != 0, F.sha2(F.concat(F.lit("s"), k), 256))
    rows = table(spark, folder, "customer").select(
        "c_custkey", F.explode(F.array(F.lit(1), F.lit(2))).alias("order")
    ).where("order = 1 OR c_custkey % 6 = 1")
    return rows.select(
        k.alias("key"),
        F.sha2(F.concat(F.lit("n"), k, F.col("order")), 256).alias("watermark"),
        F.lit("completed").alias("status"),
        F.lit(None).cast("string").alias("source_version"),
        F.lit(None).cast("string").alias("destination_identity"),
        F.lit(None).cast("bigint").alias("next_batch_index"),
        F.lit(None).cast("bigint").alias("row_group_index"),
        F.lit("2024-02-01 00:00:00").cast("timestamp").alias("last_synced_at"),
        F.sha2(F.concat(F.lit("v"), k, F.col("order")), 256).alias("version"),
        expected.alias("expected"),
        "order",
        ((F.col("order") == 1) & (key % 10 == 0)).alias("deleted"),
    )


@query(
    "conditional_merge",
    f"""WITH {_PROPOSALS} SELECT CAST(c AS VARCHAR) AS key, sha256('v' || c || '1') AS version FROM j WHERE ok AND ord = 1 AND NOT deleted
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), sha256('s' || c_custkey) FROM customer
        WHERE c_custkey % 3 <> 0 AND c_custkey NOT IN (SELECT c FROM j WHERE ok)""",
)
def conditional_merge(spark: SparkSession, folder: str) -> DataFrame:
    state, _ = sync.conditional_merge(_state(spark, folder), _proposals(spark, folder))
    return state.select("key", "version")


@query(
    "merge_outcomes",
    f"WITH {_PROPOSALS} SELECT CAST(c AS VARCHAR) AS key, ord AS \"order\", CASE WHEN ok AND ord = 1 THEN 'committed' ELSE 'conflict' END AS outcome FROM j",
)
def merge_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    _, outcomes = sync.conditional_merge(_state(spark, folder), _proposals(spark, folder))
    return outcomes


@query(
    "mirror_state",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, CASE WHEN c_custkey % 4 = 0 AND c_custkey % 7 = 1 THEN 'zzz'
              WHEN c_custkey % 4 = 0 THEN CASE WHEN c_custkey % 5 <> 0 THEN sha256('c' || c_custkey) END
              ELSE '"etag-' || c_custkey || '"' END AS watermark
       FROM customer WHERE c_custkey % 4 <> 0 OR c_custkey % 3 <> 0 OR c_custkey % 7 = 1""",
)
def mirror_state(spark: SparkSession, folder: str) -> DataFrame:
    """Committed watermarks copied into the state; blank ones leave it as it is, of two for one key the first counts."""
    state, k = _state(spark, folder), F.col("c_custkey").cast("string")
    etag = F.concat(F.lit('"etag-'), k, F.lit('"'))
    committed = table(spark, folder, "customer").select(
        k.alias("identity"), F.when(F.col("c_custkey") % 4 == 0, F.lit("")).otherwise(etag).alias("watermark")
    )
    later = committed.where("CAST(identity AS BIGINT) % 7 = 1").select("identity", F.lit("zzz").alias("watermark"))
    committed = committed.union(later).union(committed.where("CAST(identity AS BIGINT) % 2 = 1"))
    proposals = sync.mirror_proposals(committed, state, F.lit("2024-03-01 00:00:00").cast("timestamp"))
    merged, _ = sync.conditional_merge(state, proposals)
    return merged.select("key", "watermark")


@query(
    "state_violations",
    """WITH s AS (SELECT c_custkey AS c, c_custkey % 5 = 0 AS open FROM customer WHERE c_custkey % 3 <> 0)
       SELECT CAST(c AS VARCHAR) AS key, 'watermark' AS rule FROM s WHERE c % 8 = 0
       UNION ALL SELECT CAST(c AS VARCHAR), 'completed needs a watermark' FROM s WHERE NOT open AND c % 8 = 1
       UNION ALL SELECT CAST(c AS VARCHAR), 'status' FROM s WHERE c % 9 = 2
       UNION ALL SELECT CAST(c AS VARCHAR), 'completed needs a watermark' FROM s WHERE open AND c % 9 = 2 AND c % 8 NOT IN (0)
       UNION ALL SELECT CAST(c AS VARCHAR), 'checkpoint position' FROM s WHERE open AND c % 9 <> 2 AND c % 7 = 3""",
)
def state_violations(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("key").cast("bigint")
    broken = _state(spark, folder).select(
        "key",
        case([(key % 8 == 0, F.lit("bearer abc")), (key % 8 == 1, F.lit(None).cast("string"))], F.col("watermark")).alias("watermark"),
        F.when(key % 9 == 2, F.lit("done")).otherwise(F.col("status")).alias("status"),
        "source_version",
        "destination_identity",
        F.when(key % 7 == 3, F.lit(-1)).otherwise(F.col("next_batch_index")).alias("next_batch_index"),
        "row_group_index",
        "last_synced_at",
        "version",
    )
    return sync.state_violations(broken)


@query(
    "upgrade_state",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, CASE c_custkey % 4 WHEN 3 THEN 'completed' ELSE 'in_progress' END AS status,
              CASE WHEN c_custkey % 4 IN (1, 2) THEN sha256('v' || c_custkey) END AS source_version,
              CASE WHEN c_custkey % 4 IN (2, 3) THEN sha256('dest') END AS destination_identity,
              CASE WHEN c_custkey % 4 < 3 THEN c_custkey % 7 END AS next_batch_index
       FROM customer WHERE c_custkey % 10 <> 0 OR c_custkey % 4 <> 0""",
)
def upgrade_state(spark: SparkSession, folder: str) -> DataFrame:
    """Old rows of every version in one layout; rows whose old position contradicts itself are left out."""
    key, k = F.col("c_custkey"), F.col("c_custkey").cast("string")
    kind = (key % 4).cast("int")
    group = F.when(key % 10 == 0, key % 7 + 1).otherwise(key % 7)
    position = F.struct(F.lit("parquet_row_group").alias("kind"), group.alias("row_group_index"))
    base = [F.lit("in_progress").alias("status"), (key % 7).alias("next_batch_index"), position.alias("position")]
    version = F.sha2(F.concat(F.lit("v"), k), 256).alias("source_version")
    target = F.sha2(F.lit("dest"), 256).alias("destination_identity")
    documents = [
        F.struct(F.struct(F.lit(1).alias("version"), *base).alias("checkpoint")),
        F.struct(F.struct(F.lit(2).alias("version"), *base, version).alias("checkpoint")),
        F.struct(F.struct(F.lit(3).alias("version"), *base, version, target).alias("checkpoint")),
        F.struct(
            F.struct(
                target, (key * 10).alias("destination_size"), F.sha2(k, 256).alias("destination_checksum")
            ).alias("artifact")
        ),
    ]
    cursor = F.struct(F.lit("w1").alias("schema"), F.sha2(k, 256).alias("watermark")).alias("cursor")
    synced = F.lit("2024-01-01T00:00:00Z").alias("last_synced_at")
    old = table(spark, folder, "customer").select(
        k.alias("key"),
        case(
            [(kind == i, F.to_json(F.struct(cursor, d.alias("extra"), synced))) for i, d in enumerate(documents)]
        ).alias("document"),
    )
    good, _ = sync.upgrade_state(old, "checkpoint", "artifact", "dest")
    return good.select("key", "status", "source_version", "destination_identity", "next_batch_index")


@query(
    "upgrade_state_rejects",
    """SELECT CAST(c_custkey AS VARCHAR) AS key, CASE c_custkey % 5 WHEN 1 THEN 'last synced' WHEN 2 THEN 'last synced' WHEN 3 THEN 'partitions'
              ELSE 'watermark' END AS reject_reason FROM customer WHERE c_custkey % 5 <> 0""",
)
def upgrade_state_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Completed rows with an unreadable time, a time without zone, partitions, or no watermark."""
    kind, k = F.col("c_custkey") % 5, F.col("c_custkey").cast("string")
    synced = case(
        [(kind == 1, F.lit("not a time")), (kind == 2, F.lit("2024-01-01T00:00:00"))], F.lit("2024-01-01T00:00:00+02:00")
    )
    document = F.to_json(
        F.struct(
            F.struct(F.lit("w1").alias("schema"), F.when(kind != 4, F.sha2(k, 256)).alias("watermark")).alias("cursor"),
            synced.alias("last_synced_at"),
            F.when(kind == 3, F.array(k)).otherwise(F.array().cast("array<string>")).alias("partitions"),
        )
    )
    old = table(spark, folder, "customer").select(k.alias("key"), document.alias("document"))
    _, bad = sync.upgrade_state(old, "checkpoint", "artifact", "dest")
    return bad.select("key", "reject_reason")


@query(
    "load_replace",
    """SELECT c_mktsegment AS segment, count(*) AS row_count, sum(c_custkey)::BIGINT AS key_sum FROM customer WHERE c_custkey % 2 = 0 GROUP BY ALL
       UNION ALL SELECT 'view', count(*), sum(o_orderkey)::BIGINT FROM orders""",
)
def load_replace(spark: SparkSession, folder: str) -> DataFrame:
    """A table that is loaded twice holds the second load; a view under a checked name is open to SQL."""
    path = scratch_path(spark, "loads")
    database = f"loads_{path[-8:]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{path}'")
    customers = table(spark, folder, "customer").select("c_custkey", "c_mktsegment")
    sinks.load_replace({"_1_customers": customers}, database)
    sinks.load_replace({"_1_customers": customers.where("c_custkey % 2 = 0")}, database)
    sinks.register_view(table(spark, folder, "orders"), f"orders_{database}")
    counted = [F.count(F.lit(1)).alias("row_count")]
    loaded = spark.table(f"{database}._1_customers").groupBy(F.col("c_mktsegment").alias("segment"))
    seen = spark.sql(f"SELECT o_orderkey FROM orders_{database}")
    return loaded.agg(*counted, F.sum("c_custkey").alias("key_sum")).union(
        seen.agg(F.lit("view").alias("segment"), *counted, F.sum("o_orderkey").alias("key_sum"))
    )


@query(
    "cache_sweep",
    """WITH e AS (SELECT sha256(CAST(event_id AS VARCHAR)) AS digest, event_id, epoch_us(ts) / 1e6 AS fetched,
                 CASE WHEN event_type = 'error' THEN 'writing' ELSE 'ready' END AS status FROM events WHERE event_id % 9 <> 0),
            n AS (SELECT epoch_us(max(ts)) / 1e6 AS now FROM events)
       SELECT digest, 'stale writing' AS reason FROM e, n WHERE status = 'writing' AND fetched + 3600 < now
       UNION ALL SELECT digest, 'expired' FROM e, n WHERE status <> 'writing' AND fetched + 86400 < now
       UNION ALL SELECT sha256(CAST(event_id AS VARCHAR)), 'orphan' FROM events WHERE event_id % 9 = 0""",
)
def cache_sweep(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select(
        "event_id",
        F.sha2(F.col("event_id").cast("string"), 256).alias("digest"),
        (F.unix_micros(F.col("ts").cast("timestamp")) / 1e6).alias("fetched_at"),
        F.when(F.col("event_type") == "error", F.lit("writing")).otherwise(F.lit("ready")).alias("status"),
    )
    now = events.agg(F.max("fetched_at")).scalar()
    return sync.cache_sweep(events.where("event_id % 9 <> 0"), events, now, 86400.0, 3600.0)


@query(
    "artifact_manifest",
    """SELECT 's3://out/' || o_orderkey AS uri, 'application/x-parquet' AS media_type, o_custkey AS size, md5(CAST(o_orderkey AS VARCHAR)) AS content_digest,
              sha1(CAST(o_orderkey AS VARCHAR)) AS blob_digest, 'file:///orders' || o_custkey AS source_locator, CAST(o_orderkey AS VARCHAR) AS resource_identity,
              epoch_us(o_orderdate) AS created_micros, 'parquet' AS mode, 'Filter>' || o_orderstatus AS transforms,
              'owner=' || o_custkey AS metadata, CASE WHEN o_orderkey % 2 = 0 THEN 'x=' || o_orderstatus ELSE '' END AS extensions
       FROM orders WHERE o_orderkey % 9 <> 4""",
)
def artifact_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Manifest rows to envelopes and back, every column; envelopes without a source locator are rejected."""
    k = F.col("o_orderkey").cast("string")
    rows = table(spark, folder, "orders").select(
        F.concat(F.lit("s3://out/"), k).alias("uri"),
        F.lit("application/x-parquet").alias("media_type"),
        F.col("o_custkey").alias("size"),
        F.md5(k).alias("content_digest"),
        F.sha1(k).alias("blob_digest"),
        F.when(F.col("o_orderkey") % 9 != 4, F.concat(F.lit("file:///orders"), "o_custkey")).alias("source_locator"),
        k.alias("resource_identity"),
        F.col("o_orderdate").cast("timestamp").alias("created_at"),
        F.lit("parquet").alias("mode"),
        F.array(F.lit("Filter"), F.col("o_orderstatus")).alias("transforms"),
        F.create_map(F.lit("owner"), F.col("o_custkey").cast("string")).alias("metadata"),
        F.when(F.col("o_orderkey") % 2 == 0, F.create_map(F.lit("x"), F.col("o_orderstatus"))).alias("extensions"),
    )
    decoded, _ = sinks.decode_manifest(sinks.encode_manifest(rows).select("document"), "document")

    def shown(entries: str):
        return F.array_join(F.transform(F.map_entries(entries), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")

    return decoded.select(
        *["uri", "media_type", "size", "content_digest", "blob_digest", "source_locator", "resource_identity", "mode"],
        F.unix_micros("created_at").alias("created_micros"),
        F.array_join("transforms", ">").alias("transforms"),
        shown("metadata").alias("metadata"),
        shown("extensions").alias("extensions"),
    )


@query(
    "manifest_rejects",
    """SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE o_orderkey % 6 WHEN 1 THEN 'source locator' WHEN 2 THEN 'resource identity' WHEN 3 THEN 'created at'
              WHEN 4 THEN 'size' ELSE 'keys' END AS reject_reason FROM orders WHERE o_orderkey % 6 <> 0""",
)
def manifest_rejects(spark: SparkSession, folder: str) -> DataFrame:
    """Envelopes broken in one place each."""
    k, kind = F.col("o_orderkey").cast("string"), F.col("o_orderkey") % 6
    rows = table(spark, folder, "orders").select(
        "o_orderkey",
        F.concat(F.lit("s3://out/"), k).alias("uri"),
        F.lit("application/x-parquet").alias("media_type"),
        F.when(kind == 4, -1).otherwise(F.col("o_custkey")).alias("size"),
        F.md5(k).alias("content_digest"),
        F.sha1(k).alias("blob_digest"),
        F.when(kind != 1, F.lit("file:///orders")).alias("source_locator"),
        F.when(kind == 2, F.lit("")).otherwise(k).alias("resource_identity"),
        F.when(kind != 3, F.col("o_orderdate").cast("timestamp")).alias("created_at"),
        F.lit("parquet").alias("mode"),
        F.array(F.lit("Filter")).alias("transforms"),
    )
    documents = sinks.encode_manifest(rows).select(
        F.regexp_extract("uri", "([0-9]+)$", 1).alias("key"),
        F.when(F.regexp_extract("uri", "([0-9]+)$", 1).cast("long") % 6 == 5, F.lit('{"kind":"artifact"}')).otherwise(F.col("document")).alias("document"),
    )
    _, bad = sinks.decode_manifest(documents, "document")
    return bad.select("key", "reject_reason")


_REPORT_SCHEMA = '[["event_type", "string", true], ["event_id", "bigint", true], ["user_id", "bigint", true]]'


@query(
    "report_fingerprint",
    f"""SELECT event_type, row_count, sha256(concat_ws('|', sha256('{_REPORT_SCHEMA}'), row_count, lane_0, lane_1, lane_2, lane_3)) AS content_digest FROM
        (SELECT event_type, count(*) AS row_count, {_sql_lanes("h")} FROM
         (SELECT event_type, {_sql_row_digest(["event_id", "user_id"])} AS h FROM events) GROUP BY event_type)""",
)
def report_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all reports at once, whatever the order of their outcomes."""
    outcomes = table(spark, folder, "events").select("event_type", "event_id", "user_id")
    return reports.report_fingerprint(outcomes, ["event_type"])


@query("row_digest", f"SELECT o_orderkey, {_sql_row_digest(['o_orderkey', 'priority:text'])} AS digest FROM (SELECT o_orderkey, nullif(o_orderpriority, '5-LOW') AS priority FROM orders)")
def row_digests(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.nullif(F.col("o_orderpriority"), F.lit("5-LOW")).alias("priority")
    )
    return rows.select("o_orderkey", row_digest(rows.schema).alias("digest"))


@query("schema_fingerprint", "SELECT count(*) AS row_count, true AS stable, false AS nullability_ignored FROM customer")
def schema_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    customers = table(spark, folder, "customer")
    again = table(spark, folder, "customer").schema
    required = customers.select(F.coalesce("c_custkey", F.lit(0)).alias("c_custkey"), *customers.columns[1:]).schema
    same = schema_fingerprint(customers.schema) == schema_fingerprint(again)
    loose = schema_fingerprint(customers.schema) == schema_fingerprint(required)
    return customers.agg(F.count(F.lit(1)).alias("row_count")).select(
        "row_count", F.lit(same).alias("stable"), F.lit(loose).alias("nullability_ignored")
    )
