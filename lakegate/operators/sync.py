"""Incremental publication: what to do per resource, compare-and-swap state, validation and migration of state rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.functions.base import case
from lakegate.functions.rules import is_sha256, valid_watermark
from lakegate.functions.urls import is_safe_destination
from lakegate.operators.violations import checked_documents, exactly, violations

# Fixed values.
UNSUPPORTED_ACCESS = ("query", "stream")
CHECKPOINTED_ACCESS = ("local_file", "object_storage")

CHECKPOINT_KEYS = {
    1: ("version", "status", "next_batch_index", "position"),
    2: ("version", "status", "next_batch_index", "position", "source_version"),
    3: ("version", "status", "next_batch_index", "position", "source_version", "destination_identity"),
}
ARTIFACT_BY_IDENTITY = ("destination_identity", "destination_size", "destination_checksum")
ARTIFACT_BY_URI = ("destination_uri", "destination_size", "destination_checksum")

STATE_COLUMNS = (
    "key",
    "watermark",
    "status",
    "source_version",
    "destination_identity",
    "next_batch_index",
    "row_group_index",
    "last_synced_at",
    "version",
)


def duplicate_identities(resources: DataFrame) -> DataFrame:
    """Identities claimed by more than one resource, one row per id involved.

    Counted per (identity, id) first: copies of one id collapse on the map side, so what is grouped by identity
    afterwards is one row per distinct id.
    """
    per_id = resources.groupBy("identity", "id").agg(F.count(F.lit(1)).alias("copies"))
    clash = (
        per_id.groupBy("identity")
        .agg(F.sum("copies").alias("claims"), F.count(F.lit(1)).alias("ids"))
        .where("claims > 1")
    )
    return per_id.join(clash, "identity").select("identity", "id", "copies", "claims", "ids")


def destination_health(artifacts: DataFrame, listing: DataFrame) -> DataFrame:
    """Recorded artifacts against what lies at their destination.

    ``artifacts``: key, expected_uri, uri, size, content_digest, blob_digest (NULL for old records).
    ``listing``: uri, size, content_digest, blob_digest as found.
    """
    found = listing.select(
        "uri",
        F.col("size").alias("found_size"),
        F.col("content_digest").alias("found_content"),
        F.col("blob_digest").alias("found_blob"),
    )
    checks = {
        "uri_ok": F.col("uri") == F.col("expected_uri"),
        "exists": F.col("found_size").isNotNull(),
        "size_ok": F.col("found_size") == F.col("size"),
        "content_ok": F.col("found_content") == F.col("content_digest"),
        "blob_ok": F.col("blob_digest").isNull() | (F.col("found_blob") == F.col("blob_digest")),
    }
    sure = {n: F.coalesce(c, F.lit(False)) for n, c in checks.items()}
    healthy = sure["uri_ok"] & sure["exists"] & sure["size_ok"] & sure["content_ok"] & sure["blob_ok"]
    return artifacts.join(found, "uri", "left").select(
        "key", *[c.alias(n) for n, c in sure.items()], healthy.alias("healthy")
    )


def checkpoint_valid(source_version: Column, live_version: Column, destination: Column, live_destination: Column) -> Column:
    """A checkpoint survives unless the source or the destination is known to have changed."""
    changed = (source_version.isNotNull() & live_version.isNotNull() & (source_version != live_version)) | (
        destination.isNotNull() & (destination != live_destination)
    )
    return ~F.coalesce(changed, F.lit(False))


def sync_plan(resources: DataFrame, state: DataFrame, health: DataFrame, resume: bool = True) -> DataFrame:
    """What a run would do with every resource, first matching rule wins.

    ``resources``: key, access_kind, format, live_version, live_destination, content_digest (of the current content),
    response_status and fresh_watermark (of a conditional request, NULL without one).
    ``state``: one row per key, with ``status`` ``in_progress`` (open checkpoint) or ``completed``.
    ``health``: key, healthy; present only where a completed artifact is recorded.
    All three meet on the unique key, so the joins are even; nothing is read from the sources themselves.
    """
    prior = state.select(
        "key", "status", "watermark", "source_version", "destination_identity", F.lit(True).alias("has_state")
    )
    joined = resources.join(prior, "key", "left").join(health.select("key", "healthy"), "key", "left")
    parquet = (F.upper(F.coalesce("format", F.lit(""))) == "PARQUET") & F.col("access_kind").isin(*CHECKPOINTED_ACCESS)
    open_checkpoint = F.coalesce(F.col("status") == "in_progress", F.lit(False))
    usable = open_checkpoint & checkpoint_valid(
        F.col("source_version"),
        F.when(parquet, F.col("live_version")),
        F.col("destination_identity"),
        F.col("live_destination"),
    )
    dropped = open_checkpoint & ~usable
    recorded = F.col("healthy").isNotNull() & ~dropped
    healthy = F.coalesce("healthy", F.lit(False)) & ~dropped
    watermark = F.when(~dropped, F.col("watermark"))
    conditional = (F.col("access_kind") == "http_download") & (
        watermark.isNull() | ~F.coalesce(is_sha256(watermark), F.lit(False))
    )
    checkpointed = parquet & (usable | ~recorded | ~healthy)
    unchanged = (
        F.col("fresh_watermark").isNull()
        & F.coalesce(watermark == F.col("content_digest"), F.lit(False))
        & healthy
        & ~checkpointed
    )
    completed = F.coalesce("has_state", F.lit(False)) & ~open_checkpoint
    action = case(
        [
            (F.col("access_kind").isin(*UNSUPPORTED_ACCESS), F.lit("skipped-unsupported")),
            (F.lit(resume) & completed & healthy, F.lit("resumed")),
            (conditional & F.coalesce(F.col("response_status") == 304, F.lit(False)) & healthy, F.lit("skipped-unchanged")),
            (checkpointed & F.lit(resume) & usable, F.lit("resumed")),
            (checkpointed, F.lit("materialized")),
            (unchanged, F.lit("skipped-unchanged")),
        ],
        F.lit("materialized"),
    )
    return joined.select(
        *resources.columns,
        action.alias("action"),
        checkpointed.alias("checkpointed"),
        dropped.alias("checkpoint_dropped"),
    )


def conditional_merge(current: DataFrame, proposals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Compare-and-swap: a proposal is committed only if the version it expects is still the current one.

    ``proposals``: the columns of ``current`` plus ``expected`` (NULL: the key must be absent), ``order`` and
    ``deleted``. Of several proposals for one key the first in order wins and the others conflict; two with the same key
    and order have no first one, so they raise, as does a proposal without a key. Proposals are first
    reduced per (key, expected version), on the map side, and what is left meets the state on both columns: a key with
    most of the proposals is never gathered in one task.
    Returns the new state and the outcome of every proposal.
    """
    body = [c for c in current.columns if c != "key"]
    proposals = _with_unique_order(proposals)
    candidates = proposals.groupBy("key", "expected").agg(
        F.min("order").alias("order"), F.min_by(F.struct(*body, "deleted"), F.col("order")).alias("w")
    )
    # An inner and an outer join, as semi and anti joins would be moved below the reduction again.
    stored = current.select("key", F.col("version").alias("expected"))
    replacing = candidates.join(stored, ["key", "expected"])
    taken = current.select("key", F.lit(True).alias("_taken"))
    creating = candidates.where("expected IS NULL").join(taken, "key", "left").where("_taken IS NULL").drop("_taken")
    winners = replacing.unionByName(creating)
    marks = winners.select(
        F.col("key").alias("_key"), F.col("order").alias("_order"), F.col("expected").alias("_expected"), F.lit(True).alias("_won")
    )
    same = (
        (F.col("key") == F.col("_key"))
        & (F.col("order") == F.col("_order"))
        & F.col("expected").eqNullSafe(F.col("_expected"))
    )
    outcomes = proposals.join(marks, same, "left").select(
        "key", "order", F.when(F.col("_won"), F.lit("committed")).otherwise(F.lit("conflict")).alias("outcome")
    )
    kept = current.join(winners.select("key"), "key", "left_anti").select("key", *body)
    written = winners.where("NOT w.deleted").select("key", *[F.col(f"w.{c}").alias(c) for c in body])
    return kept.unionByName(written), outcomes


def _with_unique_order(proposals: DataFrame) -> DataFrame:
    """``proposals``, raising at one without a key and where two share key and order (counted per both: no key is hot)."""
    counted = proposals.groupBy(F.col("key").alias("_k"), F.col("order").alias("_o")).agg(F.count(F.lit(1)).alias("_n"))
    shared = F.concat(F.lit("proposals without an order of their own for key "), F.col("_k").cast("string"))
    message = F.coalesce(shared, F.lit("a proposal without a key"))
    good = F.col("_k").isNotNull() & (F.col("_n") == 1)
    checked = F.when(good, F.col("order")).otherwise(F.raise_error(message).cast(proposals.schema["order"].dataType))
    same = F.col("key").eqNullSafe(F.col("_k")) & F.col("order").eqNullSafe(F.col("_o"))
    joined = proposals.join(counted, same).withColumn("order", checked)
    return joined.select(*proposals.columns)


def mirror_proposals(committed: DataFrame, current: DataFrame, synced_at: Column) -> DataFrame:
    """Committed (identity, watermark) pairs as proposals for :func:`conditional_merge`; blank ones are left out.

    Pairs of one identity are proposals of their own, in the order of their watermarks; equal pairs are one.
    """
    versions = current.select("key", F.col("version").alias("expected"))
    pairs = (
        committed.where((F.coalesce("identity", F.lit("")) != "") & (F.coalesce("watermark", F.lit("")) != ""))
        .select(F.col("identity").alias("key"), "watermark")
        .distinct()
    )
    filled = {
        "status": F.lit("completed"),
        "last_synced_at": synced_at,
        "version": F.sha2(F.concat_ws("|", "key", "watermark"), 256),
    }
    known = current.schema
    return pairs.join(versions, "key", "left").select(
        "key",
        *[
            (F.col("watermark") if c == "watermark" else filled.get(c, F.lit(None)))
            .cast(known[c].dataType)
            .alias(c)
            for c in current.columns
            if c != "key"
        ],
        "expected",
        F.col("watermark").alias("order"),
        F.lit(False).alias("deleted"),
    )


def state_violations(state: DataFrame) -> DataFrame:
    """Broken rules of stored state rows.

    Rows may carry more than the table's columns: a ``partitions`` text must be empty JSON, and a ``last_synced_at`` text
    must be a time with a zone.
    """
    open_checkpoint = F.col("status") == "in_progress"
    optional_digest = F.col("source_version").isNull() | is_sha256("source_version")
    extra = {}
    if dict(state.dtypes).get("last_synced_at") == "string":
        extra["last synced"] = F.col("last_synced_at").isNull() | zoned_time(F.col("last_synced_at"))
    if "partitions" in state.columns:
        extra["partitions"] = F.coalesce("partitions", F.lit("null")).isin("null", "[]", "{}")
    return violations(
        state,
        {
            "status": F.col("status").isin("in_progress", "completed"),
            "watermark": F.col("watermark").isNull() | valid_watermark("watermark"),
            "completed needs a watermark": open_checkpoint | F.col("watermark").isNotNull(),
            "source version": optional_digest,
            "destination identity": F.col("destination_identity").isNull() | is_sha256("destination_identity"),
            **extra,
            "checkpoint position": ~open_checkpoint
            | (
                F.coalesce(F.col("next_batch_index") >= 0, F.lit(False))
                & F.coalesce(F.col("row_group_index") >= 0, F.lit(False))
            ),
        },
        ["key"],
    )


def upgrade_state(
    old: DataFrame, checkpoint_key: str, artifact_key: str, destination: str
) -> tuple[DataFrame, DataFrame]:
    """Old JSON state rows in the table layout, and the rows that cannot be read.

    ``old``: key, document (JSON object of cursor, extra and last_synced_at). Checkpoint versions 1 (no source version,
    batch index equal to the row group), 2 (no destination) and 3 are read alike; missing fields become NULL. Completed
    artifacts come by destination identity or by destination URI; ``destination`` stands for the latter.
    """
    box = (
        "struct<version:bigint,status:string,next_batch_index:bigint,position:struct<kind:string,row_group_index:bigint>,"
        "source_version:string,destination_identity:string>"
    )
    record = (
        "struct<destination_identity:string,destination_uri:string,destination_size:bigint,destination_checksum:string>"
    )
    schema = (
        "cursor struct<schema:string,watermark:string>, last_synced_at string, partitions variant,"
        f" extra struct<`{checkpoint_key}`:{box},`{artifact_key}`:{record}>"
    )

    def nested_keys(name: str) -> Column:
        return F.json_object_keys(F.get_json_object("document", f"$.extra.{name}"))

    def build(d: Column, _: Column):
        checkpoint, artifact = d["extra"][checkpoint_key], d["extra"][artifact_key]
        position, source, target = checkpoint["position"], checkpoint["source_version"], checkpoint["destination_identity"]
        is_open, found = checkpoint.isNotNull(), artifact.isNotNull()
        shape = case(
            [(checkpoint["version"] == v, exactly(nested_keys(checkpoint_key), keys)) for v, keys in CHECKPOINT_KEYS.items()],
            F.lit(False),
        )
        good_checkpoint = (
            shape
            & (position["kind"] == "parquet_row_group")
            & (checkpoint["status"] == "in_progress")
            & (checkpoint["next_batch_index"] >= 0)
            & (position["row_group_index"] >= 0)
            & ((checkpoint["version"] != 1) | (checkpoint["next_batch_index"] == position["row_group_index"]))
            & (source.isNull() | is_sha256(source))
            & ((checkpoint["version"] != 3) | is_sha256(target))
        )
        keys = nested_keys(artifact_key)
        good_artifact = (
            (exactly(keys, ARTIFACT_BY_IDENTITY) & is_sha256(artifact["destination_identity"]))
            | (exactly(keys, ARTIFACT_BY_URI) & is_safe_destination(artifact["destination_uri"]))
        ) & (artifact["destination_size"] >= 0) & is_sha256(artifact["destination_checksum"])
        named = F.coalesce(
            artifact["destination_identity"], F.when(artifact["destination_uri"].isNotNull(), F.lit(destination))
        )
        columns = {
            "watermark": F.when(~is_open, d["cursor"]["watermark"]),
            "status": F.when(is_open, F.lit("in_progress")).otherwise(F.lit("completed")),
            "source_version": source,
            "destination_identity": F.when(is_open, target).otherwise(named),
            "next_batch_index": checkpoint["next_batch_index"],
            "row_group_index": position["row_group_index"],
            "last_synced_at": F.try_to_timestamp(d["last_synced_at"]),
            "version": F.sha2(F.col("document"), 256),
        }
        return columns, [
            ("checkpoint", ~is_open | F.coalesce(good_checkpoint, F.lit(False))),
            ("artifact", ~found | F.coalesce(good_artifact, F.lit(False))),
            ("watermark", is_open | valid_watermark(d["cursor"]["watermark"])),
            ("last synced", d["last_synced_at"].isNull() | zoned_time(d["last_synced_at"])),
            ("partitions", F.coalesce(F.to_json(d["partitions"]), F.lit("null")).isin("null", "[]", "{}")),
        ]

    return checked_documents(old, "document", schema, build)


def zoned_time(text: Column) -> Column:
    """Whether a text is a point in time: a date and a time of day that exist, with a zone or an offset."""
    shaped = text.rlike(r"^\d{4}-\d\d-\d\d[T ]\d\d:\d\d(?::\d\d(?:\.\d{1,9})?)?(?:Z|[+-]\d\d:?\d\d)$")
    return F.coalesce(shaped & F.try_to_timestamp(text).isNotNull(), F.lit(False))


def unsafe_destinations(destinations: DataFrame, uri: str) -> DataFrame:
    return destinations.where(~is_safe_destination(uri))


def cache_sweep(entries: DataFrame, files: DataFrame, now: float | Column, ttl: float, stale_writing: float) -> DataFrame:
    """What a cache clean-up would remove, and why.

    ``entries``: digest, fetched_at (epoch seconds), status. ``files``: digest. Orphans are content files, named by a
    digest, without an entry; files with other names are left alone.
    """
    at = F.lit(now) if isinstance(now, (int, float)) else now
    reason = case(
        [
            ((F.col("status") == "writing") & (F.col("fetched_at") + stale_writing < at), F.lit("stale writing")),
            ((F.col("status") != "writing") & (F.col("fetched_at") + ttl < at), F.lit("expired")),
        ]
    )
    due = entries.select("digest", reason.alias("reason")).where("reason IS NOT NULL")
    content = files.where(F.col("digest").rlike("^[0-9a-f]{64}$"))
    return due.unionAll(orphan_files(content, entries).select("digest", F.lit("orphan").alias("reason")))


def orphan_files(files: DataFrame, index: DataFrame, key: str = "digest") -> DataFrame:
    """Content files the index does not know; both sides are reduced to distinct digests before they meet."""
    return files.select(key).distinct().join(index.select(key).distinct(), key, "left_anti")


def verify_checksums(files: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Compare digests without regard to case; a file without an expectation, or the reverse, is reported too."""
    wanted = expected.select(key, F.col("digest").alias("expected_digest"))
    both = files.select(key, "digest").join(wanted, key, "full_outer")
    status = case(
        [
            (F.col("digest").isNull(), F.lit("missing file")),
            (F.col("expected_digest").isNull(), F.lit("unexpected file")),
            (F.lower("digest") == F.lower("expected_digest"), F.lit("ok")),
        ],
        F.lit("mismatch"),
    )
    return both.select(key, status.alias("status"))
