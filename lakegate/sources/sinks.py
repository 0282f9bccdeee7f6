"""Publication: Parquet artifacts with provenance, JSON lines, views and replaced tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakegate.errors import IntakeError
from lakegate.functions.rules import valid_identifier
from lakegate.functions.urls import sanitize_uri
from lakegate.operators.violations import checked_documents, exactly
from lakegate.operators.digest import (
    LANES,
    LIMB_BITS,
    LIMBS,
    fingerprint_of,
    lane_parts,
    lane_sums,
    lane_totals,
    limb_sums,
    row_digest,
)
from lakegate.operators.transforms import Steps
from lakegate.sources.files import file_digests, list_files

MANIFEST_SCHEMA = (
    "uri string, media_type string, size bigint, content_digest string, blob_digest string, source_locator string,"
    " resource_identity string, created_at timestamp, mode string, transforms array<string>, row_count bigint"
)
ARTIFACT_KEYS = (
    "schema_version",
    "kind",
    "uri",
    "media_type",
    "size",
    "content_digest",
    "blob_digest",
    "provenance",
    "metadata",
    "extensions",
)


# What readers say of artifacts that are missing, empty or no Parquet.
_DAMAGE = (
    "PATH_NOT_FOUND|UNABLE_TO_INFER_SCHEMA|FAILED_READ_FILE|CANNOT_READ_FILE_FOOTER|FileNotFound|is not a Parquet file"
    "|Could not read footer|expected magic number|CANNOT_MERGE_SCHEMAS|does not exist"
)


@dataclass(frozen=True)
class Published:
    """What a publication left behind; ``written`` is false when the stored artifact was still right."""

    uri: str
    row_count: int
    content_digest: str
    written: bool


def blob_state(spark: SparkSession, uri: str) -> tuple[int, str]:
    """Total size and digest over the bytes of an artifact's data files.

    Files are hashed in tasks; per-file digests are folded order-free, as file names are generated.
    """
    digests = file_digests(list_files(spark, uri, "*.parquet"))
    summed = digests.agg(
        F.coalesce(F.sum("size"), F.lit(0)).alias("size"),
        F.count(F.lit(1)).cast("string").alias("files"),
        *[c.alias(n) for n, c in lane_sums(F.col("sha256")).items()],
    )
    row = summed.select("size", F.sha2(F.concat_ws("|", "files", *lane_totals()), 256).alias("digest")).first()
    return row["size"], row["digest"]


def is_healthy(spark: SparkSession, uri: str, content_digest: str, size: int | None = None) -> bool:
    """Whether an artifact still holds the content its manifest row promises."""
    try:
        if size is not None and blob_state(spark, uri)[0] != size:
            return False
        return fingerprint_of(spark.read.parquet(uri))[1] == content_digest
    except Exception as problem:
        if not re.search(_DAMAGE, str(problem)):  # a passing fault says nothing about the artifact
            raise
        return False


def write_fingerprinted(df: DataFrame, path: str) -> tuple:
    """Write ``df`` as Parquet in place of what is there; its row count and fingerprint lanes are added up on the way.

    The same numbers that :func:`lakegate.operators.digest.table_fingerprint` gives for the rows, without a pass of their
    own: metrics of the writing tasks, each of which counts once however often it is tried.
    """
    seen, digest = Observation(), "__row_digest"
    sums = {"row_count": F.count(F.lit(1)), **limb_sums([F.col(f"{digest}.p{lane}") for lane in range(len(LANES))])}
    hashed = df.withColumn(digest, lane_parts(row_digest(df.schema))).observe(seen, *[c.alias(n) for n, c in sums.items()])
    hashed.drop(digest).write.mode("overwrite").parquet(path)
    found = seen.get
    lanes = [sum(found[f"_l{i}_{limb}"] << (LIMB_BITS * limb) for limb in range(LIMBS)) for i in range(len(LANES))]
    return found["row_count"], *map(str, lanes)


def materialize(
    df: DataFrame,
    destination: str,
    identity: str,
    source_locator: str,
    manifest: str,
    steps: Steps | None = None,
    stored: Published | None = None,
) -> Published:
    """Apply the steps, write Parquet under a fresh version folder, verify it, and append one manifest row.

    Nothing is renamed: a reader follows the manifest, so a crashed attempt leaves only unreferenced files. If
    ``stored`` still matches the content and is healthy, nothing is written.
    """
    spark = df.sparkSession
    shaped = steps(df) if steps else df
    if stored is not None:
        count, digest = fingerprint_of(shaped, as_stored=True)
        if digest == stored.content_digest and is_healthy(spark, stored.uri, digest):
            return Published(stored.uri, count, digest, False)
    uri = f"{destination.rstrip('/')}/{identity}/v={uuid.uuid4().hex}"
    shaped.write.parquet(uri)
    count, digest = fingerprint_of(spark.read.parquet(uri))
    size, blob = blob_state(spark, uri)
    row = spark.range(1).select(
        F.lit(uri).alias("uri"),
        F.lit("application/x-parquet").alias("media_type"),
        F.lit(size).cast("bigint").alias("size"),
        F.lit(digest).alias("content_digest"),
        F.lit(blob).alias("blob_digest"),
        sanitize_uri(F.lit(source_locator)).alias("source_locator"),
        F.lit(identity).alias("resource_identity"),
        F.current_timestamp().alias("created_at"),
        F.lit("parquet").alias("mode"),
        F.array(*[F.lit(n) for n in (steps.names if steps else [])]).cast("array<string>").alias("transforms"),
        F.lit(count).cast("bigint").alias("row_count"),
    )
    row.write.mode("append").parquet(manifest)
    return Published(uri, count, digest, True)


def latest_artifacts(spark: SparkSession, manifest: str) -> DataFrame:
    """The newest manifest row per resource."""
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(manifest)
    return rows.groupBy("resource_identity").agg(
        F.max_by(F.struct(*[c for c in rows.columns if c != "resource_identity"]), F.struct("created_at", "uri")).alias("a")
    ).select("resource_identity", "a.*")


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.option("ignoreNullFields", "false").json(path)


def register_view(df: DataFrame, name: str) -> None:
    """Publish a frame under a checked name for SQL."""
    ok = df.sparkSession.range(1).select(valid_identifier(F.lit(name)).alias("ok")).first()
    if not ok["ok"]:
        raise IntakeError(f"not a valid view name: {name!r}")
    df.createOrReplaceTempView(name)


def load_replace(tables: Mapping[str, DataFrame], database: str | None = None) -> list[str]:
    """Replace one table per resource; names must already be sanitised and free of collisions."""
    written = []
    for name, df in tables.items():
        target = f"{database}.{name}" if database else name
        df.write.mode("overwrite").saveAsTable(target)
        written.append(target)
    return written


def decode_manifest(rows: DataFrame, document: str) -> tuple[DataFrame, DataFrame]:
    """Artifact envelopes (JSON) to manifest rows, and the rejected documents with the first broken rule."""
    schema = (
        "schema_version bigint, kind string, uri string, media_type string, size bigint,"
        " content_digest struct<algorithm:string,value:string>, blob_digest struct<algorithm:string,value:string>,"
        " provenance struct<source_locator:string,resource_identity:string,created_at:string,materialization_mode:string,"
        "transforms:array<string>>, metadata map<string,string>, extensions map<string,string>"
    )

    def build(d: Column, keys: Column):
        p = d["provenance"]
        columns = {
            "uri": d["uri"],
            "media_type": d["media_type"],
            "size": d["size"],
            "content_digest": d["content_digest"]["value"],
            "blob_digest": d["blob_digest"]["value"],
            "source_locator": p["source_locator"],
            "resource_identity": p["resource_identity"],
            "created_at": F.try_to_timestamp(p["created_at"]),
            "mode": p["materialization_mode"],
            "transforms": p["transforms"],
            "metadata": d["metadata"],
            "extensions": d["extensions"],
        }
        return columns, [
            ("keys", exactly(keys, ARTIFACT_KEYS)),
            ("schema version", d["schema_version"] == 1),
            ("kind", d["kind"] == "artifact"),
            ("uri", d["uri"] != ""),
            ("media type", d["media_type"] != ""),
            ("size", d["size"] >= 0),
            ("digest", d["content_digest"]["value"].isNotNull() & d["blob_digest"]["value"].isNotNull()),
            ("source locator", p["source_locator"] != ""),
            ("resource identity", p["resource_identity"] != ""),
            ("created at", F.try_to_timestamp(p["created_at"]).isNotNull()),
        ]

    return checked_documents(rows, document, schema, build)


def encode_manifest(artifacts: DataFrame) -> DataFrame:
    """Manifest rows to artifact envelopes; ``metadata`` and ``extensions`` are maps of texts, empty where absent."""
    nothing = F.create_map().cast("map<string,string>")
    notes = {
        c: F.coalesce(F.col(c), nothing) if c in artifacts.columns else nothing for c in ("metadata", "extensions")
    }
    digest = {
        name: F.struct(F.lit("sha256").alias("algorithm"), F.col(name).alias("value"))
        for name in ("content_digest", "blob_digest")
    }
    envelope = F.struct(
        F.lit(1).alias("schema_version"),
        F.lit("artifact").alias("kind"),
        "uri",
        "media_type",
        "size",
        digest["content_digest"].alias("content_digest"),
        digest["blob_digest"].alias("blob_digest"),
        F.struct(
            F.col("source_locator"),
            "resource_identity",
            F.date_format("created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("created_at"),
            F.col("mode").alias("materialization_mode"),
            "transforms",
        ).alias("provenance"),
        notes["metadata"].alias("metadata"),
        notes["extensions"].alias("extensions"),
    )
    return artifacts.select("uri", F.to_json(envelope, {"ignoreNullFields": "false"}).alias("document"))
