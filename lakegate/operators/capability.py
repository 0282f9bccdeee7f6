"""Declared operations, observed evidence and what follows from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.functions.base import ColumnOrName, case, col, lookup
from lakegate.functions.rules import parse_operation_id
from lakegate.functions.urls import parts_of, url_origin, url_struct, with_parts
from lakegate.operators.violations import violations
from lakegate.sources.files import file_digests, list_files

# Fixed values.
REMEDIES = {
    "unsupported": "Use a connector profile that declares the operation.",
    "unauthorized": "Provide credentials with access to the operation.",
    "forbidden": "Use credentials with the required role for the operation.",
    "unavailable": "Retry after the target deployment is available.",
    "deployment-disabled": "Enable the capability on the target deployment.",
}
PLATFORMS = ("ckan", "udata", "socrata")
PATH_SIGNATURES = {
    "/api/3/action/package_search": "ckan",
    "/api/3/action/group_list": "ckan",
    "/api/1/datasets/": "udata",
    "/api/1/organizations/": "udata",
    "/api/catalog/v1": "socrata",
    "/api/views.json": "socrata",
}
PAGE_SIGNATURES = {"ckan": "ckan", "udata": "udata", "socrata": "socrata"}

PROFILE_SCHEMA = T.StructType(
    [
        T.StructField("schema_version", T.StringType()),
        T.StructField("profile_version", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("platform_api_version", T.StringType()),
        T.StructField("official_source_uri", T.StringType()),
        T.StructField("source_accessed_at", T.StringType()),
        T.StructField("fixture_fingerprint", T.StringType()),
        T.StructField(
            "operations",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField(n, T.StringType())
                        for n in ("id", "capability", "authentication", "mutation", "evidence_requirement")
                    ]
                )
            ),
        ),
    ]
)


def load_profiles(spark: SparkSession, path: str) -> DataFrame:
    """Profile documents to one row per declared operation, with the id taken apart."""
    documents = spark.read.schema(PROFILE_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return operation_rows(documents.select("*", F.explode("operations").alias("op")))


def operation_rows(rows: DataFrame) -> DataFrame:
    """Declared operations with their id taken apart; ``op`` holds one operation entry of a profile."""
    name = parse_operation_id("op.id")
    return rows.select(
        "platform",
        "profile_version",
        "platform_api_version",
        "fixture_fingerprint",
        F.col("op.id").alias("operation_id"),
        name.service.alias("service"),
        name.method.alias("method"),
        F.col("op.capability").alias("capability_class"),
        F.when(F.col("op.authentication") == "application-token-or-authenticated", F.lit("authenticated"))
        .otherwise(F.col("op.authentication"))
        .alias("auth_class"),
        F.col("op.mutation").alias("mutation_class"),
        F.col("op.evidence_requirement").alias("evidence_requirement"),
    )


CASES_SCHEMA = T.StructType(
    [
        T.StructField("schema_version", T.StringType()),
        T.StructField("platform", T.StringType()),
        T.StructField("profile_version", T.StringType()),
        T.StructField(
            "cases",
            T.ArrayType(
                T.StructType([T.StructField(n, T.StringType()) for n in ("operation", "outcome", "credential_class")])
            ),
        ),
    ]
)
CASE_OUTCOMES = (
    "core",
    "optional",
    "authenticated-success",
    "missing-credentials",
    "invalid-credentials",
    "forbidden",
    "deployment-disabled",
    "unavailable",
    "async-pending",
    "rate-limited",
)


def _plain_path(column: str) -> Column:
    """One spelling for local paths; other file systems print theirs alike everywhere."""
    return F.regexp_replace(column, "^file:/+", "/").alias("path")


def fixture_violations(spark: SparkSession, path: str, operations: DataFrame) -> DataFrame:
    """Case files against the profiles they are pinned to: fingerprint, versions, declared operations, outcomes.

    ``operations`` is the output of :func:`load_profiles`. One row per finding: platform, rule, detail.
    """
    source = spark.read.schema(CASES_SCHEMA).option("multiLine", True).json(path)
    documents = source.select("*", _plain_path("_metadata.file_path"))
    hashed = file_digests(list_files(spark, path)).select(_plain_path("path"), "sha256")
    pinned = operations.select(
        "platform", F.col("profile_version").alias("pinned_version"), "fixture_fingerprint"
    ).distinct()
    joined = documents.join(hashed, "path", "left").join(pinned, "platform", "left")
    headers = violations(
        joined,
        {
            "schema version": F.col("schema_version") == "1.0",
            "profile": F.col("pinned_version").isNotNull(),
            "profile version": F.col("profile_version") == F.col("pinned_version"),
            "fingerprint": F.col("sha256") == F.col("fixture_fingerprint"),
            "cases": F.size("cases") > 0,
        },
        ["platform", "path"],
    ).select("platform", "rule", F.col("path").alias("detail"))
    cases = documents.select("platform", F.explode("cases").alias("c")).select("platform", "c.operation", "c.outcome")
    declared = operations.select("platform", F.col("operation_id").alias("operation"))
    undeclared = cases.join(declared, ["platform", "operation"], "left_anti").select(
        "platform", F.lit("undeclared operation").alias("rule"), F.col("operation").alias("detail")
    )
    outcomes = cases.where(~F.coalesce(F.col("outcome").isin(*CASE_OUTCOMES), F.lit(False))).select(
        "platform", F.lit("undeclared outcome").alias("rule"), F.col("outcome").alias("detail")
    )
    return headers.unionAll(undeclared).unionAll(outcomes)


def profile_summary(operations: DataFrame) -> DataFrame:
    return operations.groupBy("platform", "profile_version", "platform_api_version").agg(
        F.count(F.lit(1)).alias("operations")
    )


def effective_state(response_class: ColumnOrName, declared: ColumnOrName, without_evidence: Column) -> Column:
    """Success keeps the declared class, any other response names the state itself."""
    response = col(response_class)
    return case([(response.isNull(), without_evidence), (response == "success", col(declared))], response)


def effective_profile(operations: DataFrame, evidence: DataFrame, baseline: str = "unavailable") -> DataFrame:
    """Every declared operation with its effective state.

    ``baseline`` is the state without evidence: ``unavailable``, or ``declared`` for the optimistic reading.
    Evidence is reduced to one row per operation before it meets the operations, so a hot operation costs nothing.
    Evidence that contradicts itself settles nothing: the state is ``conflict``, the response class NULL;
    :func:`evidence_errors` lists all duplicates.
    """
    observed = evidence.groupBy("operation_id").agg(
        F.min("response_class").alias("response_class"),
        (F.min("response_class") != F.max("response_class")).alias("contradicts"),
        F.count(F.lit(1)).alias("evidence_count"),
    )
    settled = F.when(~F.coalesce("contradicts", F.lit(False)), F.col("response_class"))
    fallback = F.col("capability_class") if baseline == "declared" else F.lit(baseline)
    return operations.join(observed, "operation_id", "left").select(
        *operations.columns,
        settled.alias("response_class"),
        F.coalesce("evidence_count", F.lit(0)).alias("evidence_count"),
        F.when(F.col("contradicts"), F.lit("conflict"))
        .otherwise(effective_state(settled, "capability_class", fallback))
        .alias("state"),
    )


def evidence_errors(operations: DataFrame, evidence: DataFrame) -> DataFrame:
    """Operations with more than one piece of evidence, and evidence for operations nobody declared."""
    counted = evidence.groupBy("operation_id").agg(F.count(F.lit(1)).alias("evidence_count"))
    declared = operations.select("operation_id", F.lit(True).alias("declared")).distinct()
    return (
        counted.join(declared, "operation_id", "left")
        .withColumn(
            "error",
            case(
                [
                    (F.col("declared").isNull(), F.lit("undeclared operation")),
                    (F.col("evidence_count") > 1, F.lit("duplicate evidence")),
                ]
            ),
        )
        .where("error IS NOT NULL")
        .select("operation_id", "evidence_count", "error")
    )


def guard_decisions(requests: DataFrame, profile: DataFrame) -> DataFrame:
    """Allowed or not, the state behind it and the remedy; an operation nobody declares is unsupported."""
    states = profile.select("operation_id", "state")
    state = F.coalesce("state", F.lit("unsupported"))
    return requests.join(states, "operation_id", "left").select(
        *requests.columns,
        state.alias("state"),
        (~state.isin(*REMEDIES)).alias("allowed"),
        lookup(state, REMEDIES).alias("remedy"),
    )


def fresh_or_declared(operations: DataFrame, fresh: DataFrame, keys: Sequence[str], declared: str) -> DataFrame:
    """Every declared operation with its fresh evidence; without any, ``declared`` and ``source`` = ``declared`` stand in."""
    both = operations.join(fresh.withColumn("_fresh", F.lit(True)), list(keys), "left")
    source = F.when(F.col("_fresh"), F.lit("observed")).otherwise(F.lit("declared"))
    return both.select(*keys, *[c for c in fresh.columns if c not in keys], declared, source.alias("source"))


def latest_fresh(evidence: DataFrame, now: Column, ttl_seconds: float, keys: Sequence[str], ts: str, tie: str) -> DataFrame:
    """Newest evidence per operation that is younger than its time to live.

    Operations whose evidence is older are left out; :func:`fresh_or_declared` puts their declared state in its place.

    ``max_by`` keeps one candidate per task and key, so no window sorts a hot key.
    """
    others = [c for c in evidence.columns if c not in keys]
    newest = evidence.groupBy(*keys).agg(F.max_by(F.struct(*others), F.struct(ts, tie)).alias("e"))
    age = F.unix_micros(now.cast("timestamp")) - F.unix_micros(F.col(f"e.{ts}").cast("timestamp"))
    return newest.where(age < int(ttl_seconds * 1_000_000)).select(*keys, "e.*")


def spec_violations(operations: DataFrame) -> DataFrame:
    """Declarations that contradict themselves."""
    return violations(
        operations,
        {
            "read operations cannot be batch atomic": ~(
                (F.col("mutation_class") == "read") & (F.col("atomicity") == "batch")
            ),
            "admin capability cannot be public": ~(
                (F.col("auth_class") == "public") & (F.col("capability_class") == "admin")
            ),
        },
        ["operation_id"],
    )


def evidence_violations(evidence: DataFrame, url: str, target: str, keys: Sequence[str]) -> DataFrame:
    """Evidence must come from a clean HTTPS URL on the origin it claims to describe."""
    p = parts_of(F.col("_u"))
    return violations(
        evidence.select(*keys, url_struct(url).alias("_u"), url_origin(url).alias("_o"), url_origin(target).alias("_t")),
        {
            "https": p.scheme == "https",
            "host": p.netloc != "",
            "no user data": ~p.netloc.contains("@"),
            "no query": p.query == "",
            "no fragment": p.fragment == "",
            "same origin": F.col("_o") == F.col("_t"),
        },
        keys,
    )


def fingerprint_pages(pages: DataFrame, url: str, html: str) -> DataFrame:
    """One row per page and matching signature, from an inline table of nine signatures."""

    def signs(path: Column) -> Column:
        found = [(path, "path", PATH_SIGNATURES), (F.col(html), "page", PAGE_SIGNATURES)]
        return F.array(
            *[
                F.when(
                    text.contains(sign),
                    F.struct(F.lit(kind).alias("kind"), F.lit(sign).alias("sign"), F.lit(platform).alias("platform")),
                )
                for text, kind, table in found
                for sign, platform in table.items()
            ]
        )

    others = [c for c in pages.columns if c != html]
    matches = F.filter(with_parts(url, lambda p: signs(p.path)), lambda s: s.isNotNull())
    return pages.select(*others, F.inline(matches))


def detection_rollup(evidence: DataFrame, origin: str = "origin") -> DataFrame:
    """Per origin: the first platform, in fixed order, with a matching probe; evidence rows stay a table of their own."""
    rank = case([(F.col("platform") == p, F.lit(i)) for i, p in enumerate(PLATFORMS)], F.lit(len(PLATFORMS)))
    known = F.col("matched") & F.col("platform").isin(*PLATFORMS)
    found = F.min_by(F.when(known, F.col("platform")), F.when(known, rank))
    return evidence.groupBy(origin).agg(
        found.alias("platform"),
        F.when(found.isNotNull(), F.lit(1.0)).otherwise(F.lit(0.0)).alias("confidence"),
        F.count(F.lit(1)).alias("checks"),
        F.count_if(F.col("matched")).alias("matches"),
    )


def profile_drift(pinned: DataFrame, observed: DataFrame) -> DataFrame:
    """Observed fixture fingerprints that differ from the pinned one: advisory rows, nothing is changed."""
    seen = observed.select("profile_version", F.col("fixture_fingerprint").alias("observed_fixture_fingerprint"))
    return (
        pinned.select("profile_version", "fixture_fingerprint")
        .distinct()
        .join(seen, "profile_version")
        .where(~F.col("fixture_fingerprint").eqNullSafe(F.col("observed_fixture_fingerprint")))
        .select("profile_version", "observed_fixture_fingerprint", F.lit(True).alias("advisory_only"))
    )


def mutation_policy(requests: DataFrame) -> DataFrame:
    """What would happen to each requested change: rejected, skipped as a dry run, or dispatched."""
    confirmed = ~F.col("destructive") | F.coalesce("confirmed", F.lit(False))
    preview = ~F.col("dry_run") | F.coalesce("dry_run_supported", F.lit(True))
    instruction = F.coalesce(F.col("version_token") != "", F.lit(False)) | F.coalesce("overwrite", F.lit(False))
    reason = case(
        [
            (~confirmed, F.lit("confirmation required")),
            (~preview, F.lit("dry run not supported")),
            (~instruction, F.lit("version token or overwrite required")),
        ]
    )
    return requests.select(
        *requests.columns,
        case(
            [(reason.isNotNull(), F.lit("rejected")), (F.col("dry_run"), F.lit("skipped"))], F.lit("dispatch")
        ).alias("decision"),
        reason.alias("reason"),
    )


def permission_check(requests: DataFrame) -> DataFrame:
    """``unauthenticated`` when nothing is known, ``forbidden`` when something required is not held, else ``allowed``."""
    lacking = F.size(F.array_except("required_scopes", "scopes")) + F.size(F.array_except("required_roles", "roles"))
    unknown = ~F.col("authenticated") & (F.size("scopes") == 0) & (F.size("roles") == 0)
    return requests.select(
        *requests.columns,
        case([(unknown, F.lit("unauthenticated")), (lacking > 0, F.lit("forbidden"))], F.lit("allowed")).alias(
            "permission"
        ),
    )
