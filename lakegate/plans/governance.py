"""Capability, compliance, bulk, health and catalog plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.functions import declared
from lakegate.functions.base import case
from lakegate.functions.urls import url_origin
from lakegate.operators import bulk, capability, catalog, health, reports
from lakegate.plans.registry import query, table
from lakegate.session import scratch_path

# --- capability: parts stand for operations, orders for probes -------------------------------------------------------

_CLASSES = ("core", "optional", "authenticated", "admin")
_RESPONSES = ("success", "unsupported", "unauthorized", "forbidden", "unavailable", "deployment-disabled")


def _pick(values: tuple[str, ...], index: Column) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), index.cast("int"))


def _sql_pick(values: tuple[str, ...], index: str) -> str:
    return f"CASE {index} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


def _operations(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    return table(spark, folder, "part").select(
        F.concat(F.lit("ckan/part."), key).alias("operation_id"),
        _pick(_CLASSES, key % 4).alias("capability_class"),
        F.when(key % 3 == 0, F.lit("public")).otherwise(F.lit("authenticated")).alias("auth_class"),
        F.when(key % 2 == 0, F.lit("read")).otherwise(F.lit("update")).alias("mutation_class"),
        F.when(key % 5 == 0, F.lit("batch")).otherwise(F.lit("none")).alias("atomicity"),
    )


def _evidence(spark: SparkSession, folder: str) -> DataFrame:
    """One probe per third part, and some probes of operations nobody declares."""
    key = F.col("p_partkey")
    parts = table(spark, folder, "part").where("p_partkey % 3 = 0")
    return parts.select(
        F.concat(F.lit("ckan/part."), key + F.when(key % 30 == 0, 10**9).otherwise(0)).alias("operation_id"),
        _pick(_RESPONSES, F.floor(key / 3) % 6).alias("response_class"),
    )


def _contradicted(spark: SparkSession, folder: str) -> DataFrame:
    """The same probes, every second one repeated, some of the repetitions with another outcome."""
    again = _evidence(spark, folder).withColumn("n", F.xxhash64("operation_id") % 2).drop("n")
    key = F.regexp_extract("operation_id", r"([0-9]+)$", 1).cast("long")
    other = F.when(key % 4 == 0, F.lit("success")).otherwise(F.col("response_class"))
    return again.union(again.where(key % 2 == 0).select("operation_id", other))


@query(
    "effective_conflicts",
    f"""WITH o AS (SELECT p_partkey AS k, {_sql_pick(_CLASSES, 'p_partkey % 4')} AS class,
            CASE WHEN p_partkey % 3 = 0 AND p_partkey % 30 <> 0 THEN {_sql_pick(_RESPONSES, '(p_partkey // 3) % 6')} END AS r FROM part)
        SELECT 'ckan/part.' || k AS operation_id,
          CASE WHEN r IS NULL THEN 'unavailable' WHEN k % 4 = 0 AND r <> 'success' THEN 'conflict' WHEN r = 'success' THEN class ELSE r END AS state,
          CASE WHEN r IS NULL THEN 0 WHEN k % 2 = 0 THEN 2 ELSE 1 END AS evidence_count FROM o""",
)
def effective_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    profile = capability.effective_profile(_operations(spark, folder), _contradicted(spark, folder))
    return profile.select("operation_id", "state", "evidence_count")


_SQL_STATES = f"""o AS (SELECT 'ckan/part.' || p_partkey AS operation_id, {_sql_pick(_CLASSES, 'p_partkey % 4')} AS capability_class,
        CASE WHEN p_partkey % 3 = 0 AND p_partkey % 30 <> 0 THEN {_sql_pick(_RESPONSES, '(p_partkey // 3) % 6')} END AS response FROM part),
    s AS (SELECT *, CASE WHEN response IS NULL THEN 'unavailable' WHEN response = 'success' THEN capability_class ELSE response END AS state FROM o)"""


@query("effective_profile", f"WITH {_SQL_STATES} SELECT operation_id, capability_class, state FROM s")
def effective_profile(spark: SparkSession, folder: str) -> DataFrame:
    profile = capability.effective_profile(_operations(spark, folder), _evidence(spark, folder))
    return profile.select("operation_id", "capability_class", "state")


@query(
    "declared_states",
    f"""WITH {_SQL_STATES} SELECT operation_id, CASE WHEN response IS NULL OR response = 'success' THEN capability_class ELSE response END AS state FROM s""",
)
def declared_states(spark: SparkSession, folder: str) -> DataFrame:
    profile = capability.effective_profile(_operations(spark, folder), _evidence(spark, folder), baseline="declared")
    return profile.select("operation_id", "state")


def _profile_documents(spark: SparkSession, folder: str) -> str:
    """One profile document per block of parts, the parts as operations."""
    path = scratch_path(spark, "profiles")
    operation = F.struct(
        F.concat(F.lit("ckan/"), F.when(F.col("p_partkey") % 2 == 0, F.lit("part.")).otherwise(F.lit("")), F.col("p_partkey")).alias("id"),
        _pick(_CLASSES, F.col("p_partkey") % 4).alias("capability"),
        F.when(F.col("p_partkey") % 3 == 0, F.lit("application-token-or-authenticated")).otherwise(F.lit("public")).alias("authentication"),
        F.lit("read").alias("mutation"),
        F.lit("anonymous-read").alias("evidence_requirement"),
    )
    documents = table(spark, folder, "part").groupBy(F.expr("p_partkey div 4000").alias("block")).agg(
        F.collect_list(operation).alias("operations")
    )
    document = F.struct(
        F.lit("1.0").alias("schema_version"),
        F.concat(F.lit("v"), F.col("block")).alias("profile_version"),
        F.lit("ckan").alias("platform"),
        F.lit("v3").alias("platform_api_version"),
        F.md5(F.col("block").cast("string")).alias("fixture_fingerprint"),
        "operations",
    )
    rows = documents.select(F.col("block").alias("bucket"), F.to_json(document).alias("doc"))
    rows.write.partitionBy("bucket").text(path)
    return path


@query(
    "load_profiles",
    f"""SELECT 'ckan/' || CASE WHEN p_partkey % 2 = 0 THEN 'part.' ELSE '' END || p_partkey AS operation_id, 'v' || p_partkey // 4000 AS profile_version,
          CASE WHEN p_partkey % 2 = 0 THEN 'part' ELSE 'profile' END AS service, CAST(p_partkey AS VARCHAR) AS method,
          {_sql_pick(_CLASSES, 'p_partkey % 4')} AS capability_class, CASE WHEN p_partkey % 3 = 0 THEN 'authenticated' ELSE 'public' END AS auth_class FROM part""",
)
def load_profiles(spark: SparkSession, folder: str) -> DataFrame:
    return capability.load_profiles(spark, _profile_documents(spark, folder)).select(
        "operation_id", "profile_version", "service", "method", "capability_class", "auth_class"
    )


@query(
    "profile_summary",
    "SELECT 'ckan' AS platform, 'v' || p_partkey // 4000 AS profile_version, 'v3' AS platform_api_version, count(*) AS operations FROM part GROUP BY ALL",
)
def profile_summary(spark: SparkSession, folder: str) -> DataFrame:
    return capability.profile_summary(capability.load_profiles(spark, _profile_documents(spark, folder)))


@query(
    "evidence_errors",
    """WITH e AS (SELECT 'ckan/part.' || CASE WHEN l_partkey % 30 = 0 THEN l_partkey + 1000000000 ELSE l_partkey END AS operation_id,
                  l_partkey % 30 = 0 AS undeclared FROM lineitem)
       SELECT operation_id, count(*) AS evidence_count, CASE WHEN bool_or(undeclared) THEN 'undeclared operation' ELSE 'duplicate evidence' END AS error
       FROM e GROUP BY operation_id HAVING bool_or(undeclared) OR count(*) > 1""",
)
def evidence_errors(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("l_partkey")
    probes = table(spark, folder, "lineitem").select(
        F.concat(F.lit("ckan/part."), key + F.when(key % 30 == 0, 10**9).otherwise(0)).alias("operation_id")
    )
    return capability.evidence_errors(_operations(spark, folder), probes)


@query(
    "guard_decisions",
    f"""WITH {_SQL_STATES}, r AS (SELECT l_orderkey, l_linenumber, 'ckan/part.' || CASE WHEN l_linenumber = 3 THEN -1 ELSE l_partkey END AS operation_id FROM lineitem),
       d AS (SELECT l_orderkey, l_linenumber, coalesce(state, 'unsupported') AS state FROM r LEFT JOIN s USING (operation_id))
       SELECT state, state NOT IN ('unsupported', 'unauthorized', 'forbidden', 'unavailable', 'deployment-disabled') AS allowed,
              CASE state WHEN 'unsupported' THEN 'Use a connector profile that declares the operation.'
                WHEN 'unauthorized' THEN 'Provide credentials with access to the operation.'
                WHEN 'forbidden' THEN 'Use credentials with the required role for the operation.'
                WHEN 'unavailable' THEN 'Retry after the target deployment is available.'
                WHEN 'deployment-disabled' THEN 'Enable the capability on the target deployment.' END AS remedy,
              count(*) AS requests FROM d GROUP BY ALL""",
)
def guard_decisions(spark: SparkSession, folder: str) -> DataFrame:
    part = F.when(F.col("l_linenumber") == 3, F.lit(-1)).otherwise(F.col("l_partkey"))
    requests = table(spark, folder, "lineitem").select(F.concat(F.lit("ckan/part."), part).alias("operation_id"))
    profile = capability.effective_profile(_operations(spark, folder), _evidence(spark, folder))
    decided = capability.guard_decisions(requests, profile)
    return decided.groupBy("state", "allowed", "remedy").agg(F.count(F.lit(1)).alias("requests"))


@query(
    "spec_violations",
    """SELECT 'ckan/part.' || p_partkey AS operation_id, 'read operations cannot be batch atomic' AS rule FROM part WHERE p_partkey % 10 = 0
       UNION ALL SELECT 'ckan/part.' || p_partkey, 'admin capability cannot be public' FROM part WHERE p_partkey % 12 = 3""",
)
def spec_violations(spark: SparkSession, folder: str) -> DataFrame:
    return capability.spec_violations(_operations(spark, folder))


@query(
    "evidence_violations",
    """WITH u AS (SELECT page_id, CASE page_id % 5 WHEN 0 THEN replace(url, '://', '://me@') WHEN 1 THEN regexp_replace(url, '^http:', 'https:') ELSE url END AS u, url AS t FROM pages)
       SELECT page_id, 'https' AS rule FROM u WHERE u NOT LIKE 'https://%'
       UNION ALL SELECT page_id, 'no user data' FROM u WHERE page_id % 5 = 0
       UNION ALL SELECT page_id, 'no query' FROM u WHERE contains(u, '?')
       UNION ALL SELECT page_id, 'no fragment' FROM u WHERE contains(u, '#')
       UNION ALL SELECT page_id, 'same origin' FROM u WHERE u NOT LIKE 'https://%' OR page_id % 5 = 0 OR t NOT LIKE 'https://%'""",
)
def evidence_violations(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("page_id") % 5
    observed = table(spark, folder, "pages").select(
        "page_id",
        F.when(kind == 0, F.replace("url", F.lit("://"), F.lit("://me@")))
        .when(kind == 1, F.regexp_replace("url", "^http:", "https:"))
        .otherwise(F.col("url"))
        .alias("url"),
        F.col("url").alias("target"),
    )
    return capability.evidence_violations(observed, "url", "target", ["page_id"])


@query(
    "latest_fresh",
    """WITH n AS (SELECT max(ts) AS now FROM events), l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
       SELECT user_id, event_id, event_type FROM l, n WHERE r = 1 AND now - ts < INTERVAL '6 hours'""",
)
def latest_fresh(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    now = events.agg(F.max("ts")).scalar()
    return capability.latest_fresh(events, now, 6 * 3600, ["user_id"], "ts", "event_id").select(
        "user_id", "event_id", "event_type"
    )


@query(
    "latest_or_declared",
    """WITH n AS (SELECT max(ts) AS now FROM events), l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events),
       f AS (SELECT user_id, event_id FROM l, n WHERE r = 1 AND now - ts < INTERVAL '6 hours')
       SELECT DISTINCT e.user_id, f.event_id, 'class-' || e.user_id % 3 AS declared, CASE WHEN f.user_id IS NULL THEN 'declared' ELSE 'observed' END AS source
       FROM events e LEFT JOIN f USING (user_id)""",
)
def latest_or_declared(spark: SparkSession, folder: str) -> DataFrame:
    """Every user, with fresh evidence or else the declared state."""
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    now = events.agg(F.max("ts")).scalar()
    fresh = capability.latest_fresh(events, now, 6 * 3600, ["user_id"], "ts", "event_id").select("user_id", "event_id")
    users = events.select("user_id", F.concat(F.lit("class-"), F.col("user_id") % 3).alias("declared")).distinct()
    return capability.fresh_or_declared(users, fresh, ["user_id"], "declared")


def _signed_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Pages with platform signatures put into some URLs and documents."""
    kind = F.col("page_id") % 6
    host = F.regexp_extract("url", "^(https?://[^/]*)", 1)
    return table(spark, folder, "pages").select(
        "page_id",
        case(
            [
                (kind == 0, F.concat(host, F.lit("/api/3/action/package_search?q=x"))),
                (kind == 1, F.concat(host, F.lit("/api/1/datasets/7"))),
                (kind == 2, F.concat(host, F.lit("/api/views.json"))),
            ],
            F.col("url"),
        ).alias("url"),
        F.when(kind == 3, F.concat(F.col("html"), F.lit("<meta name=generator content=udata>")))
        .otherwise(F.col("html"))
        .alias("html"),
    )


_SQL_SIGNED = """g AS (SELECT page_id, html || CASE WHEN page_id % 6 = 3 THEN '<meta name=generator content=udata>' ELSE '' END AS html,
    CASE page_id % 6 WHEN 0 THEN regexp_extract(url, '^(https?://[^/]*)', 1) || '/api/3/action/package_search?q=x'
       WHEN 1 THEN regexp_extract(url, '^(https?://[^/]*)', 1) || '/api/1/datasets/7'
       WHEN 2 THEN regexp_extract(url, '^(https?://[^/]*)', 1) || '/api/views.json' ELSE url END AS url FROM pages),
    f AS (SELECT g.page_id, g.url, kind, sign, platform FROM g, (VALUES ('path', '/api/3/action/package_search', 'ckan'),
        ('path', '/api/3/action/group_list', 'ckan'), ('path', '/api/1/datasets/', 'udata'), ('path', '/api/1/organizations/', 'udata'),
        ('path', '/api/catalog/v1', 'socrata'), ('path', '/api/views.json', 'socrata'), ('page', 'ckan', 'ckan'), ('page', 'udata', 'udata'),
        ('page', 'socrata', 'socrata')) v(kind, sign, platform)
      WHERE contains(CASE WHEN kind = 'path' THEN regexp_replace(regexp_replace(url, '^https?://[^/]*', ''), '[?#].*$', '') ELSE html END, sign))"""


@query("fingerprint_pages", f"WITH {_SQL_SIGNED} SELECT page_id, kind, sign, platform FROM f")
def fingerprint_pages(spark: SparkSession, folder: str) -> DataFrame:
    return capability.fingerprint_pages(_signed_pages(spark, folder), "url", "html").select(
        "page_id", "kind", "sign", "platform"
    )


@query(
    "detect_platform",
    """WITH e AS (SELECT user_id AS origin, CASE event_id % 3 WHEN 0 THEN 'ckan' WHEN 1 THEN 'udata' ELSE 'socrata' END AS platform,
                  event_type = 'purchase' AND event_id % 3 > 0 AS matched FROM events)
       SELECT origin, CASE WHEN bool_or(matched AND platform = 'ckan') THEN 'ckan' WHEN bool_or(matched AND platform = 'udata') THEN 'udata'
              WHEN bool_or(matched AND platform = 'socrata') THEN 'socrata' END AS platform,
              CASE WHEN bool_or(matched) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence, count(*) AS checks,
              count(CASE WHEN matched THEN 1 END) AS matches FROM e GROUP BY origin""",
)
def detect_platform(spark: SparkSession, folder: str) -> DataFrame:
    probes = table(spark, folder, "events").select(
        F.col("user_id").alias("origin"),
        _pick(capability.PLATFORMS, F.col("event_id") % 3).alias("platform"),
        ((F.col("event_type") == "purchase") & (F.col("event_id") % 3 > 0)).alias("matched"),
    )
    return capability.detection_rollup(probes)


@query(
    "page_platforms",
    f"""WITH {_SQL_SIGNED}, o AS (SELECT CASE WHEN regexp_matches(url, '^https://') THEN regexp_extract(url, '^(https://[^/?#]*)', 1) END AS origin, platform FROM f)
       SELECT origin, first(platform ORDER BY CASE platform WHEN 'ckan' THEN 0 WHEN 'udata' THEN 1 ELSE 2 END) AS platform, count(*) AS matches
       FROM o WHERE origin IS NOT NULL GROUP BY origin""",
)
def page_platforms(spark: SparkSession, folder: str) -> DataFrame:
    """Page signatures rolled up to origins."""
    found = capability.fingerprint_pages(_signed_pages(spark, folder), "url", "html").select(
        url_origin("url").alias("origin"), "platform", F.lit(True).alias("matched")
    )
    return capability.detection_rollup(found).where("origin IS NOT NULL").select("origin", "platform", "matches")


@query(
    "profile_drift",
    """SELECT lang || '-' || source AS profile_version, md5(CAST(max(n_chars) AS VARCHAR)) AS observed_fixture_fingerprint, true AS advisory_only
       FROM documents GROUP BY lang, source HAVING max(n_chars) <> max(CASE WHEN doc_id % 2 = 0 THEN n_chars ELSE 0 END)""",
)
def profile_drift(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    version = F.concat_ws("-", "lang", "source").alias("profile_version")

    def pinned(df: DataFrame, size) -> DataFrame:
        return df.groupBy(version).agg(F.md5(F.max(size).cast("string")).alias("fixture_fingerprint"))

    half = F.when(F.col("doc_id") % 2 == 0, F.col("n_chars")).otherwise(F.lit(0))
    return capability.profile_drift(pinned(documents, half), pinned(documents, F.col("n_chars")))


@query(
    "mutation_policy",
    """SELECT o_orderkey, CASE WHEN reason IS NOT NULL THEN 'rejected' WHEN o_orderkey % 7 = 0 THEN 'skipped' ELSE 'dispatch' END AS decision, reason FROM
       (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 AND o_orderkey % 3 <> 0 THEN 'confirmation required'
            WHEN o_orderkey % 7 = 0 AND o_orderkey % 5 = 0 THEN 'dry run not supported'
            WHEN o_orderkey % 4 <> 1 AND o_orderkey % 11 <> 0 THEN 'version token or overwrite required' END AS reason FROM orders)""",
)
def mutation_policy(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    requests = table(spark, folder, "orders").select(
        "o_orderkey",
        (key % 2 == 0).alias("destructive"),
        F.when(key % 3 == 0, F.lit(True)).alias("confirmed"),
        F.when(key % 4 == 1, F.concat(F.lit("v"), key)).otherwise(F.lit("")).alias("version_token"),
        (key % 11 == 0).alias("overwrite"),
        (key % 7 == 0).alias("dry_run"),
        (key % 5 != 0).alias("dry_run_supported"),
    )
    return capability.mutation_policy(requests).select("o_orderkey", "decision", "reason")


@query(
    "permission_check",
    """SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN CASE WHEN c_custkey % 2 = 0 THEN 'unauthenticated' ELSE 'forbidden' END
            WHEN c_custkey % 3 = 0 AND c_custkey % 2 = 0 THEN 'allowed' WHEN c_custkey % 3 = 0 THEN 'allowed' ELSE 'forbidden' END AS permission FROM customer""",
)
def permission_check(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    empty = F.array().cast("array<string>")
    nothing = key % 5 == 0
    requests = table(spark, folder, "customer").select(
        "c_custkey",
        F.array(F.lit("read"), F.lit("write")).alias("required_scopes"),
        F.array(F.lit("editor")).alias("required_roles"),
        F.when(nothing, empty)
        .when(key % 3 == 0, F.array(F.lit("write"), F.lit("read"), F.lit("x")))
        .otherwise(F.array(F.lit("read")))
        .alias("scopes"),
        F.when(nothing, empty).otherwise(F.array(F.lit("editor"))).alias("roles"),
        (key % 2 == 1).alias("authenticated"),
    )
    return capability.permission_check(requests).select("c_custkey", "permission")


# --- compliance: nations stand for operations, customers for outcomes ------------------------------------------------


@query(
    "case_matrix",
    """SELECT n_name AS operation_id, r_name AS outcome, mode, n_name || '[' || r_name || '][' || mode || ']' AS case_id
       FROM nation JOIN region ON n_regionkey = r_regionkey, (VALUES ('sync'), ('async')) m(mode)""",
)
def case_matrix(spark: SparkSession, folder: str) -> DataFrame:
    regions = table(spark, folder, "region").select(F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("outcome"))
    cases = table(spark, folder, "nation").join(regions, "n_regionkey").select(F.col("n_name").alias("operation_id"), "outcome")
    return reports.case_matrix(cases)


def _expected(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "customer").select(F.col("c_name").alias("case_id"))


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Outcomes of most customers and of a few nobody expects."""
    key = F.col("c_custkey")
    return table(spark, folder, "customer").where("c_custkey % 10 <> 0").select(
        F.when(key % 25 == 1, F.concat(F.lit("extra"), F.col("c_name"))).otherwise(F.col("c_name")).alias("case_id"),
        F.when(key % 2 == 0, F.lit("sync")).otherwise(F.lit("async")).alias("mode"),
        F.when(key % 7 == 0, F.lit("failed")).when(key % 7 == 1, F.lit("blocked")).otherwise(F.lit("passed")).alias("state"),
        F.col("c_mktsegment").alias("tier"),
    )


_SQL_OUTCOMES = """x AS (SELECT CASE WHEN c_custkey % 25 = 1 THEN 'extra' || c_name ELSE c_name END AS case_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'sync' ELSE 'async' END AS mode,
    CASE c_custkey % 7 WHEN 0 THEN 'failed' WHEN 1 THEN 'blocked' ELSE 'passed' END AS state, c_mktsegment AS tier
    FROM customer WHERE c_custkey % 10 <> 0)"""


@query(
    "report_gaps",
    f"""WITH {_SQL_OUTCOMES} SELECT c_name AS case_id, coalesce(state, 'missing') AS gap FROM customer LEFT JOIN x ON x.case_id = c_name
        WHERE coalesce(state, 'missing') <> 'passed'""",
)
def report_gaps(spark: SparkSession, folder: str) -> DataFrame:
    return reports.report_gaps(_expected(spark, folder), _outcomes(spark, folder))


@query(
    "coverage",
    f"""WITH {_SQL_OUTCOMES} SELECT 'mode' AS dimension, mode AS value, count(*) AS outcomes FROM x GROUP BY mode
        UNION ALL SELECT 'state', state, count(*) FROM x GROUP BY state UNION ALL SELECT 'tier', tier, count(*) FROM x GROUP BY tier""",
)
def coverage(spark: SparkSession, folder: str) -> DataFrame:
    return reports.coverage(_outcomes(spark, folder))


@query(
    "is_compliant",
    "SELECT true AS passed_only, false AS everything FROM region LIMIT 1",
)
def is_compliant(spark: SparkSession, folder: str) -> DataFrame:
    outcomes = _outcomes(spark, folder)
    passed = outcomes.where("state = 'passed'")
    return reports.is_compliant(passed.select("case_id"), passed).select(
        F.col("compliant").alias("passed_only"),
        reports.is_compliant(_expected(spark, folder), outcomes).scalar().alias("everything"),
    )


@query(
    "undeclared_cases",
    f"WITH {_SQL_OUTCOMES} SELECT case_id, mode, state FROM x WHERE case_id NOT IN (SELECT c_name FROM customer)",
)
def undeclared_cases(spark: SparkSession, folder: str) -> DataFrame:
    return reports.undeclared_cases(_outcomes(spark, folder), _expected(spark, folder)).select("case_id", "mode", "state")


@query(
    "case_set_diff",
    f"""WITH {_SQL_OUTCOMES} SELECT c_name AS case_id, 'expected only' AS side FROM customer WHERE c_name NOT IN (SELECT case_id FROM x)
        UNION ALL SELECT case_id, 'observed only' FROM x WHERE case_id NOT IN (SELECT c_name FROM customer)""",
)
def case_set_diff(spark: SparkSession, folder: str) -> DataFrame:
    return reports.case_set_diff(_expected(spark, folder), _outcomes(spark, folder))


@query(
    "duplicate_cases",
    "SELECT user_id, event_type, count(*) AS copies FROM events GROUP BY ALL HAVING count(*) > 1",
)
def duplicate_cases(spark: SparkSession, folder: str) -> DataFrame:
    return reports.duplicates(table(spark, folder, "events"), ["user_id", "event_type"])


_OUTCOMES = ("core", "missing-credentials", "forbidden", "unavailable", "rate-limited", "async-pending", "invalid-credentials")
_ERRORS = ("unauthenticated", "forbidden", "unsupported", "rate-limit", "validation")


@query(
    "case_outcomes",
    f"""WITH c AS (SELECT event_id, {_sql_pick(_OUTCOMES, 'event_id % 7')} AS outcome,
            CASE WHEN event_id % 3 = 0 THEN NULL ELSE {_sql_pick(_ERRORS, 'event_id % 5')} END AS error_class, user_id % 2 AS item_count FROM events)
        SELECT event_id, CASE WHEN outcome IN ('core', 'async-pending') THEN 'available' ELSE 'unavailable' END AS capability,
          CASE WHEN outcome IN ('core', 'async-pending') AND error_class IS NULL AND item_count > 0 THEN 'passed'
               WHEN error_class = CASE outcome WHEN 'missing-credentials' THEN 'unauthenticated' WHEN 'invalid-credentials' THEN 'unauthenticated'
                 WHEN 'forbidden' THEN 'forbidden' WHEN 'unavailable' THEN 'unsupported' WHEN 'rate-limited' THEN 'rate-limit' END THEN 'passed'
               ELSE 'failed' END AS state FROM c""",
)
def case_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("event_id")
    results = table(spark, folder, "events").select(
        "event_id",
        F.lit("ckan/x.y").alias("operation_id"),
        F.lit("sync").alias("mode"),
        _pick(_OUTCOMES, key % 7).alias("outcome"),
        F.when(key % 3 != 0, _pick(_ERRORS, key % 5)).alias("error_class"),
        (F.col("user_id") % 2).alias("item_count"),
    )
    return reports.case_outcomes(results).select("event_id", "capability", "state")


@query(
    "certify",
    """SELECT true AS platform_matches, true AS version_matches, false AS fingerprint_matches, true AS connector_matches,
              false AS complete, true AS unique_cases, false AS compliant, false AS certified FROM customer LIMIT 1""",
)
def certify(spark: SparkSession, folder: str) -> DataFrame:
    identities = table(spark, folder, "customer").agg(F.md5(F.max("c_name")).alias("f")).select(
        *[F.lit("ckan").alias(f"{s}_platform") for s in ("manifest", "fixture")],
        *[F.lit("2.11").alias(n) for n in ("manifest_profile_version", "fixture_profile_version", "profile_version", "report_profile_version")],
        F.col("f").alias("profile_fingerprint"),
        F.col("f").alias("fixture_fingerprint"),
        F.reverse("f").alias("report_fingerprint"),
        F.lit("acme/ckan").alias("report_connector_id"),
        F.lit("acme/ckan").alias("manifest_connector_id"),
    )
    return reports.certify(identities, _expected(spark, folder), _outcomes(spark, folder))


# --- bulk runs: orders are plans, their lines are items --------------------------------------------------------------


def _plan(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as plan items: one plan per customer modulo, one index per order."""
    return table(spark, folder, "orders").select(
        (F.col("o_orderkey") % 16).alias("plan_id"),
        F.floor(F.col("o_orderkey") / 16).alias("item_index"),
        F.concat(F.lit("ckan/dataset/"), F.col("o_custkey")).alias("target"),
    )


def _receipts(spark: SparkSession, folder: str) -> DataFrame:
    index = F.col("item_index")
    return (
        _plan(spark, folder)
        .where((index % 9 != 8) | (index < 20 * F.col("plan_id")))
        .select(
            "plan_id",
            "item_index",
            F.when(index % 13 == 5, F.lit("ckan/dataset/other")).otherwise(F.col("target")).alias("target"),
            case([(index % 5 == 0, F.lit("failed")), (index % 5 == 1, F.lit("skipped"))], F.lit("succeeded")).alias("outcome"),
        )
    )


_SQL_BULK = """plan AS (SELECT o_orderkey % 16 AS plan_id, o_orderkey // 16 AS item_index, 'ckan/dataset/' || o_custkey AS target FROM orders),
    receipts AS (SELECT plan_id, item_index, CASE WHEN item_index % 13 = 5 THEN 'ckan/dataset/other' ELSE target END AS target,
        CASE item_index % 5 WHEN 0 THEN 'failed' WHEN 1 THEN 'skipped' ELSE 'succeeded' END AS outcome
        FROM plan WHERE item_index % 9 <> 8 OR item_index < 20 * plan_id)"""


@query(
    "resume_pending",
    f"WITH {_SQL_BULK} SELECT plan_id, item_index, target FROM plan ANTI JOIN receipts USING (plan_id, item_index)",
)
def resume_pending(spark: SparkSession, folder: str) -> DataFrame:
    return bulk.resume_pending(_plan(spark, folder), _receipts(spark, folder))


@query(
    "receipt_mismatch",
    f"""WITH {_SQL_BULK} SELECT r.plan_id, r.item_index, p.target AS planned, r.target AS received FROM receipts r JOIN plan p USING (plan_id, item_index)
        WHERE r.target IS DISTINCT FROM p.target""",
)
def receipt_mismatch(spark: SparkSession, folder: str) -> DataFrame:
    return bulk.receipt_mismatch(_plan(spark, folder), _receipts(spark, folder))


@query(
    "bulk_summary",
    f"""WITH {_SQL_BULK} SELECT p.plan_id, p.total, r.succeeded, r.failed, r.skipped, r.settled, p.total - r.settled AS outstanding,
          CASE WHEN p.total > r.settled THEN 'cancelled' ELSE 'completed' END AS state
        FROM (SELECT plan_id, count(*) AS total FROM plan GROUP BY 1) p JOIN (SELECT plan_id, count(*) AS settled,
          count(*) FILTER (outcome = 'succeeded') AS succeeded, count(*) FILTER (outcome = 'failed') AS failed,
          count(*) FILTER (outcome = 'skipped') AS skipped FROM receipts GROUP BY 1) r USING (plan_id)""",
)
def bulk_summary(spark: SparkSession, folder: str) -> DataFrame:
    return bulk.bulk_summary(_plan(spark, folder), _receipts(spark, folder))


@query(
    "duplicate_plan_items",
    """SELECT o_orderkey % 16 AS plan_id, 'ckan/dataset/' || o_custkey AS item, count(*) AS copies FROM orders GROUP BY ALL HAVING count(*) > 1""",
)
def duplicate_plan_items(spark: SparkSession, folder: str) -> DataFrame:
    plan = _plan(spark, folder).select(
        "plan_id",
        F.lit("ckan").alias("platform"),
        F.lit("dataset").alias("resource_kind"),
        F.split_part("target", F.lit("/"), F.lit(3)).alias("value"),
    )
    return bulk.duplicate_plan_items(plan)


@query(
    "contiguous_prefix",
    f"""WITH {_SQL_BULK}, n AS (SELECT *, row_number() OVER (PARTITION BY plan_id ORDER BY item_index) - 1 AS rn FROM receipts)
        SELECT plan_id, item_index, outcome FROM n WHERE rn = item_index""",
)
def contiguous_prefix(spark: SparkSession, folder: str) -> DataFrame:
    return bulk.contiguous_prefix(_receipts(spark, folder)).select("plan_id", "item_index", "outcome")


@query(
    "checkpoint_violations",
    """WITH o AS (SELECT o_orderkey % 16 AS plan_id, o_orderkey // 16 AS position,
            o_orderkey // 16 - CASE WHEN (o_orderkey // 16) % 10 = 9 THEN 1 ELSE 0 END - CASE WHEN (o_orderkey // 16) % 17 = 5 THEN 3 ELSE 0 END AS item_index FROM orders),
         c AS (SELECT *, lag(item_index) OVER (PARTITION BY plan_id ORDER BY position) AS previous, p.total FROM o JOIN
               (SELECT o_orderkey % 16 AS plan_id, count(*) - 3 AS total FROM orders GROUP BY 1) p USING (plan_id)),
         v AS (SELECT plan_id, position, item_index, CASE WHEN item_index < 0 OR item_index >= total THEN 'index out of range'
               WHEN item_index = previous THEN 'duplicate index' WHEN item_index < previous THEN 'not increasing' END AS rule FROM c)
       SELECT * FROM v WHERE rule IS NOT NULL""",
)
def checkpoint_violations(spark: SparkSession, folder: str) -> DataFrame:
    plan = _plan(spark, folder)
    position = F.col("item_index")
    receipts = plan.select(
        "plan_id",
        position.alias("position"),
        (
            position - F.when(position % 10 == 9, 1).otherwise(0) - F.when(position % 17 == 5, 3).otherwise(0)
        ).alias("item_index"),
    )
    sizes = plan.groupBy("plan_id").agg((F.count(F.lit(1)) - 3).alias("total"))
    return bulk.checkpoint_violations(receipts, sizes)


# --- health and metrics ----------------------------------------------------------------------------------------------

_SQL_RUNS = """i AS (SELECT *, sum(CASE WHEN event_type IN ('signup', 'purchase') THEN 1 ELSE 0 END) OVER w AS run FROM events
        WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
    c AS (SELECT *, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, run ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS failure_count FROM i)"""


_SQL_NULL_USERS = "FROM (SELECT * REPLACE (CASE WHEN user_id % 3 <> 0 THEN user_id END AS user_id) FROM events)"


def _health_events(spark: SparkSession, folder: str):
    events = table(spark, folder, "events").select("user_id", "ts", "event_id", "event_type")
    kind = F.col("event_type")
    return events, ["user_id"], ["ts", "event_id"], kind == "error", kind.isin("signup", "purchase")


@query(
    "health_log",
    f"WITH {_SQL_RUNS} SELECT event_id, run::BIGINT AS run, failure_count::BIGINT AS failure_count, failure_count >= 3 AS open FROM c",
)
def health_log(spark: SparkSession, folder: str) -> DataFrame:
    log = health.health_log(*_health_events(spark, folder))
    return log.select("event_id", "run", "failure_count", "open")


@query(
    "health_runs",
    f"""WITH {_SQL_RUNS} SELECT user_id, run::BIGINT AS run, max(failure_count)::BIGINT AS failures, max(failure_count) >= 3 AS opened
        FROM c GROUP BY user_id, run HAVING max(failure_count) > 0""",
)
def health_runs(spark: SparkSession, folder: str) -> DataFrame:
    return health.health_runs(*_health_events(spark, folder))


@query(
    "health_state",
    f"""WITH {_SQL_RUNS}, l AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM c)
        SELECT user_id, failure_count::BIGINT AS failure_count, failure_count >= 3 AS open FROM l WHERE r = 1""",
)
def health_state(spark: SparkSession, folder: str) -> DataFrame:
    return health.health_state(*_health_events(spark, folder))


@query(
    "health_one_key",
    """WITH i AS (SELECT *, sum(CASE WHEN event_type IN ('signup', 'purchase') THEN 1 ELSE 0 END) OVER (ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS run FROM events)
       SELECT run::BIGINT AS run, count(*) FILTER (event_type = 'error') AS failures FROM i GROUP BY run HAVING count(*) FILTER (event_type = 'error') > 0""",
)
def health_one_key(spark: SparkSession, folder: str) -> DataFrame:
    """All events under one key: the worst skew there is."""
    events, keys, order, failure, reset = _health_events(spark, folder)
    one = events.withColumn("user_id", F.col("event_id") % 1)
    return health.health_runs(one, keys, order, failure, reset).select("run", "failures")


_SQL_METRICS = """m AS (SELECT event_id, ts, event_type AS operation_id, CASE WHEN user_id % 2 = 0 THEN 'ckan' ELSE 'udata' END AS platform,
        CASE WHEN event_id % 10 = 0 THEN 'breaker_state_change' ELSE 'ok' END AS outcome, event_id % 4 - 1 AS retry_count, value - 2 AS budget_usage FROM events)"""


def metric_events(events: DataFrame) -> DataFrame:
    return events.select(
        "ts",
        F.col("event_type").alias("operation_id"),
        F.when(F.col("user_id") % 2 == 0, F.lit("ckan")).otherwise(F.lit("udata")).alias("platform"),
        F.when(F.col("event_id") % 10 == 0, F.lit("breaker_state_change")).otherwise(F.lit("ok")).alias("outcome"),
        (F.col("event_id") % 4 - 1).alias("retry_count"),
        (F.col("value") - 2).alias("budget_usage"),
    )


@query(
    "retry_metrics",
    f"""WITH {_SQL_METRICS} SELECT operation_id, platform, outcome, coalesce(sum(retry_count) FILTER (retry_count > 0), 0)::BIGINT AS retries,
          count(*) FILTER (outcome = 'breaker_state_change') AS breaker_changes, count(*) FILTER (budget_usage >= 0) AS budget_samples,
          count(*) FILTER (budget_usage >= 0 AND budget_usage <= 5) AS budget_bucket_0,
          count(*) FILTER (budget_usage > 5 AND budget_usage <= 20) AS budget_bucket_1, count(*) FILTER (budget_usage > 20) AS budget_bucket_2
        FROM m GROUP BY ALL""",
)
def retry_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return health.retry_metrics(metric_events(table(spark, folder, "events")), bounds=[5.0, 20.0])


@query(
    "health_hot_keys",
    f"WITH {_SQL_RUNS.replace('FROM events', _SQL_NULL_USERS)} SELECT event_id, run::BIGINT AS run, failure_count::BIGINT AS failure_count, failure_count >= 3 AS open FROM c",
)
def health_hot_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The log again, with a third of all events under one key that is NULL."""
    events, keys, *rest = _health_events(spark, folder)
    hot = F.when(F.col("user_id") % 3 != 0, F.col("user_id")).alias("user_id")
    log = health.health_log(events.select(hot, *[c for c in events.columns if c != "user_id"]), keys, *rest)
    return log.select("event_id", "run", "failure_count", "open")


@query("last_n_events", "SELECT event_id, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000")
def last_n_events(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").select("ts", "event_id", "event_type")
    return health.last_n_events(events, ["ts", "event_id"], 1000).select("event_id", "event_type")


# --- catalog ---------------------------------------------------------------------------------------------------------


def _envelopes(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as catalog dataset records, sixteen to a page; every fifth page breaks the contract."""
    key = F.col("doc_id")
    record = F.struct(
        F.when(key % 9 == 4, 2).otherwise(1).alias("schema_version"),
        F.lit("dataset").alias("kind"),
        F.struct(
            F.lit("ckan").alias("platform"),
            F.when(key % 11 == 3, F.lit("user")).otherwise(F.lit("dataset")).alias("resource_kind"),
            key.cast("string").alias("value"),
        ).alias("id"),
        F.when(key % 7 == 2, F.lit("")).otherwise(F.col("source")).alias("name"),
        F.col("lang").alias("description"),
        F.create_map(F.when(key % 13 == 1, F.lit("plain")).otherwise(F.lit("org.example")), F.col("n_chars")).alias("extensions"),
    )
    page = F.expr("doc_id div 16")
    pages = table(spark, folder, "documents").groupBy(page.alias("page_no")).agg(F.collect_list(record).alias("items"))
    envelope = F.struct(
        F.lit(1).alias("schema_version"),
        F.when(F.col("page_no") % 5 == 4, F.lit("page")).otherwise(F.lit("result_envelope")).alias("kind"),
        "items",
        F.lit(None).cast("string").alias("page"),
        F.array().cast("array<string>").alias("warnings"),
        F.lit(None).cast("string").alias("platform"),
    )
    return pages.select("page_no", F.to_json(envelope, {"ignoreNullFields": "false"}).alias("document"))


@query(
    "decode_envelopes",
    """SELECT doc_id // 16 AS page_no, count(*) AS items, (doc_id // 16) % 5 = 4 AS rejected FROM documents WHERE (doc_id // 16) % 5 <> 4 GROUP BY ALL
       UNION ALL SELECT DISTINCT doc_id // 16, 0, true FROM documents WHERE (doc_id // 16) % 5 = 4""",
)
def decode_envelopes(spark: SparkSession, folder: str) -> DataFrame:
    items, rejects = catalog.decode_envelopes(_envelopes(spark, folder), "document")
    good = items.groupBy("page_no").agg(F.count(F.lit(1)).alias("items")).withColumn("rejected", F.lit(False))
    return good.unionAll(rejects.select("page_no", F.lit(0).cast("bigint"), F.lit(True)))


@query(
    "envelope_pages",
    """WITH p AS (SELECT doc_id // 16 AS page_no, count(*) AS n, string_agg(DISTINCT source, ',' ORDER BY source) AS s FROM documents GROUP BY 1)
       SELECT page_no, 'ckan' AS platform, n AS item_count, 1 AS warnings, CASE WHEN page_no > 0 THEN 'c' || page_no END AS cursor, 'c' || (page_no + 1) AS next_cursor,
              CASE WHEN page_no % 3 <> 0 THEN (SELECT count(*) FROM documents) END AS total_items, NULL AS reject_reason FROM p WHERE page_no % 7 NOT IN (2, 3)
       UNION ALL SELECT page_no, NULL, NULL, NULL, NULL, NULL, NULL, 'page' FROM p WHERE page_no % 7 IN (2, 3)""",
)
def envelope_pages(spark: SparkSession, folder: str) -> DataFrame:
    """Page information of listings, good and broken (a negative total, another kind)."""
    documents = table(spark, folder, "documents")
    number, total = F.col("page_no"), documents.agg(F.count(F.lit(1))).scalar()
    pages = documents.groupBy(F.expr("doc_id div 16").alias("page_no")).agg(F.collect_list("source").alias("items"))
    info = F.struct(
        F.lit(1).alias("schema_version"),
        F.when(number % 7 == 2, F.lit("page")).otherwise(F.lit("page_info")).alias("kind"),
        F.when(number > 0, F.concat(F.lit("c"), number)).alias("cursor"),
        F.concat(F.lit("c"), number + 1).alias("next_cursor"),
        F.when(number % 7 == 3, F.lit(-1)).when(number % 3 != 0, total).alias("total_items"),
    )
    envelope = F.struct(
        F.lit(1).alias("schema_version"),
        F.lit("result_envelope").alias("kind"),
        "items",
        info.alias("page"),
        F.array(F.struct(F.lit("slow").alias("code"))).alias("warnings"),
        F.lit("ckan").alias("platform"),
    )
    shaped = pages.select("page_no", F.to_json(envelope, {"ignoreNullFields": "false"}).alias("document"))
    good, bad = catalog.envelope_pages(shaped, "document", ["page_no"])
    return good.withColumn("warnings", F.size("warnings")).unionByName(
        bad.select("page_no", "reject_reason"), allowMissingColumns=True
    )


@query(
    "declared_operations",
    f"""WITH d(n, operation_id, capability_class) AS (VALUES {", ".join(f"({i}, '{o}', '{c}')" for i, (o, c) in enumerate(declared.listed()))})
        SELECT d.operation_id, d.capability_class AS state, count(*) AS requests FROM events e JOIN d ON e.event_id % {len(declared.listed())} = d.n GROUP BY ALL""",
)
def declared_operations(spark: SparkSession, folder: str) -> DataFrame:
    """Requests against the declared operations of the platforms, with the state they meet without any evidence."""
    names = [o for o, _ in declared.listed()]
    operations = declared.operations(spark)
    none = operations.limit(0).select("operation_id", F.lit(None).cast("string").alias("response_class"))
    profile = capability.effective_profile(operations, none, baseline="declared")
    wanted = F.get(F.array(*[F.lit(n) for n in names]), (F.col("event_id") % len(names)).cast("int"))
    requests = table(spark, folder, "events").select(wanted.alias("operation_id"))
    decided = capability.guard_decisions(requests, profile)
    return decided.groupBy("operation_id", "state").agg(F.count(F.lit(1)).alias("requests"))


@query(
    "dataset_records",
    """SELECT 'ckan' AS platform, CAST(doc_id AS VARCHAR) AS id, source AS name, lang AS description FROM documents
       WHERE (doc_id // 16) % 5 <> 4 AND doc_id % 9 <> 4 AND doc_id % 11 <> 3 AND doc_id % 7 <> 2 AND doc_id % 13 <> 1""",
)
def dataset_records(spark: SparkSession, folder: str) -> DataFrame:
    items, _ = catalog.decode_envelopes(_envelopes(spark, folder), "document")
    good, _ = catalog.records(items, "item", "dataset")
    return good.select("platform", "id", "name", "description")


@query(
    "rejected_records",
    """SELECT CASE WHEN doc_id % 9 = 4 THEN 'schema version or kind' WHEN doc_id % 13 = 1 THEN 'extensions' WHEN doc_id % 11 = 3 THEN 'id' ELSE 'name' END AS reject_reason,
              count(*) AS items
       FROM documents WHERE (doc_id // 16) % 5 <> 4 AND (doc_id % 9 = 4 OR doc_id % 11 = 3 OR doc_id % 7 = 2 OR doc_id % 13 = 1) GROUP BY 1""",
)
def rejected_records(spark: SparkSession, folder: str) -> DataFrame:
    items, _ = catalog.decode_envelopes(_envelopes(spark, folder), "document")
    _, bad = catalog.records(items, "item", "dataset")
    return bad.groupBy("reject_reason").agg(F.count(F.lit(1)).alias("items"))


def _person(spark: SparkSession, folder: str, kind: str, fields: list) -> DataFrame:
    key = F.col("c_custkey").cast("string")
    identity = F.struct(F.lit("udata").alias("platform"), F.lit(kind).alias("resource_kind"), key.alias("value"))
    record = F.struct(
        F.lit(1).alias("schema_version"),
        F.lit(kind).alias("kind"),
        identity.alias("id"),
        *fields,
        F.create_map(F.lit("org.example"), F.col("c_nationkey")).alias("extensions"),
    )
    return table(spark, folder, "customer").select("c_custkey", F.to_json(record, {"ignoreNullFields": "false"}).alias("item"))


@query(
    "organization_records",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name FROM customer WHERE c_custkey % 6 <> 0",
)
def organization_records(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 6 != 0, F.col("c_name")).alias("name")
    items = _person(spark, folder, "organization", [name, F.col("c_mktsegment").alias("description")])
    return catalog.records(items, "item", "organization")[0].select("id", "name")


@query(
    "user_records",
    "SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS username, c_mktsegment AS display_name FROM customer WHERE c_custkey % 6 <> 0",
)
def user_records(spark: SparkSession, folder: str) -> DataFrame:
    name = F.when(F.col("c_custkey") % 6 != 0, F.col("c_name")).alias("username")
    items = _person(spark, folder, "user", [name, F.col("c_mktsegment").alias("display_name")])
    return catalog.records(items, "item", "user")[0].select("id", "username", "display_name")


@query(
    "resource_records",
    """SELECT CAST(page_id AS VARCHAR) AS id, CAST(page_id % 10 AS VARCHAR) AS dataset_id, 'p' || page_id AS name, CASE WHEN page_id % 3 > 0 THEN url END AS url
       FROM pages WHERE page_id % 5 <> 0 AND page_id % 7 <> 0""",
)
def resource_records(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("page_id")

    def identity(platform, kind, value):
        return F.struct(platform.alias("platform"), kind.alias("resource_kind"), value.cast("string").alias("value"))

    other = F.when(key % 5 == 0, F.lit("udata")).otherwise(F.lit("ckan"))
    parent = F.when(key % 7 == 0, F.lit("resource")).otherwise(F.lit("dataset"))
    record = F.struct(
        F.lit(1).alias("schema_version"),
        F.lit("resource").alias("kind"),
        identity(F.lit("ckan"), F.lit("resource"), key).alias("id"),
        identity(other, parent, key % 10).alias("dataset_id"),
        F.concat(F.lit("p"), key).alias("name"),
        F.when(key % 3 > 0, F.col("url")).alias("url"),
        F.create_map().cast("map<string,string>").alias("extensions"),
    )
    items = table(spark, folder, "pages").select(F.to_json(record, {"ignoreNullFields": "false"}).alias("item"))
    return catalog.records(items, "item", "resource")[0].select("id", "dataset_id", "name", "url")


@query(
    "native_records",
    """SELECT CAST(event_id AS VARCHAR) AS id, event_type AS resource_kind, '{"props":{"k":' || (props->>'k') || '},"user":' || user_id || '}' AS payload FROM events WHERE event_id % 4 <> 0""",
)
def native_records(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("event_id")
    kind = F.when(key % 4 == 0, F.lit("other")).otherwise(F.col("event_type"))
    record = F.concat(
        F.lit('{"schema_version":1,"kind":"native_record","platform":"ckan","resource_kind":"'),
        F.col("event_type"),
        F.lit('","id":{"platform":"ckan","resource_kind":"'),
        kind,
        F.lit('","value":"'),
        key,
        F.lit('"},"extensions":{},"payload":{"user":'),
        F.col("user_id"),
        F.lit(',"props":'),
        F.col("props"),
        F.lit("}}"),
    )
    items = table(spark, folder, "events").select(record.alias("item"))
    good, _ = catalog.records(items, "item", "native")
    return good.select("id", "resource_kind", F.to_json("payload").alias("payload"))


@query(
    "extension_keys",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN lang ELSE '.' || lang || '.x' END AS extension FROM documents WHERE doc_id % 4 < 2""",
)
def extension_keys(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("doc_id") % 4
    name = case(
        [(kind == 0, F.col("lang")), (kind == 1, F.concat(F.lit("."), F.col("lang"), F.lit(".x")))],
        F.concat(F.lit("org.example-"), F.col("lang")),
    )
    documents = table(spark, folder, "documents").select("doc_id", F.create_map(name, F.col("source")).alias("extensions"))
    return catalog.bad_extension_keys(documents, "extensions", ["doc_id"])


@query(
    "page_chain",
    """WITH p AS (SELECT lang AS listing_id, doc_id // 16 AS page_no, count(*) AS n FROM documents GROUP BY ALL),
       g AS (SELECT *, row_number() OVER (PARTITION BY listing_id ORDER BY page_no) - 1 AS i FROM p)
       SELECT listing_id, i AS page_no, 'cursor' AS problem FROM g WHERE i > 0 AND i % 6 = 5
       UNION ALL SELECT listing_id, NULL, 'total' FROM g WHERE listing_id IN ('de', 'es') GROUP BY listing_id""",
)
def page_chain(spark: SparkSession, folder: str) -> DataFrame:
    """Listings of documents by language; some cursors and two totals are made wrong."""
    from lakegate.operators.ordering import with_row_number

    pages = table(spark, folder, "documents").groupBy(
        F.col("lang").alias("listing_id"), F.expr("doc_id div 16").alias("page")
    ).agg(F.count(F.lit(1)).alias("item_count"))
    numbered = with_row_number(pages, ["listing_id", "page"], "at")
    first = numbered.groupBy("listing_id").agg(F.min("at").alias("first"), F.sum("item_count").alias("total"))
    listed = numbered.join(first, "listing_id").withColumn("page_no", F.col("at") - F.col("first"))
    shaped = listed.select(
        "listing_id",
        "page_no",
        F.when(F.col("page_no") > 0, F.concat(F.lit("c"), F.col("page_no"))).alias("cursor"),
        F.concat(F.lit("c"), F.col("page_no") + F.when(F.col("page_no") % 6 == 4, 2).otherwise(1)).alias("next_cursor"),
        (F.col("total") + F.when(F.col("listing_id").isin("de", "es"), 1).otherwise(0)).alias("total_items"),
        "item_count",
    )
    return catalog.page_chain(shaped)


@query(
    "apply_patches",
    """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'renamed ' || c_custkey ELSE c_name END AS c_name, c_nationkey,
              CASE WHEN c_custkey % 6 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN 10.5 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer""",
)
def apply_patches(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("c_custkey")
    customers = table(spark, folder, "customer")

    def field(name, state, value):
        return F.struct(F.lit(name).alias("name"), F.lit(state).alias("state"), value.cast("string").alias("value"))

    patches = customers.where("c_custkey % 2 = 0").select(
        "c_custkey",
        F.array(
            field("c_name", "value", F.concat(F.lit("renamed "), key)),
            field("c_mktsegment", "unset", F.lit(None)),
            field("c_acctbal", "value", F.when(key % 6 != 0, F.lit(10.5))),
        ).alias("fields"),
    )
    return catalog.apply_patches(
        customers, patches, "c_custkey", {"c_name": T.StringType(), "c_mktsegment": T.StringType(), "c_acctbal": T.DoubleType()}
    )


@query(
    "patch_errors",
    """SELECT c_custkey, CASE c_custkey % 4 WHEN 0 THEN 'blank name' WHEN 1 THEN 'duplicate name' ELSE 'state' END AS reason FROM customer WHERE c_custkey % 4 < 3""",
)
def patch_errors(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("c_custkey") % 4

    def field(name, state):
        return F.struct(name.alias("name"), state.alias("state"), F.col("c_name").alias("value"))

    patches = table(spark, folder, "customer").select(
        "c_custkey",
        F.array(
            field(F.lit("a"), F.when(kind == 2, F.lit("gone")).otherwise(F.lit("value"))),
            field(case([(kind == 0, F.lit("")), (kind == 1, F.lit("a"))], F.lit("b")), F.lit("unset")),
        ).alias("fields"),
    )
    return catalog.patch_errors(patches, "fields", ["c_custkey"])


@query(
    "search_catalog",
    """WITH h AS (SELECT * FROM documents WHERE contains(lower(text), 'the') AND lang IN ('en', 'de'))
       SELECT doc_id, lang, source, n_chars, (SELECT count(*) FROM h) AS total, 2 AS page, (SELECT count(*) FROM h) > 50 AS has_next
       FROM h ORDER BY n_chars DESC, doc_id LIMIT 25 OFFSET 25""",
)
def search_catalog(spark: SparkSession, folder: str) -> DataFrame:
    found = catalog.search_catalog(
        table(spark, folder, "documents"),
        text="the",
        text_columns=["text"],
        any_of={"lang": ["en", "de"]},
        sort=[F.col("n_chars").desc(), F.col("doc_id")],
        limit=25,
        offset=25,
    )
    return found.drop("text")
