"""Compliance evidence: case matrices, outcomes, gaps, coverage and certification."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakegate.functions.base import case, lookup
from lakegate.operators.digest import table_fingerprint

# Fixed values.
MODES = ("sync", "async")
SUCCESS_CASES = ("core", "optional", "authenticated-success", "async-pending")
EXPECTED_ERRORS = {
    "missing-credentials": "unauthenticated",
    "invalid-credentials": "unauthenticated",
    "forbidden": "forbidden",
    "deployment-disabled": "unsupported",
    "unavailable": "unsupported",
    "rate-limited": "rate-limit",
}


def case_id(operation: str = "operation_id", outcome: str = "outcome", mode: str = "mode") -> Column:
    return F.concat(F.col(operation), F.lit("["), F.col(outcome), F.lit("]["), F.col(mode), F.lit("]"))


def case_matrix(cases: DataFrame) -> DataFrame:
    """Every declared case in both modes; a fixed array explodes, nothing is joined."""
    expanded = cases.select("operation_id", "outcome", F.explode(F.array(*[F.lit(m) for m in MODES])).alias("mode"))
    return expanded.withColumn("case_id", case_id()).orderBy("operation_id", "outcome", "mode")


def undeclared_cases(executed: DataFrame, declared: DataFrame, key: str = "case_id") -> DataFrame:
    return executed.join(declared.select(key), key, "left_anti")


def case_set_diff(expected: DataFrame, observed: DataFrame, key: str = "case_id") -> DataFrame:
    """Ids on one side only, from one aggregation over both sides: no join, so no key can be hot."""
    both = expected.select(key, F.lit(1).alias("e"), F.lit(0).alias("o")).unionAll(
        observed.select(key, F.lit(0), F.lit(1))
    )
    return (
        both.groupBy(key)
        .agg(F.max("e").alias("e"), F.max("o").alias("o"))
        .where("e <> o")
        .select(key, F.when(F.col("e") == 1, F.lit("expected only")).otherwise(F.lit("observed only")).alias("side"))
    )


def case_outcomes(results: DataFrame) -> DataFrame:
    """Judge raw results: a success case must return items, any other case must fail with its own error class.

    Input columns: ``operation_id, outcome, mode, error_class, item_count``.
    """
    succeeds = F.col("outcome").isin(*SUCCESS_CASES)
    returned = F.col("error_class").isNull() & (F.coalesce("item_count", F.lit(0)) > 0)
    rejected = F.coalesce(F.col("error_class") == lookup(F.col("outcome"), EXPECTED_ERRORS), F.lit(False))
    return results.select(
        *results.columns,
        case_id().alias("case_id"),
        F.when(succeeds, F.lit("available")).otherwise(F.lit("unavailable")).alias("capability"),
        F.when((succeeds & returned) | rejected, F.lit("passed")).otherwise(F.lit("failed")).alias("state"),
    )


def report_gaps(expected: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Expected cases that are missing or did not pass."""
    states = outcomes.select("case_id", "state")
    found = F.coalesce("state", F.lit("missing"))
    return (
        expected.select("case_id")
        .distinct()
        .join(states, "case_id", "left")
        .where(found != "passed")
        .select("case_id", found.alias("gap"))
    )


def coverage(outcomes: DataFrame, dimensions: Sequence[str] = ("mode", "state", "tier")) -> DataFrame:
    """Counts by every dimension in one pass over the outcomes."""
    one = F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).alias("value")) for d in dimensions]))
    return (
        outcomes.select(one.alias("d"))
        .groupBy("d.dimension", "d.value")
        .agg(F.count(F.lit(1)).alias("outcomes"))
        .orderBy("dimension", "value")
    )


def is_compliant(expected: DataFrame, outcomes: DataFrame) -> DataFrame:
    return report_gaps(expected, outcomes).agg((F.count(F.lit(1)) == 0).alias("compliant"))


def duplicates(df: DataFrame, keys: Sequence[str], name: str = "copies") -> DataFrame:
    """Keys that occur more than once (partial counts per task, so a hot key is cheap)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def report_fingerprint(outcomes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Digest of a report's outcomes; independent of their order and of how many there are."""
    return table_fingerprint(outcomes, by).select(*by, "row_count", "content_digest")


def certify(checks: DataFrame, expected: DataFrame, outcomes: DataFrame) -> DataFrame:
    """One row of named checks and the verdict.

    ``checks`` is one row with the identities of manifest, profile, fixture set and report.
    """
    named = checks.select(
        (F.col("manifest_platform") == F.col("fixture_platform")).alias("platform_matches"),
        (
            (F.col("manifest_profile_version") == F.col("fixture_profile_version"))
            & (F.col("profile_version") == F.col("fixture_profile_version"))
            & (F.col("report_profile_version") == F.col("fixture_profile_version"))
        ).alias("version_matches"),
        (
            (F.col("profile_fingerprint") == F.col("fixture_fingerprint"))
            & (F.col("report_fingerprint") == F.col("fixture_fingerprint"))
        ).alias("fingerprint_matches"),
        (F.col("report_connector_id") == F.col("manifest_connector_id")).alias("connector_matches"),
        _is_empty(case_set_diff(expected, outcomes)).alias("complete"),
        _is_empty(duplicates(expected, ["case_id"])).alias("unique_cases"),
        _is_empty(report_gaps(expected, outcomes)).alias("compliant"),
    )
    verdict = case([(~F.coalesce(F.col(c), F.lit(False)), F.lit(False)) for c in named.columns], F.lit(True))
    return named.withColumn("certified", verdict)


def _is_empty(findings: DataFrame) -> Column:
    return findings.agg(F.count(F.lit(1)) == 0).scalar()
