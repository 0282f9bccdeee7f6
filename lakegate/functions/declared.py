"""Declared operations and contract cases of the supported catalog platforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Platform, profile version, API version, documentation, date read, fingerprint of the pinned cases.
PROFILES = (
    (
        "ckan",
        "2.11.5",
        "Action API v3",
        "https://docs.ckan.org/en/2.11/api/",
        "2026-08-15",
        "24ad7ecf6c72b6b5fb9351db9c1f0166e4701b5cc1f020156e7fbf4640190f06",
    ),
    (
        "udata",
        "17.3.0",
        "uData API v1",
        "https://udata.readthedocs.io/en/17.3/",
        "2026-08-15",
        "64545cfcdc5ba7177d15b458fd4097a41ee96c745383442654c383651dfa39f8",
    ),
    (
        "socrata",
        "3.0",
        "SODA 3",
        "https://dev.socrata.com/docs/endpoints",
        "2026-08-15",
        "5efa030b488733646893c5a785067e9b1e2df9e2e40040a6990ee21b2eafb16f",
    ),
)

# Operation, capability, authentication, mutation, evidence.
OPERATIONS = """
ckan/action-api-v3.discovery-help-and-status core public read anonymous-read
ckan/action-api-v3.dataset-list-show-search core public read anonymous-read
ckan/action-api-v3.dataset-create-update-patch-delete-purge authenticated authenticated delete controlled-environment-only
ckan/action-api-v3.resource-list-show-create-update-patch-delete-upload authenticated authenticated delete controlled-environment-only
ckan/action-api-v3.organization-list-show-create-update-delete-members admin privileged admin controlled-environment-only
ckan/action-api-v3.group-list-show-create-update-delete-members admin privileged admin controlled-environment-only
ckan/action-api-v3.user-list-show-create-update-delete-token-management admin privileged admin controlled-environment-only
ckan/action-api-v3.tags-vocabularies-and-licenses authenticated authenticated update controlled-environment-only
ckan/action-api-v3.relationships-followers-and-activity authenticated authenticated update controlled-environment-only
ckan/action-api-v3.resource-views authenticated authenticated update controlled-environment-only
ckan/datastore-extension.query-and-record-crud optional authenticated update controlled-environment-only
ckan/filestore.upload-and-resource-file-replacement optional authenticated update controlled-environment-only
ckan/plugin-provided-action-and-extension-probes optional public read deployment-probe
udata/api-v1.root-and-effective-profile-probe core public read anonymous-read
udata/api-v1.dataset-list-search-show-create-update-delete authenticated authenticated delete controlled-environment-only
udata/api-v1.dataset-resource-create-update-reorder-upload-delete authenticated authenticated delete controlled-environment-only
udata/api-v1.organizations-and-memberships authenticated authenticated update controlled-environment-only
udata/api-v1.users-me-and-api-token-management authenticated authenticated update controlled-environment-only
udata/api-v1.authentication-and-oauth-flows optional public read deployment-probe
udata/api-v1.taxonomies-licenses-frequencies-formats-badges-and-schemas core public read anonymous-read
udata/api-v1.followers-activities-discussions-and-reuses authenticated authenticated update controlled-environment-only
udata/api-v1.topics-territories-contact-points-and-dataservices optional public read deployment-probe
udata/api-v1.harvest-moderation-and-admin-operations admin privileged admin controlled-environment-only
udata/deployment-plugin-and-configuration-dependent-routes optional public read deployment-probe
socrata/soda-v3-query core application-token-or-authenticated read application-token-or-controlled-authentication
socrata/soda-v3-export core application-token-or-authenticated read application-token-or-controlled-authentication
socrata/soda-v3-row-create-update-upsert-delete authenticated authenticated delete controlled-environment-only
socrata/soda-v3-soql-query-types-and-format-negotiation core application-token-or-authenticated read application-token-or-controlled-authentication
socrata/catalog-discovery-and-view-metadata core public read deployment-probe
socrata/asset-dataset-metadata-and-permission-management optional privileged admin controlled-environment-only
socrata/user-current-identity-and-permission-probe authenticated authenticated read controlled-environment-only
socrata/application-token-basic-auth-and-oauth core authenticated read controlled-environment-only
socrata/async-request-status-rate-limit-and-request-id core application-token-or-authenticated read deployment-probe
"""

# Operation, expected outcome.
CASES = """
ckan/action-api-v3.dataset-list-show-search core
ckan/datastore-extension.query-and-record-crud optional
ckan/action-api-v3.dataset-create-update-patch-delete-purge authenticated-success
ckan/action-api-v3.dataset-create-update-patch-delete-purge missing-credentials
ckan/action-api-v3.dataset-create-update-patch-delete-purge invalid-credentials
ckan/action-api-v3.user-list-show-create-update-delete-token-management forbidden
ckan/plugin-provided-action-and-extension-probes deployment-disabled
ckan/action-api-v3.discovery-help-and-status unavailable
ckan/action-api-v3.resource-list-show-create-update-patch-delete-upload authenticated-success
ckan/action-api-v3.organization-list-show-create-update-delete-members authenticated-success
ckan/action-api-v3.group-list-show-create-update-delete-members authenticated-success
ckan/action-api-v3.tags-vocabularies-and-licenses authenticated-success
ckan/action-api-v3.relationships-followers-and-activity authenticated-success
ckan/action-api-v3.resource-views authenticated-success
ckan/filestore.upload-and-resource-file-replacement optional
udata/api-v1.root-and-effective-profile-probe core
udata/deployment-plugin-and-configuration-dependent-routes optional
udata/api-v1.dataset-list-search-show-create-update-delete authenticated-success
udata/api-v1.dataset-list-search-show-create-update-delete missing-credentials
udata/api-v1.dataset-list-search-show-create-update-delete invalid-credentials
udata/api-v1.harvest-moderation-and-admin-operations forbidden
udata/deployment-plugin-and-configuration-dependent-routes deployment-disabled
udata/api-v1.root-and-effective-profile-probe unavailable
udata/api-v1.dataset-resource-create-update-reorder-upload-delete authenticated-success
udata/api-v1.organizations-and-memberships authenticated-success
udata/api-v1.users-me-and-api-token-management authenticated-success
udata/api-v1.authentication-and-oauth-flows optional
udata/api-v1.taxonomies-licenses-frequencies-formats-badges-and-schemas core
udata/api-v1.followers-activities-discussions-and-reuses authenticated-success
udata/api-v1.topics-territories-contact-points-and-dataservices optional
socrata/soda-v3-query core
socrata/soda-v3-export core
socrata/soda-v3-row-create-update-upsert-delete authenticated-success
socrata/application-token-basic-auth-and-oauth authenticated-success
socrata/soda-v3-query missing-credentials
socrata/soda-v3-query invalid-credentials
socrata/asset-dataset-metadata-and-permission-management optional
socrata/user-current-identity-and-permission-probe forbidden
socrata/asset-dataset-metadata-and-permission-management deployment-disabled
socrata/async-request-status-rate-limit-and-request-id async-pending
socrata/async-request-status-rate-limit-and-request-id rate-limited
socrata/catalog-discovery-and-view-metadata unavailable
socrata/soda-v3-soql-query-types-and-format-negotiation core
"""


def profiles(spark: SparkSession) -> DataFrame:
    names = "platform profile_version platform_api_version official_source_uri source_accessed_at fixture_fingerprint"
    return spark.createDataFrame(list(PROFILES), ", ".join(f"{n} string" for n in names.split()))


def listed() -> list[tuple[str, str]]:
    """Operation and capability class, in the order declared."""
    return [(line.split()[0], line.split()[1]) for line in OPERATIONS.strip().splitlines()]


def operations(spark: SparkSession) -> DataFrame:
    """Declared operations in the layout of :func:`lakegate.operators.capability.load_profiles`."""
    from lakegate.operators.capability import operation_rows

    names = "id capability authentication mutation evidence_requirement"
    rows = [tuple(line.split()) for line in OPERATIONS.strip().splitlines()]
    declared = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names.split()))
    platform = declared.selectExpr("split_part(id, '/', 1) AS platform", "struct(*) AS op")
    return operation_rows(platform.join(profiles(spark), "platform"))


def cases(spark: SparkSession) -> DataFrame:
    rows = [tuple(line.split()) for line in CASES.strip().splitlines()]
    return spark.createDataFrame(rows, "operation_id string, outcome string")
