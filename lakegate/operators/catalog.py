"""Catalog envelopes, records, names, patches and search as tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakegate.errors import TransformFailure
from lakegate.functions.base import case, col, quoted
from lakegate.functions.rules import sanitize_table_name, valid_namespace
from lakegate.operators.violations import checked_documents, exactly
from lakegate.functions.urls import (
    canonical_identity,
    file_name,
    format_from_url,
    local_path,
    route_access,
    sanitize_uri,
    url_decision,
    with_parts,
)

# Fixed values.
ENVELOPE_KEYS = ("schema_version", "kind", "items", "page", "warnings", "platform")
RECORD_KEYS = {
    "dataset": ("schema_version", "kind", "id", "name", "description", "extensions"),
    "resource": ("schema_version", "kind", "id", "dataset_id", "name", "url", "extensions"),
    "organization": ("schema_version", "kind", "id", "name", "description", "extensions"),
    "user": ("schema_version", "kind", "id", "username", "display_name", "extensions"),
    "native": ("schema_version", "kind", "platform", "resource_kind", "id", "payload", "extensions"),
}
LOCATOR_KEYS = ("schema_version", "kind", "uri", "format", "media_type", "extensions")
PAGE_KEYS = ("schema_version", "kind", "cursor", "next_cursor", "total_items")
RESERVED_TABLE = "resources"


def decode_envelopes(pages: DataFrame, document: str) -> tuple[DataFrame, DataFrame]:
    """Page documents to one row per item, and the pages that break the contract."""

    def build(d: Column, keys: Column):
        return {"items": d["items"]}, [
            ("keys", exactly(keys, ENVELOPE_KEYS)),
            ("schema version or kind", (d["schema_version"] == 1) & (d["kind"] == "result_envelope")),
            ("items", d["items"].isNotNull()),
            ("warnings", d["warnings"].isNotNull()),
        ]

    schema = "schema_version bigint, kind string, items array<variant>, warnings array<variant>"
    good, bad = checked_documents(pages, document, schema, build)
    others = [c for c in good.columns if c != "items"]
    return good.select(*others, F.posexplode("items").alias("item_index", "_item")).select(
        *others, "item_index", F.to_json("_item").alias("item")
    ), bad


def envelope_pages(pages: DataFrame, document: str, order: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Page documents to one row per page, ready for :func:`page_chain`, and those whose page information is broken.

    Besides the other columns: platform, item_count, warnings (as JSON), cursor, next_cursor and total_items; a page
    without page information has NULLs there. ``order`` names the columns that must be known to place a page.
    """
    page = "struct<schema_version:bigint,kind:string,cursor:string,next_cursor:string,total_items:bigint>"
    schema = f"schema_version bigint, kind string, items array<variant>, warnings array<variant>, platform string, page {page}"

    def build(d: Column, keys: Column):
        p = d["page"]
        raw = F.get_json_object(F.col(document), "$.page")
        info = F.json_object_keys(raw)
        known = (p["schema_version"] == 1) & (p["kind"] == "page_info") & exactly(info, PAGE_KEYS)
        total_given = F.get_json_object(F.col(document), "$.page.total_items").isNotNull()
        total = (p["total_items"] >= 0) | ~total_given
        columns = {
            "platform": d["platform"],
            "item_count": F.size(d["items"]).cast("long"),
            "warnings": F.transform(d["warnings"], lambda w: F.to_json(w)),
            "cursor": p["cursor"],
            "next_cursor": p["next_cursor"],
            "total_items": p["total_items"],
        }
        return columns, [
            ("keys", exactly(keys, ENVELOPE_KEYS)),
            ("schema version or kind", (d["schema_version"] == 1) & (d["kind"] == "result_envelope")),
            ("items", d["items"].isNotNull()),
            ("warnings", d["warnings"].isNotNull()),
            ("page", raw.isNull() | F.coalesce(known & total, F.lit(False))),
            *[(f"no {name}", F.col(name).isNotNull()) for name in order],
        ]

    return checked_documents(pages, document, schema, build)


_ID = "struct<platform:string,resource_kind:string,value:string>"


def records(items: DataFrame, item: str, kind: str) -> tuple[DataFrame, DataFrame]:
    """Items of one kind as typed rows, and the rejected ones with the first broken rule.

    The payload and extensions stay VARIANT, so nothing of them is lost.
    """
    keys = RECORD_KEYS[kind]
    types = {"schema_version": "bigint", "id": _ID, "dataset_id": _ID, "extensions": "map<string,variant>", "payload": "variant"}
    schema = ", ".join(f"{k} {types.get(k, 'string')}" for k in keys)
    envelope = "native_record" if kind == "native" else kind

    def build(d: Column, found: Column):
        rules = [
            ("keys", exactly(found, keys)),
            ("schema version or kind", (d["schema_version"] == 1) & (d["kind"] == envelope)),
            ("extensions", F.forall(F.map_keys(d["extensions"]), valid_namespace)),
        ]
        if kind == "native":
            rules.append(
                ("id", (d["id"]["platform"] == d["platform"]) & (d["id"]["resource_kind"] == d["resource_kind"]))
            )
        else:
            rules.append(("id", d["id"]["resource_kind"] == kind))
        if kind in ("dataset", "resource", "organization"):
            rules.append(("name", F.coalesce(d["name"], F.lit("")) != ""))
        if kind == "user":
            rules.append(("name", F.coalesce(d["username"], F.lit("")) != ""))
        if kind == "resource":
            rules.append(("dataset", d["dataset_id"]["resource_kind"] == "dataset"))
            rules.append(("same platform", d["dataset_id"]["platform"] == d["id"]["platform"]))
        columns = {"platform": d["id"]["platform"], "id": d["id"]["value"]}
        for key in keys:
            if key == "dataset_id":
                columns[key] = d[key]["value"]
            elif key not in ("schema_version", "kind", "id", "platform"):
                columns[key] = d[key]
        return columns, rules

    return checked_documents(items, item, schema, build)


def decode_locators(rows: DataFrame, document: str) -> tuple[DataFrame, DataFrame]:
    """Stored resource locators as rows, and the ones that break the contract: no credentials may be stored in them."""

    def build(d: Column, keys: Column):
        columns = {n: d[n] for n in ("uri", "format", "media_type", "extensions")}
        return columns, [
            ("keys", exactly(keys, LOCATOR_KEYS)),
            ("schema version or kind", (d["schema_version"] == 1) & (d["kind"] == "direct")),
            ("uri", d["uri"] != ""),
            ("credentials", with_parts(d["uri"], lambda p: ~p.netloc.contains("@") & ~p.malformed)),
            ("extensions", F.forall(F.map_keys(d["extensions"]), valid_namespace)),
        ]

    schema = "schema_version bigint, kind string, uri string, format string, media_type string, extensions map<string,variant>"
    return checked_documents(rows, document, schema, build)


def encode_locators(locators: DataFrame) -> DataFrame:
    """Locator rows as documents, with the URL in its display form: secrets never reach a stored locator."""
    document = F.struct(
        F.lit(1).alias("schema_version"),
        F.lit("direct").alias("kind"),
        sanitize_uri("uri").alias("uri"),
        "format",
        "media_type",
        F.create_map().cast("map<string,string>").alias("extensions"),
    )
    others = [c for c in locators.columns if c not in ("uri", "format", "media_type")]
    return locators.select(*others, F.to_json(document, {"ignoreNullFields": "false"}).alias("document"))


def bad_extension_keys(df: DataFrame, extensions: str, keys: Sequence[str]) -> DataFrame:
    """Extension names without a dotted namespace."""
    return df.select(*keys, F.explode(F.map_keys(extensions)).alias("extension")).where(~valid_namespace("extension"))


def page_chain(pages: DataFrame) -> DataFrame:
    """Breaks in a listing: a cursor that is not the one announced before, or a total that does not add up.

    ``pages``: listing_id, page_no (without holes), cursor, next_cursor, total_items, item_count. A page meets its
    predecessor by an equi-join on (listing, page number), so a long listing is spread over many tasks.
    """
    previous = pages.select("listing_id", (F.col("page_no") + 1).alias("page_no"), F.col("next_cursor").alias("announced"))
    broken = (
        pages.join(previous, ["listing_id", "page_no"], "left")
        .where((F.col("page_no") > 0) & ~F.col("cursor").eqNullSafe(F.col("announced")))
        .select("listing_id", F.col("page_no").cast("long").alias("page_no"), F.lit("cursor").alias("problem"))
    )
    totals = (
        pages.groupBy("listing_id")
        .agg(F.sum("item_count").alias("items"), F.max("total_items").alias("total"), F.min("total_items").alias("least"))
        .where("total IS NOT NULL AND (items <> total OR least < 0)")
        .select("listing_id", F.lit(None).cast("long").alias("page_no"), F.lit("total").alias("problem"))
    )
    return broken.unionAll(totals)


def resolve_locators(locators: DataFrame, uri: str) -> DataFrame:
    """Locators to resource rows: id, name, URL for display, format, access kind and where the bytes are."""
    return locators.select(
        *locators.columns,
        F.sha2(sanitize_uri(uri), 256).alias("resource_id"),
        file_name(uri).alias("name"),
        F.coalesce(format_from_url(uri), F.lit("CSV")).alias("format"),
        route_access(uri).alias("access_kind"),
        local_path(uri).alias("locator"),
    )


def records_to_resources(df: DataFrame, record_id: str, url: str) -> DataFrame:
    """Catalog resource records to data resources; unusable URLs carry a reject reason."""
    decided = df.select("*", url_decision(url).alias("_d")).select(*df.columns, "_d.*")
    remote = F.col("access_kind") != "http_download"
    return decided.select(
        *df.columns,
        "access_kind",
        "locator",
        F.when(
            F.col("access_kind").isNotNull(),
            canonical_identity(F.col(record_id).cast("string"), url, F.when(remote, F.col("locator"))),
        ).alias("identity"),
        "reject_reason",
    )


def name_collisions(resources: DataFrame, resource_id: str, include_metadata: bool = True) -> DataFrame:
    """Table names that two ids share, or that are reserved for the metadata table."""
    named = resources.select(F.lower(sanitize_table_name(resource_id)).alias("table_name"), F.col(resource_id).alias("id"))
    per_id = named.groupBy("table_name", "id").agg(F.count(F.lit(1)).alias("copies"))
    grouped = per_id.groupBy("table_name").agg(
        F.sum("copies").alias("claims"), F.min("id").alias("first_id"), F.max("id").alias("last_id")
    )
    reserved = F.lit(include_metadata) & (F.col("table_name") == RESERVED_TABLE)
    return grouped.where((F.col("claims") > 1) | reserved).select(
        "table_name", "claims", "first_id", "last_id", reserved.alias("reserved")
    )


def resource_metadata(resources: DataFrame) -> DataFrame:
    return resources.select("id", "dataset_id", "name", "url")


def patch_wire(fields: Column) -> Column:
    """The part of a patch that is sent: fields in state ``value`` (their value may be NULL), ``unset`` ones left out."""
    sent = F.filter(fields, lambda f: f["state"] == "value")
    return F.map_from_entries(F.transform(sent, lambda f: F.struct(f["name"].alias("key"), f["value"].alias("value"))))


def patch_errors(patches: DataFrame, fields: str, keys: Sequence[str], allow_unset: bool = True) -> DataFrame:
    """Patches with blank or repeated field names, unknown states, or ``unset`` where a value is required."""
    names = F.transform(fields, lambda f: f["name"])
    states = ("value", "unset") if allow_unset else ("value",)
    reason = case(
        [
            (F.exists(names, lambda n: n.isNull() | (n == "")), F.lit("blank name")),
            (F.size(F.array_distinct(names)) < F.size(names), F.lit("duplicate name")),
            (F.exists(fields, lambda f: ~F.coalesce(f["state"].isin(*states), F.lit(False))), F.lit("state")),
        ]
    )
    return patches.select(*keys, reason.alias("reason")).where("reason IS NOT NULL")


def apply_patches(records_: DataFrame, patches: DataFrame, key: str, columns: Mapping[str, T.DataType]) -> DataFrame:
    """Apply one tri-state patch per key: a ``value`` replaces (also by NULL), anything else keeps what is there.

    ``patches``: the key and ``fields ARRAY<STRUCT<name, state, value STRING>>``.
    """
    unknown = [c for c in columns if c not in records_.columns]
    if unknown:
        raise TransformFailure(f"columns to patch {unknown!r} not in the records")
    wire = patches.select(key, patch_wire(F.col("fields")).alias("_wire"))

    def patched(name: str, kind: T.DataType) -> Column:
        given = F.coalesce(F.map_contains_key("_wire", F.lit(name)), F.lit(False))
        return F.when(given, F.col("_wire")[name].cast(kind)).otherwise(F.col(quoted(name))).alias(name)

    joined = records_.join(wire, key, "left")
    return joined.select(*[patched(c, columns[c]) if c in columns else F.col(quoted(c)) for c in records_.columns])


def search_catalog(
    df: DataFrame,
    text: str | None = None,
    text_columns: Sequence[str] = (),
    equals: Mapping[str, str] | None = None,
    any_of: Mapping[str, Sequence[str]] | None = None,
    sort: Sequence[Column] = (),
    *,
    limit: int,
    offset: int = 0,
) -> DataFrame:
    """One page of matches, each row with the total, the page number and whether more pages follow.

    ``any_of`` works on array columns and on plain ones. The total is a separate small aggregate; the page itself is a
    distributed top-n.
    """
    hits = df
    if text:
        found = [F.coalesce(F.lower(col(c)).contains(text.lower()), F.lit(False)) for c in text_columns]
        condition = found[0]
        for f in found[1:]:
            condition = condition | f
        hits = hits.where(condition)
    for name, value in (equals or {}).items():
        hits = hits.where(F.col(name) == value)
    for name, values in (any_of or {}).items():
        wanted = F.array(*[F.lit(v) for v in values])
        is_array = isinstance(df.schema[name].dataType, T.ArrayType)
        hits = hits.where(F.arrays_overlap(name, wanted) if is_array else F.col(name).isin(*values))
    total = hits.agg(F.count(F.lit(1)).alias("total")).scalar()
    ordered = hits.orderBy(*sort) if sort else hits
    page = ordered.offset(offset).limit(limit) if offset else ordered.limit(limit)
    return page.withColumn("total", total).select(
        *df.columns,
        "total",
        F.lit(offset // limit + 1).alias("page"),
        (F.col("total") > offset + limit).alias("has_next"),
    )
