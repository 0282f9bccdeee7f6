"""Text rules: names, watermarks, HTTP outcomes and coordinates."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakegate.functions.base import ColumnOrName, case, col, contains_any, lookup

# Fixed values.
SECRET_IN_WATERMARK = (
    "signature",
    "credential",
    "password",
    "token",
    "secret",
    "bearer",
    "apikey",
    "api_key",
    "authorization",
    "://",
    "@",
    "?=",
)
ETAG = r'^(?:W/)?"[\x21\x23-\x7e\x80-\xff]*"$'
HTTP_DATE = r"^(?:[A-Za-z]{3}, *)?[0-9]{1,2} [A-Za-z]{3} [0-9]{4} [0-9]{2}:[0-9]{2}(?::[0-9]{2})? (?:GMT|UTC|[+-][0-9]{4})$"
EXTENSION_NAMESPACE = r"^[A-Za-z0-9][A-Za-z0-9.-]*[.][A-Za-z0-9][A-Za-z0-9.-]*$"
OPERATION_PART = r"^[a-z][a-z0-9_-]*\z"
RETRYABLE_STATUS = (408, 425, 429, 500, 502, 503, 504)


def sanitize_table_name(value: ColumnOrName) -> Column:
    """Any identifier to a table name of at most 64 safe characters."""
    name = F.regexp_replace(col(value), "[^A-Za-z0-9_]", "_")
    name = F.when(name == "", F.lit("_")).when(name.rlike("^[0-9]"), F.concat(F.lit("_"), name)).otherwise(name)
    return F.substring(name, 1, 64)


def valid_identifier(value: ColumnOrName) -> Column:
    return col(value).rlike(r"^[A-Za-z_][A-Za-z0-9_]*\z")


def safe_filename(value: ColumnOrName) -> Column:
    """Keep letters and digits of any script, and ``-_.`` and blanks."""
    return F.regexp_replace(col(value), r"[^\p{L}\p{N}_. -]", "")


def is_sha256(value: ColumnOrName) -> Column:
    return col(value).rlike(r"^[0-9a-fA-F]{64}\z")


def is_etag(value: ColumnOrName) -> Column:
    value = col(value)
    return value.rlike(ETAG.replace("$", r"\z")) & ~contains_any(F.lower(value), SECRET_IN_WATERMARK)


def http_date(value: ColumnOrName) -> Column:
    """Instant of an HTTP date in the fixed ``[Day,] dd Mon yyyy HH:mm[:ss] zone`` forms, else NULL."""
    value = col(value)
    plain = F.regexp_replace(value, "^[A-Za-z]{3}, *", "")
    plain = F.regexp_replace(plain, " (?:GMT|UTC)$", " +0000")
    full = F.regexp_replace(plain, r"( [0-9]{2}:[0-9]{2}) ", "$1:00 ")
    return F.when(value.rlike(HTTP_DATE), F.try_to_timestamp(full, F.lit("d MMM yyyy HH:mm:ss xx")))


def is_http_date(value: ColumnOrName) -> Column:
    return http_date(value).isNotNull()


def valid_watermark(value: ColumnOrName) -> Column:
    value = col(value)
    return F.coalesce(
        (value != "") & (F.length(value) <= 256) & (is_sha256(value) | is_etag(value) | is_http_date(value)),
        F.lit(False),
    )


def watermark_kind(value: ColumnOrName) -> Column:
    """Which conditional header a stored watermark goes into (NULL: none)."""
    value = col(value)
    return case(
        [
            (value.isNull() | is_sha256(value), F.lit(None).cast("string")),
            (value.startswith('"') | value.startswith("W/"), F.lit("If-None-Match")),
        ],
        F.lit("If-Modified-Since"),
    )


def preferred_watermark(headers: ColumnOrName) -> Column:
    """``ETag`` before ``Last-Modified``, header names in any case."""
    pairs = F.map_entries(col(headers))
    return F.coalesce(
        F.try_element_at(_values(pairs, "etag"), F.lit(-1)),
        F.try_element_at(_values(pairs, "last-modified"), F.lit(-1)),
    )


def _values(pairs: Column, name: str) -> Column:
    return F.transform(F.filter(pairs, lambda e: F.lower(e["key"]) == name), lambda e: e["value"])


class StatusClass(NamedTuple):
    error: Column
    state: Column
    advice: Column


def classify_status(status: ColumnOrName) -> StatusClass:
    """Error class, capability state and advice for an HTTP status of a failed call."""
    status = col(status)
    known = {
        401: ("unauthenticated", "unauthorized", "Provide valid credentials and retry the operation."),
        403: ("forbidden", "forbidden", "Use credentials with the required scope or role."),
        404: ("not-found", None, "Confirm the target identifier and deployment."),
        409: ("conflict", None, "Refresh the target version token before retrying."),
        422: ("validation", None, "Correct the request according to the platform validation details."),
        429: ("rate-limit", None, "Wait for Retry-After before retrying a safe operation."),
    }
    down = status.isNull() | (status >= 500)

    def pick(position: int, when_down: str, otherwise: str | None) -> Column:
        branches = [(status == code, F.lit(row[position]).cast("string")) for code, row in known.items()]
        return case([*branches, (down, F.lit(when_down))], F.lit(otherwise).cast("string"))

    return StatusClass(
        error=pick(0, "unavailable", "validation"),
        state=pick(1, "unavailable", None),
        advice=pick(2, "Retry after the deployment is available.", "Correct the request before retrying."),
    )


class Retry(NamedTuple):
    retry: Column
    delay: Column
    reason: Column


def retry_decision(
    attempt: ColumnOrName,
    max_attempts: ColumnOrName,
    status: ColumnOrName,
    retry_after: ColumnOrName,
    repeatable: ColumnOrName,
    budget: ColumnOrName,
) -> Retry:
    """Whether one more attempt is allowed, after which delay, and why."""
    attempt, status, retry_after, budget = col(attempt), col(status), col(retry_after), col(budget)
    wait = F.coalesce(
        retry_after.cast("double"), F.least(F.pow(F.lit(2.0), (attempt - 1).cast("double")), budget.cast("double"))
    )
    retryable = status.isNull() | status.isin(*RETRYABLE_STATUS)
    reason = case(
        [
            (~col(repeatable), F.lit("The operation is not safe to repeat.")),
            (attempt >= col(max_attempts), F.lit("The retry attempt limit is exhausted.")),
            (~retryable, F.lit("The response is not retryable.")),
            (wait > budget, F.lit("Retry-After exceeds the total time budget.")),
        ],
        F.lit("The response is retryable within the configured budget."),
    )
    allowed = reason == "The response is retryable within the configured budget."
    return Retry(retry=allowed, delay=F.when(allowed, wait), reason=reason)


def retry_after_seconds(value: ColumnOrName, now: ColumnOrName) -> Column:
    """Seconds to wait: a number, or an HTTP date minus ``now``; never negative, NULL when unreadable."""
    value = col(value)
    numeric = F.trim(value).try_cast("double")
    dated = (F.unix_micros(http_date(value)) - F.unix_micros(col(now).cast("timestamp"))) / 1e6
    return F.greatest(F.lit(0.0), F.coalesce(numeric, dated)) + F.when(
        F.coalesce(numeric, dated).isNotNull(), F.lit(0.0)
    )


def bound_bytes(body: ColumnOrName, limit: int) -> Column:
    if not 1 <= limit <= 65_536:
        raise ValueError("the byte bound must lie between 1 and 65536")
    return F.substring(col(body).cast("binary"), 1, limit)


class OperationName(NamedTuple):
    platform: Column
    service: Column
    method: Column


def parse_operation_id(value: ColumnOrName) -> OperationName:
    """``platform/service.method``; without a dot the service is ``profile``."""
    value = col(value)
    rest = F.regexp_extract(value, "(?s)^[^/]*/(.*)$", 1)
    dotted = rest.contains(".")
    return OperationName(
        platform=F.regexp_extract(value, "(?s)^([^/]*)/", 1),
        service=F.when(dotted, F.regexp_extract(rest, r"(?s)^([^.]*)\.", 1)).otherwise(F.lit("profile")),
        method=F.when(dotted, F.regexp_extract(rest, r"(?s)^[^.]*\.(.*)$", 1)).otherwise(rest),
    )


def valid_operation_id(value: ColumnOrName) -> Column:
    """Platform, service and method in lower-case vendor spelling."""
    op = parse_operation_id(value)
    return op.platform.rlike(OPERATION_PART) & op.service.rlike(OPERATION_PART) & op.method.rlike(OPERATION_PART)


def coordinate_text(value: ColumnOrName) -> Column:
    """A coordinate without a trailing ``.0``."""
    value = col(value)
    whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
    return F.when(whole, value.cast("bigint").cast("string")).otherwise(value.cast("string"))


def point_wkt(x: ColumnOrName, y: ColumnOrName) -> Column:
    return F.concat(F.lit("POINT ("), coordinate_text(x), F.lit(" "), coordinate_text(y), F.lit(")"))


def _number_text(node: Column) -> Column:
    """Text of one coordinate held in a VARIANT."""
    rendered = F.to_json(node)
    number = rendered.try_cast("double")
    integral = rendered.rlike(r"^-?[0-9]+\.0+$")
    return (
        F.when(integral, F.regexp_replace(rendered, r"\.0+$", ""))
        .when(rendered.rlike("[eE]") & (number == F.floor(number)), number.cast("decimal(38,0)").cast("string"))
        .otherwise(rendered)
    )


def _pair_text(point: Column) -> Column:
    xy = point.cast("array<variant>")
    return F.concat(_number_text(xy[0]), F.lit(" "), _number_text(xy[1]))


def _path_text(points: Column) -> Column:
    usable = F.filter(points.cast("array<variant>"), lambda p: F.size(p.cast("array<variant>")) >= 2)
    return F.array_join(F.transform(usable, _pair_text), ", ")


def _is_array(node: Column) -> Column:
    return F.coalesce(F.schema_of_variant(node).startswith("ARRAY"), F.lit(False))


def geometry_wkt(geometry: ColumnOrName, raw: Column | None = None) -> Column:
    """WKT of a GeoJSON geometry held as VARIANT; other kinds keep their compact JSON text, NULL gives ``''``.

    ``raw`` is that text where it is at hand, as a VARIANT does not keep the order of keys.
    """
    geometry = col(geometry)
    absent = geometry.isNull() | F.is_variant_null(geometry)
    kind = F.try_variant_get(geometry, "$.type", "string")
    coords = F.try_variant_get(geometry, "$.coordinates", "variant")
    listed = _is_array(coords)
    parts = F.when(listed, coords.cast("array<variant>"))
    rings = F.transform(
        F.filter(parts, _is_array), lambda ring: F.concat(F.lit("("), _path_text(ring), F.lit(")"))
    )
    return case(
        [
            (absent, F.lit("")),
            (
                (kind == "Point") & listed & (F.size(parts) >= 2),
                F.concat(F.lit("POINT ("), _pair_text(coords), F.lit(")")),
            ),
            ((kind == "LineString") & listed, F.concat(F.lit("LINESTRING ("), _path_text(coords), F.lit(")"))),
            ((kind == "Polygon") & listed, F.concat(F.lit("POLYGON ("), F.array_join(rings, ", "), F.lit(")"))),
        ],
        F.to_json(geometry) if raw is None else raw,
    )


def valid_namespace(value: ColumnOrName) -> Column:
    return col(value).rlike(EXTENSION_NAMESPACE)
