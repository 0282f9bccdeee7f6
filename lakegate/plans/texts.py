"""URL, redaction and text-rule plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakegate.functions import redact, rules, urls
from lakegate.functions.base import case
from lakegate.operators import catalog
from lakegate.operators.catalog import records_to_resources
from lakegate.operators.catalog import resolve_locators as resolve
from lakegate.operators.sync import unsafe_destinations as unsafe
from lakegate.operators.violations import violations
from lakegate.plans.registry import query, table

# Page URLs dressed up with what the operators must handle: user data, secrets, ports, other schemes, parent segments.
_SQL_URLS = """
u AS (SELECT page_id, CASE page_id % 8
    WHEN 0 THEN replace(url, '://', '://User:p%40ss@')
    WHEN 1 THEN regexp_replace(url, '[?#].*$', '') || '?q=a+b&Token=abc~*&empty=&flag'
    WHEN 2 THEN regexp_replace(replace(url, 'http:', 'https:'), '^(https?://[^/]*)', '\\1:8443')
    WHEN 3 THEN regexp_replace(url, '^https?://', 's3://')
    WHEN 4 THEN regexp_replace(regexp_replace(url, '^https?://[^/]*', 'file:///data'), '[?#].*$', '') || '/../x.csv'
    WHEN 5 THEN regexp_replace(url, '^https?://[^/]*', '')
    WHEN 6 THEN upper(url)
    ELSE url END AS url FROM pages)"""


def dressed_urls(spark: SparkSession, folder: str) -> DataFrame:
    url, kind = F.col("url"), F.col("page_id") % 8
    bare = F.regexp_replace(url, "[?#].*$", "")
    shaped = case(
        [
            (kind == 0, F.replace(url, F.lit("://"), F.lit("://User:p%40ss@"))),
            (kind == 1, F.concat(bare, F.lit("?q=a+b&Token=abc~*&empty=&flag"))),
            (
                kind == 2,
                F.regexp_replace(F.replace(url, F.lit("http:"), F.lit("https:")), "^(https?://[^/]*)", "$1:8443"),
            ),
            (kind == 3, F.regexp_replace(url, "^https?://", "s3://")),
            (kind == 4, F.concat(F.regexp_replace(F.regexp_replace(url, "^https?://[^/]*", "file:///data"), "[?#].*$", ""), F.lit("/../x.csv"))),
            (kind == 5, F.regexp_replace(url, "^https?://[^/]*", "")),
            (kind == 6, F.upper(url)),
        ],
        url,
    )
    return table(spark, folder, "pages").select("page_id", shaped.alias("url"))


# The parts of a URL, once, for the SQL side.
_SQL_PARTS = _SQL_URLS + """,
p AS (SELECT page_id, url,
    lower(regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)) AS scheme,
    regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) AS netloc,
    regexp_extract(regexp_replace(regexp_replace(url, '^[A-Za-z][A-Za-z0-9+.-]*:', ''), '^//[^/?#]*', ''), '^([^?#]*)', 1) AS path,
    regexp_extract(url, '\\?([^#]*)', 1) AS query,
    regexp_extract(url, '#(.*)$', 1) AS fragment FROM u),
h AS (SELECT *, lower(regexp_replace(netloc, '^.*@', '')) AS authority FROM p)"""

_SQL_QUERY = """list_transform(list_filter(string_split(query, '&'), lambda s: s <> ''), lambda s:
    {'name': url_decode(replace(split_part(s, '=', 1), '+', ' ')), 'value': url_decode(replace(regexp_replace(s, '^[^=]*=?', ''), '+', ' '))})"""


def _encoded(value: str, star: str) -> str:
    return f"replace(replace(url_encode({value}), '%20', '+'), '{'%2A' if star == '*' else '*'}', '{star}')"


@query(
    "sanitize_uri",
    f"""WITH {_SQL_PARTS}
    SELECT page_id, CASE WHEN scheme = '' THEN url ELSE
        scheme || ':' || CASE WHEN netloc <> '' OR scheme IN ('file', 'http', 'https') THEN '//' ELSE '' END || authority || path
        || CASE WHEN query = '' THEN '' ELSE '?' || array_to_string(list_transform({_SQL_QUERY}, lambda e:
            {_encoded("e.name", "*")} || '=' || CASE WHEN lower(e.name) IN ('api_key', 'apikey', 'token', 'access_token',
              'refresh_token', 'secret', 'signature', 'credential', 'password', 'x-api-key', 'x-api-token', 'x-auth-token')
              THEN '***' ELSE {_encoded("e.value", "*")} END), '&') END
        || CASE WHEN fragment = '' THEN '' ELSE '#' || fragment END END AS shown FROM h""",
)
def sanitize_uri(spark: SparkSession, folder: str) -> DataFrame:
    return dressed_urls(spark, folder).select("page_id", urls.sanitize_uri("url").alias("shown"))


@query(
    "strip_query",
    f"""WITH {_SQL_PARTS}
    SELECT page_id, CASE WHEN scheme = '' THEN '' ELSE scheme || ':' END
        || CASE WHEN netloc <> '' OR scheme IN ('file', 'http', 'https') THEN '//' ELSE '' END || netloc || path
        || CASE WHEN coalesce(pairs, '') = '' THEN '' ELSE '?' || pairs END AS shown
    FROM (SELECT *, array_to_string(list_transform(list_filter({_SQL_QUERY}, lambda e:
        NOT regexp_matches(lower(e.name), 'api_key|apikey|token|secret|password|passwd|credential|authorization|signature')),
        lambda e: {_encoded("e.name", "%2A")} || '=' || {_encoded("e.value", "%2A")}), '&') AS pairs FROM h)""",
)
def strip_query(spark: SparkSession, folder: str) -> DataFrame:
    return dressed_urls(spark, folder).select("page_id", urls.strip_query_credentials("url").alias("shown"))


@query(
    "url_origin",
    f"""WITH {_SQL_PARTS}
    SELECT page_id, CASE WHEN scheme = 'https' AND regexp_matches(url, '^https://') AND netloc <> '' AND NOT contains(netloc, '@')
             THEN 'https://' || regexp_replace(authority, ':(80|443)$', '')
         WHEN NOT regexp_matches(url, '^https?://') AND regexp_matches(url, '^[A-Za-z0-9]') THEN
             'https://' || lower(regexp_extract(url, '^([^:/?#]*)', 1)) END AS origin FROM h""",
)
def url_origin(spark: SparkSession, folder: str) -> DataFrame:
    return dressed_urls(spark, folder).select("page_id", urls.url_origin("url").alias("origin"))


@query(
    "route_access",
    f"""WITH {_SQL_PARTS}
    SELECT page_id, CASE WHEN scheme IN ('', 'file') THEN 'local_file'
        WHEN scheme IN ('s3', 'gs', 'gcs', 'az', 'azure', 'abfs') THEN 'object_storage' ELSE 'http_download' END AS access_kind FROM h""",
)
def route_access(spark: SparkSession, folder: str) -> DataFrame:
    return dressed_urls(spark, folder).select("page_id", urls.route_access("url").alias("access_kind"))


@query(
    "canonical_identity",
    f"""WITH {_SQL_PARTS}
    SELECT page_id, sha256(CASE WHEN scheme <> '' AND netloc <> '' THEN scheme || '://' || authority
        WHEN page_id % 3 = 0 THEN 'local:/mnt/' || page_id
        WHEN scheme <> '' AND path <> '' THEN scheme || ':' || path
        WHEN path <> '' THEN 'path:' || path ELSE 'local' END || '/' || page_id) AS identity FROM h""",
)
def canonical_identity(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("page_id").cast("string")
    locator = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("/mnt/"), key))
    return dressed_urls(spark, folder).select("page_id", urls.canonical_identity(key, "url", locator).alias("identity"))


@query(
    "destination_identity",
    f"""WITH {_SQL_PARTS}
    SELECT page_id, sha256(CASE WHEN scheme <> '' THEN scheme || '://' || authority || rtrim(path, '/')
        WHEN rtrim(path, '/') <> '' THEN rtrim(path, '/') ELSE rtrim(regexp_replace(url, '[?#].*$', ''), '/') END) AS identity FROM h""",
)
def destination_identity(spark: SparkSession, folder: str) -> DataFrame:
    return dressed_urls(spark, folder).select("page_id", urls.destination_identity("url").alias("identity"))


@query(
    "resolve_locators",
    f"""WITH {_SQL_PARTS}, n AS (SELECT *, regexp_extract(rtrim(path, '/'), '([^/]*)$', 1) AS last FROM h)
    SELECT page_id, nullif(last, '') AS name,
        CASE WHEN regexp_matches(last, '^[^.].*\\.[^.]+$') THEN upper(regexp_extract(last, '\\.([^.]+)$', 1)) ELSE 'CSV' END AS format,
        CASE WHEN scheme IN ('', 'file') THEN 'local_file' WHEN scheme = 's3' THEN 'object_storage' ELSE 'http_download' END AS access_kind,
        CASE WHEN scheme = 'file' THEN path ELSE url END AS locator
    FROM n WHERE netloc = authority""",
)
def resolve_locators(spark: SparkSession, folder: str) -> DataFrame:
    plain = dressed_urls(spark, folder)
    clean = plain.where(urls.with_parts("url", lambda p: p.netloc == F.lower(F.regexp_replace(p.netloc, "^.*@", ""))))
    return resolve(clean, "url").select("page_id", "name", "format", "access_kind", "locator")


@query(
    "decode_locators",
    f"""WITH {_SQL_PARTS} SELECT page_id, url AS uri, CASE WHEN page_id % 5 = 1 THEN 'CSV' END AS format, NULL::VARCHAR AS reject_reason FROM h
        WHERE NOT contains(netloc, '@') AND page_id % 5 <> 0
        UNION ALL SELECT page_id, NULL, NULL, CASE WHEN page_id % 5 = 0 THEN 'schema version or kind' ELSE 'credentials' END FROM h
        WHERE contains(netloc, '@') OR page_id % 5 = 0""",
)
def decode_locators(spark: SparkSession, folder: str) -> DataFrame:
    document = F.to_json(
        F.struct(
            F.when(F.col("page_id") % 5 == 0, F.lit(2)).otherwise(F.lit(1)).alias("schema_version"),
            F.lit("direct").alias("kind"),
            F.col("url").alias("uri"),
            F.when(F.col("page_id") % 5 == 1, F.lit("CSV")).alias("format"),
            F.lit(None).cast("string").alias("media_type"),
            F.create_map(F.lit("org.example"), F.lit(1)).alias("extensions"),
        ),
        {"ignoreNullFields": "false"},
    )
    stored = dressed_urls(spark, folder).select("page_id", document.alias("document"))
    good, bad = catalog.decode_locators(stored, "document")
    nothing = F.lit(None).cast("string")
    return good.select("page_id", "uri", "format", nothing.alias("reject_reason")).unionAll(
        bad.select("page_id", nothing, nothing, "reject_reason")
    )


@query(
    "locator_round_trip",
    f"""WITH {_SQL_PARTS} SELECT count(*) AS locators, 0::BIGINT AS rejected, 0::BIGINT AS with_secrets FROM h""",
)
def locator_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Locators written and read again: nothing is rejected, as no credential was stored."""
    plain = dressed_urls(spark, folder).select(
        "page_id", F.col("url").alias("uri"), F.lit("CSV").alias("format"), F.lit(None).cast("string").alias("media_type")
    )
    good, bad = catalog.decode_locators(catalog.encode_locators(plain), "document")
    return good.agg(
        F.count(F.lit(1)).alias("locators"),
        bad.agg(F.count(F.lit(1))).scalar().alias("rejected"),
        F.count_if(redact.has_credential("uri") & ~F.col("uri").contains("***")).alias("with_secrets"),
    )


@query(
    "record_to_resource",
    f"""WITH {_SQL_PARTS}
    SELECT page_id, CASE WHEN scheme IN ('http', 'https') THEN 'http_download' WHEN scheme = 's3' THEN 'object_storage'
        WHEN scheme IN ('', 'file') AND netloc IN ('', 'localhost') THEN 'local_file' END AS access_kind,
        CASE WHEN url IS NULL THEN 'missing url' WHEN scheme = 'ftp' THEN 'unsupported scheme'
        WHEN scheme = 'file' AND netloc NOT IN ('', 'localhost') THEN 'unsupported host' END AS reject_reason
    FROM (SELECT page_id, regexp_replace(url, '^file:///data/(e|d)', 'file://host/\\1') AS url,
                 CASE WHEN scheme = 'https' AND page_id % 5 = 0 THEN 'ftp' ELSE scheme END AS scheme,
                 CASE WHEN regexp_matches(url, '^file:///data/(e|d)') THEN 'host' ELSE netloc END AS netloc FROM h)""",
)
def record_to_resource(spark: SparkSession, folder: str) -> DataFrame:
    ftp = (F.col("page_id") % 5 == 0) & (F.lower(F.substring("url", 1, 6)) == "https:")
    url = F.regexp_replace("url", "^file:///data/(e|d)", "file://host/$1")
    varied = dressed_urls(spark, folder).select(
        "page_id", F.when(ftp, F.concat(F.lit("ftp"), F.expr("substring(url, 6)"))).otherwise(url).alias("url")
    )
    return records_to_resources(varied, "page_id", "url").select("page_id", "access_kind", "reject_reason")


@query(
    "format_from_url",
    """SELECT page_id, nullif(upper(regexp_extract(regexp_replace(url, '[?#].*$', ''), '^https?://[^/]*/.*[^/.][^/.]*\\.([^./]+)/*$', 1)), '')
              AS format FROM pages""",
)
def format_from_url(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select("page_id", urls.format_from_url("url").alias("format"))


_RAW_FORMATS = ["text/csv", " csv ", "Application/JSON", "application/geo+json", "xlsx", "application/pdf", "Parquet"]


@query(
    "normalize_format",
    """SELECT doc_id, CASE doc_id % 7 WHEN 0 THEN 'CSV' WHEN 1 THEN 'CSV' WHEN 2 THEN 'JSON' WHEN 3 THEN 'GEOJSON'
        WHEN 4 THEN 'XLSX' WHEN 5 THEN 'PDF' ELSE 'PARQUET' END AS format FROM documents""",
)
def normalize_format(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.array(*[F.lit(f) for f in _RAW_FORMATS])[(F.col("doc_id") % 7).cast("int")]
    return table(spark, folder, "documents").select("doc_id", urls.normalize_format(raw).alias("format"))


@query(
    "raw_media_type",
    """SELECT doc_id, CASE WHEN doc_id % 4 = 0 THEN 'text/' || lang WHEN doc_id % 4 = 1 THEN 'text/csv'
        WHEN doc_id % 4 = 2 THEN 'application/x-ndjson' ELSE 'application/octet-stream' END AS media_type FROM documents""",
)
def raw_media_type(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("doc_id") % 4
    media = F.when(kind == 0, F.concat(F.lit("text/"), F.col("lang"))).when(kind == 1, F.lit(""))
    fmt = case([(kind == 1, F.lit("CSV")), (kind == 2, F.lit("JSONL"))])
    return table(spark, folder, "documents").select("doc_id", urls.raw_media_type(media, fmt).alias("media_type"))


@query("unsafe_paths", f"WITH {_SQL_URLS} SELECT page_id FROM u WHERE page_id % 8 = 4 OR page_id % 16 = 15")
def unsafe_paths(spark: SparkSession, folder: str) -> DataFrame:
    climbing = F.when(F.col("page_id") % 16 == 15, F.concat(F.lit("a\\..\\"), F.col("url"))).otherwise(F.col("url"))
    return dressed_urls(spark, folder).where(urls.has_parent_segment(climbing)).select("page_id")


@query(
    "unsafe_destinations",
    f"""WITH {_SQL_PARTS} SELECT page_id FROM h
        WHERE contains(netloc, '@') OR query <> '' OR fragment <> '' OR length(url) > 4096 OR regexp_matches(url, '[\\x00-\\x1f]')""",
)
def unsafe_destinations(spark: SparkSession, folder: str) -> DataFrame:
    return unsafe(dressed_urls(spark, folder), "url").select("page_id")


# --- redaction -------------------------------------------------------------------------------------------------------

# Unicode-aware word boundaries and blanks spelled out, as the SQL side's \\b and \\s are ASCII only.
_KEYS = "authorization|private-key|private_key|consumer-key|consumer_key|access-key|access_key|client-key|client_key|credential|signature|password|api-key|api_key|apikey|cookie|passwd|secret|token|pwd"
_BLANK = "\\s\\p{Z}\\x1c-\\x1f\\x85"
def _sql_scrub(text: str) -> str:
    edge = "(^|[^\\p{L}\\p{N}_])"
    userinfo = f"regexp_replace({text}, '{edge}([a-z][a-z0-9+.-]*://[^@/{_BLANK}]*):([^@{_BLANK}]*)@', '\\1\\2:***@', 'gi')"
    pairs = (
        f"regexp_replace({userinfo}, '([?&;]|^|[^\\p{{L}}\\p{{N}}_])([^=&;{_BLANK}]*(?:{_KEYS})[^=&;{_BLANK}]*)=[^&;{_BLANK}]+',"
        " '\\1\\2=***', 'gi')"
    )
    return f"regexp_replace({pairs}, '{edge}(bearer|basic)[{_BLANK}]+[A-Za-z0-9._~+/=-]{{8,}}', '\\1\\2 ***', 'gi')"


# Texts with a credential, an authorisation scheme or a URL with user data appended, so that every rule has work.
_SQL_TEXTS = """CASE doc_id % 4 WHEN 0 THEN text || ' https://joe:' || doc_id || 'pw@host/x' WHEN 1 THEN 'see api_key=' || doc_id || 'abc&x=1 ' || text
    WHEN 2 THEN 'Authorization: Bearer abc.' || doc_id || '.defghi ' || text ELSE text END"""


def _texts(spark: SparkSession, folder: str) -> DataFrame:
    key, text = F.col("doc_id").cast("string"), F.col("text")
    kind = F.col("doc_id") % 4
    shaped = case(
        [
            (kind == 0, F.concat(text, F.lit(" https://joe:"), key, F.lit("pw@host/x"))),
            (kind == 1, F.concat(F.lit("see api_key="), key, F.lit("abc&x=1 "), text)),
            (kind == 2, F.concat(F.lit("Authorization: Bearer abc."), key, F.lit(".defghi "), text)),
        ],
        text,
    )
    return table(spark, folder, "documents").select("doc_id", shaped.alias("text"))


@query(
    "redact_text",
    f"SELECT doc_id, left({_sql_scrub('t')}, 256) AS shown FROM (SELECT doc_id, {_SQL_TEXTS} AS t FROM documents)",
)
def redact_text(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder).select("doc_id", redact.redact_text("text", redact.MAX_TEXT).alias("shown"))


@query(
    "scrub_text",
    f"""SELECT doc_id, length(s) AS scrubbed_chars, md5(s) AS scrubbed_md5
        FROM (SELECT doc_id, {_sql_scrub('t')} AS s FROM (SELECT doc_id, {_SQL_TEXTS} AS t FROM documents))""",
)
def scrub_text(spark: SparkSession, folder: str) -> DataFrame:
    """The whole text, masked but not cut."""
    scrubbed = _texts(spark, folder).select("doc_id", redact.scrub_text("text").alias("s"))
    return scrubbed.select("doc_id", F.length("s").cast("bigint").alias("scrubbed_chars"), F.md5("s").alias("scrubbed_md5"))


@query(
    "has_credential",
    f"""SELECT doc_id FROM (SELECT doc_id, {_SQL_TEXTS} AS t FROM documents) WHERE {_sql_scrub('t')} <> t
        OR regexp_matches(t, '(?i)=\\*\\*\\*')""",
)
def has_credential(spark: SparkSession, folder: str) -> DataFrame:
    return _texts(spark, folder).where(redact.has_credential("text")).select("doc_id")


@query(
    "redact_report",
    """SELECT doc_id, CASE WHEN length(t) <= 256 THEN regexp_replace(t,
        '(authorization|api[-_ ]?key|token|secret|password|cookie)[\\s\\p{Z}]*[:=][\\s\\p{Z}]*(?:bearer[\\s\\p{Z}]+)?[^\\s\\p{Z},;]+',
        '\\1: [REDACTED]', 'gi') END AS shown
       FROM (SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'Api-Key = k' || doc_id || ', token:bearer xyz; ' || source
             WHEN 1 THEN source || ' ' || lang ELSE text END AS t FROM documents)""",
)
def redact_report(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("doc_id").cast("string")
    text = case(
        [
            (
                F.col("doc_id") % 3 == 0,
                F.concat(F.lit("Api-Key = k"), key, F.lit(", token:bearer xyz; "), F.col("source")),
            ),
            (F.col("doc_id") % 3 == 1, F.concat_ws(" ", "source", "lang")),
        ],
        F.col("text"),
    )
    return table(spark, folder, "documents").select("doc_id", redact.redact_report_text(text, redact.MAX_TEXT).alias("shown"))


def _props(spark: SparkSession, folder: str) -> DataFrame:
    """Event properties as maps, with a sensitive key, a credential-shaped value and a plain one added."""
    key = F.col("event_id").cast("string")
    extra = F.create_map(
        F.when(F.col("event_id") % 2 == 0, F.lit("X-Auth-Token")).otherwise(F.lit("note")),
        F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("basic abcdefgh"), key)).otherwise(key),
    )
    return table(spark, folder, "events").select(
        "event_id", F.map_concat(F.from_json("props", "map<string,string>"), extra).alias("props")
    )


_SQL_PROPS = """SELECT event_id, props->>'k' AS k, CASE WHEN event_id % 3 = 0 THEN 'basic abcdefgh' || event_id ELSE CAST(event_id AS VARCHAR) END AS v
    FROM events"""


@query(
    "redact_map",
    f"""SELECT event_id, 'k=' || k || ',' || CASE WHEN event_id % 2 = 0 THEN 'X-Auth-Token=***'
            WHEN event_id % 3 = 0 THEN 'note=basic ***' ELSE 'note=' || v END AS shown FROM ({_SQL_PROPS})""",
)
def redact_map(spark: SparkSession, folder: str) -> DataFrame:
    masked = redact.redact_map("props", redact.MAX_ENTRIES, redact.MAX_TEXT)
    shown = F.array_join(F.transform(F.map_entries(masked), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return _props(spark, folder).select("event_id", shown.alias("shown"))


@query(
    "redact_map_strict",
    f"""SELECT event_id, 'k=' || k || ',' || CASE WHEN event_id % 2 = 0 THEN 'X-Auth-Token=***' ELSE 'note=' || v END AS shown, NULL AS error
        FROM ({_SQL_PROPS}) WHERE event_id % 5 <> 0
        UNION ALL SELECT event_id, NULL, 'too many entries' FROM events WHERE event_id % 5 = 0""",
)
def redact_map_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Sensitive keys masked, values shown as they are; maps with more than 32 entries are refused."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(39)), lambda i: F.concat(F.lit("x"), i))
    many = F.map_from_arrays(keys, F.transform(keys, lambda k: F.lit("v")))
    entries = F.when(F.col("event_id") % 5 == 0, F.map_concat("props", many)).otherwise(F.col("props"))
    rows = _props(spark, folder).select("event_id", entries.alias("props"))
    masked = redact.redact_map_strict("props")
    shown = F.array_join(F.transform(F.map_entries(masked), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ",")
    return rows.select("event_id", shown.alias("shown"), redact.strict_map_error("props").alias("error"))


@query(
    "redact_json",
    f"""SELECT event_id, '{{"k":' || (props->>'k') || ',"inner":[{{"password":"***","note":"basic ***"}}],"deep":{"[" * 12}"basic ***"{"]" * 12}'
        || ',"many":[' || (SELECT string_agg(i, ',' ORDER BY i) FROM range(40) r(i)) || '],"long":"' || repeat('x', 300) || '"}}' AS shown
        FROM events""",
)
def redact_json(spark: SparkSession, folder: str) -> DataFrame:
    """Deeper than eight levels, wider than 32 entries, longer than 256 characters: everything is masked and kept."""
    return table(spark, folder, "events").select("event_id", redact.redact_json(_json_documents()).alias("shown"))


def _json_documents() -> Column:
    return F.concat(
        F.regexp_replace("props", r"\}$", ""),
        F.lit(',"inner":[{"password":"p'),
        F.col("event_id"),
        F.lit('","note":"basic abcdefgh"}],"deep":' + "[" * 12 + '"basic abcdefgh"' + "]" * 12),
        F.lit(',"many":[' + ",".join(map(str, range(40))) + '],"long":"'),
        F.repeat(F.lit("x"), 300),
        F.lit('"}'),
    )


@query(
    "redact_json_bounded",
    f"""SELECT event_id, '{{"k":' || (props->>'k') || ',"inner":[{{"password":"***","note":"basic ***"}}],"deep":{"[" * 7}"[TRUNCATED]"{"]" * 7}'
        || ',"many":[' || (SELECT string_agg(i, ',' ORDER BY i) FROM range(31) r(i)) || ',"[TRUNCATED]"],"long":"' || repeat('x', 256) || '"}}' AS shown
        FROM events""",
)
def redact_json_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """The same documents with the bounds for display."""
    shown = redact.redact_json(_json_documents(), redact.MAX_DEPTH, redact.MAX_ENTRIES, redact.MAX_TEXT)
    return table(spark, folder, "events").select("event_id", shown.alias("shown"))


@query(
    "audit_violations",
    f"""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'X-Auth-Token' ELSE 'note' END AS entry,
            CASE WHEN event_id % 2 = 0 THEN 'sensitive key' ELSE 'credential value' END AS reason
        FROM ({_SQL_PROPS}) WHERE event_id % 2 = 0 OR event_id % 3 = 0""",
)
def audit_violations(spark: SparkSession, folder: str) -> DataFrame:
    entries = _props(spark, folder).select("event_id", F.explode("props").alias("entry", "value"))
    reason = redact.audit_violation("entry", "value")
    return entries.select("event_id", "entry", reason.alias("reason")).where("reason IS NOT NULL")


# --- names, watermarks and HTTP outcomes -----------------------------------------------------------------------------


@query(
    "sanitize_table_name",
    """SELECT p_partkey, left(CASE WHEN regexp_matches(n, '^[0-9]') THEN '_' || n WHEN n = '' THEN '_' ELSE n END, 64) AS table_name
       FROM (SELECT p_partkey, regexp_replace(CASE WHEN p_partkey % 2 = 0 THEN p_partkey || '-' || p_name
             ELSE repeat(p_name || '#', 6) END, '[^A-Za-z0-9_]', '_', 'g') AS n FROM part)""",
)
def sanitize_table_name(spark: SparkSession, folder: str) -> DataFrame:
    raw = F.when(F.col("p_partkey") % 2 == 0, F.concat_ws("-", "p_partkey", "p_name")).otherwise(
        F.repeat(F.concat(F.col("p_name"), F.lit("#")), 6)
    )
    return table(spark, folder, "part").select("p_partkey", rules.sanitize_table_name(raw).alias("table_name"))


@query(
    "valid_identifier",
    """SELECT p_partkey, regexp_matches(CASE p_partkey % 3 WHEN 0 THEN p_type WHEN 1 THEN p_name ELSE p_partkey || p_type END,
        '^[A-Za-z_][A-Za-z0-9_]*$') AS valid FROM part""",
)
def valid_identifier(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("p_partkey") % 3
    name = case([(kind == 0, F.col("p_type")), (kind == 1, F.col("p_name"))], F.concat("p_partkey", "p_type"))
    return table(spark, folder, "part").select("p_partkey", rules.valid_identifier(name).alias("valid"))


@query(
    "safe_filename",
    """SELECT doc_id, md5(regexp_replace(text, '[^\\p{L}\\p{N}_. -]', '', 'g')) AS name_md5 FROM documents""",
)
def safe_filename(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents").select("doc_id", F.md5(rules.safe_filename("text")).alias("name_md5"))


def _watermarks(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("doc_id").cast("string")
    kind = F.col("doc_id") % 7
    mark = case(
        [
            (kind == 0, F.sha2(key, 256)),
            (kind == 1, F.concat(F.lit('W/"'), key, F.lit('"'))),
            (kind == 2, F.concat(F.lit('"https://host/'), key, F.lit('"'))),
            (kind == 3, F.lit("Wed, 21 Oct 2015 07:28:00 GMT")),
            (kind == 4, F.concat(F.lit('"token-'), key, F.lit('"'))),
            (kind == 5, F.col("text")),
        ]
    )
    return table(spark, folder, "documents").select("doc_id", mark.alias("watermark"))


@query("valid_watermark", "SELECT doc_id, doc_id % 7 IN (0, 1, 3) AS valid FROM documents")
def valid_watermark(spark: SparkSession, folder: str) -> DataFrame:
    return _watermarks(spark, folder).select("doc_id", rules.valid_watermark("watermark").alias("valid"))


@query(
    "watermark_kind",
    """SELECT doc_id, CASE WHEN doc_id % 7 IN (0, 6) THEN NULL WHEN doc_id % 7 IN (1, 2, 4) THEN 'If-None-Match'
        ELSE 'If-Modified-Since' END AS header FROM documents""",
)
def watermark_kind(spark: SparkSession, folder: str) -> DataFrame:
    return _watermarks(spark, folder).select("doc_id", rules.watermark_kind("watermark").alias("header"))


@query(
    "preferred_watermark",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN '"' || event_id || '"' WHEN event_id % 3 = 1 THEN 'date ' || user_id END AS watermark
       FROM events""",
)
def preferred_watermark(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_id") % 3
    etag = F.concat(F.lit('"'), F.col("event_id").cast("string"), F.lit('"'))
    dated = F.concat(F.lit("date "), F.col("user_id").cast("string"))
    headers = case(
        [
            (kind == 0, F.create_map(F.lit("Last-Modified"), dated, F.lit("ETag"), etag)),
            (kind == 1, F.create_map(F.lit("LAST-MODIFIED"), dated, F.lit("Age"), etag)),
        ],
        F.create_map(F.lit("Age"), etag),
    )
    return table(spark, folder, "events").select("event_id", rules.preferred_watermark(headers).alias("watermark"))


_STATUS = [200, 401, 403, 404, 409, 422, 429, 500, 503, 418]
_SQL_STATUS = "CASE event_id % 11 WHEN 10 THEN NULL " + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(_STATUS)) + " END"


def _status() -> Column:
    codes = F.array(*[F.lit(s) for s in _STATUS])
    return F.get(codes, (F.col("event_id") % 11).cast("int"))


@query(
    "classify_status",
    f"""SELECT event_id, status, CASE WHEN status = 401 THEN 'unauthenticated' WHEN status = 403 THEN 'forbidden'
            WHEN status = 404 THEN 'not-found' WHEN status = 409 THEN 'conflict' WHEN status = 422 THEN 'validation'
            WHEN status = 429 THEN 'rate-limit' WHEN status IS NULL OR status >= 500 THEN 'unavailable' ELSE 'validation' END AS error_class,
        CASE WHEN status = 401 THEN 'unauthorized' WHEN status = 403 THEN 'forbidden'
            WHEN status IS NULL OR status >= 500 THEN 'unavailable' END AS capability_state
        FROM (SELECT event_id, {_SQL_STATUS} AS status FROM events)""",
)
def classify_status(spark: SparkSession, folder: str) -> DataFrame:
    c = rules.classify_status("status")
    return (
        table(spark, folder, "events")
        .select("event_id", _status().alias("status"))
        .select("event_id", "status", c.error.alias("error_class"), c.state.alias("capability_state"))
    )


@query(
    "retry_decision",
    f"""SELECT event_id, reason, reason LIKE 'The response is retryable%' AS retry,
        CASE WHEN reason LIKE 'The response is retryable%' THEN wait END AS delay FROM
        (SELECT *, CASE WHEN event_type = 'purchase' THEN 'The operation is not safe to repeat.'
            WHEN attempt >= 5 THEN 'The retry attempt limit is exhausted.'
            WHEN NOT (status IS NULL OR status IN (408, 425, 429, 500, 502, 503, 504)) THEN 'The response is not retryable.'
            WHEN wait > 30 THEN 'Retry-After exceeds the total time budget.'
            ELSE 'The response is retryable within the configured budget.' END AS reason
         FROM (SELECT event_id, event_type, attempt, status, coalesce(after, least(pow(2, attempt - 1), 30.0)) AS wait FROM
               (SELECT event_id, event_type, event_id % 6 + 1 AS attempt, {_SQL_STATUS} AS status,
                       CASE WHEN event_id % 4 = 0 THEN CAST(user_id AS DOUBLE) END AS after FROM events)))""",
)
def retry_decision(spark: SparkSession, folder: str) -> DataFrame:
    attempts = table(spark, folder, "events").select(
        "event_id",
        (F.col("event_type") != "purchase").alias("repeatable"),
        (F.col("event_id") % 6 + 1).alias("attempt"),
        _status().alias("status"),
        F.when(F.col("event_id") % 4 == 0, F.col("user_id").cast("double")).alias("after"),
    )
    r = rules.retry_decision("attempt", F.lit(5), "status", "after", "repeatable", F.lit(30.0))
    return attempts.select("event_id", r.reason.alias("reason"), r.retry.alias("retry"), r.delay.alias("delay"))


@query(
    "retry_after",
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN greatest(value - 5, 0.0) WHEN 1 THEN 120.0 WHEN 2 THEN 0.0 END AS seconds FROM events""",
)
def retry_after(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_id") % 4
    header = case(
        [
            (kind == 0, (F.col("value") - 5).cast("string")),
            (kind == 1, F.lit("Wed, 21 Oct 2015 07:30:00 GMT")),
            (kind == 2, F.lit("Wed, 21 Oct 2015 07:00:00 GMT")),
            (kind == 3, F.lit("soon")),
        ]
    )
    now = F.lit("2015-10-21 07:28:00").cast("timestamp")
    return table(spark, folder, "events").select("event_id", rules.retry_after_seconds(header, now).alias("seconds"))


@query("bound_bytes", "SELECT doc_id, lower(hex(left(lang || '-' || source, 5))) AS head, least(octet_length(encode(text)), 65536) AS kept FROM documents")
def bound_bytes(spark: SparkSession, folder: str) -> DataFrame:
    head = rules.bound_bytes(F.concat_ws("-", "lang", "source"), 5)
    kept = F.octet_length(rules.bound_bytes("text", 65_536))
    return table(spark, folder, "documents").select(
        "doc_id", F.lower(F.hex(head)).alias("head"), kept.cast("bigint").alias("kept")
    )


@query(
    "geometry_to_wkt",
    """SELECT p_partkey, 'POINT (' || p_size || ' ' || CASE WHEN p_partkey % 2 = 0 THEN p_partkey || ')' ELSE p_partkey || '.5)' END AS wkt FROM part""",
)
def geometry_to_wkt(spark: SparkSession, folder: str) -> DataFrame:
    y = F.col("p_partkey") + F.when(F.col("p_partkey") % 2 == 0, F.lit(0.0)).otherwise(F.lit(0.5))
    return table(spark, folder, "part").select("p_partkey", rules.point_wkt("p_size", y).alias("wkt"))


@query(
    "parse_operation_id",
    """SELECT n_nationkey, 'ckan' AS platform, CASE WHEN n_nationkey % 2 = 0 THEN lower(n_name) ELSE 'profile' END AS service,
        CASE WHEN n_nationkey % 2 = 0 THEN 'list.all' ELSE lower(n_name) END AS method FROM nation""",
)
def parse_operation_id(spark: SparkSession, folder: str) -> DataFrame:
    name = F.lower("n_name")
    raw = F.concat(F.lit("ckan/"), name, F.when(F.col("n_nationkey") % 2 == 0, F.lit(".list.all")).otherwise(F.lit("")))
    op = rules.parse_operation_id(raw)
    return table(spark, folder, "nation").select(
        "n_nationkey", op.platform.alias("platform"), op.service.alias("service"), op.method.alias("method")
    )


@query(
    "valid_operation_id",
    """SELECT p_partkey, p_partkey % 3 = 0 OR regexp_matches(p_type, '^[a-z][a-z0-9_-]*$') AS valid FROM part""",
)
def valid_operation_id(spark: SparkSession, folder: str) -> DataFrame:
    method = F.when(F.col("p_partkey") % 3 == 0, F.lower("p_type")).otherwise(F.col("p_type"))
    raw = F.concat(F.lit("ckan/part."), method)
    return table(spark, folder, "part").select("p_partkey", rules.valid_operation_id(raw).alias("valid"))


@query(
    "url_rules",
    f"""WITH {_SQL_PARTS}
    SELECT page_id, 'web scheme' AS rule FROM h WHERE scheme NOT IN ('http', 'https')
    UNION ALL SELECT page_id, 'no user data' FROM h WHERE contains(netloc, '@')
    UNION ALL SELECT page_id, 'no fragment' FROM h WHERE fragment <> ''""",
)
def url_rules(spark: SparkSession, folder: str) -> DataFrame:
    p = urls.parts_of(F.col("_u"))
    return violations(
        dressed_urls(spark, folder).select("page_id", urls.url_struct("url").alias("_u")),
        {
            "web scheme": p.scheme.isin("http", "https"),
            "no user data": ~p.netloc.contains("@"),
            "no fragment": p.fragment == "",
        },
        ["page_id"],
    )
