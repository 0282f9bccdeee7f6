"""URL handling as column expressions: display-safe URLs, origins, identities and access routing."""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakegate.functions.base import ColumnOrName, case, col, contains_any, let, lookup

# Fixed values.
MASK = "***"
MASKED_QUERY_KEYS = (
    "api_key",
    "apikey",
    "token",
    "access_token",
    "refresh_token",
    "secret",
    "signature",
    "credential",
    "password",
    "x-api-key",
    "x-api-token",
    "x-auth-token",
)
DROPPED_QUERY_PARTS = (
    "api_key",
    "apikey",
    "token",
    "secret",
    "password",
    "passwd",
    "credential",
    "authorization",
    "signature",
)
OBJECT_STORE_SCHEMES = ("s3", "gs", "gcs", "az", "azure", "abfs")
FORMAT_OF_MEDIA_TYPE = {
    "text/csv": "CSV",
    "application/json": "JSON",
    "application/vnd.ms-excel": "XLS",
    "application/vnd.openxmlformats-officedocument.spreadsheetml.sheet": "XLSX",
    "application/parquet": "PARQUET",
    "application/geo+json": "GEOJSON",
    "application/xml": "XML",
    "application/pdf": "PDF",
}
MEDIA_TYPE_OF_FORMAT = {
    "CSV": "text/csv",
    "JSON": "application/json",
    "JSONL": "application/x-ndjson",
    "XML": "application/xml",
}
# Schemes whose absolute paths keep an empty authority (``file:///x``) when a URL is put together again.
HIERARCHICAL_SCHEMES = ("file", "http", "https", "ftp", "sftp", "ws", "wss", "nfs", "git")

# scheme, authority, path, query, fragment (the generic syntax of RFC 3986, appendix B)
_GENERIC = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


class UrlParts(NamedTuple):
    """Parts of a URL; missing ones are empty strings, a missing or invalid port is NULL."""

    scheme: Column
    netloc: Column
    path: Column
    query: Column
    fragment: Column
    userinfo: Column
    host: Column
    port: Column
    bad_port: Column
    malformed: Column


def url_struct(url: ColumnOrName) -> Column:
    """The parts of a URL as one STRUCT, every pattern applied once (NULL for a NULL URL)."""

    def generic(raw: Column) -> Column:
        names = ("scheme", "netloc", "path", "query", "fragment")
        return F.struct(*[F.regexp_extract(raw, _GENERIC, i + 1).alias(n) for i, n in enumerate(names)])

    def with_host(u: Column) -> Column:
        hostinfo = F.regexp_replace(u["netloc"], "^.*@", "")
        bracketed = hostinfo.contains("[")
        return F.struct(
            u.alias("u"),
            F.when(bracketed, F.regexp_extract(hostinfo, r"\[([^\]]*)", 1))
            .otherwise(F.regexp_extract(hostinfo, "^([^:]*)", 1))
            .alias("host"),
            F.when(bracketed, F.regexp_extract(hostinfo, r"\][^:]*:(.*)$", 1))
            .otherwise(F.regexp_extract(hostinfo, "^[^:]*:(.*)$", 1))
            .alias("port_text"),
        )

    def complete(r: Column) -> Column:
        u, port_text = r["u"], r["port_text"]
        number = F.when(port_text.rlike("^[0-9]{1,9}$"), port_text.try_cast("int"))
        port = F.when(number <= 65535, number)
        netloc = u["netloc"]
        return F.struct(
            F.lower(u["scheme"]).alias("scheme"),
            netloc.alias("netloc"),
            u["path"].alias("path"),
            u["query"].alias("query"),
            u["fragment"].alias("fragment"),
            F.regexp_extract(netloc, "^(.*)@", 1).alias("userinfo"),
            F.lower(r["host"]).alias("host"),
            port.alias("port"),
            ((port_text != "") & port.isNull()).alias("bad_port"),
            (netloc.contains("[") != netloc.contains("]")).alias("malformed"),
        )

    raw = F.translate(F.regexp_replace(col(url), r"^[\x00-\x20]+", ""), "\t\r\n", "")
    return let(raw, lambda r: let(generic(r), lambda u: let(with_host(u), complete)))


def parts_of(struct: Column) -> UrlParts:
    return UrlParts(*[struct[name] for name in UrlParts._fields])


def with_parts(url: ColumnOrName, body: Callable[[UrlParts], Column]) -> Column:
    """Take a URL apart once and build ``body`` from the parts."""
    return let(url_struct(url), lambda u: body(parts_of(u)))


def _percent_decoded(value: Column, plus_is_space: bool) -> Column:
    """Decode like a browser: stray percent signs stay, they never fail the row."""
    safe = F.regexp_replace(value, "%(?![0-9A-Fa-f]{2})", "%25")
    if not plus_is_space:
        safe = F.replace(safe, F.lit("+"), F.lit("%2B"))
    return F.coalesce(F.try_url_decode(safe), value)


def unquote(value: ColumnOrName) -> Column:
    return _percent_decoded(col(value), plus_is_space=False)


def _form_encoded(value: Column, keep_star: bool) -> Column:
    out = F.replace(F.url_encode(value), F.lit("%7E"), F.lit("~"))
    return out if keep_star else F.replace(out, F.lit("*"), F.lit("%2A"))


def _query_pairs(query: Column) -> Column:
    segments = F.filter(F.split(query, "&"), lambda s: s != "")
    return F.transform(
        segments,
        lambda s: F.struct(
            _percent_decoded(F.regexp_extract(s, "(?s)^([^=]*)", 1), True).alias("name"),
            _percent_decoded(F.regexp_extract(s, "(?s)^[^=]*=(.*)$", 1), True).alias("value"),
        ),
    )


def _joined(scheme: Column, netloc: Column, path: Column, query: Column, fragment: Column) -> Column:
    empty_authority = scheme.isin(*HIERARCHICAL_SCHEMES) & ((path == "") | path.startswith("/"))
    authority = case(
        [(netloc != "", F.concat(F.lit("//"), netloc)), (empty_authority | path.startswith("//"), F.lit("//"))],
        F.lit(""),
    )
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit("")),
        authority,
        path,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(F.lit("")),
    )


def _host_and_port(p: UrlParts) -> Column:
    host = F.when(p.host.contains(":"), F.concat(F.lit("["), p.host, F.lit("]"))).otherwise(p.host)
    return F.when(p.port.isNull(), host).otherwise(F.concat(host, F.lit(":"), p.port.cast("string")))


def sanitize_uri(url: ColumnOrName) -> Column:
    """URL fit for display: no user or password, secret query values masked, host in lower case."""
    url = col(url)

    def masked(p: UrlParts) -> Column:
        netloc = F.when(p.host == "", F.regexp_replace(p.netloc, "^.*@", "")).otherwise(_host_and_port(p))
        pairs = F.transform(
            _query_pairs(p.query),
            lambda kv: F.concat(
                _form_encoded(kv["name"], True),
                F.lit("="),
                F.when(F.lower(kv["name"]).isin(*MASKED_QUERY_KEYS), F.lit(MASK)).otherwise(
                    _form_encoded(kv["value"], True)
                ),
            ),
        )
        query = F.when(p.query == "", F.lit("")).otherwise(F.array_join(pairs, "&"))
        clean = _joined(p.scheme, netloc, p.path, query, p.fragment)
        return F.when((p.scheme == "") | p.malformed, url).otherwise(clean)

    return with_parts(url, masked)


def strip_query_credentials(url: ColumnOrName) -> Column:
    """URL without credential-like query pairs and without its fragment."""

    def stripped(p: UrlParts) -> Column:
        kept = F.filter(_query_pairs(p.query), lambda kv: ~contains_any(F.lower(kv["name"]), DROPPED_QUERY_PARTS))
        pairs = F.transform(
            kept, lambda kv: F.concat(_form_encoded(kv["name"], False), F.lit("="), _form_encoded(kv["value"], False))
        )
        query = F.when(p.query == "", F.lit("")).otherwise(F.array_join(pairs, "&"))
        clean = _joined(p.scheme, p.netloc, p.path, query, F.lit(""))
        return F.when(p.malformed, F.lit("<unparseable-redirect-target>")).otherwise(clean)

    return with_parts(url, stripped)


def url_origin(url: ColumnOrName) -> Column:
    """``https://host[:port]`` of an HTTPS URL without user data; NULL for anything else.

    A text without ``http://`` or ``https://`` in front is taken as a host name.
    """
    url = col(url)
    has_scheme = url.startswith("http://") | url.startswith("https://")

    def origin(p: UrlParts) -> Column:
        usable = (p.scheme == "https") & (p.host != "") & p.userinfo.rlike("^:?$") & ~p.bad_port & ~p.malformed
        shown = F.when(p.port.isNull() | p.port.isin(80, 443), F.lit("")).otherwise(
            F.concat(F.lit(":"), p.port.cast("string"))
        )
        return F.when(usable, F.concat(F.lit("https://"), p.host, shown))

    return with_parts(F.when(has_scheme, url).otherwise(F.concat(F.lit("https://"), url)), origin)


def identity_scope(url: ColumnOrName, locator: ColumnOrName) -> Column:
    """Namespace of a resource id: authority of its URL, else its locator, else its path."""
    url, locator = col(url), col(locator)
    has_url = F.coalesce(url != "", F.lit(False))
    has_locator = F.coalesce(locator != "", F.lit(False))

    def scope(p: UrlParts) -> Column:
        authority = F.lower(F.regexp_replace(p.netloc, "^.*@", ""))
        return case(
            [
                (has_url & (p.scheme != "") & (p.netloc != ""), F.concat(p.scheme, F.lit("://"), authority)),
                (has_locator, F.concat(F.lit("local:"), locator)),
                (has_url & (p.scheme != "") & (p.path != ""), F.concat(p.scheme, F.lit(":"), p.path)),
                (has_url & (p.path != ""), F.concat(F.lit("path:"), p.path)),
            ],
            F.lit("local"),
        )

    return with_parts(url, scope)


def canonical_identity(resource_id: ColumnOrName, url: ColumnOrName, locator: ColumnOrName) -> Column:
    return F.sha2(F.concat(identity_scope(url, locator), F.lit("/"), col(resource_id)), 256)


def destination_identity(uri: ColumnOrName) -> Column:
    """Digest of a destination without credentials, query, fragment or trailing slash."""
    uri = col(uri)

    def scope(p: UrlParts) -> Column:
        authority = F.when(p.host == "", F.lower(F.regexp_replace(p.netloc, "^.*@", ""))).otherwise(
            F.when(p.port.isNull(), p.host).otherwise(F.concat(p.host, F.lit(":"), p.port.cast("string")))
        )
        path = F.regexp_replace(p.path, "/+$", "")
        bare = F.regexp_replace(F.regexp_replace(uri, "(?s)[?#].*$", ""), "/+$", "")
        return case(
            [(p.scheme != "", F.concat(p.scheme, F.lit("://"), authority, path)), (path != "", path)], bare
        )

    return F.sha2(with_parts(uri, scope), 256)


def _access_kind(scheme: Column) -> Column:
    return case(
        [
            (scheme.isNull(), F.lit(None).cast("string")),
            (scheme.isin("", "file"), F.lit("local_file")),
            (scheme.isin(*OBJECT_STORE_SCHEMES), F.lit("object_storage")),
        ],
        F.lit("http_download"),
    )


def route_access(url: ColumnOrName) -> Column:
    """How the bytes behind a locator are reached."""
    return with_parts(url, lambda p: _access_kind(p.scheme))


def file_name(url: ColumnOrName) -> Column:
    """Last path segment, percent-decoded; NULL when there is none."""
    url = col(url)

    def name(p: UrlParts) -> Column:
        path = unquote(F.when(p.path == "", url).otherwise(p.path))
        trimmed = F.regexp_replace(path, r"(?s)(?:/\.?)+$", "")
        return F.nullif(F.regexp_extract(trimmed, "(?s)([^/]*)$", 1), F.lit(""))

    return with_parts(url, name)


def format_from_url(url: ColumnOrName) -> Column:
    """Upper-case extension of the URL path; NULL when it has none."""

    def extension(p: UrlParts) -> Column:
        name = F.regexp_extract(F.regexp_replace(p.path, "/+$", ""), "(?s)([^/]*)$", 1)
        return F.nullif(F.upper(F.regexp_extract(name, r"(?s)[^.].*?\.([^.]+)$", 1)), F.lit(""))

    return with_parts(url, extension)


def local_path(url: ColumnOrName) -> Column:
    """Decoded path of a ``file:`` URL, any other URL as it is."""
    url = col(url)
    return with_parts(url, lambda p: F.when(p.scheme == "file", unquote(p.path)).otherwise(url))


def normalize_format(raw: ColumnOrName) -> Column:
    """Media type or free-form format to its canonical upper-case name."""
    raw = col(raw)
    return lookup(F.lower(raw), FORMAT_OF_MEDIA_TYPE, F.trim(F.upper(raw)))


def raw_media_type(media_type: ColumnOrName, fmt: ColumnOrName) -> Column:
    return F.coalesce(
        F.nullif(col(media_type), F.lit("")),
        lookup(col(fmt), MEDIA_TYPE_OF_FORMAT),
        F.lit("application/octet-stream"),
    )


def has_parent_segment(path: ColumnOrName) -> Column:
    """True when a path climbs with ``..`` (a backslash counts as a slash)."""
    return F.array_contains(F.split(F.translate(col(path), "\\", "/"), "/"), "..")


def is_safe_destination(uri: ColumnOrName) -> Column:
    """Short, printable, and free of user data, query and fragment."""
    uri = col(uri)
    clean = with_parts(
        uri,
        lambda p: ~p.netloc.contains("@") & (p.query == "") & (p.fragment == "") & ~p.malformed,
    )
    return F.coalesce(
        (uri != "") & (F.length(uri) <= 4096) & ~uri.rlike(r"[\x00-\x1f]") & clean, F.lit(False)
    )


def url_decision(url: ColumnOrName) -> Column:
    """STRUCT of access kind, locator and reject reason of a catalog resource URL (stricter than :func:`route_access`)."""
    url = col(url)

    def decide(p: UrlParts) -> Column:
        local = p.scheme.isin("", "file")
        kind = case(
            [
                (p.scheme.isin("http", "https"), F.lit("http_download")),
                (p.scheme.isin(*OBJECT_STORE_SCHEMES), F.lit("object_storage")),
                (local & p.netloc.isin("", "localhost"), F.lit("local_file")),
            ]
        )
        reason = case(
            [
                (url.isNull(), F.lit("missing url")),
                (kind.isNotNull(), F.lit(None).cast("string")),
                (local, F.lit("unsupported host")),
            ],
            F.lit("unsupported scheme"),
        )
        locator = F.when(local, unquote(p.path)).otherwise(url)
        return F.struct(
            kind.alias("access_kind"), F.when(kind.isNotNull(), locator).alias("locator"), reason.alias("reject_reason")
        )

    return with_parts(url, decide)
