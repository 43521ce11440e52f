"""Identities of URLs and records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Publications: source, host pattern, path pattern whose group is the source's own id (fixed values).
PUBLICATIONS = (
    ("substack", "(?:[a-z0-9-]+\\.)?substack\\.com", "^/p/([a-z0-9-]+)/?$"),
    ("medium", "(?:[a-z0-9-]+\\.)?medium\\.com", "^(?:/@[^/]+)?/(?:.*-)?([0-9a-f]{8,12})/?$"),
    ("patreon", "(?:www\\.)?patreon\\.com", "^/posts/(?:.*-)?([0-9]+)/?$"),
    ("fxempire", "(?:www\\.)?fxempire\\.com", "-([0-9]+)/?$"),
)


def part(url: Column, name: str) -> Column:
    return F.try_parse_url(url, F.lit(name))


def canonical(url: Column) -> Column:
    """One spelling of a URL: scheme and host in lower case, no fragment, no closing slash; null if it has no host."""
    host = F.lower(part(url, "HOST"))
    port = F.regexp_extract(url, "^[A-Za-z]+://[^/?#]*:([0-9]+)(?:[/?#]|$)", 1)
    scheme = F.lower(part(url, "PROTOCOL"))
    default = F.when(scheme == "https", "443").when(scheme == "http", "80").otherwise("")
    query = part(url, "QUERY")
    return F.concat(
        scheme, F.lit("://"), host, F.when((port != "") & (port != default), F.concat(F.lit(":"), port)).otherwise(""),
        F.regexp_replace(F.coalesce(part(url, "PATH"), F.lit("")), "/+$", ""), F.when(query.isNotNull(), F.concat(F.lit("?"), query)).otherwise(""),
    )


def publication(url: Column) -> Column:
    """The source whose host a URL has; null for others."""
    host = F.lower(part(url, "HOST"))
    return F.coalesce(*(F.when(host.rlike(f"^{h}$"), s) for s, h, _ in PUBLICATIONS))


def native_id(url: Column) -> Column:
    """The source's own id in a URL; null for other hosts and paths."""
    host, path = F.lower(part(url, "HOST")), F.coalesce(part(url, "PATH"), F.lit(""))
    return F.coalesce(*(F.when(host.rlike(f"^{h}$"), F.nullif(F.regexp_extract(path, p, 1), F.lit(""))) for _, h, p in PUBLICATIONS))


def last_segment(url: Column) -> Column:
    return F.regexp_extract(url, "([^/]+)/?$", 1)


def stable_id(prefix: str, c: Column) -> Column:
    """prefix, underscore and 14 hex digits of the value's SHA-256."""
    return F.concat(F.lit(prefix + "_"), F.substring(F.sha2(c, 256), 1, 14))
