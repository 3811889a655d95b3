"""Reference (URL) handling for managed subscriptions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .hashing import sha_prefix
from .text import clean_display_label, col, strip

# ---- fixed values: default domain per source type ----
DEFAULT_DOMAINS = {
    "telegram_channel": "telegram",
    "rss_feed": "news",
    "news_url": "news",
    "event_stream": "events",
    "web_page": "web",
    "api_json": "api",
}
SOURCE_TYPES = tuple(DEFAULT_DOMAINS)


def url_scheme(reference: str | Column) -> Column:
    return F.lower(F.regexp_extract(strip(col(reference)), r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def url_host(reference: str | Column) -> Column:
    """Authority part, lower-case ('' when absent)."""
    return F.lower(F.regexp_extract(strip(col(reference)), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def url_path(reference: str | Column) -> Column:
    return F.regexp_extract(
        strip(col(reference)), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1
    )


def normalize_reference(reference: str | Column) -> Column:
    """Reference without its fragment; null when there is no scheme."""
    text = strip(col(reference))
    return F.when(url_scheme(text) != "", F.regexp_replace(text, "#.*$", ""))


def infer_source_type(reference: str | Column) -> Column:
    """Source type from host, scheme and path; null for unsupported references."""
    text = F.lower(col(reference))
    host, path, scheme = url_host(reference), F.lower(url_path(reference)), url_scheme(reference)
    has = lambda c, part: F.contains(c, F.lit(part))
    return (
        F.when(host.isin("t.me", "telegram.me") | host.endswith(".t.me"), "telegram_channel")
        .when(text.rlike("^wss?://") | has(path, "stream") | has(path, "events"), "event_stream")
        .when(path.rlike(r"\.(rss|xml|atom)$") | has(text, "rss") | has(text, "feed"), "rss_feed")
        .when(path.endswith(".json") | has(path, "api"), "api_json")
        .when(scheme.isin("http", "https"), "news_url")
    )


def default_domain(source_type: str | Column) -> Column:
    result = F.lit("context")
    for name, domain in DEFAULT_DOMAINS.items():
        result = F.when(col(source_type) == name, domain).otherwise(result)
    return result


def default_label(reference: str | Column) -> Column:
    """Last path segment with dashes and underscores as spaces, else the host."""
    path = F.btrim(url_path(reference), F.lit("/"))
    tail = F.substring_index(path, "/", -1)
    tail = F.when(tail == "", url_host(reference)).otherwise(tail)
    label = clean_display_label(F.regexp_replace(tail, "[-_]", " "))
    return F.when(label == "", url_host(reference)).otherwise(label)


def reference_hash(reference: str | Column) -> Column:
    return sha_prefix(reference, 24)


def subscription_id(source_type: str | Column, reference: str | Column) -> Column:
    digest = sha_prefix(F.concat(col(source_type), F.lit(":"), col(reference)), 12)
    return F.concat(F.substring(col(source_type), 1, 3), F.lit("_"), digest)
