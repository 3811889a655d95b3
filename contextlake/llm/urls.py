"""URL filters: host-suffix and path-prefix rules found by hash, longest first."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, packed, stored

#: Hex digits of the digest that the equi-join goes by.
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    """What stands between ``://`` and the next ``/``, ``?`` or ``#``, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s:.*?)://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty if there is no ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "^(?s:.*?)://[^/?#]*([^?#]*)", 1)


def label_count(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."), F.lit(""))) + 1


def host_suffixes(host: Column, counts: Column) -> Column:
    """Ends of the host of so many labels each: ``b.c`` of ``a.b.c`` for 2."""
    return F.transform(
        F.filter(counts, lambda n: n <= label_count(host)), lambda n: F.call_function("substring_index", host, F.lit("."), -n)
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    default: str = "allow",
    url_col: str = "url",
) -> DataFrame:
    """Verdict of the longest rule that fits each url.

    ``rules`` holds ``host``, ``path``, ``verdict``. A rule fits its host and all
    hosts below it where the url's path starts with the rule's path. The longest
    rule text (host and path) wins, then the longer host; if two verdicts stand
    for one rule text, ``block`` wins. Returns ``page`` (the row as a struct),
    ``host``, ``path``, ``rule`` (null if none fits), ``verdict`` (``default`` then).

    Distinct (host, path) pairs are expanded into the host suffixes of a number of labels,
    times the path prefixes of a length, that some rule has. Expressions meet the rules by a
    short digest prefix; the full digest confirms. Only pairs with a fitting rule
    come back, one row each, so a host with a third of all pages is split freely.

    Defined cases: a null url, or one without ``://``, has empty host and path;
    it meets only rules for the empty host. Rules with a null host or path count
    as empty there, with a null verdict not at all. Repeated pages stay repeated.
    A very long url costs one pass for each number of labels and each length of path that
    rules have. Empty pages or rules give an empty result or the default. Extra columns
    stay in ``page``.
    """
    parts = packed(pages, "page").select(
        "page",
        url_host(F.col("page").getField(url_col)).alias("host"),
        url_path(F.col("page").getField(url_col)).alias("path"),
    )
    wanted = (
        rules.filter(F.col("verdict").isNotNull())
        .select(
            F.concat(ascii_lower(F.coalesce("host", F.lit(""))), F.coalesce("path", F.lit(""))).alias("rule"),
            F.length(F.coalesce("host", F.lit(""))).alias("host_length"),
            F.length(F.coalesce("path", F.lit(""))).alias("path_length"),
            label_count(F.coalesce("host", F.lit(""))).alias("labels"),
            (F.col("verdict") == "block").alias("blocks"),
            "verdict",
        )
        .groupBy("rule", "host_length", "path_length", "labels")
        .agg(F.max(F.struct("blocks", "verdict")).getField("verdict").alias("verdict"))
        .withColumn("digest", _digest(F.col("rule"), F.col("host_length")))
        .withColumn("short", F.substring("digest", 1, PREFIX_DIGITS))
    )
    wanted = stored(wanted, "url-rules")
    # Lengths of rule paths and label counts of rule hosts: sets of small numbers, bounded by the longest rule.
    facts = wanted.agg(*[F.sort_array(F.collect_set(c)).alias(c) for c in ("path_length", "labels")]).first()
    lengths, counts = (F.array(*[F.lit(n) for n in facts[c]]).cast("array<int>") for c in ("path_length", "labels"))
    expressions = (
        parts.select("host", "path")
        .distinct()
        .select("host", "path", F.explode(host_suffixes(F.col("host"), counts)).alias("suffix"))
        .select("*", F.explode(F.filter(lengths, lambda n: n <= F.length("path"))).alias("taken"))
        .withColumn("expression", F.concat("suffix", F.expr("substring(path, 1, taken)")))
        .withColumn("full", _digest(F.col("expression"), F.length("suffix")))
        .select("host", "path", "full", F.substring("full", 1, PREFIX_DIGITS).alias("short"))
    )
    found = (
        # The rules are a written table: the planner knows its bytes and picks the join by them.
        expressions.join(wanted, "short")
        .filter(F.col("full") == F.col("digest"))
        .groupBy("host", "path")
        .agg(F.max(F.struct(F.length("rule").alias("size"), "host_length", "rule", "verdict")).alias("best"))
    )
    hits = stored(found.select("host", "path", "best.rule", "best.verdict"), "url-hits")
    return parts.join(hits, ["host", "path"], "left").select(
        "page", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


def _digest(expression: Column, host_length: Column) -> Column:
    """The host's length keeps ``a.b`` + ``c`` apart from ``a`` + ``.bc``."""
    return F.sha2(F.concat(host_length.cast("string"), F.lit("|"), expression), 256)
