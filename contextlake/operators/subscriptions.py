"""Managed external sources: subscription rows, their items and item events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import event_id, sha_prefix
from ..functions.text import clean_display_label, collapse, first_filled
from ..functions.times import AsOf, as_of_col
from ..functions.urls import (
    SOURCE_TYPES,
    default_domain,
    default_label,
    infer_source_type,
    normalize_reference,
    reference_hash,
    subscription_id,
    url_host,
)
from ..schemas import ENVELOPE, LAKE_VERSION
from ..sources.files import SUBSCRIPTION_ROW_KEYS, explode_json_rows, feed_items
from .latest import latest_by


def register_subscriptions(requests: DataFrame) -> DataFrame:
    """Requests (source_type or 'auto', reference, label, domain, tags, …) to subscription rows."""
    inferred = F.when(F.col("source_type") == "auto", infer_source_type("reference")).otherwise(
        F.col("source_type")
    )
    staged = requests.withColumns(
        {"source_type": inferred, "reference": normalize_reference("reference")}
    ).filter(F.col("source_type").isin(*SOURCE_TYPES) & F.col("reference").isNotNull())
    filled = lambda c, default: F.when(c == "", default).otherwise(c)
    return staged.select(
        subscription_id("source_type", "reference").alias("subscription_id"),
        "source_type",
        "reference",
        filled(clean_display_label("label"), default_label("reference")).alias("label"),
        filled(clean_display_label("domain"), default_domain("source_type")).alias("domain"),
        F.filter(F.transform("tags", lambda t: clean_display_label(t)), lambda t: t != "").alias("tags"),
        F.lit(True).alias("enabled"),
        "privacy_class",
        filled(clean_display_label("cadence"), F.lit("manual")).alias("cadence"),
    )


# ---- fixed values: which source types carry parsed items ----
FEED_TYPES = ("rss_feed",)
JSON_TYPES = ("api_json", "event_stream")
_ITEM = (
    "subscription_id", "item_number", "event_type", "event_time", "title", "url", "link", "summary", "metrics_json",
)


#: Parts that subscriptions and contents meet in at least, whatever their bytes.
PARTS = 200


def _spread(df: DataFrame) -> DataFrame:
    """Rows by subscription in as many parts as asked for.

    Contents compress well, so parts joined by their bytes in the shuffle hold very many
    rows, all of which a task sorts; a part's rows follow the rows there are.
    """
    parts = max(PARTS, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(parts, "subscription_id")


def subscription_items(
    subscriptions: DataFrame, contents: DataFrame, limit: int = 20, checked_at: AsOf = None
) -> DataFrame:
    """Items of enabled subscriptions: feed items, JSON records, or one ``source_seen`` row.

    ``contents`` holds (subscription_id, text) with at most one row per
    subscription. ``limit`` is the item limit per subscription.
    """
    active = _spread(subscriptions.filter("enabled")).join(_spread(contents), "subscription_id", "left")
    has_text = F.length(F.trim(F.coalesce("text", F.lit("")))) > 0
    feeds = active.filter(F.col("source_type").isin(*FEED_TYPES) & has_text)
    records = active.filter(F.col("source_type").isin(*JSON_TYPES) & has_text)
    seen = active.filter(~(F.col("source_type").isin(*FEED_TYPES, *JSON_TYPES) & has_text))

    none = F.lit(None).cast("string")
    from_feeds = feed_items(feeds.select("subscription_id", "text")).select(
        "subscription_id",
        "item_number",
        none.alias("event_type"),
        # Feed dates are RFC-822 text: store them as ISO so that they survive the silver filter.
        F.coalesce(
            F.date_format("published_time", "yyyy-MM-dd'T'HH:mm:ssXXX"), F.nullif("published_at", F.lit(""))
        ).alias("event_time"),
        "title",
        "url",
        none.alias("link"),
        "summary",
        none.alias("metrics_json"),
    )
    rows = explode_json_rows(
        records.select("subscription_id", "text"), "text", SUBSCRIPTION_ROW_KEYS, allow_json_lines=True
    ).filter("is_object")
    field = lambda *names: first_filled(
        *[F.get_json_object("row_json", f"$.{n}") for n in names]
    )
    from_records = rows.select(
        "subscription_id",
        F.col("row_number").alias("item_number"),
        field("event_type").alias("event_type"),
        field("event_time", "published_at", "updated_at").alias("event_time"),
        field("title", "name").alias("title"),
        field("url").alias("url"),
        field("link").alias("link"),
        field("summary", "description").alias("summary"),
        F.get_json_object("row_json", "$.metrics").alias("metrics_json"),
    )
    placeholder = seen.select(
        "subscription_id",
        F.lit(1).alias("item_number"),
        F.lit("source_seen").alias("event_type"),
        as_of_col(checked_at).cast("timestamp").cast("string").alias("event_time"),
        F.col("label").alias("title"),
        F.col("reference").alias("url"),
        none.alias("link"),
        F.lit("subscription registered or checked").alias("summary"),
        none.alias("metrics_json"),
    )
    parsed = latest_by(
        from_feeds.unionByName(from_records), ["subscription_id"], [F.col("item_number").asc()], limit
    )
    return parsed.unionByName(placeholder).select(*_ITEM)


def subscription_events(
    subscriptions: DataFrame, items: DataFrame, ingested_at: AsOf = None
) -> DataFrame:
    """Item envelopes: host, hashes and short previews only, with a stable key."""
    now = as_of_col(ingested_at).cast("timestamp").cast("string")
    joined = items.join(subscriptions, "subscription_id")
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    staged = joined.withColumns(
        {
            "_time": first_filled("event_time", now),
            "_title": collapse(first_filled("title", "label"), 160),
            "_url": first_filled("url", "link", "reference"),
            "_summary": collapse(blank("summary"), 160),
            "_host": url_host("reference"),
            "_type": F.coalesce(
                F.nullif("event_type", F.lit("")), F.concat("source_type", F.lit("_item"))
            ),
        }
    )
    key = F.concat_ws(
        ":", "subscription_id", "_time", sha_prefix(F.concat("_url", "_title"), 24)
    )
    some_hash = lambda c: F.when(F.col(c) != "", sha_prefix(c, 24))
    payload = F.struct(
        "subscription_id",
        "source_type",
        "domain",
        "label",
        F.nullif("_host", F.lit("")).alias("reference_host"),
        reference_hash("reference").alias("reference_hash"),
        some_hash("_url").alias("item_url_hash"),
        some_hash("_title").alias("title_hash"),
        some_hash("_summary").alias("summary_hash"),
        F.col("_time").alias("published_at"),
    )
    summary = F.struct(
        "subscription_id", "source_type", "label", F.col("_title").alias("title_preview")
    )
    has_url = blank("url") != ""
    values: dict[str, Column] = {
        "lake_version": F.lit(LAKE_VERSION),
        "event_id": event_id(key),
        "source_name": F.lit("external_source_items"),
        "source_tier": F.lit("tier_1_foundation"),
        "source_type": F.lit("managed_url_subscription"),
        "event_type": F.col("_type"),
        "event_time": F.col("_time"),
        "ingested_at": now,
        "privacy_class": F.col("privacy_class"),
        "consent_scope": F.lit("local_personal_use"),
        "subject_id": F.lit("self"),
        "schema_version": F.lit("1"),
        "idempotency_key": key,
        "provenance": F.to_json(
            F.struct(F.lit("source-subscriptions").alias("connector"), F.col("_host").alias("reference_host"))
        ),
        "raw_policy": F.lit("local_raw_only"),
        "local_policy": F.lit("summarized_landing_only"),
        "payload_summary": F.to_json(summary),
        "metrics": F.coalesce(F.from_json("metrics_json", "map<string,double>"), F.create_map().cast("map<string,double>")),
        "tags": F.concat(F.array(F.lit("managed_source"), "source_type", "domain"), "tags"),
        "quality_flags": F.array(F.when(has_url, "parsed_item").otherwise("fixture_or_manual_check")),
        "payload": F.to_json(payload),
    }
    return staged.select(*[values[f.name].cast(f.dataType).alias(f.name) for f in ENVELOPE.fields])
