"""Row schemas at every table boundary and the enumerations that guard them."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    BooleanType,
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

LAKE_VERSION = "contextlake.v1"

STRING, INT, LONG, DOUBLE = StringType(), IntegerType(), LongType(), DoubleType()
BINARY, BOOLEAN, TIMESTAMP = BinaryType(), BooleanType(), TimestampType()


def _row(*columns: tuple[str, DataType] | str) -> StructType:
    """Columns as (name, type); a bare name is a string column."""
    pairs = [(c, STRING) if isinstance(c, str) else c for c in columns]
    return StructType([StructField(name, dtype) for name, dtype in pairs])


BUS = _row(
    "topic",
    ("key", BINARY),
    ("value", BINARY),
    ("partition", INT),
    ("offset", LONG),
    ("timestamp", TIMESTAMP),
)

BRONZE_EVENT = _row(
    "event_source",
    ("event_time", TIMESTAMP),
    ("schema_id", INT),
    ("payload_size", INT),
    "json_payload",
    ("partition", INT),
    ("offset", LONG),
)

# payload, summaries and provenance stay JSON text: their keys differ per source.
ENVELOPE = _row(
    "lake_version",
    "event_id",
    "source_name",
    "source_tier",
    "source_type",
    "event_type",
    "event_time",
    "ingested_at",
    "privacy_class",
    "consent_scope",
    "subject_id",
    "schema_version",
    "idempotency_key",
    "provenance",
    "raw_policy",
    "local_policy",
    "payload_summary",
    ("metrics", MapType(STRING, DOUBLE)),
    ("tags", ArrayType(STRING)),
    ("quality_flags", ArrayType(STRING)),
    "payload",
)

MEDALLION_EVENT = _row(
    "lake_version",
    "source_name",
    "event_type",
    ("event_time", TIMESTAMP),
    ("ingested_at", TIMESTAMP),
    "privacy_class",
    "json_payload",
    "landing_file",
    ("loaded_at", TIMESTAMP),
)

RUNTIME_LOG = _row(
    "event_time",
    "run_id",
    "component",
    "action",
    "status",
    "message",
    "metrics",
    "fields",
)

ORDER_EVENT = _row(
    "order_id",
    "user_id",
    "product_id",
    ("amount", DOUBLE),
    "currency",
    ("ts", LONG),
)
PAYMENT_EVENT = _row(
    "payment_id",
    "order_id",
    "method",
    "status",
    ("ts", LONG),
)
INVENTORY_EVENT = _row(
    "change_id",
    "warehouse_id",
    "product_id",
    "change_type",
    ("quantity_delta", INT),
    ("previous_qty", INT),
    ("new_qty", INT),
    "reason",
    "order_id",
    "supplier_id",
    ("cost_per_unit", DOUBLE),
    ("ts", LONG),
)

WEATHER_HOUR = _row(
    "location_id",
    ("forecast_time", TIMESTAMP),
    ("temperature_c", DOUBLE),
    ("precipitation_mm", DOUBLE),
    ("rain_mm", DOUBLE),
    ("snowfall_cm", DOUBLE),
    ("snow_depth_cm", DOUBLE),
    ("wind_speed_kmh", DOUBLE),
    ("wind_gust_kmh", DOUBLE),
    ("visibility_m", DOUBLE),
    ("is_day", BOOLEAN),
    ("fetched_at", TIMESTAMP),
)

# ---- fixed values: enumerations, one list per table because they differ ----
ACTIVITY_TYPES = ("skate", "snowboard", "volleyball", "moto_lesson", "gym", "walk", "rest")
ACTIVITY_RESULTS = ("good", "ok", "bad", "skipped")
READINESS_ACTIVITIES = ("skate", "snowboard", "moto_lesson", "volleyball")
READINESS_DECISIONS = ("go", "caution", "skip")
RECOMMENDATION_DECISIONS = ("go", "caution", "recover")
FEEDBACK_ACTIONS = ("followed", "skipped", "changed")
SIGNAL_DOMAINS = ("market", "github", "career", "wellbeing", "system")
SIGNAL_DIRECTIONS = ("positive", "negative", "neutral")
FAILURE_STATUSES = ("error", "failed", "failure", "skipped")
HIGH_IMPACT_ACTIVITIES = ("skate", "snowboard", "moto_lesson")
