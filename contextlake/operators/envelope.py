"""Lake envelopes: 21 common fields around a typed payload, with a stable event id."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import canonical_json, event_id, event_key
from ..functions.json_tools import redact_json
from ..functions.text import first_filled
from ..functions.times import AsOf, as_of_col
from ..schemas import ENVELOPE, LAKE_VERSION
from ..session import broadcast_if_small


@dataclass(frozen=True)
class EnvelopeSpec:
    """How rows of one source become envelopes.

    ``event_time`` and ``payload`` name columns; ``idempotency`` names the
    columns whose values identify an event. Without it the key is built from
    source, type, time and the whole payload.
    """

    source_name: str
    event_type: str
    event_time: str
    payload: Sequence[str]
    privacy_class: str = "derived_context"
    source_tier: str = ""
    source_type: str = ""
    raw_policy: str = ""
    local_policy: str = ""
    idempotency: Sequence[str] = ()
    payload_summary: Sequence[str] = ()
    metrics: Sequence[str] = ()
    tags: Sequence[str] = ()
    tag_columns: Sequence[str] = ()
    quality_flags: Sequence[str] = ()
    extra: Mapping[str, Column] = field(default_factory=dict)


def as_text(c: Column, dtype: str) -> Column:
    """Timestamps as ISO text with a zone, to the microsecond; everything else as plain text."""
    if dtype in ("timestamp", "timestamp_ntz"):
        return F.date_format(c.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    return c.cast("string")


def envelope(df: DataFrame, spec: EnvelopeSpec, ingested_at: AsOf = None) -> DataFrame:
    """Rows in the ENVELOPE schema. Payload order and nulls follow the spec."""
    types = dict(df.dtypes)
    fields = [
        (as_text(F.col(c), types[c]) if types[c].startswith("timestamp") else F.col(c)).alias(c)
        for c in spec.payload
    ]
    staged = df.select(
        "*",
        F.struct(*fields).alias("_payload"),
        as_text(F.col(spec.event_time), types[spec.event_time]).alias("_time"),
    )
    canonical = canonical_json(F.col("_payload"), staged.schema["_payload"].dataType)
    if spec.idempotency:
        key = F.concat_ws(
            ":", F.lit(spec.source_name), *[as_text(F.col(c), types[c]) for c in spec.idempotency]
        )
    else:
        key = event_key(F.lit(spec.source_name), F.lit(spec.event_type), F.col("_time"), canonical)
    payload_text = F.to_json(F.col("_payload"), {"ignoreNullFields": "false"})
    summary = F.to_json(F.struct(*spec.payload_summary)) if spec.payload_summary else F.lit("{}")
    metrics = [x for c in spec.metrics for x in (F.lit(c), F.col(c).cast("double"))]
    tags = F.array_compact(F.array(*[F.lit(t) for t in spec.tags], *[F.col(c) for c in spec.tag_columns]))
    values = {
        "lake_version": F.lit(LAKE_VERSION),
        "event_id": event_id(key),
        "source_name": F.lit(spec.source_name),
        "source_tier": F.lit(spec.source_tier),
        "source_type": F.lit(spec.source_type),
        "event_type": F.lit(spec.event_type),
        "event_time": F.col("_time"),
        "ingested_at": as_text(as_of_col(ingested_at), "timestamp"),
        "privacy_class": F.lit(spec.privacy_class),
        "consent_scope": F.lit("local_personal_use"),
        "subject_id": F.lit("self"),
        "schema_version": F.lit("1"),
        "idempotency_key": key,
        "provenance": F.lit("{}"),
        "raw_policy": F.lit(spec.raw_policy),
        "local_policy": F.lit(spec.local_policy),
        "payload_summary": summary,
        "metrics": F.create_map(*metrics) if metrics else F.create_map(),
        "tags": tags,
        "quality_flags": F.array(*[F.lit(q) for q in spec.quality_flags]),
        "payload": payload_text,
        **spec.extra,
    }
    return staged.select(
        *[values[f.name].cast(f.dataType).alias(f.name) for f in ENVELOPE.fields]
    )


# ---- the standing envelopes of the derived tables ----
WEATHER = EnvelopeSpec(
    source_name="weather_forecast",
    event_type="weather_hour",
    event_time="forecast_time",
    privacy_class="public_context",
    payload=(
        "location_id", "forecast_time", "temperature_c", "precipitation_mm", "rain_mm",
        "snowfall_cm", "snow_depth_cm", "wind_speed_kmh", "wind_gust_kmh", "visibility_m",
        "is_day", "fetched_at",
    ),
    idempotency=("location_id", "forecast_time", "fetched_at"),
)
RECOMMENDATION = EnvelopeSpec(
    source_name="daily_context_profile",
    event_type="recommendation",
    event_time="generated_at",
    payload=("recommendation_type", "activity", "location_id", "score", "decision", "reasons", "generated_at"),
)
SIGNAL = EnvelopeSpec(
    source_name="context_signals",
    event_type="context_signal",
    event_time="occurred_at",
    payload=(
        "signal_id", "domain", "source", "title", "direction", "urgency", "confidence", "summary",
        "occurred_at", "ingested_at",
    ),
    idempotency=("signal_id",),
)
WEEK_SUMMARY = EnvelopeSpec(
    source_name="activity_diary",
    event_type="activity_week_summary",
    event_time="generated_at",
    privacy_class="private_behavior_summary",
    payload=("sessions", "avg_intensity", "avg_mood", "avg_fatigue", "pain_sessions", "by_activity", "by_result"),
)
DECISION_METRICS = EnvelopeSpec(
    source_name="decision_feedback",
    event_type="decision_metrics_7d",
    event_time="generated_at",
    privacy_class="private_behavior_summary",
    payload=("useful_decision_days", "followed_events", "skipped_events", "follow_rate"),
)
DAILY_CONTEXT = EnvelopeSpec(
    source_name="daily_context_profile",
    event_type="daily_context_profile",
    event_time="generated_at",
    payload=(
        "profile_date", "timezone", "top_activity", "top_decision", "top_score", "readiness_state",
        "sessions_7d", "avg_mood_7d", "avg_fatigue_7d", "pain_sessions_7d",
        "useful_decision_days_7d", "follow_rate_7d", "open_goal_count", "signal_count_7d",
        "highest_signal_domain", "highest_signal_urgency", "context_summary", "generated_at",
    ),
)
ACTIVITY_FILE = EnvelopeSpec(
    source_name="activity_files",
    event_type="activity_file_summary",
    event_time="started_at",
    privacy_class="private_location_summary",
    payload=(
        "source_file", "activity_type", "started_at", "ended_at", "duration_minutes",
        "distance_km", "elevation_gain_m", "point_count",
    ),
)
SLEEP_NIGHT = EnvelopeSpec(
    source_name="sleep_quality",
    event_type="sleep_quality_night",
    event_time="woke_at",
    privacy_class="private_health_summary",
    payload=(
        "slept_at", "woke_at", "duration_minutes", "quality_score", "recovery_score",
        "sleep_efficiency", "source",
    ),
)
PLACE = EnvelopeSpec(
    source_name="place_spots",
    event_type="public_place_spot",
    event_time="observed_at",
    privacy_class="public_context",
    source_tier="tier_1_foundation",
    source_type="public_map_api",
    raw_policy="public_fixture_ok",
    local_policy="summarized_landing_only",
    payload=("spot_id", "label", "latitude", "longitude", "tags", "source", "observed_at"),
    payload_summary=("spot_id", "label", "tags"),
    metrics=("latitude", "longitude"),
    tags=("places",),
    quality_flags=("public_osm_or_config",),
    idempotency=("spot_id", "source"),
)
RUN = EnvelopeSpec(
    source_name="data_source_runs",
    event_type="data_source_run",
    event_time="observed_at",
    privacy_class="derived_context",
    source_tier="tier_1_foundation",
    source_type="pipeline_observability",
    raw_policy="local_raw_only",
    local_policy="summarized_landing_only",
    payload=(
        "observed_at", "source_name", "status", "quality_state", "freshness_minutes", "row_count",
        "error_count", "latest_event_time", "status_counts", "last_error",
    ),
    payload_summary=("source_name", "status", "quality_state", "latest_event_time"),
    metrics=("freshness_minutes", "row_count", "error_count"),
    tags=("runtime_log",),
    tag_columns=("source_name", "status", "quality_state"),
    quality_flags=("summary_only", "runtime_log_import"),
    idempotency=("source_name", "observed_at"),
)
STANDARD = {
    "weather": WEATHER,
    "recommendation": RECOMMENDATION,
    "signal": SIGNAL,
    "week_summary": WEEK_SUMMARY,
    "decision_metrics": DECISION_METRICS,
    "daily_context": DAILY_CONTEXT,
    "activity_file": ACTIVITY_FILE,
    "sleep": SLEEP_NIGHT,
    "place": PLACE,
    "run": RUN,
}


def custom_events(
    rows: DataFrame,
    registry: DataFrame,
    *,
    row_json: str = "row_json",
    event_type: str = "custom_life_event",
    time_field: str = "occurred_at",
    privacy_class: str = "custom_local_summary",
    ingested_at: AsOf = None,
) -> tuple[DataFrame, DataFrame]:
    """(envelopes, rejected rows) for free-form JSON records of registered sources.

    ``rows`` holds ``source_name`` and the record text. Payloads lose every
    forbidden key at any depth; records of unknown sources or without a time
    are rejected with a reason.
    """
    known = broadcast_if_small(registry.select("source_name").distinct()).withColumn("_known", F.lit(True))
    text = F.col(row_json)
    staged = rows.join(known, "source_name", "left").withColumns(
        {
            "_time": first_filled(
                F.get_json_object(text, f"$.{time_field}"), F.get_json_object(text, "$.event_time")
            ),
            "_type": first_filled(F.get_json_object(text, "$.event_type"), F.lit(event_type)),
        }
    )
    reason = F.when(F.col("_known").isNull(), "source is not registered").when(
        F.col("_time").isNull(), f"row has no {time_field} or event_time"
    )
    checked = staged.withColumn("reject_reason", reason)
    valid = checked.filter(F.col("reject_reason").isNull()).withColumn("_payload", redact_json(text))
    key = event_key(F.col("source_name"), F.col("_type"), F.col("_time"), F.col("_payload"))
    values = {
        "lake_version": F.lit(LAKE_VERSION),
        "event_id": event_id(key),
        "source_name": F.col("source_name"),
        "event_type": F.col("_type"),
        "event_time": F.col("_time"),
        "ingested_at": as_text(as_of_col(ingested_at), "timestamp"),
        "privacy_class": F.lit(privacy_class),
        "consent_scope": F.lit("local_personal_use"),
        "subject_id": F.lit("self"),
        "schema_version": F.lit("1"),
        "idempotency_key": key,
        "provenance": F.lit("{}"),
        "payload_summary": F.lit("{}"),
        "metrics": F.create_map(),
        "tags": F.array(),
        "quality_flags": F.array(),
        "payload": F.col("_payload"),
    }
    envelopes = valid.select(
        *[
            values.get(f.name, F.lit("")).cast(f.dataType).alias(f.name)
            for f in ENVELOPE.fields
        ]
    )
    rejected = checked.filter(F.col("reject_reason").isNotNull()).drop("_known", "_time", "_type")
    return envelopes, rejected
