"""Local exports to privacy-safe summaries: one spec table, one generated projection."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.hashing import stable_hash
from ..functions.numbers import optional_bool, optional_float, optional_int
from ..functions.text import clean_label, col, first_filled, strip, word_count
from ..sources.files import file_extension, file_name


@dataclass(frozen=True)
class SummarySpec:
    """Fields of one export kind: time candidates, numeric metrics, cleaned labels, policies."""

    event_type: str
    time_fields: tuple[str, ...]
    metrics: tuple[str, ...]
    labels: tuple[str, ...]
    privacy_class: str
    source_tier: str
    source_type: str
    raw_policy: str = "local_raw_only"
    local_policy: str = "summarized_landing_only"


# ---- fixed values: the export kinds ----
SUMMARY_SPECS = {
    "training_sessions": SummarySpec(
        event_type="training_session_summary",
        time_fields=("occurred_at", "started_at", "date"),
        metrics=("duration_minutes", "load_score", "intensity", "fatigue_score"),
        labels=("activity_type", "result", "venue_bucket"),
        privacy_class="private_behavior_summary",
        source_tier="tier_2_personal_context",
        source_type="derived_training_session",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "habit_goals": SummarySpec(
        event_type="habit_goal_progress",
        time_fields=("updated_at", "date"),
        metrics=("target_count", "done_count", "streak_days"),
        labels=("goal_bucket", "status", "skipped_reason_bucket"),
        privacy_class="private_behavior_summary",
        source_tier="tier_2_personal_context",
        source_type="local_config_and_manual_events",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "market_watchlist_snapshot": SummarySpec(
        event_type="market_watchlist_snapshot",
        time_fields=("observed_at", "date"),
        metrics=("volatility_score", "relative_volume", "change_pct"),
        labels=("symbol_bucket", "volatility_bucket", "direction", "attention_state"),
        privacy_class="public_context",
        source_tier="tier_1_foundation",
        source_type="market_data_api",
        raw_policy="public_fixture_ok",
        local_policy="summarized_landing_only",
    ),
    "github_project_activity": SummarySpec(
        event_type="github_project_activity",
        time_fields=("observed_at", "date"),
        metrics=("activity_count", "commit_count", "issue_count", "pr_count"),
        labels=("repo_bucket", "focus_bucket", "maintenance_state"),
        privacy_class="public_context",
        source_tier="tier_1_foundation",
        source_type="public_api",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "learning_activity": SummarySpec(
        event_type="learning_activity",
        time_fields=("occurred_at", "date"),
        metrics=("duration_minutes", "progress_pct", "artifact_count"),
        labels=("topic_bucket", "progress_state", "next_action_bucket"),
        privacy_class="private_behavior_summary",
        source_tier="tier_2_personal_context",
        source_type="local_notes_or_project_summary",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "finance_event_calendar": SummarySpec(
        event_type="finance_event_calendar_item",
        time_fields=("event_date", "date"),
        metrics=("urgency", "days_until"),
        labels=("event_bucket", "impact_bucket", "watchlist_bucket"),
        privacy_class="private_finance_summary",
        source_tier="tier_2_personal_context",
        source_type="local_calendar_or_public_finance_events",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "health_summary": SummarySpec(
        event_type="health_metric_summary",
        time_fields=("metric_date", "date"),
        metrics=("metric_value", "resting_hr", "hrv_ms", "steps", "active_minutes"),
        labels=("metric_name", "unit", "device_bucket"),
        privacy_class="private_health_summary",
        source_tier="tier_3_sensitive_life",
        source_type="wearable_or_health_export",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "location_area_summary": SummarySpec(
        event_type="location_area_summary",
        time_fields=("occurred_at", "date"),
        metrics=("dwell_minutes", "distance_km"),
        labels=("area_bucket", "movement_mode", "city_bucket", "precision_bucket"),
        privacy_class="private_location_summary",
        source_tier="tier_3_sensitive_life",
        source_type="local_location_history",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "finance_transactions": SummarySpec(
        event_type="finance_transaction_summary",
        time_fields=("occurred_at", "booked_at", "date"),
        metrics=("transaction_count",),
        labels=("category_bucket", "amount_bucket", "currency", "account_bucket", "direction"),
        privacy_class="private_finance_summary",
        source_tier="tier_3_sensitive_life",
        source_type="local_bank_or_budget_export",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "data_source_runs": SummarySpec(
        event_type="data_source_run",
        time_fields=("observed_at", "started_at", "date"),
        metrics=("freshness_minutes", "row_count", "error_count", "duration_seconds"),
        labels=("source_name", "status", "quality_state"),
        privacy_class="derived_context",
        source_tier="tier_1_foundation",
        source_type="pipeline_observability",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "browser_and_app_usage": SummarySpec(
        event_type="digital_activity_summary",
        time_fields=("activity_date", "date"),
        metrics=("duration_minutes", "session_count"),
        labels=("category", "device_bucket", "focus_state"),
        privacy_class="private_behavior_summary",
        source_tier="tier_2_personal_context",
        source_type="local_browser_or_screen_time_export",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "tasks_and_projects": SummarySpec(
        event_type="task_project_summary",
        time_fields=("updated_at", "date"),
        metrics=("task_count", "done_count", "effort_points"),
        labels=("project_bucket", "status", "priority_bucket", "effort_bucket"),
        privacy_class="private_behavior_summary",
        source_tier="tier_2_personal_context",
        source_type="local_task_export",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "communications_metadata": SummarySpec(
        event_type="communications_metadata_summary",
        time_fields=("occurred_at", "date"),
        metrics=("interaction_count", "duration_minutes"),
        labels=("channel", "direction", "contact_bucket", "response_bucket"),
        privacy_class="private_communications_summary",
        source_tier="tier_3_sensitive_life",
        source_type="local_mail_message_or_call_export",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "location_visits": SummarySpec(
        event_type="location_visit_summary",
        time_fields=("occurred_at", "date"),
        metrics=("dwell_minutes", "distance_km"),
        labels=("place_bucket", "movement_mode", "precision_bucket", "city_bucket"),
        privacy_class="private_location_summary",
        source_tier="tier_3_sensitive_life",
        source_type="local_location_history",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "health_metrics": SummarySpec(
        event_type="health_metric_summary",
        time_fields=("metric_date", "date"),
        metrics=("metric_value",),
        labels=("metric_name", "unit", "source_device_class"),
        privacy_class="private_health_summary",
        source_tier="tier_3_sensitive_life",
        source_type="wearable_or_health_export",
        raw_policy="local_raw_only",
        local_policy="summarized_landing_only",
    ),
    "identity_documents": SummarySpec(
        event_type="identity_document_pointer",
        time_fields=("indexed_at", "date"),
        metrics=("days_until_expiry",),
        labels=("document_bucket", "status", "expiry_month", "reminder_bucket", "pointer_bucket"),
        privacy_class="private_identity_document",
        source_tier="tier_4_private_core",
        source_type="local_document_index",
        raw_policy="no_shared_bronze_raw",
        local_policy="explicit_opt_in_pointer_only",
    ),
    "secrets_inventory": SummarySpec(
        event_type="credential_rotation_pointer",
        time_fields=("indexed_at", "date"),
        metrics=("age_days",),
        labels=("credential_bucket", "rotation_due_month", "age_bucket", "vault_bucket", "status"),
        privacy_class="secret_credential",
        source_tier="tier_4_private_core",
        source_type="local_secret_manager_index",
        raw_policy="no_shared_bronze_raw",
        local_policy="explicit_opt_in_pointer_only",
    ),
}


def _parsed(df: DataFrame, row_json: str, names: Iterable[str]) -> DataFrame:
    """Record text parsed once into a struct of text fields ``_r``.

    The struct is a generated column: filters on its fields stay above it. Pushed below, each
    of them would parse the record again, once per field it names. It is a plain column before
    that: Spark does not count what a generator adds to a row, and would take the few columns
    kept of a wide record for a table small enough to broadcast.
    """
    fields = StructType([StructField(n, StringType()) for n in dict.fromkeys(names)])
    read = df.withColumn("_record", F.from_json(row_json, fields))
    return read.select("*", F.explode(F.array("_record")).alias("_r")).drop("_record")


def _field(*names: str) -> Column:
    """First of several record fields that is filled."""
    return first_filled(*[F.col(f"_r.{n}") for n in names])


def summarize_source(
    df: DataFrame, kind: str, row_json: str = "row_json", path: str = "path", row_number: str = "row_number"
) -> DataFrame:
    """Summary rows of one export kind, with ``reject_reason`` for rows without any time.

    A summary row keeps cleaned labels and numeric metrics only; free text and
    file names leave as hashes. ``labels`` and ``metrics`` are maps without
    blank entries. Rejected rows stay in the result, so one pass serves both
    the table and the quarantine.
    """
    spec = SUMMARY_SPECS[kind]
    raw = lambda name: F.col(f"_r.{name}")
    event_time = _field(*spec.time_fields)
    labels = F.map_filter(
        F.create_map(*[x for f in spec.labels for x in (F.lit(f), clean_label(raw(f)))]),
        lambda _k, v: v != "",
    )
    metrics = F.map_filter(
        F.create_map(*[x for f in spec.metrics for x in (F.lit(f), optional_float(raw(f)))]),
        lambda _k, v: v.isNotNull(),
    )
    file_hash = stable_hash(file_name(path))
    parsed = _parsed(df, row_json, [*spec.time_fields, *spec.labels, *spec.metrics])
    staged = parsed.withColumns({"_time": event_time, "_labels": labels, "_metrics": metrics})
    rows = staged.select(
        F.lit(kind).alias("source_name"),
        F.lit(spec.event_type).alias("event_type"),
        F.col("_time").alias("event_time"),
        F.lit(spec.privacy_class).alias("privacy_class"),
        F.lit(spec.source_tier).alias("source_tier"),
        F.lit(spec.source_type).alias("source_type"),
        F.lit(spec.raw_policy).alias("raw_policy"),
        F.lit(spec.local_policy).alias("local_policy"),
        file_hash.alias("source_file_hash"),
        F.col(row_number).alias("row_number"),
        F.col("_labels").alias("labels"),
        F.col("_metrics").alias("metrics"),
        F.concat(
            F.array(F.lit(kind), F.lit(spec.source_type)),
            F.filter(
                F.array(*[F.try_element_at(F.col("_labels"), F.lit(f)) for f in spec.labels]),
                lambda v: v.isNotNull(),
            ),
        ).alias("tags"),
        F.array(F.lit("summary_only"), F.lit("raw_local_only")).alias("quality_flags"),
    )
    if kind == "data_source_runs":
        rows = rows.withColumn(
            "tracked_source_hash",
            F.nullif(stable_hash(F.try_element_at("labels", F.lit("source_name"))), F.lit("")),
        )
    missing = f"missing one of {', '.join(spec.time_fields)}"
    return rows.withColumn("reject_reason", F.when(F.col("event_time").isNull(), missing))


def file_hash(path: str = "path") -> Column:
    """The name of a file as it leaves: hashed."""
    return stable_hash(file_name(path))


def _missing_time(*names: str) -> Column:
    return F.when(_field(*names).isNull(), f"missing one of {', '.join(names)}").alias("reject_reason")


def learning_sessions(
    df: DataFrame, row_json: str = "row_json", path: str = "path", keep: Iterable[str] = ()
) -> DataFrame:
    """Lesson logs: topic label, hashed course, minutes, scores, completion.

    Rows without any time carry a ``reject_reason``.
    """
    names = ("occurred_at", "completed_at", "started_at", "date", "topic", "category", "skill", "course",
        "lesson", "title", "practice_minutes", "duration_minutes", "confidence_score", "confidence",
        "quiz_score", "score", "completed")
    times = ("occurred_at", "completed_at", "started_at", "date")
    return _parsed(df, row_json, names).select(
        *keep,
        _field(*times).alias("occurred_at"),
        clean_label(_field("topic", "category", "skill")).alias("topic"),
        stable_hash(_field("course", "lesson", "title")).alias("course_hash"),
        optional_int(_field("practice_minutes", "duration_minutes")).alias("practice_minutes"),
        optional_int(_field("confidence_score", "confidence")).alias("confidence_score"),
        optional_float(_field("quiz_score", "score")).alias("quiz_score"),
        optional_bool(_field("completed")).alias("completed"),
        stable_hash(file_name(path)).alias("source_file_hash"),
        _missing_time(*times),
    )


def trade_entries(
    df: DataFrame, row_json: str = "row_json", path: str = "path", keep: Iterable[str] = ()
) -> DataFrame:
    """Trade journal: hashed instrument, setup and notes; cleaned labels; returns and risk.

    Rows without any time carry a ``reject_reason``.
    """
    names = ("occurred_at", "closed_at", "entry_time", "date", "asset_class", "market", "instrument",
        "symbol", "ticker", "side", "setup", "strategy", "result", "outcome", "pnl_r", "r_multiple",
        "pnl_pct", "return_pct", "risk_pct", "duration_minutes", "emotion", "mood", "notes", "comment")
    times = ("occurred_at", "closed_at", "entry_time", "date")
    return _parsed(df, row_json, names).select(
        *keep,
        _field(*times).alias("occurred_at"),
        clean_label(_field("asset_class", "market")).alias("asset_class"),
        stable_hash(_field("instrument", "symbol", "ticker")).alias("instrument_hash"),
        clean_label(_field("side")).alias("side"),
        stable_hash(_field("setup", "strategy")).alias("setup_hash"),
        clean_label(_field("result", "outcome")).alias("result"),
        optional_float(_field("pnl_r", "r_multiple")).alias("pnl_r"),
        optional_float(_field("pnl_pct", "return_pct")).alias("pnl_pct"),
        optional_float(_field("risk_pct")).alias("risk_pct"),
        optional_int(_field("duration_minutes")).alias("duration_minutes"),
        clean_label(_field("emotion", "mood")).alias("emotion"),
        stable_hash(_field("notes", "comment")).alias("notes_hash"),
        stable_hash(file_name(path)).alias("source_file_hash"),
        _missing_time(*times),
    )


def note_rows(df: DataFrame, row_json: str = "row_json", keep: Iterable[str] = ("path",)) -> DataFrame:
    """JSON notes as the rows :func:`note_summaries` takes.

    The text is ``summary``, ``body`` or ``content``; tags are a text or an array.
    """
    times = ("occurred_at", "created_at", "updated_at", "date")
    parsed = _parsed(df, row_json, (*times, "title", "summary", "body", "content", "tags", "mood"))
    tags = F.col("_r.tags")
    listed = F.array_join(F.from_json(tags, "array<string>"), ",")
    return parsed.select(
        *keep,
        *[F.col(f"_r.{c}").alias(c) for c in (*times, "title")],
        F.coalesce(_field("summary", "body", "content"), F.lit("")).alias("summary"),
        F.when(F.startswith(F.ltrim(tags), F.lit("[")), listed).otherwise(tags).alias("tags"),
        F.col("_r.mood").alias("mood"),
    )


def note_summaries(df: DataFrame, imported_at: str, path: str = "path", keep: Iterable[str] = ()) -> DataFrame:
    """Notes (title, summary, tags text, mood) to hashes, word count and tags."""
    tags = F.transform(F.split(F.coalesce("tags", F.lit("")), ","), strip)
    kept = F.slice(F.filter(tags, lambda t: t != ""), 1, 12)
    labels = F.filter(F.transform(kept, lambda t: clean_label(t)), lambda t: t != "")
    return df.select(
        *keep,
        first_filled("occurred_at", "created_at", "updated_at", "date", col(imported_at)).alias("occurred_at"),
        stable_hash("title").alias("title_hash"),
        stable_hash("summary").alias("summary_hash"),
        word_count("summary").alias("word_count"),
        labels.alias("tags"),
        clean_label("mood").alias("mood"),
        stable_hash(file_name(path)).alias("source_file_hash"),
        file_extension(path).alias("source_extension"),
    )
