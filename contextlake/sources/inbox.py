"""Recognising the kind of local export files by name and by their keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import col
from .files import file_extension, file_name, json_records

# ---- fixed values: file stem fragments, first match wins ----
STEM_RULES = (
    ("sleep", ("sleep",)),
    ("moto_learning", ("moto",)),
    ("trade_journal", ("trade", "journal")),
    ("training_sessions", ("training", "session")),
    ("habit_goals", ("habit", "goal")),
    ("tasks_and_projects", ("task", "todo", "productivity")),
    ("github_project_activity", ("github",)),
    ("market_watchlist_snapshot", ("watchlist", "market")),
    ("learning_activity", ("learning", "study")),
    ("finance_event_calendar", ("finance_event", "earnings")),
    ("health_metrics", (("metric", "health"),)),
    ("health_summary", ("health",)),
    ("location_visits", ("visit",)),
    ("location_area_summary", ("location", "area", "movement")),
    ("finance_transactions", ("expense", "transaction", "finance")),
    ("data_source_runs", ("source_run", "data_source", "freshness")),
    ("browser_and_app_usage", ("browser", "app_usage", "screen_time", "digital")),
    ("communications_metadata", ("communication", "message", "notification")),
    ("identity_documents", ("identity", "document")),
    ("secrets_inventory", ("credential", "rotation", "vault")),
    ("personal_notes", ("note", "summary")),
)
# ---- fixed values: key sets, first match wins; "any" needs one key, "all" every key ----
KEY_RULES = (
    ("sleep", "all", ("slept_at", "woke_at")),
    ("moto_learning", "any", ("lesson", "topic", "course", "practice_minutes", "confidence_score")),
    ("trade_journal", "any", ("symbol", "instrument", "pnl", "pnl_r", "setup", "entry_time")),
    ("training_sessions", "all", ("activity_type", "duration_minutes", "load_score")),
    ("habit_goals", "all", ("goal_bucket", "target_count", "done_count")),
    ("market_watchlist_snapshot", "all", ("symbol_bucket", "volatility_bucket")),
    ("github_project_activity", "all", ("repo_bucket", "activity_count", "focus_bucket")),
    ("learning_activity", "all", ("topic_bucket", "duration_minutes", "progress_state")),
    ("finance_event_calendar", "all", ("event_date", "event_bucket", "urgency")),
    ("health_summary", "all", ("metric_date", "metric_name", "metric_value", "unit")),
    ("location_area_summary", "all", ("area_bucket", "dwell_minutes", "movement_mode")),
    ("finance_transactions", "all", ("category_bucket", "amount_bucket", "currency")),
    ("data_source_runs", "all", ("source_name", "status", "freshness_minutes")),
    ("browser_and_app_usage", "all", ("activity_date", "category", "duration_minutes", "device_bucket")),
    ("tasks_and_projects", "all", ("updated_at", "project_bucket", "status", "priority_bucket")),
    ("communications_metadata", "all", ("occurred_at", "channel", "direction", "contact_bucket")),
    ("location_visits", "all", ("place_bucket", "dwell_minutes", "movement_mode")),
    ("health_metrics", "all", ("metric_date", "metric_name", "metric_value", "source_device_class")),
    ("identity_documents", "all", ("document_bucket", "status", "expiry_month", "pointer_bucket")),
    ("secrets_inventory", "all", ("credential_bucket", "rotation_due_month", "age_bucket", "vault_bucket")),
    ("personal_notes", "any", ("summary", "title", "body", "tags")),
)


def kind_by_name(path: str | Column) -> Column:
    """Kind from extension and file stem; null when the name decides nothing."""
    extension = file_extension(path)
    name = F.lower(file_name(path))
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    result = F.when(extension == "ics", "ics").when(extension == "md", "personal_notes")
    tabular = extension.isin("csv", "json")
    for kind, fragments in STEM_RULES:
        hit = F.lit(False)
        for fragment in fragments:
            part = F.lit(True)
            for word in (fragment,) if isinstance(fragment, str) else fragment:
                part = part & F.contains(stem, F.lit(word))
            hit = hit | part
        result = result.when(tabular & hit, kind)
    return result


def record_keys(row_json: str | Column) -> Column:
    """Lower-case keys of a record; empty for anything that is not an object."""
    return F.transform(F.coalesce(F.json_object_keys(col(row_json)), F.array()), lambda k: F.lower(k))


def kind_by_keys(keys: str | Column) -> Column:
    """Kind from the keys of a sample record; '' when unknown."""
    result = None
    for kind, mode, names in KEY_RULES:
        wanted = F.array(*[F.lit(n) for n in names])
        hit = (
            F.arrays_overlap(col(keys), wanted)
            if mode == "any"
            else F.size(F.array_except(wanted, col(keys))) == 0
        )
        result = F.when(hit, kind) if result is None else result.when(hit, kind)
    return result.otherwise("")


def with_kind(df: DataFrame, path: str = "path", text: str | None = "text") -> DataFrame:
    """Add ``kind``: by name, else for JSON by the keys of the first record, else ''.

    Text is looked at only where the name decides nothing, and its keys are
    taken out once before the rules are tried.
    """
    named = df.withColumn("_by_name", kind_by_name(path))
    if text is None:
        return named.withColumn("kind", F.coalesce("_by_name", F.lit(""))).drop("_by_name")
    undecided = F.col("_by_name").isNull() & (file_extension(path) == "json")
    sampled = named.withColumn("_keys", record_keys(first_record(F.when(undecided, F.col(text)))))
    kind = F.coalesce("_by_name", F.when(undecided, kind_by_keys("_keys")), F.lit(""))
    return sampled.withColumn("kind", kind).drop("_by_name", "_keys")


def first_record(text: str | Column) -> Column:
    """First record of a JSON document as text, without exploding it."""
    return F.get(json_records(F.btrim(col(text), F.lit(" \t\r\n"))), F.lit(0))


def scan_inbox(spark: SparkSession, root: str, read_content: bool = True) -> DataFrame:
    """Recursive listing of a folder with the detected kind of every file.

    Files that match no rule are dropped. All files are listed without their
    content; only JSON files are opened, to look at the keys of those whose
    names decide nothing. ``file`` is the path as other readers write it.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    columns = ("path", "length", F.col("_metadata.file_path").alias("file"))
    listed = with_kind(reader.load(root).select(*columns), text=None).filter(F.col("kind") != "")
    if not read_content:
        return listed
    opened = reader.option("pathGlobFilter", "*.[jJ][sS][oO][nN]").load(root)
    texts = opened.select(*columns, F.col("content").cast("string").alias("text"))
    by_keys = with_kind(texts.filter(kind_by_name("path").isNull())).drop("text").filter(F.col("kind") != "")
    return listed.unionByName(by_keys)
