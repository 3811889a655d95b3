"""A folder of local exports, listed once, parsed by kind and landed as envelopes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import event_id
from ..functions.times import AsOf, as_of_col
from ..operators import imports
from ..operators.envelope import as_text
from ..operators.sleep import normalize_sleep
from ..schemas import ENVELOPE, LAKE_VERSION
from ..session import work_dir
from ..sinks.tables import write_landing
from ..sources import files
from ..sources.csv_records import csv_records
from ..sources.inbox import scan_inbox
from ..streaming.folders import remove


@dataclass(frozen=True)
class Landing:
    """What the envelopes of a kind say about their source."""

    source_name: str
    event_type: str
    privacy_class: str
    source_tier: str
    source_type: str


# ---- fixed values: envelopes of the kinds that are no plain summaries ----
LANDINGS = {
    "ics": Landing(
        "calendar_events", "calendar_busy_block", "private_behavior_summary", "tier_2_personal_context", "local_calendar_export"
    ),
    "sleep": Landing("sleep_quality", "sleep_quality_night", "private_health_summary", "", ""),
    "moto_learning": Landing(
        "moto_learning_log", "moto_learning_session", "private_behavior_summary", "tier_2_personal_context", "local_csv_json_import"
    ),
    "trade_journal": Landing(
        "trade_journal_summary", "trade_journal_entry", "private_finance_summary", "tier_3_sensitive_life", "local_trade_journal_export"
    ),
    "personal_notes": Landing(
        "personal_notes_summary", "personal_note_summary", "private_behavior_summary", "tier_2_personal_context",
        "local_markdown_json_summary",
    ),
}
KINDS = (*LANDINGS, *imports.SUMMARY_SPECS)
_NIGHT_FIELDS = ("slept_at", "woke_at", "quality_score", "recovery_score", "in_bed_minutes", "source")


def inbox_records(spark: SparkSession, root: str, listing: DataFrame) -> DataFrame:
    """Records of the tabular and JSON files: ``kind``, ``file``, ``row_number``, ``row_json``, ``is_object``."""
    kinds = listing.select("file", "kind")
    tabular = csv_records(spark, root).join(kinds, "file").select(
        "kind", "file", "row_number", "row_json", F.lit(True).alias("is_object")
    )
    documents = _documents(spark, root, "*.[jJ][sS][oO][nN]").join(kinds, "file")
    return tabular.unionByName(
        files.explode_json_rows(documents, "text").select("kind", "file", F.col("row_number").cast("long"), "row_json", "is_object")
    )


def _documents(spark: SparkSession, root: str, glob: str) -> DataFrame:
    reader = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return reader.text(root, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))


def _filled(value: Column, kind: str) -> Column:
    return F.nullif(value, F.lit("")) if kind == "string" else value


def _events(
    df: DataFrame, landing: Landing, time: str, fields: list[str], more: dict[str, Column] | None = None
) -> DataFrame:
    """Rows of one kind in the common form; ``fields`` are the payload, without what is empty or null."""
    kinds = dict(df.dtypes)
    filled = [_filled(F.col(c) if kinds[c] != "timestamp" else as_text(F.col(c), "timestamp"), kinds[c]).alias(c) for c in fields]
    time_text = F.col(time) if kinds[time] == "string" else as_text(F.col(time), kinds[time])
    values = {
        "source_name": F.lit(landing.source_name),
        "event_type": F.lit(landing.event_type),
        "event_time": time_text,
        "privacy_class": F.lit(landing.privacy_class),
        "source_tier": F.lit(landing.source_tier),
        "source_type": F.lit(landing.source_type),
        "raw_policy": F.lit("local_raw_only"),
        "local_policy": F.lit("summarized_landing_only"),
        "source_file_hash": F.col("source_file_hash"),
        "row_number": F.col("row_number").cast("long"),
        "payload": F.to_json(F.struct(*filled)),
        "payload_summary": F.lit("{}"),
        "metrics": F.create_map().cast("map<string,double>"),
        "tags": F.array().cast("array<string>"),
        "quality_flags": F.array().cast("array<string>"),
        "reject_reason": F.col("reject_reason"),
        **(more or {}),
    }
    return df.select(*[c.alias(n) for n, c in values.items()])


def summary_events(records: DataFrame, kind: str, imported_at: Column) -> DataFrame:
    """One of the plain summary kinds: labels and metrics side by side in the payload."""
    spec = imports.SUMMARY_SPECS[kind]
    rows = imports.summarize_source(records, kind, path="file").withColumn("imported_at", imported_at)
    fields = ["event_time", "source_file_hash", "row_number", "imported_at"]
    flat = rows.withColumns(
        {f: F.try_element_at("labels", F.lit(f)) for f in spec.labels if f not in rows.columns}
        | {f"_{f}": F.try_element_at("labels", F.lit(f)) for f in spec.labels if f in rows.columns}
        | {f: F.try_element_at("metrics", F.lit(f)) for f in spec.metrics}
    )
    # A label named like a column of the row keeps its name in the payload only.
    parts = [F.col(f) for f in fields]
    parts += [F.col(f"_{f}" if f in rows.columns else f).alias(f) for f in spec.labels]
    parts += [F.col(f) for f in spec.metrics]
    parts += [F.col("tracked_source_hash")] if "tracked_source_hash" in rows.columns else []
    landing = Landing(kind, spec.event_type, spec.privacy_class, spec.source_tier, spec.source_type)
    return _events(
        flat, landing, "event_time", fields,
        {
            "payload": F.to_json(F.struct(*parts)),
            "payload_summary": F.to_json(F.struct("source_file_hash", "row_number", "labels")),
            **{c: F.col(c) for c in ("metrics", "tags", "quality_flags", "raw_policy", "local_policy")},
        },
    )


def lesson_events(records: DataFrame, imported_at: Column) -> DataFrame:
    rows = imports.learning_sessions(records, path="file", keep=("row_number",)).withColumn("imported_at", imported_at)
    payload = [c for c in rows.columns if c not in ("row_number", "reject_reason")]
    return _events(rows, LANDINGS["moto_learning"], "occurred_at", payload)


def trade_events(records: DataFrame, imported_at: Column) -> DataFrame:
    rows = imports.trade_entries(records, path="file", keep=("row_number",)).withColumn("imported_at", imported_at)
    payload = [c for c in rows.columns if c not in ("row_number", "reject_reason")]
    return _events(rows, LANDINGS["trade_journal"], "occurred_at", payload)


def note_events(notes: DataFrame, imported_at: Column) -> DataFrame:
    """Notes in the form of :func:`imports.note_rows`; a note without a time has that of the import."""
    timed = notes.withColumn("_imported", imported_at)
    rows = imports.note_summaries(timed, "_imported", path="file", keep=("row_number",)).withColumns(
        {"imported_at": imported_at, "reject_reason": F.lit(None).cast("string")}
    )
    payload = [c for c in rows.columns if c != "reject_reason"]
    return _events(rows, LANDINGS["personal_notes"], "occurred_at", payload)


def night_events(records: DataFrame, imported_at: Column) -> DataFrame:
    fields = F.from_json("row_json", ", ".join(f"{f} string" for f in _NIGHT_FIELDS))
    keep = ("row_number", "source_file_hash")
    texts = records.select("row_number", imports.file_hash("file").alias("source_file_hash"), fields.alias("_r")).select(*keep, "_r.*")
    valid, rejected = normalize_sleep(texts, keep=keep)
    rows = valid.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(rejected.drop("in_bed"))
    payload = ["slept_at", "woke_at", "duration_minutes", "quality_score", "recovery_score", "sleep_efficiency", "source", "imported_at"]
    return _events(rows.withColumn("imported_at", imported_at), LANDINGS["sleep"], "woke_at", payload)


def calendar_block_events(documents: DataFrame, imported_at: Column) -> DataFrame:
    blocks = files.calendar_blocks(documents, path="file").withColumns(
        {
            "row_number": F.col("block_number"),
            "imported_at": imported_at,
            "reject_reason": F.when(F.col("started_at").isNull(), "missing or unreadable DTSTART"),
        }
    )
    payload = ["started_at", "ended_at", "duration_minutes", "all_day", "summary_hash", "summary_category", "location_present",
        "description_present", "attendee_count", "status", "source_file_hash", "source_extension", "imported_at"]
    return _events(
        blocks, LANDINGS["ics"], "started_at", payload,
        {
            "payload_summary": F.to_json(F.struct("duration_minutes", "summary_category")),
            "metrics": F.create_map(F.lit("duration_minutes"), F.col("duration_minutes").cast("double")),
            "tags": F.array(F.lit("calendar"), F.col("summary_category")),
        },
    )


def broken_rows(records: DataFrame) -> DataFrame:
    """Records that are no objects, with a reason, in the common form."""
    landing = Landing("", "", "", "", "")
    rows = records.select(
        "kind", imports.file_hash("file").alias("source_file_hash"), "row_number", F.lit(None).cast("string").alias("none"),
        F.lit("row is not a JSON object").alias("reject_reason"),
    )
    return _events(rows, landing, "none", ["source_file_hash"], {"source_name": F.col("kind")})


def envelopes(events: DataFrame, ingested_at: AsOf = None) -> DataFrame:
    """Accepted rows in the ENVELOPE schema.

    A row is known by its source, file and number, so an import that runs again makes
    the same ids, whenever it runs.
    """
    key = F.concat_ws(":", "source_name", "event_type", "source_file_hash", F.col("row_number").cast("string"))
    values = {
        "lake_version": F.lit(LAKE_VERSION),
        "event_id": event_id(key),
        "ingested_at": as_text(as_of_col(ingested_at), "timestamp"),
        "consent_scope": F.lit("local_personal_use"),
        "subject_id": F.lit("self"),
        "schema_version": F.lit("1"),
        "idempotency_key": key,
        "provenance": F.lit("{}"),
    }
    accepted = events.filter(F.col("reject_reason").isNull())
    return accepted.select(*[values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in ENVELOPE.fields])


def read_inbox(spark: SparkSession, root: str, imported_at: AsOf = None, staging: str | None = None) -> DataFrame:
    """Every row of every known file under ``root`` in the common form, rejected ones with a reason.

    One listing routes the files. Tabular and JSON records are written once, a
    partition for each kind, so that each parser reads the rows of its kind and no
    others; notes and calendars are read as documents. Files of unknown kind are left out,
    and empty files hold no rows. The listing and the records stand in the folder ``staging``.
    """
    staging = staging or work_dir(spark, "inbox")
    at = as_text(as_of_col(imported_at), "timestamp")
    listing = _written(scan_inbox(spark, root), f"{staging}/listing")
    records = inbox_records(spark, root, listing)
    known = _written(records.filter(F.col("kind").isin(*KINDS)), f"{staging}/records", "kind")
    whole = known.filter("is_object")
    of = lambda kind: whole.filter(F.col("kind") == kind)
    parsers: dict[str, Callable[[DataFrame, Column], DataFrame]] = {
        "sleep": night_events, "moto_learning": lesson_events, "trade_journal": trade_events,
    }
    parts = [parse(of(kind), at) for kind, parse in parsers.items()]
    parts += [summary_events(of(kind), kind, at) for kind in imports.SUMMARY_SPECS]
    parts.append(note_events(imports.note_rows(of("personal_notes"), keep=("file", "row_number")), at))
    markdown = files.parse_notes(_documents(spark, root, "*.[mM][dD]"))
    parts.append(note_events(markdown.withColumn("row_number", F.lit(1)), at))
    parts.append(calendar_block_events(_documents(spark, root, "*.[iI][cC][sS]"), at))
    parts.append(broken_rows(known.filter("NOT is_object")))
    return reduce(DataFrame.unionByName, parts)


def import_inbox(
    spark: SparkSession, root: str, landing_root: str, rejects_path: str, imported_at: AsOf = None, dt: str | Column | None = None,
    compression: str | None = None,
) -> None:
    """Land an inbox: envelopes under ``landing_root``, rejected rows with their reasons in ``rejects_path``.

    Rows are parsed once and staged; both outputs come from what was staged. A staged file holds rows of
    one kind, so envelopes are landed without a shuffle; ``compression`` is that of the landing files.
    What was staged is removed when it has been used; an import that stops leaves it.
    """
    staging = work_dir(spark, "inbox")
    events = _written(read_inbox(spark, root, imported_at, staging), f"{staging}/events")
    remove(spark, f"{staging}/records")
    write_landing(envelopes(events, imported_at), landing_root, dt, compression, gathered=True)
    rejected = events.filter(F.col("reject_reason").isNotNull())
    rejected.select("source_name", "source_file_hash", "row_number", "reject_reason").write.mode("append").parquet(rejects_path)
    remove(spark, staging)


#: Rows of a staged file at most. Files are dealt out by their bytes; staged rows take few, but time to parse.
ROWS_PER_FILE = 50_000


def _written(df: DataFrame, path: str, *partitions: str) -> DataFrame:
    spread = df.hint("rebalance", *partitions) if partitions else df
    spread.write.option("maxRecordsPerFile", ROWS_PER_FILE).partitionBy(*partitions).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
