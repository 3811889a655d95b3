"""Bus → bronze and landing → bronze / silver / gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.hashing import event_id, event_key
from ..functions.text import col
from ..functions.times import AsOf, as_of_col, parse_iso
from ..functions.wire import decode_avro_payload, decode_json_payload, payload_size, schema_id
from ..operators.latest import latest_by
from ..schemas import BRONZE_EVENT, MEDALLION_EVENT
from ..session import work_dir
from ..sinks.id_index import IdIndex
from ..sinks.tables import counted_writer, prune_to, touched_partitions
from ..sources.files import read_landing

GOLD_CONDITION = "source_name = 'daily_context_profile' OR event_type LIKE 'decision_%'"


def to_bronze(
    bus: DataFrame,
    value: str = "value",
    avro_schemas: Mapping[int, str] | None = None,
    on_error: str = "null",
    clamp_size: bool = False,
) -> DataFrame:
    """Raw bus records in the fixed seven-column order, payload decoded in the JVM.

    With ``avro_schemas`` (registry id → schema) payloads are Avro, else JSON.
    """
    payload = (
        decode_avro_payload(value, avro_schemas, on_error)
        if avro_schemas
        else decode_json_payload(value, on_error)
    )
    values = {
        "event_source": F.col("topic"),
        "event_time": F.col("timestamp"),
        "schema_id": schema_id(value),
        "payload_size": payload_size(value, clamp_size),
        "json_payload": payload,
        "partition": F.col("partition"),
        "offset": F.col("offset"),
    }
    return bus.select(*[values[f.name].alias(f.name) for f in BRONZE_EVENT.fields])


def landing_to_bronze(landing: DataFrame, loaded_at: AsOf = None, keep_event_id: bool = True) -> DataFrame:
    """Landing envelopes to medallion rows; unreadable times become null.

    ``event_id`` is carried by default so that loads can be repeated safely;
    without it the result has the plain nine columns.
    """
    values = {
        "event_time": parse_iso("event_time"),
        "ingested_at": parse_iso("ingested_at"),
        "json_payload": F.col("payload"),
        "loaded_at": as_of_col(loaded_at).cast("timestamp"),
    }
    columns = [
        values.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in MEDALLION_EVENT.fields
    ]
    return landing.select(*(["event_id"] if keep_event_id else []), *columns)


def to_silver(bronze: DataFrame) -> DataFrame:
    """Rows with a time, a source and a type."""
    return bronze.filter("event_time IS NOT NULL AND source_name IS NOT NULL AND event_type IS NOT NULL")


def to_gold(bronze: DataFrame) -> DataFrame:
    """Decision rows. ``_`` in the pattern matches any character, as in SQL LIKE."""
    return bronze.filter(GOLD_CONDITION)


def project(df: DataFrame, mapping: Mapping[str, str | Column]) -> DataFrame:
    """Rename and cast: output name → column name or expression."""
    return df.select(*[col(c).alias(name) for name, c in mapping.items()])


# ---- fixed values: columns of the staging projections ----
STAGING = {
    "weather_hourly": (
        "location_id", "forecast_time", "temperature_c", "precipitation_mm", "rain_mm", "snowfall_cm",
        "snow_depth_cm", "wind_speed_kmh", "wind_gust_kmh", "visibility_m", "is_day", "fetched_at",
    ),
    "readiness_scores": ("activity", "location_id", "score", "decision", "explanation", "computed_at"),
    "spots": ("spot_id", "label", "latitude", "longitude", "tags", "source", "updated_at"),
    "recommendation_events": (
        "recommendation_type", "activity", "location_id", "score", "decision", "reasons", "generated_at",
    ),
    "decision_feedback_events": ("activity", "action", "result", "note", "created_at"),
    "signal_events": (
        "signal_id", "domain", "source", "title", "direction", "urgency", "confidence", "summary",
        "occurred_at", "ingested_at",
    ),
    "daily_context_profiles": (
        "profile_date", "timezone", "top_activity", "top_decision", "top_score", "readiness_state",
        "sessions_7d", "avg_mood_7d", "avg_fatigue_7d", "pain_sessions_7d", "useful_decision_days_7d",
        "follow_rate_7d", "open_goal_count", "signal_count_7d", "highest_signal_domain",
        "highest_signal_urgency", "context_summary", "generated_at",
    ),
}


def stage(df: DataFrame, columns: Sequence[str] | str) -> DataFrame:
    """Column-pruning projection, by list or by the name of a staging model."""
    return df.select(*(STAGING[columns] if isinstance(columns, str) else columns))


#: Columns that name a partition of a layer.
LAYER_PARTITIONS = ("source_name", "event_day")


def load_medallion(
    spark: SparkSession,
    landing_path: str,
    bronze_path: str,
    silver_path: str,
    gold_path: str,
    staging: str,
    index_path: str | None = None,
) -> dict[str, int]:
    """Load landing events into bronze, silver and gold; returns rows written per layer.

    The landing files are parsed once into ``staging`` (a new folder), one row
    per ``event_id``: the last ingested one, ties broken by its own columns, so every
    run picks the same. Lines without an id get one from their source, type, time and
    payload, so different lines stay different and a line that comes again is known.
    Layers are partitioned by source and event day, null included.

    Each layer inserts the ids it lacks. Which it has stands in an index bucketed by id
    (``index_path``, beside bronze by default): an id is one row of a layer even if it
    comes again with another day or from another source, and no layer is read. A load
    writes down its new ids before it inserts them and enters them afterwards. One that
    stopped in between is settled by the next: of its ids those count that the layers
    have, looked up in the partitions they were meant for. Layers older than their
    index are read once.
    """
    incoming = identified(landing_to_bronze(read_landing(spark, landing_path)))
    order = [F.col(c).asc_nulls_last() for c in incoming.columns if c not in ("event_id", "loaded_at")]
    newest = latest_by(incoming, ["event_id"], [F.col("ingested_at").desc_nulls_last(), *order])
    paths = {"bronze": bronze_path, "silver": silver_path, "gold": gold_path}
    index = open_index(spark, incoming.schema, paths, index_path or f"{bronze_path.rstrip('/')}_ids")
    _write_counted(index.with_held_layers(newest), staging, "overwrite")
    staged = spark.read.schema(StructType([*incoming.schema.fields, *StructType.fromDDL("held_layers array<string>")])).parquet(staging)
    fresh = {
        name: rows.filter(~F.array_contains("held_layers", name)).drop("held_layers")
        for name, rows in (("bronze", staged), ("silver", to_silver(staged)), ("gold", to_gold(staged)))
    }
    marked = [rows.select("event_id", F.lit(name).alias("layer"), *LAYER_PARTITIONS) for name, rows in fresh.items()]
    load = index.begin(reduce(DataFrame.unionByName, marked))
    written = {name: _append_layer(spark, rows, paths[name]) for name, rows in fresh.items()}
    index.finish(load, index.pending()[load])
    index.compact()
    return written


def open_index(spark: SparkSession, schema: StructType, paths: Mapping[str, str], index_path: str) -> IdIndex:
    """The index of the layers, made from them if it is missing, with stopped loads settled."""
    index = IdIndex(spark, index_path)
    if not index.exists:
        layouts = {name: layer_partitions(spark, path) for name, path in paths.items()}
        held = [
            spark.read.schema(schema).parquet(paths[name]).select("event_id", F.lit(name).alias("layer"))
            for name, layout in layouts.items()
            if layout is not None
        ]
        index.create(reduce(DataFrame.unionByName, held) if held else None)
    for load, ids in index.pending().items():
        index.finish(load, reduce(DataFrame.unionByName, [inserted(spark, schema, ids, n, p) for n, p in paths.items()]))
    return index


def inserted(spark: SparkSession, schema: StructType, ids: DataFrame, name: str, path: str) -> DataFrame:
    """Of the ids that a stopped load meant for a layer, those that the layer has."""
    wanted = ids.filter(F.col("layer") == name)
    layout = layer_partitions(spark, path)
    if layout is None:
        return wanted.limit(0).select("event_id", "layer")
    touched = touched_partitions(wanted, LAYER_PARTITIONS, work_dir(spark, "stopped-load"))
    layer = spark.read.schema(schema).parquet(path)
    held = prune_to(layer, touched, layout).select("event_id").distinct()
    return wanted.join(held, "event_id").select("event_id", "layer")


def identified(bronze: DataFrame) -> DataFrame:
    """Rows with an id each, computed where it is missing, and their ``event_day``."""
    line = event_key(
        F.col("source_name"),
        F.col("event_type"),
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"),
        F.col("json_payload"),
    )
    given = F.when(F.trim("event_id") != "", F.col("event_id"))
    return bronze.withColumns(
        {"event_id": F.coalesce(given, event_id(line)), "event_day": F.date_format("event_time", "yyyy-MM-dd")}
    )


def layer_partitions(spark: SparkSession, path: str) -> list[str] | None:
    """Partition columns of a stored layer; None if it holds no rows yet.

    Layers written before days were a partition go on by source alone.
    """
    if not _has_data(spark, path):
        return None
    try:
        stored = spark.read.parquet(path).columns
    except AnalysisException as error:
        if error.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return None
    return [c for c in LAYER_PARTITIONS if c in stored]


def held_ids(
    spark: SparkSession, batch: DataFrame, touched: DataFrame, path: str, partitions: Sequence[str] = LAYER_PARTITIONS
) -> DataFrame:
    """Event ids that a layer holds in the touched partitions."""
    layer = spark.read.schema(batch.schema).parquet(path)
    return prune_to(layer, touched, partitions).select("event_id")


def _append_layer(spark: SparkSession, fresh: DataFrame, path: str) -> int:
    layout = layer_partitions(spark, path)
    if layout is None:
        return _write_counted(fresh, path, "append", LAYER_PARTITIONS)
    missing = [c for c in LAYER_PARTITIONS if c not in layout]
    return _write_counted(fresh.drop(*missing), path, "append", layout)


def _write_counted(df: DataFrame, path: str, mode: str, partitions: Sequence[str] = ()) -> int:
    writer, seen = counted_writer(df, partitions)
    writer = writer.mode(mode)
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)
    return seen.get["rows"]


def _has_data(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
