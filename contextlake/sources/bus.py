"""Message-bus reads (streaming or bounded) and change-record parsing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.text import col
from ..operators.latest import latest_by


def topic_list(topics: str | Sequence[str]) -> list[str]:
    """Topic names from comma-separated text or a sequence, trimmed, blanks dropped."""
    parts = topics.split(",") if isinstance(topics, str) else topics
    return [t.strip() for t in parts if t.strip()]


def read_bus(
    spark: SparkSession,
    topics: str | Sequence[str],
    *,
    bootstrap: str,
    starting: str = "latest",
    max_per_trigger: int = 10_000,
    batch: bool = False,
    watermark: str | None = "1 minute",
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Kafka topics as a stream, or as one bounded read with ``batch=True``.

    Needs the Kafka connector on the classpath. Several topics share one
    stream; offsets per trigger are limited and lost offsets do not fail it.
    """
    if starting not in ("earliest", "latest"):
        raise ValueError("starting must be 'earliest' or 'latest'")
    settings = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": ",".join(topic_list(topics)),
        **(options or {}),
    }
    if batch:
        return (
            spark.read.format("kafka")
            .options(**settings)
            .option("startingOffsets", "earliest")
            .option("endingOffsets", "latest")
            .load()
        )
    stream = (
        spark.readStream.format("kafka")
        .options(**settings)
        .option("startingOffsets", starting)
        .option("maxOffsetsPerTrigger", str(max_per_trigger))
        .option("failOnDataLoss", "false")
        .load()
    )
    return stream.withWatermark("timestamp", watermark) if watermark else stream


def read_file_stream(
    spark: SparkSession,
    path: str,
    schema: StructType,
    *,
    fmt: str = "parquet",
    max_files_per_trigger: int = 1_000,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """Files landing in a folder (or glob) as a stream, same downstream code as Kafka."""
    return (
        spark.readStream.format(fmt)
        .schema(schema)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .options(**(options or {}))
        .load(path)
    )


def bus_metadata(df: DataFrame) -> DataFrame:
    """Key text, position and value size of raw records."""
    return df.select(
        F.col("key").cast("string").alias("key"),
        "topic",
        "partition",
        "offset",
        F.length("value").alias("value_size"),
    )


def parse_cdc(df: DataFrame, row: StructType | str, payload: str = "json_payload") -> DataFrame:
    """Change records: before/after images, operation, log position and time."""
    row_ddl = row if isinstance(row, str) else row.simpleString()
    schema = (
        f"before {row_ddl}, after {row_ddl}, source struct<lsn:bigint,`table`:string,ts_ms:bigint>,"
        " op string, ts_ms bigint"
    )
    parsed = df.withColumn("_change", F.from_json(col(payload), schema))
    return parsed.select(
        *df.columns,
        F.col("_change.before").alias("before"),
        F.col("_change.after").alias("after"),
        F.col("_change.op").alias("op"),
        F.col("_change.source.lsn").alias("lsn"),
        F.coalesce("_change.ts_ms", "_change.source.ts_ms").alias("ts_ms"),
    )


def cdc_current_state(
    changes: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ("lsn",)
) -> DataFrame:
    """Table state after all changes: newest image per key, deleted keys dropped."""
    image = F.when(F.col("op") == "d", F.col("before")).otherwise(F.col("after"))
    keyed = changes.select("op", *order_by, image.alias("_row"))
    for key in keys:
        keyed = keyed.withColumn(f"_key_{key}", F.col(f"_row.{key}"))
    order: list[Column] = [F.col(c).desc() for c in order_by]
    newest = latest_by(keyed, [f"_key_{k}" for k in keys], order)
    return newest.filter(F.col("op") != "d").select("_row.*")
