"""Sleep nights: validation and per-user summary."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import bounded_int, strict_int
from ..functions.times import parse_iso, seconds_between
from .quality import split_valid


def normalize_sleep(
    df: DataFrame, source: str = "local_sleep_log", keep: tuple[str, ...] = ()
) -> tuple[DataFrame, DataFrame]:
    """(valid nights, rejected rows with a reason) from text columns."""
    start, end = parse_iso("slept_at"), parse_iso("woke_at")
    quality_text = F.coalesce(F.col("quality_score").cast("string"), F.lit("0"))
    numbers = F.struct(
        F.floor(seconds_between(start, end) / 60).cast("int").alias("duration_minutes"),
        F.nullif(strict_int("in_bed_minutes"), F.lit(0)).alias("in_bed"),
        bounded_int(quality_text, 1, 100).alias("quality_score"),
        bounded_int(F.coalesce(F.col("recovery_score").cast("string"), quality_text), 1, 100).alias(
            "recovery_score"
        ),
    )
    # A generated column is worked out once; the rules below, pushed past a projection, would
    # each read the times again.
    timed = df.select("*", F.explode(F.array(numbers)).alias("_n")).withColumn(
        "in_bed", F.coalesce("_n.in_bed", "_n.duration_minutes")
    )
    rows = timed.select(
        *keep,
        F.nullif("slept_at", F.lit("")).alias("slept_at"),
        F.nullif("woke_at", F.lit("")).alias("woke_at"),
        F.col("_n.duration_minutes").alias("duration_minutes"),
        "in_bed",
        F.col("_n.quality_score").alias("quality_score"),
        F.col("_n.recovery_score").alias("recovery_score"),
        F.round(F.col("_n.duration_minutes") / F.nullif("in_bed", F.lit(0)), 3).alias("sleep_efficiency"),
        F.coalesce(F.nullif("source", F.lit("")), F.lit(source)).alias("source"),
    )
    valid, rejected = split_valid(
        rows,
        {
            "slept_at and woke_at are required": F.col("slept_at").isNull() | F.col("woke_at").isNull(),
            "time is not readable": F.col("duration_minutes").isNull(),
            "duration must be positive": F.col("duration_minutes") <= 0,
            "quality_score must be between 1 and 100": F.col("quality_score").isNull(),
            "recovery_score must be between 1 and 100": F.col("recovery_score").isNull(),
            "in_bed_minutes must be >= duration": F.col("in_bed") < F.col("duration_minutes"),
        },
    )
    return valid.drop("in_bed"), rejected


def sleep_summary(nights: DataFrame, user_col: str = "user_id") -> DataFrame:
    """Per user: nights, the latest night's values and averages."""
    woke = parse_iso("woke_at")
    last = F.max_by(
        F.struct("woke_at", "duration_minutes", "quality_score", "recovery_score"),
        F.struct(woke, F.col("duration_minutes"), F.col("quality_score"), F.col("recovery_score")),
    )
    grouped = nights.groupBy(user_col).agg(
        F.count(F.lit(1)).alias("nights"),
        last.alias("_last"),
        F.round(F.avg("duration_minutes"), 1).alias("avg_duration_minutes"),
        F.round(F.avg("quality_score"), 1).alias("avg_quality_score"),
        F.round(F.avg("recovery_score"), 1).alias("avg_recovery_score"),
        # Three-decimal ratios: averaged as decimals the result does not depend on row order.
        F.round(F.avg(F.col("sleep_efficiency").cast("decimal(9,3)")), 3)
        .cast("double")
        .alias("avg_sleep_efficiency"),
    )
    return grouped.select(
        user_col,
        "nights",
        F.col("_last.woke_at").alias("latest_woke_at"),
        F.col("_last.duration_minutes").alias("latest_duration_minutes"),
        F.col("_last.quality_score").alias("latest_quality_score"),
        F.col("_last.recovery_score").alias("latest_recovery_score"),
        "avg_duration_minutes",
        "avg_quality_score",
        "avg_recovery_score",
        "avg_sleep_efficiency",
    )


def sleep_daily(events: DataFrame, payload: str = "json_payload") -> DataFrame:
    """Nights and averages per date from stored event payloads, parsed once per row."""
    schema = "duration_minutes double, quality_score double, recovery_score double, sleep_efficiency double"
    nights = events.filter(
        (F.col("source_name") == "sleep_quality") & (F.col("event_type") == "sleep_quality_night")
    ).select(F.to_date("event_time").alias("sleep_date"), F.from_json(payload, schema).alias("p"))
    return nights.groupBy("sleep_date").agg(
        F.count(F.lit(1)).alias("nights"),
        F.avg("p.duration_minutes").alias("avg_duration_minutes"),
        F.avg("p.quality_score").alias("avg_quality_score"),
        F.avg("p.recovery_score").alias("avg_recovery_score"),
        F.avg("p.sleep_efficiency").alias("avg_sleep_efficiency"),
    )
