"""Route summaries over ordered track points."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.numbers import haversine_km
from ..functions.times import parse_iso, seconds_between

CHUNK_POINTS = 100_000


def route_summary(
    points: DataFrame, track: str = "track_id", idx: str = "idx", chunk_points: int = CHUNK_POINTS
) -> DataFrame:
    """Start, end, duration, distance, climb and point count per track.

    Consecutive points are paired inside chunks of ``idx``, then the few chunk
    borders of each track are paired. A track with a third of all points is
    spread over as many tasks as it has chunks and the result stays exact.
    """
    chunk = F.floor(F.col(idx) / chunk_points).alias("_chunk")
    rows = points.select(track, idx, "lat", "lon", "ele", "time", chunk)
    inside = W.partitionBy(track, "_chunk").orderBy(idx)
    paired = rows.select(
        "*",
        F.lag("lat").over(inside).alias("_lat"),
        F.lag("lon").over(inside).alias("_lon"),
        F.lag("ele").over(inside).alias("_ele"),
    )
    point = F.struct(idx, "lat", "lon", "ele", "time")
    chunks = paired.groupBy(track, "_chunk").agg(
        F.count(F.lit(1)).alias("_points"),
        F.sum(haversine_km(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon"))).alias("_km"),
        F.sum(F.greatest(F.col("ele") - F.col("_ele"), F.lit(0.0))).alias("_climb"),
        F.min_by(point, F.col(idx)).alias("_first"),
        F.max_by(point, F.col(idx)).alias("_last"),
    )
    across = W.partitionBy(track).orderBy("_chunk")
    bordered = chunks.withColumn("_prev", F.lag("_last").over(across))
    border_km = haversine_km(
        F.col("_prev.lat"), F.col("_prev.lon"), F.col("_first.lat"), F.col("_first.lon")
    )
    border_climb = F.greatest(F.col("_first.ele") - F.col("_prev.ele"), F.lit(0.0))
    zero = F.lit(0.0)
    total = bordered.groupBy(track).agg(
        F.sum(F.coalesce("_km", zero) + F.coalesce(border_km, zero)).alias("_km"),
        F.sum(F.coalesce("_climb", zero) + F.coalesce(border_climb, zero)).alias("_climb"),
        F.sum("_points").alias("point_count"),
        F.min_by("_first.time", "_chunk").alias("started_at"),
        F.max_by("_last.time", "_chunk").alias("ended_at"),
    )
    seconds = seconds_between(parse_iso("started_at"), parse_iso("ended_at"))
    minutes = F.greatest(F.coalesce(seconds / 60.0, zero), zero)
    return total.select(
        track,
        "started_at",
        "ended_at",
        F.round(minutes, 2).alias("duration_minutes"),
        # Binary noise depends on the order of addition: cut it before the final rounding.
        F.round(F.round("_km", 9), 3).alias("distance_km"),
        F.round(F.round("_climb", 6), 1).alias("elevation_gain_m"),
        "point_count",
    )
