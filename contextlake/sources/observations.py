"""Weather series and map elements: nested API payloads to rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import col
from ..functions.times import parse_iso
from ..operators.latest import latest_by

# ---- fixed values: output column -> (API array, default) ----
WEATHER_SERIES = {
    "temperature_c": ("temperature_2m", 0.0),
    "precipitation_mm": ("precipitation", 0.0),
    "rain_mm": ("rain", 0.0),
    "snowfall_cm": ("snowfall", 0.0),
    "snow_depth_cm": ("snow_depth", 0.0),
    "wind_speed_kmh": ("wind_speed_10m", 0.0),
    "wind_gust_kmh": ("wind_gusts_10m", 0.0),
    "visibility_m": ("visibility", 10000.0),
    "is_day": ("is_day", 1.0),
}


def explode_series(
    df: DataFrame,
    payload: str,
    root: str,
    time_array: str,
    series: Mapping[str, tuple[str, float]],
    keep: list[str],
) -> DataFrame:
    """Index-aligned arrays to rows; short or null entries take the default."""
    fields = ", ".join(f"`{name}`: array<double>" for name, _ in series.values())
    schema = f"struct<{root}: struct<`{time_array}`: array<string>, {fields}>>"
    parsed = df.select(*keep, F.from_json(col(payload), schema)[root].alias("_s"))
    rows = parsed.select(
        *keep, "_s", F.posexplode(f"_s.{time_array}").alias("_pos", "forecast_time_text")
    )
    values = [
        F.coalesce(F.get(F.col(f"_s.{name}"), F.col("_pos")), F.lit(default)).alias(out)
        for out, (name, default) in series.items()
    ]
    return rows.select(*keep, "forecast_time_text", *values)


def normalize_weather(
    df: DataFrame, payload: str, location_id: str = "location_id", fetched_at: str = "fetched_at"
) -> DataFrame:
    """Hourly forecast payloads, one per location, to weather rows."""
    rows = explode_series(
        df, payload, "hourly", "time", WEATHER_SERIES, [location_id, fetched_at]
    )
    return rows.select(
        F.col(location_id).alias("location_id"),
        parse_iso("forecast_time_text").alias("forecast_time"),
        *[c for c in WEATHER_SERIES if c != "is_day"],
        (F.col("is_day").cast("int") != 0).alias("is_day"),
        F.col(fetched_at).alias("fetched_at"),
    )


def weather_for_locations(
    payloads: DataFrame, locations: DataFrame, payload: str, location_id: str = "location_id"
) -> DataFrame:
    """Weather rows of the configured locations (equi-join on the location key)."""
    known = payloads.join(locations.select(location_id), location_id, "left_semi")
    return normalize_weather(known, payload, location_id)


def normalize_places(df: DataFrame, payload: str, order_by: list[Column]) -> DataFrame:
    """Map elements to spots; the first occurrence of an id wins.

    ``order_by`` orders the payload rows; elements keep their position inside one.
    """
    schema = (
        "struct<elements: array<struct<type: string, id: bigint, lat: double, lon: double,"
        " center: struct<lat: double, lon: double>,"
        " tags: struct<name: string, sport: string, leisure: string>>>>"
    )
    ranked = df.select(
        F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_by)]).alias("_order"),
        F.posexplode(F.from_json(col(payload), schema)["elements"]).alias("_pos", "_el"),
    )
    tag = lambda name: F.nullif(F.col(f"_el.tags.{name}"), F.lit(""))
    spot_id = F.concat(
        F.lit("osm_"),
        F.coalesce(F.col("_el.type"), F.lit("node")),
        F.lit("_"),
        F.col("_el.id").cast("string"),
    )
    tags = F.array_distinct(
        F.array_compact(
            F.array(
                F.lit("public"),
                tag("sport"),
                tag("leisure"),
                F.when(tag("sport") == "skateboard", F.lit("skate")),
                F.when(tag("sport") == "volleyball", F.lit("volleyball")),
            )
        )
    )
    spots = ranked.select(
        "_order",
        "_pos",
        spot_id.alias("spot_id"),
        F.coalesce(tag("name"), tag("leisure"), tag("sport"), spot_id).alias("label"),
        F.coalesce("_el.lat", "_el.center.lat").alias("latitude"),
        F.coalesce("_el.lon", "_el.center.lon").alias("longitude"),
        tags.alias("tags"),
        F.lit("overpass").alias("source"),
    ).filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    return latest_by(spots, ["spot_id"], [F.col("_order").asc(), F.col("_pos").asc()]).drop(
        "_order", "_pos"
    )
