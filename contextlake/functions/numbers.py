"""Numeric casts, bounds, ratios and distance."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, strip

EARTH_RADIUS_KM = 6371.0088


def optional_float(value: str | Column, digits: int = 6) -> Column:
    return F.round(strip(col(value).cast("string")).try_cast("double"), digits)


def optional_int(value: str | Column) -> Column:
    """Integer through double, truncating; null when missing or malformed."""
    return strip(col(value).cast("string")).try_cast("double").try_cast("int")


def optional_bool(value: str | Column) -> Column:
    text = F.lower(strip(col(value).cast("string")))
    return F.when(text != "", text.isin("1", "true", "yes", "y", "done", "completed"))


def strict_int(value: str | Column) -> Column:
    """Integer text only; ``7.0`` and words give null."""
    text = strip(col(value).cast("string"))
    return F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("int"))


def bounded_int(value: str | Column, low: int, high: int) -> Column:
    """Integer inside [low, high], else null (pair with a rejection rule)."""
    number = strict_int(value)
    return F.when(number.between(low, high), number)


def clamp(value: Column, low: int = 0, high: int = 100) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def percent_change(start: Column, end: Column) -> Column:
    return F.when(start == 0, F.lit(0.0)).otherwise((end - start) / start * 100)


def ratio(part: Column, whole: Column, digits: int = 3, empty: float | None = 0.0) -> Column:
    """part / whole rounded; ``empty`` is the answer for a zero denominator."""
    value = F.round(part.cast("double") / F.nullif(whole, F.lit(0)), digits)
    return value if empty is None else F.coalesce(value, F.lit(empty))


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    p1, p2 = F.radians(lat1), F.radians(lat2)
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    h = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    return EARTH_RADIUS_KM * 2 * F.atan2(F.sqrt(h), F.sqrt(1 - h))


# ---- repair of damaged fields ----
def ensure_str(value: str | Column, fallback: Column) -> Column:
    return F.coalesce(F.nullif(col(value), F.lit("")), fallback)


def ensure_int(value: str | Column, fallback: Column) -> Column:
    return F.coalesce(strict_int(value), fallback.cast("int"))


def ensure_float(value: str | Column, fallback: Column) -> Column:
    return F.coalesce(strip(col(value).cast("string")).try_cast("double"), fallback.cast("double"))


def clamp_enum(value: str | Column, allowed: Sequence[str], fallback: Column) -> Column:
    return F.when(col(value).isin(*allowed), col(value)).otherwise(fallback)


def duration_minutes(value: str | Column) -> Column:
    """``7.5h``, ``7:30`` or minutes → whole positive minutes, else null."""
    text = F.lower(strip(col(value)))
    hours = F.regexp_replace(text, "h$", "").try_cast("double") * 60
    clock = (
        F.substring_index(text, ":", 1).try_cast("int") * 60
        + F.regexp_replace(text, "^[^:]*:", "").try_cast("int")
    )
    minutes = (
        F.when(text.endswith("h"), hours.try_cast("int"))
        .when(F.contains(text, F.lit(":")), clock)
        .otherwise(text.try_cast("double").try_cast("int"))
    )
    return F.when(minutes > 0, minutes)
