"""Grouped rollups. Column names are parameters; defaults follow the domain tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from ..functions.times import AsOf, minute, recent, week_start


def rows(name: str) -> Column:
    return F.count(F.lit(1)).alias(name)


def rows_if(condition: Column, name: str) -> Column:
    return F.count_if(condition).alias(name)


def mean(value: str, digits: int | None, name: str) -> Column:
    average = F.avg(value)
    return (average if digits is None else F.round(average, digits)).alias(name)


def grouped(df: DataFrame, keys: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*keys).agg(*aggs)


def daily_rollup(
    df: DataFrame, ts: str, keys: Sequence[str], aggs: Sequence[Column], date_name: str
) -> DataFrame:
    """Calendar-day rollup by the date of ``ts`` and further keys."""
    return df.groupBy(F.to_date(F.col(ts)).alias(date_name), *keys).agg(*aggs)


def weather_daily(df: DataFrame) -> DataFrame:
    return daily_rollup(
        df,
        "forecast_time",
        ["location_id"],
        [
            rows("hourly_rows"),
            F.min("temperature_c").alias("min_temperature_c"),
            F.max("temperature_c").alias("max_temperature_c"),
            F.sum("precipitation_mm").alias("precipitation_mm"),
            F.sum("rain_mm").alias("rain_mm"),
            F.sum("snowfall_cm").alias("snowfall_cm"),
            F.max("snow_depth_cm").alias("max_snow_depth_cm"),
            F.max("wind_gust_kmh").alias("max_wind_gust_kmh"),
            F.min("visibility_m").alias("min_visibility_m"),
            F.max("fetched_at").alias("latest_fetch_at"),
        ],
        "forecast_date",
    )


def activity_daily(df: DataFrame) -> DataFrame:
    return daily_rollup(
        df,
        "logged_at",
        ["activity_type"],
        [
            rows("sessions"),
            mean("intensity", 2, "avg_intensity"),
            mean("mood", 2, "avg_mood"),
            mean("fatigue", 2, "avg_fatigue"),
            rows_if(F.col("pain_flag"), "pain_sessions"),
            rows_if(F.col("result") == "good", "good_sessions"),
            rows_if(F.col("result") == "skipped", "skipped_sessions"),
        ],
        "activity_date",
    )


def recommendation_daily(df: DataFrame, digits: int | None = 2) -> DataFrame:
    return daily_rollup(
        df,
        "generated_at",
        ["recommendation_type", "activity", "decision"],
        [
            rows("recommendations"),
            mean("score", digits, "avg_score"),
            F.max("generated_at").alias("latest_generated_at"),
        ],
        "recommendation_date",
    )


def _feedback_counts() -> list[Column]:
    return [
        rows("feedback_events"),
        rows_if(F.col("action") == "followed", "followed_events"),
        rows_if(F.col("action") == "skipped", "skipped_events"),
    ]


def feedback_daily(df: DataFrame, user_col: str | None = None) -> DataFrame:
    """Feedback per day, activity and action (so the follow rate is 0 or 1)."""
    keys = ([user_col] if user_col else []) + ["activity", "action"]
    daily = daily_rollup(
        df,
        "created_at",
        keys,
        [*_feedback_counts(), F.max("created_at").alias("latest_feedback_at")],
        "feedback_date",
    )
    return daily.withColumn("follow_rate", ratio(F.col("followed_events"), F.col("feedback_events")))


def useful_decision_days(
    daily: DataFrame,
    week_starts_on: str = "sunday",
    user_col: str | None = None,
    digits: int | None = 3,
    empty: float | None = 0.0,
) -> DataFrame:
    """Days of each week with at least one followed decision, from daily feedback."""
    keys = [user_col] if user_col else []
    weekly = daily.groupBy(
        *keys, week_start("feedback_date", week_starts_on).alias("week_start")
    ).agg(
        F.countDistinct(F.when(F.col("followed_events") > 0, F.col("feedback_date"))).alias(
            "useful_decision_days"
        ),
        F.sum("followed_events").alias("total_followed_events"),
        F.sum("skipped_events").alias("total_skipped_events"),
        F.sum("feedback_events").alias("_events"),
    )
    followed, events = F.col("total_followed_events"), F.col("_events")
    rate = (
        ratio(followed, events, digits, empty)
        if digits is not None
        else followed.cast("double") / F.nullif(events, F.lit(0))
    )
    return weekly.withColumn("follow_rate", rate).drop("_events")


def signal_daily(df: DataFrame, digits: int | None = 2) -> DataFrame:
    return daily_rollup(
        df,
        "occurred_at",
        ["domain", "source", "direction"],
        [
            rows("signals"),
            F.max("urgency").alias("max_urgency"),
            mean("confidence", digits, "avg_confidence"),
            F.max("ingested_at").alias("latest_ingested_at"),
        ],
        "signal_date",
    )


def feedback_profile(
    df: DataFrame,
    days: int = 30,
    as_of: AsOf = None,
    ts: str = "created_at",
    user_col: str | None = None,
) -> DataFrame:
    """Per activity: how often advice was followed and how it went, lately."""
    keys = ([user_col] if user_col else []) + ["activity"]
    counted = (
        df.filter(recent(ts, f"{days} days", as_of))
        .groupBy(*keys)
        .agg(
            *_feedback_counts(),
            rows_if(F.col("result") == "good", "good_results"),
            rows_if(F.col("result") == "bad", "bad_results"),
            F.max(ts).alias("latest_feedback_at"),
        )
    )
    return counted.withColumn(
        "follow_rate", ratio(F.col("followed_events"), F.col("feedback_events"))
    )


def decision_metrics(
    df: DataFrame, days: int = 7, as_of: AsOf = None, user_col: str | None = None
) -> DataFrame:
    """Useful days, followed, skipped and followed / (followed + skipped)."""
    followed = F.col("action") == "followed"
    counted = (
        df.filter(recent("created_at", f"{days} days", as_of))
        .groupBy(*([user_col] if user_col else []))
        .agg(
            F.countDistinct(F.when(followed, F.to_date("created_at"))).alias("useful_decision_days"),
            rows_if(followed, "followed_events"),
            rows_if(F.col("action") == "skipped", "skipped_events"),
            F.max("created_at").alias("updated_at"),
        )
    )
    return counted.withColumn(
        "follow_rate",
        ratio(F.col("followed_events"), F.col("followed_events") + F.col("skipped_events")),
    )


def week_summary(
    df: DataFrame, user_col: str, as_of: AsOf = None, days: int = 7, ts: str = "logged_at"
) -> DataFrame:
    """Per user: totals of the last days plus activity and result counts as lists.

    One scan: rows are first counted per (user, activity, result). The few
    counted rows are then unfolded into totals, activities and results, so the
    lists hold one entry per distinct label and no joins are needed.
    """
    scores = ("intensity", "mood", "fatigue")
    counted = (
        df.filter(recent(ts, f"{days} days", as_of))
        .groupBy(user_col, "activity_type", "result")
        .agg(
            rows("n"),
            *[F.sum(c).alias(c) for c in scores],
            *[F.count(c).alias(f"{c}_n") for c in scores],
            rows_if(F.col("pain_flag"), "pain"),
            F.max(ts).alias("latest"),
        )
    )
    measures = ("n", *scores, *[f"{c}_n" for c in scores], "pain")
    section = lambda name, label: F.struct(
        F.lit(name).alias("section"), label.cast("string").alias("label")
    )
    unfolded = counted.select(
        user_col,
        *measures,
        "latest",
        F.inline(
            F.array(
                section("total", F.lit("")),
                section("activity", F.col("activity_type")),
                section("result", F.col("result")),
            )
        ),
    )
    merged = unfolded.groupBy(user_col, "section", "label").agg(
        *[F.sum(c).alias(c) for c in measures], F.max("latest").alias("latest")
    )
    total = F.col("section") == "total"
    whole = lambda c: F.max(F.when(total, F.col(c)))
    average = lambda c: F.coalesce(
        F.round(whole(c).cast("double") / F.nullif(whole(f"{c}_n"), F.lit(0)), 1), F.lit(0.0)
    )

    def ordered(name: str, label: str) -> Column:
        entry = F.struct((-F.col("n")).alias("n"), F.col("label").alias("label"))
        entries = F.array_sort(F.collect_list(F.when(F.col("section") == name, entry)))
        return F.transform(
            entries, lambda e: F.struct(e["label"].alias(label), (-e["n"]).alias("sessions"))
        )

    return merged.groupBy(user_col).agg(
        whole("n").alias("sessions"),
        *[average(c).alias(f"avg_{c}") for c in scores],
        whole("pain").alias("pain_sessions"),
        F.max("latest").alias("latest_logged_at"),
        ordered("activity", "activity_type").alias("by_activity"),
        ordered("result", "result").alias("by_result"),
    )


def weekly_counts(df: DataFrame, user_col: str, as_of: AsOf = None, days: int = 7) -> DataFrame:
    """(user, activity, sessions) of the last days, the long form of ``by_activity``."""
    return (
        df.filter(recent("logged_at", f"{days} days", as_of))
        .groupBy(user_col, F.col("activity_type").alias("activity"))
        .agg(rows("sessions"))
    )


def counts_of_week(week: DataFrame, user_col: str) -> DataFrame:
    """The same rows as :func:`weekly_counts` unfolded from a week summary, without another scan."""
    return week.select(user_col, F.inline("by_activity")).withColumnRenamed("activity_type", "activity")


def per_minute_sales(
    df: DataFrame, ts: str, amount: str, customer: str, as_of: AsOf = None, window: str | None = "1 hour"
) -> DataFrame:
    """Orders, gross sales and exact active customers per minute."""
    kept = df.filter(recent(ts, window, as_of)) if window else df
    return kept.groupBy(minute(ts).alias("minute")).agg(
        rows("orders"),
        F.round(F.sum(amount), 2).alias("gross_sales"),
        F.countDistinct(customer).alias("active_customers"),
    )


def net_movement(
    df: DataFrame, key: str, delta: str, threshold: float, n: int | None = 50
) -> DataFrame:
    """Net change per key above a threshold, largest absolute change first."""
    net = df.groupBy(key).agg(
        F.sum(delta).alias("net_inventory_delta"), rows("inventory_events")
    )
    large = net.filter(F.abs("net_inventory_delta") > threshold)
    if n is None:
        return large
    return large.orderBy(F.abs("net_inventory_delta").desc(), F.col(key)).limit(n)


def table_counts(tables: Mapping[str, DataFrame], name: str = "table_name", value: str = "row_count") -> DataFrame:
    """Row counts of many tables as (name, count) rows."""
    parts = [
        df.agg(F.count(F.lit(1)).alias(value)).select(F.lit(label).alias(name), value)
        for label, df in tables.items()
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def metric_rows(parts: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """(metric, value) rows from single-row frames; no join between them."""
    frames = [
        df.select(F.lit(label).alias("metric"), F.col(column).cast("string").alias("value"))
        for label, df, column in parts
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


def ingest_profile(
    df: DataFrame, source: str, event_ts: str, ingested_at: str, key: str
) -> DataFrame:
    """Rows, missing times and approximate distinct keys per source."""
    return df.groupBy(source).agg(
        rows("rows_loaded"),
        rows_if(F.col(event_ts).isNull(), "missing_event_ts"),
        rows_if(F.col(ingested_at).isNull(), "missing_ingested_at"),
        F.approx_count_distinct(key, 0.02).alias("approx_keys"),
    )


#: Buckets of a key sketch are 2 to this power; its standard error is 0.8 %.
SKETCH_LOG_BUCKETS = 14
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_LOG_BUCKETS / 2)


def minute_sketches(df: DataFrame, source: str, ts: str, key: str) -> DataFrame:
    """Rows and a mergeable sketch of the distinct keys per source and minute.

    Stored, these answer for any span of minutes without the rows; a sketch has at most
    16 KB, however many keys it has seen.
    """
    return df.groupBy(source, F.date_trunc("minute", ts).alias("minute")).agg(
        rows("rows"), F.hll_sketch_agg(key, SKETCH_LOG_BUCKETS).alias("keys")
    )


def merge_sketches(sketches: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Sketches of spans from those of their minutes, or of larger spans from smaller ones."""
    return sketches.groupBy(*keys).agg(F.sum("rows").alias("rows"), F.hll_union_agg("keys").alias("keys"))


def sketched_keys(sketches: DataFrame) -> DataFrame:
    """The estimate in the place of the sketch."""
    return sketches.withColumn("approx_keys", F.hll_sketch_estimate("keys")).drop("keys")


def duplicate_groups(df: DataFrame, keys: Sequence[str], by: str) -> DataFrame:
    """Number of key groups with more than one copy, per ``by``."""
    copies = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
    return copies.groupBy(by).agg(rows("duplicate_records"))
