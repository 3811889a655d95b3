"""The daily decision as one lazy chain: weather → scores → recommendations → profile."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import AsOf
from ..operators.profile import daily_profile
from ..operators.rollups import counts_of_week, decision_metrics, feedback_profile, week_summary
from ..operators.rules import WEEKLY_GOALS, readiness_scores, recommend
from ..operators.sleep import sleep_summary


@dataclass(frozen=True)
class DailyInputs:
    """Source tables of the daily decision. ``user_locations`` maps users to weather locations."""

    weather: DataFrame
    user_locations: DataFrame
    activity: DataFrame
    feedback: DataFrame
    signals: DataFrame
    sleep: DataFrame


def user_scores(inputs: DailyInputs, user_col: str = "user_id") -> DataFrame:
    """Readiness of every location a user follows.

    The location side is one row per location, an array of its activities'
    scores: a city that holds most users is joined once per user and unfolded
    afterwards, and a hot location can be split.
    """
    scores = readiness_scores(inputs.weather)
    others = [c for c in scores.columns if c != "location_id"]
    of_location = scores.groupBy("location_id").agg(F.collect_list(F.struct(*others)).alias("_scores"))
    followed = inputs.user_locations.select(user_col, "location_id").join(of_location, "location_id")
    return followed.select("location_id", user_col, F.inline("_scores"))


def daily_recommendations(
    inputs: DailyInputs,
    as_of: AsOf = None,
    goals: Mapping[str, int] = WEEKLY_GOALS,
    user_col: str = "user_id",
) -> DataFrame:
    week = week_summary(inputs.activity, user_col, as_of)
    return recommend(
        user_scores(inputs, user_col),
        week,
        counts_of_week(week, user_col),
        feedback_profile(inputs.feedback, 30, as_of, user_col=user_col),
        sleep_summary(inputs.sleep, user_col),
        user_col=user_col,
        goals=goals,
    )


def daily_profiles(
    inputs: DailyInputs,
    as_of: AsOf = None,
    goals: Mapping[str, int] = WEEKLY_GOALS,
    user_col: str = "user_id",
    timezone: str = "UTC",
) -> DataFrame:
    week = week_summary(inputs.activity, user_col, as_of)
    return daily_profile(
        inputs.user_locations.select(user_col),
        daily_recommendations(inputs, as_of, goals, user_col),
        week,
        decision_metrics(inputs.feedback, 7, as_of, user_col),
        inputs.signals,
        counts_of_week(week, user_col),
        sleep_summary(inputs.sleep, user_col),
        user_col=user_col,
        goals=goals,
        timezone=timezone,
        as_of=as_of,
    )


def kpis(
    latest_profile: DataFrame, useful_days: DataFrame, recommendation_daily: DataFrame,
    signal_daily: DataFrame, runs: DataFrame, goals: DataFrame,
) -> DataFrame:
    """Headline numbers as (metric, value) rows; each metric is its own small aggregate."""
    text = lambda c: c.cast("string").alias("value")

    def one(metric: str, df: DataFrame, value) -> DataFrame:
        return df.agg(text(value)).select(F.lit(metric).alias("metric"), "value")

    recent = F.max_by(F.col("useful_decision_days"), F.col("week_start"))
    rate = F.max_by(F.col("follow_rate"), F.col("week_start"))
    best = F.max_by(
        F.concat_ws(" ", "top_activity", F.col("top_score").cast("string")),
        F.struct("profile_date", "top_score", "top_activity"),
    )
    frames = [
        one("Best action", latest_profile, best),
        one("Useful decision days", useful_days, recent),
        one("Follow rate", useful_days, rate),
        one("Recommendations", recommendation_daily, F.sum("recommendations")),
        one("Context signals", signal_daily, F.sum("signals")),
        one("Source health", runs, F.count_if(F.col("error_count") > 0)),
        one("Goals covered", goals, F.count_if(F.col("done") >= F.col("target"))),
        one("Goals total", goals, F.count(F.lit(1))),
    ]
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result
