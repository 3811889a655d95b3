"""Daily context profile per user: state, confidence, gaps and the summary text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import AsOf, as_of_col, older_than_days, recent
from .rules import WEEKLY_GOALS, goal_progress, top_recommendation


def signal_totals(signals: DataFrame, user_col: str, as_of: AsOf = None, fresh_days: int = 7) -> DataFrame:
    """Per user: signal count, stale count and the strongest signal."""
    # Smallest rank = most urgent, most confident, newest, first id.
    rank = F.struct(
        (-F.col("urgency")).alias("u"),
        (-F.col("confidence")).alias("c"),
        (-F.unix_micros(F.col("occurred_at").cast("timestamp"))).alias("t"),
        F.col("signal_id").alias("id"),
    )
    return signals.groupBy(user_col).agg(
        F.count(F.lit(1)).alias("signal_count_7d"),
        F.count_if(older_than_days("occurred_at", fresh_days, as_of)).alias("stale_signals"),
        F.min_by("domain", rank).alias("highest_signal_domain"),
        F.min_by("urgency", rank).alias("highest_signal_urgency"),
    )


def readiness_state(
    has_best: Column, decision: Column, score: Column, fatigue: Column, pain: Column,
    follow_rate: Column, open_goals: Column, recovery: Column,
) -> Column:
    strained = (
        (pain > 0) | (fatigue >= 8) | ((recovery != 0) & (recovery < 55)) | (decision == "recover")
    )
    return (
        F.when(~has_best, "needs_data")
        .when(strained, "recovery_first")
        .when((decision == "go") & (score >= 80) & (open_goals > 0), "act_on_open_goal")
        .when((decision == "go") & (follow_rate >= 0.7), "trusted_go")
        .when(decision == "go", "good_window")
        .otherwise("caution_window")
    )


# ---- fixed values: days after which an input counts as stale ----
FRESH_DAYS = {"diary": 10, "feedback": 14, "signals": 7, "sleep": 3}


def confidence_and_gaps(
    sessions: Column, diary_at: Column, has_feedback: Column, feedback_at: Column,
    signal_count: Column, stale_signals: Column, has_recovery: Column, woke_at: Column,
    as_of: AsOf = None,
) -> tuple[Column, Column]:
    """Confidence 100 minus penalties, and the names of the gaps behind them."""
    no_signals = signal_count == 0
    gaps = [
        (sessions <= 0, 25, "activity_diary_empty"),
        (older_than_days(diary_at, FRESH_DAYS["diary"], as_of), 10, "activity_diary_freshness_unknown"),
        (~has_feedback, 15, "decision_feedback_missing"),
        (has_feedback & older_than_days(feedback_at, FRESH_DAYS["feedback"], as_of), 8,
         "decision_feedback_freshness_unknown"),
        (no_signals, 10, "context_signals_missing"),
        (~no_signals & (stale_signals == signal_count), 10, "context_signals_stale"),
        (~has_recovery, 10, "sleep_recovery_missing"),
        (has_recovery & woke_at.isNotNull() & older_than_days(woke_at, FRESH_DAYS["sleep"], as_of), 10,
         "sleep_recovery_stale"),
    ]
    confidence = F.lit(100)
    for condition, penalty, _name in gaps:
        confidence = confidence - F.when(condition, penalty).otherwise(0)
    names = F.array_compact(F.array(*[F.when(c, F.lit(n)) for c, _p, n in gaps]))
    return F.greatest(F.lit(0), confidence), names


def daily_profile(
    users: DataFrame,
    recommendations: DataFrame,
    week: DataFrame,
    metrics: DataFrame,
    signals: DataFrame,
    counts: DataFrame,
    recovery: DataFrame,
    *,
    user_col: str = "user_id",
    goals: Mapping[str, int] = WEEKLY_GOALS,
    timezone: str = "UTC",
    as_of: AsOf = None,
) -> DataFrame:
    """One profile row per user and day; users without data get a ``needs_data`` row.

    Every input is reduced to one row per user before the joins, so all joins
    are on ``user_col`` over at most one row each.
    """
    now = as_of_col(as_of)
    best = top_recommendation(recommendations, user_col).select(
        user_col,
        F.col("activity").alias("_activity"),
        F.col("decision").alias("_decision"),
        F.col("score").alias("_score"),
    )
    w = week.select(
        user_col,
        F.col("sessions").alias("_sessions"),
        F.col("avg_mood").alias("_mood"),
        F.col("avg_fatigue").alias("_fatigue"),
        F.col("pain_sessions").alias("_pain"),
        F.col("latest_logged_at").alias("_diary_at"),
    )
    m = metrics.select(
        user_col,
        F.col("useful_decision_days").alias("_useful"),
        F.col("follow_rate").alias("_rate"),
        F.col("updated_at").alias("_feedback_at"),
        F.lit(True).alias("_has_feedback"),
    )
    recent_signals = signals.filter(recent("occurred_at", f"{FRESH_DAYS['signals']} days", as_of))
    s = signal_totals(recent_signals, user_col, as_of, FRESH_DAYS["signals"])
    r = recovery.select(
        user_col,
        F.col("latest_recovery_score").cast("double").alias("_recovery"),
        F.col("latest_duration_minutes").cast("double").alias("_sleep"),
        F.col("latest_woke_at").alias("_woke_at"),
        F.lit(True).alias("_has_recovery"),
    )
    people = users.select(user_col).distinct()
    open_goals = (
        goal_progress(people, counts, goals, user_col)
        .groupBy(user_col)
        .agg(F.count_if(F.col("done") < F.col("target")).cast("int").alias("open_goal_count"))
    )
    joined = people
    for side in (best, w, m, s, r, open_goals):
        joined = joined.join(side, user_col, "left")

    zeros = ("_sessions", "_mood", "_fatigue", "_pain", "_useful", "_rate", "signal_count_7d",
             "stale_signals", "_recovery", "_sleep", "open_goal_count")
    filled = joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in zeros})
    has_best = F.col("_activity").isNotNull()
    has_feedback = F.coalesce(F.col("_has_feedback"), F.lit(False))
    has_recovery = F.coalesce(F.col("_has_recovery"), F.lit(False))
    state = readiness_state(
        has_best, F.col("_decision"), F.col("_score"), F.col("_fatigue"), F.col("_pain"),
        F.col("_rate"), F.col("open_goal_count"), F.col("_recovery"),
    )
    confidence, gaps = confidence_and_gaps(
        F.col("_sessions"), F.col("_diary_at"), has_feedback, F.col("_feedback_at"),
        F.col("signal_count_7d"), F.col("stale_signals"), has_recovery, F.col("_woke_at"), as_of,
    )
    staged = filled.withColumns({"readiness_state": state, "confidence": confidence, "gaps": gaps})
    summary = profile_summary(has_best)
    gap_text = F.when(F.size("gaps") == 0, "none").otherwise(F.concat_ws(", ", "gaps"))
    full = F.concat(summary, F.format_string("; confidence=%d/100; data_gaps=%s", "confidence", gap_text))
    return staged.select(
        F.to_date(now).alias("profile_date"),
        F.lit(timezone).alias("timezone"),
        user_col,
        F.coalesce("_activity", F.lit("none")).alias("top_activity"),
        F.coalesce("_decision", F.lit("recover")).alias("top_decision"),
        F.coalesce("_score", F.lit(0)).cast("int").alias("top_score"),
        "readiness_state",
        F.col("_sessions").cast("int").alias("sessions_7d"),
        F.round(F.col("_mood").cast("double"), 2).alias("avg_mood_7d"),
        F.round(F.col("_fatigue").cast("double"), 2).alias("avg_fatigue_7d"),
        F.col("_pain").cast("int").alias("pain_sessions_7d"),
        F.col("_useful").cast("int").alias("useful_decision_days_7d"),
        F.round(F.col("_rate").cast("double"), 3).alias("follow_rate_7d"),
        "open_goal_count",
        F.col("signal_count_7d").cast("int").alias("signal_count_7d"),
        F.coalesce("highest_signal_domain", F.lit("none")).alias("highest_signal_domain"),
        F.coalesce("highest_signal_urgency", F.lit(0)).cast("int").alias("highest_signal_urgency"),
        "confidence",
        "gaps",
        full.alias("context_summary"),
        now.cast("timestamp").alias("generated_at"),
    )


def profile_summary(has_best: Column) -> Column:
    """``; ``-joined facts over the staged profile columns."""
    parts = F.concat_ws(
        "; ",
        F.format_string(
            "%s is top action at %d/100 (%s)", F.col("_activity"), F.col("_score").cast("int"), F.col("_decision")
        ),
        F.concat(F.lit("state="), F.col("readiness_state")),
        F.format_string("sessions_7d=%d", F.col("_sessions").cast("int")),
        F.format_string("fatigue=%.1f", F.col("_fatigue").cast("double")),
        F.format_string("useful_days=%d", F.col("_useful").cast("int")),
        F.format_string("open_goals=%d", F.col("open_goal_count").cast("int")),
        F.when(
            F.col("signal_count_7d") > 0,
            F.concat(F.lit("top_signal="), "highest_signal_domain", F.lit(":"), "highest_signal_urgency"),
        ),
        F.when(
            F.col("_recovery") != 0,
            F.concat(F.lit("sleep_recovery="), F.bround(F.col("_recovery"), 0).cast("int"), F.lit("/100")),
        ),
        F.when(
            F.col("_sleep").cast("int") != 0,
            F.concat(F.lit("sleep_minutes="), F.col("_sleep").cast("int")),
        ),
    )
    return F.when(
        has_best, parts
    ).otherwise("No recommendation data yet; ingest weather and compute scores first.")
