"""Domain rules, normalizers, envelopes and message parsers."""

from __future__ import annotations

from pyspark.sql import functions as F

from contextlake.functions import json_tools
from contextlake.operators import (
    digests,
    envelope,
    imports,
    logs,
    messages,
    profile,
    repair,
    rollups,
    rules,
    signals,
    sleep,
    subscriptions,
    tracks,
)
from contextlake.plans import daily
from contextlake.session import config_frame

from .adapters import ACTIVITY, AS_OF, table, view
from .registry import ORACLES, half_up, query
from .rollup_queries import sleep_rows
from .source_queries import managed_sources


# ---------- readiness ----------
def arm(condition: str, delta: int) -> str:
    return f"CASE WHEN {condition} THEN {delta} ELSE 0 END"


def why(*pairs: tuple[str, str]) -> str:
    items = ", ".join(f"CASE WHEN {c} THEN '{t}' END" for c, t in pairs)
    return f"array_to_string(list_filter([{items}], lambda x: x IS NOT NULL), ', ')"


MEASURES = """ranked AS (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY is_day DESC, forecast_time) AS rn,
        bool_or(is_day) OVER (PARTITION BY location_id) AS any_day FROM v_weather),
    m AS (SELECT location_id, round(sum(rain_mm + precipitation_mm), 6) AS wet, round(sum(precipitation_mm), 6) AS prec,
        round(sum(rain_mm), 6) AS rain, max(wind_gust_kmh) AS gust, min(temperature_c) AS low, max(temperature_c) AS high,
        max(snow_depth_cm) AS depth, round(sum(snowfall_cm), 6) AS snow, min(visibility_m) AS vis
        FROM ranked WHERE rn <= 8 AND is_day = any_day GROUP BY location_id)"""
SKATE = (("wet > 0.2", -45, "wet pavement risk"), ("gust > 35", -20, "strong gusts"), ("low < 2", -25, "freezing or slush risk"))
BOARD = (("depth >= 5 OR snow >= 1", 35, "snow base or fresh snowfall"), ("high > 2", -25, "thaw risk"),
         ("rain > 0", -25, "rain degrades snow"), ("gust > 45", -15, "windy lift/session conditions"))
MOTO = (("prec > 0.2", -35, "precipitation"), ("gust > 40", -25, "wind gusts"), ("vis < 5000", -20, "low visibility"),
        ("low < 3", -25, "cold road surface"))
VOLLEY = (("true", 0, "indoor session is mostly readiness-driven"), ("high > 28", -10, "hot outdoor conditions"))


def scored(activity: str, base: int, table_rows) -> str:
    total = " + ".join([str(base), *[arm(c, d) for c, d, _t in table_rows]])
    text = why(*[(c, t) for c, _d, t in table_rows])
    return f"SELECT '{activity}' AS activity, location_id, greatest(0, least(100, {total})) AS score, {text} AS why FROM m"


READINESS = f"""scored AS ({' UNION ALL '.join([scored('skate', 100, SKATE), scored('snowboard', 40, BOARD),
    scored('moto_lesson', 100, MOTO), scored('volleyball', 80, VOLLEY)])}),
    readiness AS (SELECT activity, location_id, CAST(score AS BIGINT) AS score,
        CASE WHEN score >= 75 THEN 'go' WHEN score >= 50 THEN 'caution' ELSE 'skip' END AS decision,
        CASE WHEN why = '' THEN 'conditions look usable' ELSE why END AS explanation FROM scored)"""


@query("d01_readiness_scores", f"WITH {MEASURES}, {READINESS} SELECT * FROM readiness", ("v_weather",))
def readiness(spark, sf):
    return rules.readiness_scores(view(spark, sf, "v_weather"))


@query(
    "d02_clamp_and_bucket",
    """SELECT event_id, greatest(0, least(100, event_id % 200 - 50)) AS score,
    CASE WHEN event_id % 200 - 50 >= 75 THEN 'go' WHEN event_id % 200 - 50 >= 50 THEN 'caution' ELSE 'skip' END AS decision FROM events""",
)
def _(spark, sf):
    from contextlake.functions.numbers import clamp

    score = clamp(F.col("event_id") % 200 - 50)
    return table(spark, sf, "events").select(
        "event_id", score.alias("score"), rules.readiness_decision(score).alias("decision")
    )


# ---------- recommendations ----------
CONTEXT = f"""best AS (SELECT user_id, activity, location_id, score, decision, explanation FROM v_scores
        QUALIFY row_number() OVER (PARTITION BY user_id, activity ORDER BY score DESC, location_id, score_id) = 1),
    recent AS (SELECT * FROM v_activity WHERE logged_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY),
    week AS (SELECT user_id, count(*) AS sessions, {half_up('avg(mood)', 1)} AS mood, {half_up('avg(fatigue)', 1)} AS fatigue,
        count(*) FILTER (WHERE pain_flag) AS pain, max(logged_at) AS diary_at FROM recent GROUP BY 1),
    done AS (SELECT user_id, activity_type AS activity, count(*) AS done FROM recent GROUP BY 1, 2),
    fb AS (SELECT user_id, activity, count(*) AS events, count(*) FILTER (WHERE action = 'skipped') AS skipped,
        count(*) FILTER (WHERE result = 'good') AS good, count(*) FILTER (WHERE result = 'bad') AS bad,
        {half_up("CAST(count(*) FILTER (WHERE action = 'followed') AS DOUBLE) / greatest(count(*), 1)", 3)} AS rate
        FROM v_feedback WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY GROUP BY 1, 2),
    last_night AS (SELECT user_id, recovery, minutes, slept + minutes * INTERVAL 1 MINUTE AS woke FROM v_sleep QUALIFY row_number() OVER (
        PARTITION BY user_id ORDER BY slept + minutes * INTERVAL 1 MINUTE DESC, minutes DESC, quality DESC) = 1)"""
HIGH = "activity IN ('skate', 'snowboard', 'moto_lesson')"
TEAM = "activity IN ('skate', 'snowboard', 'moto_lesson', 'volleyball')"
REC_RULES = (
    ("fatigue >= 7", "-20", "'recent fatigue is high'"),
    ("pain > 0", "-15", "'pain was logged this week'"),
    ("mood <> 0 AND mood <= 4", "-10", "'recent mood is low'"),
    ("sessions = 0 AND activity IN ('walk', 'volleyball')", "5", "'no sessions logged this week'"),
    (f"sessions >= 5 AND {HIGH}", "-10", "'weekly load is already high'"),
    (f"rec <> 0 AND rec < 65 AND {TEAM}", "-15", "'sleep recovery is low (' || CAST(rec AS BIGINT) || '/100)'"),
    (f"mins <> 0 AND mins < 390 AND {HIGH}", "-10", "'sleep duration was short'"),
    ("rec >= 75 AND activity IN ('walk', 'gym')", "3", "'recovery is stable'"),
    ("goal > 0 AND done < goal", "least(10, 7 + greatest(goal - done - 1, 0) * 2)", "'weekly goal gap ' || done || '/' || goal"),
    ("activity IN ('skate', 'moto_lesson')", "3", "'high priority activity'"),
    ("events >= 2 AND rate >= 0.7", "8", "'recent feedback says this is usually followed'"),
    ("good >= 2 AND good > bad", "5", "'recent outcomes were good'"),
    ("events >= 2 AND rate <= 0.35", "-8", "'recent feedback says this is often skipped'"),
    ("bad >= 1 AND bad >= good", "-7", "'recent outcomes were weak'"),
    ("skipped >= 2 AND decision = 'go'", "-5", "'go recommendation was often ignored'"),
)
GOAL = "CASE activity WHEN 'skate' THEN 2 WHEN 'volleyball' THEN 1 WHEN 'moto_lesson' THEN 1 WHEN 'gym' THEN 1 WHEN 'walk' THEN 2 ELSE 0 END"
RECS = f"""joined AS (SELECT user_id, activity, location_id, score, decision, explanation, {GOAL} AS goal,
        coalesce(sessions, 0) AS sessions, coalesce(mood, 0) AS mood, coalesce(fatigue, 0) AS fatigue, coalesce(pain, 0) AS pain,
        coalesce(done, 0) AS done, coalesce(events, 0) AS events, coalesce(rate, 0) AS rate, coalesce(good, 0) AS good,
        coalesce(bad, 0) AS bad, coalesce(skipped, 0) AS skipped, coalesce(recovery, 0) AS rec, coalesce(minutes, 0) AS mins
        FROM best LEFT JOIN week USING (user_id) LEFT JOIN done USING (user_id, activity) LEFT JOIN fb USING (user_id, activity)
        LEFT JOIN last_night USING (user_id)),
    adjusted AS (SELECT *, greatest(0, least(100, score + {' + '.join(f'CASE WHEN {c} THEN {d} ELSE 0 END' for c, d, _r in REC_RULES)})) AS final,
        array_to_string(list_filter([explanation, {', '.join(f'CASE WHEN {c} THEN {r} END' for c, _d, r in REC_RULES)}], lambda x: x IS NOT NULL), ', ') AS reasons FROM joined),
    recs AS (SELECT 'daily' AS recommendation_type, user_id, activity, location_id, CAST(final AS BIGINT) AS score,
        CASE WHEN pain > 0 OR fatigue >= 8 OR (rec <> 0 AND rec < 55) THEN CASE WHEN final < 75 THEN 'recover' ELSE 'caution' END
        WHEN rec <> 0 AND rec < 65 AND {TEAM} THEN CASE WHEN final >= 50 THEN 'caution' ELSE 'recover' END
        WHEN final >= 75 THEN 'go' WHEN final >= 50 THEN 'caution' ELSE 'recover' END AS decision, reasons FROM adjusted)"""
PEOPLE = ("v_scores", "v_activity", "v_feedback", "v_sleep", "v_signals")


def inputs(spark, sf):
    """Side inputs of the personal rules, one row per key each."""
    activity, feedback = view(spark, sf, "v_activity"), view(spark, sf, "v_feedback")
    nights, _rejected = sleep.normalize_sleep(sleep_rows(spark, sf), keep=("user_id",))
    week = rollups.week_summary(activity, "user_id", AS_OF)
    return {
        "scores": view(spark, sf, "v_scores"),
        "week": week,
        "counts": rollups.counts_of_week(week, "user_id"),
        "feedback": rollups.feedback_profile(feedback, 30, AS_OF, user_col="user_id"),
        "recovery": sleep.sleep_summary(nights),
        "metrics": rollups.decision_metrics(feedback, 7, AS_OF, "user_id"),
        "users": activity.select("user_id"),
    }


def recommendations(spark, sf, side=None):
    side = side or inputs(spark, sf)
    return rules.recommend(side["scores"], side["week"], side["counts"], side["feedback"], side["recovery"])


@query("d03_recommendations", f"WITH {CONTEXT}, {RECS} SELECT * FROM recs", PEOPLE)
def _(spark, sf):
    return recommendations(spark, sf)


@query(
    "d04_goal_progress",
    f"""WITH {CONTEXT} SELECT user_id, activity, coalesce(done, 0) AS done, CAST(target AS BIGINT) AS target,
    least(1.0, CAST(coalesce(done, 0) AS DOUBLE) / target) AS progress FROM (SELECT DISTINCT user_id FROM v_activity)
    CROSS JOIN (VALUES ('skate', 2), ('volleyball', 1), ('moto_lesson', 1), ('gym', 1), ('walk', 2)) g(activity, target)
    LEFT JOIN done USING (user_id, activity)""",
    PEOPLE,
)
def _(spark, sf):
    side = inputs(spark, sf)
    return rules.goal_progress(side["users"], side["counts"])


# ---------- daily profile ----------
PROFILE = f"""top AS (SELECT * FROM recs QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, activity) = 1),
    open_goals AS (SELECT user_id, count(*) FILTER (WHERE coalesce(done, 0) < target) AS open_goal_count FROM (SELECT DISTINCT user_id FROM v_activity)
        CROSS JOIN (VALUES ('skate', 2), ('volleyball', 1), ('moto_lesson', 1), ('gym', 1), ('walk', 2)) g(activity, target)
        LEFT JOIN done USING (user_id, activity) GROUP BY 1),
    metrics AS (SELECT user_id, count(DISTINCT CAST(created_at AS DATE)) FILTER (WHERE action = 'followed') AS useful, max(created_at) AS feedback_at,
        coalesce({half_up("CAST(count(*) FILTER (WHERE action = 'followed') AS DOUBLE) / nullif(count(*) FILTER (WHERE action IN ('followed', 'skipped')), 0)", 3)}, 0) AS rate
        FROM v_feedback WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1),
    sig AS (SELECT user_id, count(*) AS signal_count FROM v_signals WHERE occurred_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1),
    strongest AS (SELECT user_id, domain, urgency FROM v_signals WHERE occurred_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY urgency DESC, confidence DESC, occurred_at DESC, signal_id) = 1),
    p AS (SELECT user_id, top.activity, top.score, top.decision, coalesce(sessions, 0) AS sessions, coalesce(mood, 0) AS mood, coalesce(fatigue, 0) AS fatigue,
        coalesce(pain, 0) AS pain, coalesce(useful, 0) AS useful, coalesce(metrics.rate, 0) AS rate, open_goal_count, coalesce(signal_count, 0) AS signal_count,
        coalesce(domain, 'none') AS domain, coalesce(urgency, 0) AS urgency, coalesce(recovery, 0) AS rec, coalesce(minutes, 0) AS mins,
        diary_at, feedback_at, woke FROM (SELECT DISTINCT user_id FROM v_activity) LEFT JOIN top USING (user_id) LEFT JOIN week USING (user_id)
        LEFT JOIN metrics USING (user_id) LEFT JOIN sig USING (user_id) LEFT JOIN strongest USING (user_id) LEFT JOIN last_night USING (user_id) LEFT JOIN open_goals USING (user_id)),
    stated AS (SELECT *, CASE WHEN activity IS NULL THEN 'needs_data'
        WHEN pain > 0 OR fatigue >= 8 OR (rec <> 0 AND rec < 55) OR decision = 'recover' THEN 'recovery_first'
        WHEN decision = 'go' AND score >= 80 AND open_goal_count > 0 THEN 'act_on_open_goal' WHEN decision = 'go' AND rate >= 0.7 THEN 'trusted_go'
        WHEN decision = 'go' THEN 'good_window' ELSE 'caution_window' END AS state,
        100 - CASE WHEN sessions <= 0 THEN 25 ELSE 0 END
        - CASE WHEN coalesce(diary_at < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY, true) THEN 10 ELSE 0 END
        - CASE WHEN feedback_at IS NULL THEN 15 WHEN feedback_at < TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY THEN 8 ELSE 0 END
        - CASE WHEN signal_count = 0 THEN 10 ELSE 0 END
        - CASE WHEN woke IS NULL THEN 10 WHEN woke < TIMESTAMP '{AS_OF}' - INTERVAL 3 DAY THEN 10 ELSE 0 END AS confidence,
        array_to_string(list_filter([CASE WHEN sessions <= 0 THEN 'activity_diary_empty' END,
            CASE WHEN coalesce(diary_at < TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY, true) THEN 'activity_diary_freshness_unknown' END,
            CASE WHEN feedback_at IS NULL THEN 'decision_feedback_missing' END,
            CASE WHEN feedback_at < TIMESTAMP '{AS_OF}' - INTERVAL 14 DAY THEN 'decision_feedback_freshness_unknown' END,
            CASE WHEN signal_count = 0 THEN 'context_signals_missing' END,
            CASE WHEN woke IS NULL THEN 'sleep_recovery_missing' WHEN woke < TIMESTAMP '{AS_OF}' - INTERVAL 3 DAY THEN 'sleep_recovery_stale' END],
            lambda x: x IS NOT NULL), ', ') AS gaps FROM p)"""
SUMMARY = """activity || ' is top action at ' || score || '/100 (' || decision || '); state=' || state || '; sessions_7d=' || sessions
    || '; fatigue=' || printf('%.1f', fatigue) || '; useful_days=' || useful || '; open_goals=' || open_goal_count
    || CASE WHEN signal_count > 0 THEN '; top_signal=' || domain || ':' || urgency ELSE '' END
    || CASE WHEN rec <> 0 THEN '; sleep_recovery=' || CAST(rec AS BIGINT) || '/100' ELSE '' END
    || CASE WHEN mins <> 0 THEN '; sleep_minutes=' || CAST(mins AS BIGINT) ELSE '' END
    || '; confidence=' || confidence || '/100; data_gaps=' || CASE WHEN gaps = '' THEN 'none' ELSE gaps END"""


def profiles(spark, sf, side=None):
    side = side or inputs(spark, sf)
    return profile.daily_profile(
        side["users"], recommendations(spark, sf, side), side["week"], side["metrics"],
        view(spark, sf, "v_signals"), side["counts"], side["recovery"], as_of=AS_OF,
    )


@query(
    "d05_daily_profile",
    f"""WITH {CONTEXT}, {RECS}, {PROFILE} SELECT '2024-01-31' AS profile_date, 'UTC' AS timezone, user_id, activity AS top_activity, decision AS top_decision,
    CAST(score AS BIGINT) AS top_score, state AS readiness_state, sessions AS sessions_7d, CAST(mood AS DOUBLE) AS avg_mood_7d,
    CAST(fatigue AS DOUBLE) AS avg_fatigue_7d, pain AS pain_sessions_7d, useful AS useful_decision_days_7d, CAST(rate AS DOUBLE) AS follow_rate_7d,
    open_goal_count, signal_count AS signal_count_7d, domain AS highest_signal_domain, CAST(urgency AS BIGINT) AS highest_signal_urgency,
    {SUMMARY} AS context_summary FROM stated""",
    PEOPLE,
)
def _(spark, sf):
    return profiles(spark, sf).drop("confidence", "gaps", "generated_at")


@query(
    "d06_readiness_state",
    f"WITH {CONTEXT}, {RECS}, {PROFILE} SELECT state AS readiness_state, count(*) AS users FROM stated GROUP BY 1",
    PEOPLE,
)
def _(spark, sf):
    return profiles(spark, sf).groupBy("readiness_state").agg(rollups.rows("users"))


@query(
    "d07_confidence_and_gaps",
    f"WITH {CONTEXT}, {RECS}, {PROFILE} SELECT user_id, CAST(confidence AS BIGINT) AS confidence, replace(gaps, ', ', '|') AS gaps FROM stated",
    PEOPLE,
)
def _(spark, sf):
    return profiles(spark, sf).select("user_id", "confidence", "gaps")


# ---------- texts ----------
@query(
    "d08_personal_digest",
    f"""WITH {CONTEXT}, {RECS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, activity) AS rn FROM recs),
    best AS (SELECT * FROM ranked WHERE rn = 1), opts AS (SELECT user_id, string_agg('- ' || activity || ': ' || score || '/100, ' || decision || ' — ' || reasons, chr(10) ORDER BY rn) AS o
        FROM ranked WHERE rn <= 5 GROUP BY 1)
    SELECT user_id, 'Context today: ' || activity || ' (' || score || '/100, ' || decision || ').' || chr(10) || chr(10) || 'Why:' || chr(10) || '- ' || reasons
    || chr(10) || chr(10) || 'Options:' || chr(10) || o || chr(10) || chr(10) || 'Log after session: /log activity intensity mood fatigue result notes' AS digest
    FROM best JOIN opts USING (user_id)""".replace("best AS (SELECT * FROM ranked", "first AS (SELECT * FROM ranked").replace("FROM best JOIN opts", "FROM first JOIN opts"),
    PEOPLE,
)
def _(spark, sf):
    return digests.personal_digest(recommendations(spark, sf))


@query(
    "d08_readiness_digest",
    f"""WITH {MEASURES}, {READINESS}, options AS (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY score DESC, activity) AS rn FROM readiness),
    opts AS (SELECT location_id, string_agg('- ' || activity || ': ' || score || '/100, ' || decision || ' — ' || explanation, chr(10) ORDER BY rn) AS o FROM options GROUP BY 1)
    SELECT location_id, 'Context today: ' || activity || ' is the best option (' || score || '/100, ' || decision || ').' || chr(10) || chr(10)
    || 'Outdoor readiness:' || chr(10) || o || chr(10) || chr(10) || 'Log after session: /log activity intensity mood fatigue result notes' AS digest
    FROM options JOIN opts USING (location_id) WHERE rn = 1""",
    ("v_weather",),
)
def _(spark, sf):
    return digests.readiness_digest(readiness(spark, sf), ["location_id"])


@query(
    "d08_goal_summary",
    f"""WITH {CONTEXT}, g AS (SELECT user_id, activity, coalesce(done, 0) AS done, target FROM (SELECT DISTINCT user_id FROM v_activity)
        CROSS JOIN (VALUES ('skate', 2), ('volleyball', 1), ('moto_lesson', 1), ('gym', 1), ('walk', 2)) t(activity, target) LEFT JOIN done USING (user_id, activity))
    SELECT user_id, 'Context goals this week:' || chr(10) || string_agg('- ' || activity || ': ' || done || '/' || target || CASE WHEN done >= target THEN ' (covered)' ELSE ' (open)' END, chr(10) ORDER BY activity)
    || chr(10) || CASE WHEN count(*) FILTER (WHERE done < target) > 0 THEN 'Next: pick one open goal when readiness and recovery allow it.'
    ELSE 'Next: weekly targets are covered; protect recovery.' END AS digest FROM g GROUP BY user_id""",
    PEOPLE,
)
def _(spark, sf):
    side = inputs(spark, sf)
    return digests.goal_digest(rules.goal_progress(side["users"], side["counts"]))


def text_inputs(spark, sf):
    side = inputs(spark, sf)
    return side, rules.goal_progress(side["users"], side["counts"]), recommendations(spark, sf, side)


WEEK_FULL = f"""{CONTEXT}, intense AS (SELECT user_id, {half_up('avg(intensity)', 1)} AS intensity FROM recent GROUP BY 1),
    acts AS (SELECT user_id, string_agg(activity_type || ' ' || n, ', ' ORDER BY n DESC, activity_type) AS a FROM (SELECT user_id, activity_type, count(*) AS n FROM recent GROUP BY 1, 2) GROUP BY 1),
    outcomes AS (SELECT user_id, string_agg(result || ' ' || n, ', ' ORDER BY n DESC, result) AS r FROM (SELECT user_id, result, count(*) AS n FROM recent GROUP BY 1, 2) GROUP BY 1)"""


@query(
    "d08_week_summary_text",
    f"""WITH {WEEK_FULL} SELECT user_id, 'Context week: ' || sessions || ' sessions logged.' || chr(10) || 'Avg intensity ' || intensity || '/10, mood ' || mood || '/10, fatigue ' || fatigue || '/10.'
    || chr(10) || 'Pain-flagged sessions: ' || pain || '.' || chr(10) || 'Activities: ' || a || '.' || chr(10) || 'Results: ' || r || '.' || chr(10)
    || 'Next: keep logging after sessions so recommendations can account for fatigue.' AS digest
    FROM week JOIN intense USING (user_id) JOIN acts USING (user_id) JOIN outcomes USING (user_id)""",
    PEOPLE,
)
def _(spark, sf):
    week = inputs(spark, sf)["week"]
    return week.select("user_id", digests.week_text(week).alias("digest"))


OPEN = f"""goals AS (SELECT user_id, activity, coalesce(done, 0) AS done, target FROM (SELECT DISTINCT user_id FROM v_activity)
        CROSS JOIN (VALUES ('skate', 2), ('volleyball', 1), ('moto_lesson', 1), ('gym', 1), ('walk', 2)) t(activity, target) LEFT JOIN done USING (user_id, activity)),
    gap AS (SELECT user_id, string_agg(activity || ' ' || done || '/' || target, ', ' ORDER BY activity) FILTER (WHERE done < target) AS open_text,
        string_agg(activity || ' ' || done || '/' || target, ', ' ORDER BY activity) FILTER (WHERE done >= target) AS covered_text,
        count(*) FILTER (WHERE done >= target) AS covered, count(*) AS total FROM goals GROUP BY 1)"""


@query(
    "d08_coach_summary",
    f"""WITH {CONTEXT}, {RECS}, {OPEN}, top AS (SELECT user_id AS tu, activity, score, decision FROM recs QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, activity) = 1)
    SELECT gap.user_id, CASE WHEN coalesce(sessions, 0) = 0 THEN 'Context coach: no sessions logged this week. Start with one easy /log after activity.' ELSE
    'Context coach: ' || sessions || ' sessions this week.' || chr(10) || 'Load signal: fatigue ' || fatigue || '/10, mood ' || mood || '/10, pain sessions ' || pain || '.' || chr(10)
    || CASE WHEN pain > 0 THEN 'Focus: recovery or low-impact movement until pain clears.' WHEN fatigue >= 7 THEN 'Focus: reduce intensity today; keep consistency without chasing max effort.'
    WHEN sessions < 3 THEN 'Focus: add one light session or walk to keep the week alive.' ELSE 'Focus: maintain rhythm; avoid stacking hard sessions back-to-back.' END || chr(10)
    || 'Today: ' || activity || ' is the best fit (' || score || '/100, ' || decision || ').' || chr(10)
    || CASE WHEN open_text IS NOT NULL THEN 'Goal gaps: ' || open_text || '.' ELSE 'Goal gaps: weekly targets are covered.' END END AS digest
    FROM gap LEFT JOIN week USING (user_id) LEFT JOIN top ON tu = gap.user_id""",
    PEOPLE,
)
def _(spark, sf):
    side, progress, recs = text_inputs(spark, sf)
    return digests.coach_digest(side["week"], progress, recs)


@query(
    "d08_weekly_review",
    f"""WITH {WEEK_FULL}, {RECS}, {OPEN}, top AS (SELECT user_id AS tu, activity, score, decision FROM recs QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY score DESC, activity) = 1),
    learned AS (SELECT user_id AS lu, activity AS la, rate AS lr, events AS le FROM fb QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rate DESC, good DESC, events DESC, activity) = 1),
    urgent AS (SELECT user_id AS uu, string_agg(title, ', ' ORDER BY urgency DESC, confidence DESC, signal_id) AS titles FROM (SELECT * FROM v_signals WHERE urgency >= 7
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY urgency DESC, confidence DESC, signal_id, title) <= 3) GROUP BY 1)
    SELECT gap.user_id, 'Context weekly review' || chr(10) || 'Sessions: ' || coalesce(sessions, 0) || '; mood ' || CAST(coalesce(mood, 0) AS DOUBLE) || '/10; fatigue ' || CAST(coalesce(fatigue, 0) AS DOUBLE) || '/10; pain sessions ' || coalesce(pain, 0) || '.' || chr(10)
    || CASE WHEN a IS NULL THEN 'Activity mix: no logged sessions yet.' ELSE 'Activity mix: ' || array_to_string(string_split(a, ', ')[1:6], ', ') || '.' END
    || CASE WHEN r IS NULL THEN '' ELSE chr(10) || 'Outcomes: ' || array_to_string(string_split(r, ', ')[1:4], ', ') || '.' END
    || CASE WHEN open_text IS NULL THEN '' ELSE chr(10) || 'Open goals: ' || open_text || '.' END
    || CASE WHEN covered_text IS NULL THEN '' ELSE chr(10) || 'Covered goals: ' || covered_text || '.' END || chr(10)
    || CASE WHEN la IS NULL THEN 'Learning: no recommendation feedback yet; use Done/Skip after /today.' ELSE 'Learning: ' || la || ' has follow rate ' || printf('%.2f', lr + 1e-9) || ' across ' || le || ' feedback events.' END
    || CASE WHEN titles IS NULL THEN '' ELSE chr(10) || 'Context watch: ' || titles || '.' END || chr(10)
    || CASE WHEN coalesce(pain, 0) > 0 THEN 'Next week: keep sport, but bias toward recovery until pain clears.' WHEN coalesce(fatigue, 0) >= 7 THEN 'Next week: reduce intensity and protect sleep/recovery before adding load.'
    WHEN open_text IS NOT NULL THEN 'Next week: choose the highest-readiness open goal first.' WHEN coalesce(sessions, 0) = 0 THEN 'Next week: start with one easy logged session to create a baseline.'
    ELSE 'Next week: maintain rhythm and use feedback to refine recommendations.' END || chr(10)
    || 'Best next action now: ' || activity || ' (' || score || '/100, ' || decision || ').' AS digest
    FROM gap LEFT JOIN week USING (user_id) LEFT JOIN acts USING (user_id) LEFT JOIN outcomes USING (user_id) LEFT JOIN top ON tu = gap.user_id LEFT JOIN learned ON lu = gap.user_id LEFT JOIN urgent ON uu = gap.user_id""",
    PEOPLE,
)
def _(spark, sf):
    side, progress, recs = text_inputs(spark, sf)
    return digests.weekly_review(side["week"], progress, recs, side["feedback"], view(spark, sf, "v_signals"))


PERCENT = "CAST(round_even({} * 100, 0) AS BIGINT) || '%'"


@query(
    "d08_progress_scorecard",
    f"""WITH {CONTEXT}, {OPEN}, m AS (SELECT user_id, count(DISTINCT CAST(created_at AS DATE)) FILTER (WHERE action = 'followed') AS useful,
        count(*) FILTER (WHERE action = 'followed') AS followed, count(*) FILTER (WHERE action = 'skipped') AS skipped,
        coalesce({half_up("CAST(count(*) FILTER (WHERE action = 'followed') AS DOUBLE) / nullif(count(*) FILTER (WHERE action IN ('followed', 'skipped')), 0)", 3)}, 0) AS rate
        FROM v_feedback WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1),
    learned AS (SELECT user_id AS lu, activity AS la, rate AS lr FROM fb QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY rate DESC, events DESC, activity) = 1),
    card AS (SELECT gap.user_id, coalesce(useful, 0) AS useful, coalesce(m.rate, 0) AS rate, coalesce(sessions, 0) AS sessions, coalesce(followed, 0) AS followed,
        coalesce(skipped, 0) AS skipped, covered, total, open_text, la, lr FROM gap LEFT JOIN week USING (user_id) LEFT JOIN m USING (user_id) LEFT JOIN learned ON lu = gap.user_id),
    stated AS (SELECT *, CASE WHEN useful >= 4 AND rate >= 0.6 THEN 'compounding' WHEN useful >= 2 OR sessions >= 3 THEN 'building' ELSE 'thin data' END AS status FROM card)
    SELECT user_id, status, 'Context metrics: ' || status || '.' || chr(10) || 'North Star: useful decision days ' || useful || '/7.' || chr(10) || 'Logged sessions: ' || sessions || '/week.' || chr(10)
    || 'Feedback: ' || followed || ' followed, ' || skipped || ' skipped, follow rate ' || {PERCENT.format("rate")} || '.' || chr(10) || 'Weekly goals covered: ' || covered || '/' || total || '.'
    || CASE WHEN open_text IS NULL THEN '' ELSE chr(10) || 'Open goal gaps: ' || open_text || '.' END
    || CASE WHEN la IS NULL THEN '' ELSE chr(10) || 'Best learned activity: ' || la || ' (' || {PERCENT.format("lr")} || ' follow rate).' END || chr(10)
    || CASE WHEN useful = 0 THEN 'Next metric move: use /today once and tap Done/Skip after the decision.' WHEN open_text IS NOT NULL THEN 'Next metric move: close one open goal with the highest-readiness activity.'
    ELSE 'Next metric move: keep feedback density high and protect recovery.' END AS digest FROM stated""",
    PEOPLE,
)
def _(spark, sf):
    side, progress, _recs = text_inputs(spark, sf)
    return digests.progress_scorecard(side["week"], progress, side["metrics"], side["feedback"])


@query(
    "d08_profile_and_gap_texts",
    f"""WITH {CONTEXT}, {RECS}, {PROFILE}, texts AS (SELECT *, {SUMMARY} AS summary, CASE WHEN gaps = '' THEN 'none' ELSE gaps END AS gap_names FROM stated)
    SELECT user_id, 'Context data gaps' || chr(10) || 'Profile confidence: ' || confidence || '/100' || chr(10) || 'Readiness state: ' || state || chr(10)
    || CASE WHEN gaps = '' THEN 'Open gaps: none' ELSE 'Open gaps:' || chr(10) || '- ' || replace(gaps, ', ', chr(10) || '- ') END AS gaps_text,
    'Context daily context profile' || chr(10) || 'Date: 2024-01-31 (UTC)' || chr(10) || 'Top action: ' || activity || ' (' || score || '/100, ' || decision || ')' || chr(10) || 'State: ' || state || chr(10)
    || '7d loop: ' || sessions || ' sessions, mood ' || CAST(mood AS DOUBLE) || '/10, fatigue ' || CAST(fatigue AS DOUBLE) || '/10, pain sessions ' || pain || chr(10)
    || 'Decision quality: ' || useful || ' useful days, follow rate ' || {PERCENT.format("rate")} || ', open goals ' || open_goal_count || chr(10)
    || 'Signals: ' || signal_count || ' active, top ' || domain || ' urgency ' || urgency || '/10' || chr(10) || 'Profile confidence: ' || confidence || '/100' || chr(10)
    || 'Data gaps: ' || gap_names || chr(10) || 'Summary: ' || summary AS profile_text FROM texts""",
    PEOPLE,
)
def _(spark, sf):
    rows = profiles(spark, sf)
    return rows.select(
        "user_id", digests.data_gaps_text().alias("gaps_text"), digests.profile_text().alias("profile_text")
    )


@query(
    "d08_source_status_text",
    f"""SELECT '- ' || component || ': failed; fresh ' || CAST(floor(date_diff('microsecond', max(ts), TIMESTAMP '{AS_OF}') / 60000000) AS BIGINT) || 'm; rows ' || count(*)
    || '; errors ' || count(*) FILTER (WHERE lower(status) IN ('error', 'failed', 'failure', 'skipped')) AS line FROM v_logs GROUP BY component""",
    ("v_logs",),
)
def _(spark, sf):
    health = logs.run_health(view(spark, sf, "v_logs"), AS_OF, order=["event_id"]).filter("source_name <> 'runtime'")
    return health.select(F.regexp_replace(digests.source_status_text(), "; last: .*$", "").alias("line"))


@query(
    "d08_log_text",
    """WITH s AS (SELECT string_agg(status || ' ' || n, ', ' ORDER BY status) AS t FROM (SELECT status, count(*) AS n FROM v_logs GROUP BY 1)),
    c AS (SELECT string_agg(component || ' ' || n, ', ' ORDER BY component) AS t FROM (SELECT component, count(*) AS n FROM v_logs GROUP BY 1)),
    f AS (SELECT string_agg('- ' || et || ' ' || component || ' ' || action || ': ' || message, chr(10) ORDER BY ts) AS t FROM (
        SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS et FROM v_logs WHERE lower(status) IN ('error', 'failed', 'failure', 'skipped') ORDER BY ts DESC, event_id DESC LIMIT 5))
    SELECT 'Context runtime logs' || chr(10) || 'Events: ' || (SELECT count(*) FROM v_logs) || chr(10) || 'Latest event: ' || (SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%S') FROM v_logs)
    || chr(10) || 'Status: ' || s.t || chr(10) || 'Components: ' || c.t || chr(10) || 'Recent failures:' || chr(10) || f.t AS digest FROM s, c, f""",
    ("v_logs",),
)
def _(spark, sf):
    rows = view(spark, sf, "v_logs").withColumn("event_time", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    return logs.log_text(rows, [F.col("ts").desc(), F.col("event_id").desc()])


# ---------- signals ----------
@query(
    "d09_generic_signals",
    """SELECT event_id, CASE WHEN event_id % 13 = 0 THEN 'unknown domain' WHEN event_id % 17 = 0 THEN 'urgency must be an integer from 1 to 10' ELSE 'ok' END AS outcome,
    CASE WHEN event_id % 3 = 0 THEN CASE WHEN event_id % 13 = 0 THEN 'weather' ELSE 'market' END || '_' || event_type || '_' || event_id ELSE 'sig_' || event_id END AS signal_id FROM events""",
)
def _(spark, sf):
    e = F.col("event_id")
    raw = table(spark, sf, "events").select(
        "event_id",
        F.when(e % 3 != 0, F.concat(F.lit("sig_"), e)).alias("signal_id"),
        F.when(e % 13 == 0, "Weather").otherwise("MARKET").alias("domain"),
        F.col("event_type").alias("source"),
        F.lit(None).cast("string").alias("title"),
        F.lit(None).cast("string").alias("direction"),
        F.when(e % 17 == 0, "eleven").otherwise((1 + e % 10).cast("string")).alias("urgency"),
        F.lit("50").alias("confidence"),
        F.lit(None).cast("string").alias("summary"),
        F.col("ts").alias("occurred_at"),
        F.col("ts").alias("ingested_at"),
    )
    valid, rejected = signals.normalize_signals(raw, "event_id", keep=("event_id",))
    return valid.select("event_id", F.lit("ok").alias("outcome"), "signal_id").unionByName(
        rejected.select("event_id", F.col("reject_reason").alias("outcome"), "signal_id")
    )


@query(
    "d09_repository_signals",
    """SELECT 'github_n' || s_nationkey || '_' || 'supplier_' || printf('%d', s_suppkey) || '_2024-01-05' AS signal_id,
    CASE WHEN s_suppkey % 9 = 0 THEN 'neutral' WHEN s_suppkey % 40 >= 10 THEN 'negative' ELSE 'positive' END AS direction,
    CAST(CASE WHEN s_suppkey % 9 = 0 THEN 2 WHEN s_suppkey % 40 >= 10 THEN least(10, 4 + (s_suppkey % 40) // 5) WHEN s_suppkey % 3 = 0 THEN 4 ELSE 5 END AS BIGINT) AS urgency,
    CASE WHEN s_suppkey % 9 = 0 THEN 'Archived repo' WHEN s_suppkey % 40 >= 10 THEN 'Issue backlog needs attention' ELSE 'Project focus window' END AS title FROM supplier""",
)
def _(spark, sf):
    key = F.col("s_suppkey")
    repos = table(spark, sf, "supplier").select(
        F.concat(F.lit("N"), "s_nationkey", F.lit("/Supplier-"), key).alias("full_name"),
        F.lit("2024-01-05T10:00:00Z").alias("pushed_at"),
        F.lit(None).cast("string").alias("updated_at"),
        (key % 40).cast("int").alias("open_issues_count"),
        (key % 3).cast("int").alias("stargazers_count"),
        (key % 9 == 0).alias("archived"),
        F.lit("2024-01-31T00:00:00Z").alias("ingested_at"),
    )
    return signals.repo_signals(repos).select("signal_id", "direction", "urgency", "title")


@query(
    "d09_market_signals",
    """WITH b AS (SELECT p_partkey, CAST(p_partkey % 17 AS DOUBLE) + 10 AS o, CAST(p_partkey % 17 AS DOUBLE) + 10 + CAST(p_partkey % 7 - 3 AS DOUBLE) / 10 AS c FROM part),
    x AS (SELECT *, c + 0.1 AS h, o - 0.1 AS l, (c - o) / o * 100 AS move FROM b), y AS (SELECT *, (h - l) / l * 100 AS span FROM x)
    SELECT 'market_p' || p_partkey || '_2024-01-05' AS signal_id,
    CASE WHEN abs(move) >= 2.5 OR span >= 4 THEN 'negative' WHEN move >= 0.8 THEN 'positive' ELSE 'neutral' END AS direction,
    CAST(CASE WHEN abs(move) >= 2.5 OR span >= 4 THEN least(10, greatest(6, CAST(trunc(abs(move) + span) AS INT))) WHEN move >= 0.8 THEN 5 ELSE 3 END AS BIGINT) AS urgency FROM y""",
)
def _(spark, sf):
    key = F.col("p_partkey")
    opened = (key % 17).cast("double") + 10
    closed = (key % 17).cast("double") + 10 + (key % 7 - 3).cast("double") / 10
    bars = table(spark, sf, "part").select(
        F.concat(F.lit("p"), key).alias("symbol"),
        opened.alias("open"),
        (closed + 0.1).alias("high"),
        (opened - 0.1).alias("low"),
        closed.alias("close"),
        F.lit("2024-01-05T16:00:00Z").alias("bar_time"),
        F.lit("2024-01-31T00:00:00Z").alias("ingested_at"),
    )
    return signals.market_signals(bars).select("signal_id", "direction", "urgency")


@query("d09_market_payloads", ORACLES["d09_market_signals"])
def _(spark, sf):
    """The same bars from payloads: a list with long names, and an object by symbol with one-letter names."""
    key = F.col("p_partkey")
    opened = (key % 17).cast("double") + 10
    closed = (key % 17).cast("double") + 10 + (key % 7 - 3).cast("double") / 10
    values = {"open": opened, "high": closed + 0.1, "low": opened - 0.1, "close": closed}
    at, symbol = F.lit("2024-01-05T16:00:00Z"), F.concat(F.lit("p"), key)
    long_names = F.struct(symbol.alias("symbol"), at.alias("timestamp"), *[v.alias(k) for k, v in values.items()])
    short_names = F.struct(at.alias("t"), F.lit(0).alias("open"), *[v.alias(k[0]) for k, v in values.items()])
    listed = F.to_json(F.struct(F.lit("x").alias("provider"), F.array(long_names).alias("symbols")))
    named = F.to_json(F.struct(F.create_map(symbol, short_names).alias("symbols")))
    payloads = table(spark, sf, "part").select(F.when(key % 2 == 0, listed).otherwise(named).alias("payload"))
    bars = signals.market_rows(payloads).withColumn("ingested_at", F.lit("2024-01-31T00:00:00Z"))
    return signals.market_signals(bars).select("signal_id", "direction", "urgency")


@query("d09_repository_payloads", ORACLES["d09_repository_signals"])
def _(spark, sf):
    """The same repositories from payloads, half of them with the short field names."""
    key = F.col("s_suppkey")
    name = F.concat(F.lit("N"), "s_nationkey", F.lit("/Supplier-"), key)
    shared = [(key % 9 == 0).alias("archived")]
    long_names = F.struct(
        name.alias("full_name"), F.lit("2024-01-05T10:00:00Z").alias("pushed_at"), (key % 40).alias("open_issues_count"),
        (key % 3).alias("stargazers_count"), *shared,
    )
    short_names = F.struct(
        name.alias("name"), F.lit("2024-01-05T10:00:00Z").alias("updated_at"), (key % 40).alias("open_issues"),
        (key % 3).alias("stars"), *shared,
    )
    wrapped = lambda r: F.to_json(F.struct(F.array(r).alias("repositories")))
    payloads = table(spark, sf, "supplier").select(F.when(key % 2 == 0, wrapped(long_names)).otherwise(wrapped(short_names)).alias("payload"))
    repos = signals.repository_rows(payloads).withColumn("ingested_at", F.lit("2024-01-31T00:00:00Z"))
    return signals.repo_signals(repos).select("signal_id", "direction", "urgency", "title")


@query(
    "d09_signal_payloads",
    """SELECT event_id, 'market' || '_' || event_type || '_1' AS signal_id, 1 + event_id % 10 AS urgency, 'neutral' AS direction FROM events
    UNION ALL SELECT event_id, 'second_' || event_id, 1, 'positive' FROM events""",
)
def _(spark, sf):
    """Two signals per payload: one without id, one without numbers."""
    e = F.col("event_id")
    none = F.lit(None).cast("string")
    item = lambda sid, source, direction, urgency: F.struct(
        sid.alias("signal_id"), F.lit("Market").alias("domain"), source.alias("source"), direction.alias("direction"), urgency.alias("urgency")
    )
    first = item(none, F.col("event_type"), none, (1 + e % 10).cast("string"))
    second = item(F.concat(F.lit("second_"), e), none, F.lit("POSITIVE"), none)
    payloads = table(spark, sf, "events").select("event_id", F.to_json(F.struct(F.array(first, second).alias("signals"))).alias("payload"))
    rows = signals.signal_rows(payloads, keep=("event_id",)).withColumn("ingested_at", F.lit("2024-01-31T00:00:00Z"))
    valid, _rejected = signals.normalize_signals(rows, "row_number", keep=("event_id",))
    return valid.select("event_id", "signal_id", "urgency", "direction")


# ---------- imports ----------
@query(
    "d10_summary_imports",
    """SELECT kind AS source_name, event_id AS row_number,
    CASE WHEN event_id % 7 = 0 THEN 'missing' ELSE 'ok' END AS outcome, CASE WHEN event_id % 7 = 0 THEN '' ELSE event_type END AS label,
    CASE WHEN event_id % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE round(value, 6) END AS metric
    FROM events, (VALUES ('training_sessions'), ('habit_goals'), ('market_watchlist_snapshot'), ('github_project_activity'), ('learning_activity'),
        ('finance_event_calendar'), ('health_summary'), ('location_area_summary'), ('finance_transactions'), ('data_source_runs'), ('browser_and_app_usage'),
        ('tasks_and_projects'), ('communications_metadata'), ('location_visits'), ('health_metrics'), ('identity_documents'), ('secrets_inventory')) k(kind)""",
)
def _(spark, sf):
    """All seventeen export kinds over one record shape that holds every field."""
    result = None
    for kind, spec in imports.SUMMARY_SPECS.items():
        e = F.col("event_id")
        fields = [F.when(e % 7 != 0, F.col("ts").cast("string")).alias(spec.time_fields[0])]
        fields += [F.concat(F.lit(" "), F.upper("event_type"), F.lit("! ")).alias(name) for name in spec.labels]
        fields += [F.col("value").alias(name) for name in spec.metrics]
        rows = table(spark, sf, "events").select(
            F.to_json(F.struct(*fields)).alias("row_json"), F.lit(f"inbox/{kind}.json").alias("path"), e.alias("row_number")
        )
        good = F.col("reject_reason").isNull()
        part = imports.summarize_source(rows, kind).select(
            "source_name",
            "row_number",
            F.when(good, "ok").otherwise("missing").alias("outcome"),
            F.when(good, F.trim(F.try_element_at("labels", F.lit(spec.labels[0])))).otherwise("").alias("label"),
            F.when(good, F.try_element_at("metrics", F.lit(spec.metrics[0]))).alias("metric"),
        )
        result = part if result is None else result.unionByName(part)
    return result


KIND_SIZES = ", ".join(f"('{kind}', {len(spec.labels)}, {len(spec.metrics)})" for kind, spec in imports.SUMMARY_SPECS.items())


@query(
    "d10_summary_imports_all_fields",
    f"""SELECT kind AS source_name, event_id AS row_number, CAST(n_labels AS BIGINT) AS n_labels, event_type AS labels,
    CAST(n_metrics AS BIGINT) AS n_metrics, round(value, 6) AS metrics FROM events, (VALUES {KIND_SIZES}) k(kind, n_labels, n_metrics)
    WHERE event_id % 7 <> 0""",
)
def _(spark, sf):
    """Every label and every metric of the accepted rows; all fields of a record hold one value."""
    result = None
    for kind, spec in imports.SUMMARY_SPECS.items():
        e = F.col("event_id")
        fields = [F.when(e % 7 != 0, F.col("ts").cast("string")).alias(spec.time_fields[-1])]
        fields += [F.concat(F.lit(" "), F.upper("event_type"), F.lit("! ")).alias(name) for name in spec.labels]
        fields += [F.col("value").alias(name) for name in spec.metrics]
        rows = table(spark, sf, "events").select(
            F.to_json(F.struct(*fields)).alias("row_json"), F.lit(f"inbox/{kind}.json").alias("path"), e.alias("row_number")
        )
        part = imports.summarize_source(rows, kind).filter(F.col("reject_reason").isNull()).select(
            "source_name",
            "row_number",
            F.size("labels").alias("n_labels"),
            F.array_join(F.array_distinct(F.transform(F.map_values("labels"), lambda v: F.trim(v))), ",").alias("labels"),
            F.size("metrics").alias("n_metrics"),
            F.when(F.size(F.array_distinct(F.map_values("metrics"))) == 1, F.map_values("metrics")[0]).alias("metrics"),
        )
        result = part if result is None else result.unionByName(part)
    return result


@query(
    "d11_learning_and_trades",
    """SELECT event_id, event_type AS topic, substring(sha256('course ' || user_id), 1, 16) AS course_hash, CAST(floor(value) AS BIGINT) AS practice_minutes, event_id % 2 = 0 AS completed,
    substring(sha256(event_type), 1, 16) AS instrument_hash, 'long' AS side, round(value / 10, 6) AS pnl_r FROM events""",
)
def _(spark, sf):
    """Lessons and trades of one file for each event. Every side has a row per event, so none is broadcast."""
    e = F.col("event_id")
    record = F.struct(
        F.col("ts").cast("string").alias("date"), F.upper("event_type").alias("category"), F.concat(F.lit("course "), "user_id").alias("lesson"),
        F.col("value").alias("duration_minutes"), F.when(e % 2 == 0, "Done").otherwise("no").alias("completed"),
        F.col("event_type").alias("symbol"), F.lit("LONG").alias("side"), F.round(F.col("value") / 10, 6).alias("r_multiple"),
    )
    rows = table(spark, sf, "events").select("event_id", F.to_json(record).alias("row_json"), F.lit("x/log.json").alias("path"))
    keyed = rows.select("event_id", "row_json", F.concat(F.lit("x/"), "event_id").alias("path"))
    lessons = imports.learning_sessions(keyed)
    trades = imports.trade_entries(keyed)
    key = ["source_file_hash"]
    ids = table(spark, sf, "events").select("event_id", F.substring(F.sha2(F.col("event_id").cast("string"), 256), 1, 16).alias("source_file_hash"))
    return (
        ids.join(lessons.select(*key, "topic", "course_hash", "practice_minutes", "completed").hint("merge"), key)
        .join(trades.select(*key, "instrument_hash", "side", "pnl_r").hint("merge"), key)
        .drop(*key)
    )


@query(
    "d11_note_summaries",
    """SELECT doc_id, substring(sha256(trim(text, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))), 1, 16) AS summary_hash,
    CAST(len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS BIGINT) AS word_count, lang || '|' || source AS tags, 'note' AS source_extension FROM documents""",
)
def _(spark, sf):
    """Every document as a note: hash and word count of its whole text."""
    none = F.lit(None).cast("string")
    notes = table(spark, sf, "documents").select(
        "doc_id", F.lit("").alias("title"), F.col("text").alias("summary"),
        F.concat(F.upper("lang"), F.lit(", ,"), F.lit(" "), "source").alias("tags"), none.alias("mood"),
        none.alias("occurred_at"), none.alias("created_at"), none.alias("updated_at"), none.alias("date"),
        F.lit("2024-01-31").alias("imported"), F.concat(F.lit("notes/"), "doc_id", F.lit(".note")).alias("path"),
    )
    summaries = imports.note_summaries(notes, "imported")
    ids = notes.select("doc_id", F.substring(F.sha2(F.concat(F.col("doc_id").cast("string"), F.lit(".note")), 256), 1, 16).alias("source_file_hash"))
    return ids.join(summaries, "source_file_hash").select("doc_id", "summary_hash", "word_count", "tags", "source_extension")


@query(
    "d11_rows_without_time",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'missing one of occurred_at, completed_at, started_at, date' END AS lesson_reason,
    CASE WHEN event_id % 3 = 0 THEN 'missing one of occurred_at, closed_at, entry_time, date' END AS trade_reason FROM events""",
)
def _(spark, sf):
    """Every third lesson and trade has no time and is rejected."""
    e = F.col("event_id")
    when_known = F.when(e % 3 != 0, F.col("ts").cast("string"))
    rows = table(spark, sf, "events").select(
        "event_id", F.to_json(F.struct(when_known.alias("date"), F.lit("x").alias("topic"))).alias("row_json"), e.cast("string").alias("path")
    )
    hashed = rows.select("event_id", F.substring(F.sha2("path", 256), 1, 16).alias("source_file_hash"))
    lessons = imports.learning_sessions(rows).select("source_file_hash", F.col("reject_reason").alias("lesson_reason"))
    trades = imports.trade_entries(rows).select("source_file_hash", F.col("reject_reason").alias("trade_reason"))
    # Rejected or not, every side has a row per event.
    return hashed.join(lessons.hint("merge"), "source_file_hash").join(trades.hint("merge"), "source_file_hash").drop("source_file_hash")


@query(
    "d11_json_notes",
    """SELECT doc_id, substring(sha256(trim(text, chr(32) || chr(9) || chr(10) || chr(13) || chr(12) || chr(11))), 1, 16) AS summary_hash,
    CAST(len(regexp_extract_all(text, '[\\p{L}\\p{N}_]+')) AS BIGINT) AS word_count, lang || '|' || source AS tags FROM documents""",
)
def _(spark, sf):
    """Documents as JSON notes: the text in three fields, tags as an array or as text."""
    d = F.col("doc_id")
    field = lambda k: F.when(d % 3 == k, F.col("text"))
    listed = F.struct(field(0).alias("summary"), field(1).alias("body"), field(2).alias("content"), F.array(F.upper("lang"), "source").alias("tags"))
    plain = F.struct(field(0).alias("summary"), field(1).alias("body"), field(2).alias("content"), F.concat("lang", F.lit(" , "), "source").alias("tags"))
    rows = table(spark, sf, "documents").select(
        F.when(d % 2 == 0, F.to_json(listed)).otherwise(F.to_json(plain)).alias("row_json"), d.cast("string").alias("path")
    )
    notes = imports.note_rows(rows).withColumn("imported", F.lit("2024-01-31"))
    summaries = imports.note_summaries(notes, "imported")
    ids = table(spark, sf, "documents").select("doc_id", F.substring(F.sha2(d.cast("string"), 256), 1, 16).alias("source_file_hash"))
    return ids.join(summaries, "source_file_hash").select("doc_id", "summary_hash", "word_count", "tags")


@query(
    "d12_sleep_nights",
    f"""SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'duration must be positive' WHEN event_id % 10 = 3 THEN 'quality_score must be between 1 and 100' ELSE 'ok' END AS outcome,
    CASE WHEN event_id % 9 = 0 THEN CAST(0 AS BIGINT) ELSE CAST(minutes AS BIGINT) END AS duration_minutes,
    CASE WHEN event_id % 9 = 0 THEN CAST(0 AS DOUBLE) ELSE {half_up('CAST(minutes AS DOUBLE) / (minutes + 30)', 3)} END AS sleep_efficiency FROM v_sleep""",
    ("v_sleep",),
)
def _(spark, sf):
    rows = sleep_rows(spark, sf)
    e = F.col("event_id")
    damaged = rows.withColumns(
        {
            "woke_at": F.when(e % 9 == 0, F.col("slept_at")).otherwise(F.col("woke_at")),
            "quality_score": F.when(e % 10 == 3, "101").otherwise(F.col("quality_score")),
        }
    )
    valid, rejected = sleep.normalize_sleep(damaged, keep=("event_id",))
    columns = ("event_id", "outcome", "duration_minutes", "sleep_efficiency")
    return valid.withColumn("outcome", F.lit("ok")).select(*columns).unionByName(
        rejected.withColumn("outcome", F.col("reject_reason")).select(*columns)
    )


# ---------- privacy ----------
@query(
    "d13_redacted_payloads",
    """SELECT event_id, '{"kept":"' || event_type || '","list":[{"b":' || user_id || '},1]}' AS payload FROM events""",
)
def _(spark, sf):
    """Unknown shapes: text in, text out, forbidden keys gone at any depth."""
    raw = F.concat(
        F.lit('{"Home-Address": {"x": 1}, "kept": "'), "event_type", F.lit('", "token": "t", "list": [{"note": "n", "b": '),
        "user_id", F.lit("}, 1]}"),
    )
    return table(spark, sf, "events").select("event_id", json_tools.redact_json(raw).alias("payload"))


@query(
    "d13_redacted_structs",
    """SELECT event_id, '{"kept":"' || event_type || '","inner":{"b":' || user_id || '}}' AS payload FROM events""",
)
def _(spark, sf):
    """Known shapes: the same result without Python workers."""
    row = F.struct(
        F.lit("s").alias("secret"), F.col("event_type").alias("kept"),
        F.struct(F.lit("h").alias("home"), F.col("user_id").alias("b")).alias("inner"),
    )
    staged = table(spark, sf, "events").select("event_id", row.alias("r"))
    return staged.select("event_id", F.to_json(json_tools.redact_struct(F.col("r"), staged.schema["r"].dataType)).alias("payload"))


@query(
    "d14_masked_logs",
    """SELECT event_id, '{"Api_Key_Id":"[redacted]","nested":{"user_password":"[redacted]","n":' || user_id || '}}' AS fields FROM events""",
)
def _(spark, sf):
    raw = F.concat(
        F.lit('{"Api_Key_Id": "'), "event_id", F.lit('", "nested": {"user_password": ["a"], "n": '), "user_id", F.lit("}}")
    )
    return table(spark, sf, "events").select("event_id", json_tools.mask_json(raw).alias("fields"))


@query(
    "d15_custom_source_events",
    """SELECT CASE WHEN event_type = 'error' THEN 'source is not registered' WHEN event_id % 6 = 5 THEN 'row has no occurred_at or event_time' ELSE 'ok' END AS outcome,
    count(*) AS n, count(DISTINCT CASE WHEN event_type <> 'error' AND event_id % 6 <> 5 THEN event_id END) AS ids FROM events GROUP BY 1""",
)
def _(spark, sf):
    e = F.col("event_id")
    record = F.struct(
        F.when(e % 6 < 3, F.col("ts").cast("string")).alias("occurred_at"),
        F.when((e % 6 >= 3) & (e % 6 < 5), F.col("ts").cast("string")).alias("event_time"),
        e.alias("n"), F.lit("private").alias("note"),
    )
    rows = table(spark, sf, "events").select(F.col("event_type").alias("source_name"), F.to_json(record).alias("row_json"))
    registry = config_frame(spark, [("click",), ("view",), ("purchase",), ("signup",)], "source_name string")
    events, rejected = envelope.custom_events(rows, registry, ingested_at=AS_OF)
    kept = events.filter(~F.contains(F.col("payload"), F.lit("private")))
    good = kept.agg(rollups.rows("n"), F.countDistinct("event_id").alias("ids")).select(F.lit("ok").alias("outcome"), "n", "ids")
    bad = rejected.groupBy(F.col("reject_reason").alias("outcome")).agg(rollups.rows("n"))
    return good.unionByName(bad.withColumn("ids", F.lit(0).cast("bigint")))


@query(
    "d16_subscription_events",
    """SELECT event_type, quality_flags, count(*) AS n, count(DISTINCT id) AS ids FROM (
        SELECT event_id || '/' || n AS id, CASE event_id % 3 WHEN 0 THEN 'rss_feed_item' WHEN 1 THEN 'api_json_item' ELSE 'source_seen' END AS event_type,
        CASE event_id % 3 WHEN 1 THEN 'fixture_or_manual_check' ELSE 'parsed_item' END AS quality_flags
        FROM events, generate_series(1, 3) g(n) WHERE event_id % 5 <> 0 AND (event_id % 3 < 2 OR n = 1)) GROUP BY 1, 2""",
)
def _(spark, sf):
    subs, contents = managed_sources(spark, sf)
    items = subscriptions.subscription_items(subs, contents, checked_at=AS_OF)
    events = subscriptions.subscription_events(subs, items, AS_OF)
    return events.groupBy("event_type", F.concat_ws("|", "quality_flags").alias("quality_flags")).agg(
        rollups.rows("n"), F.countDistinct("event_id").alias("ids")
    )


@query(
    "d16_source_commands",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN 'rss_feed' ELSE 'auto' END AS source_type,
    CASE WHEN event_id % 3 = 2 THEN NULL ELSE 'https://x.org/' || event_id END AS reference,
    CASE WHEN event_id % 3 = 2 THEN '' ELSE 'My ' || event_type END AS label, CASE WHEN event_id % 3 = 2 THEN '' ELSE 'extra tag|a|b' END AS tags,
    CASE WHEN event_id % 3 = 2 THEN 'source URL is missing' END AS error FROM events""",
)
def _(spark, sf):
    e = F.col("event_id")
    tail = F.concat(F.lit(" https://x.org/"), e, F.lit(" label=My_"), "event_type", F.lit(" tags=a,b extra_tag"))
    message = F.when(e % 3 == 0, F.concat(F.lit("/source_add rss_feed"), tail)).when(e % 3 == 1, F.concat(F.lit("/source_add "), tail)).otherwise("/source_add auto")
    parsed = messages.parse_source_commands(table(spark, sf, "events").select("event_id", message.alias("text")))
    return parsed.select("event_id", "source_type", "reference", "label", "tags", "error")


@query(
    "d16_registered_subscriptions",
    """SELECT page_id, 'rss_' || substring(sha256('rss_feed:' || regexp_replace(url, '#.*$', '') || '?rss=' || page_id), 1, 12) AS subscription_id,
    CASE WHEN page_id % 2 = 0 THEN 'Page ' || page_id ELSE NULL END AS label, 'news' AS domain, 'a b|c' AS tags, 'manual' AS cadence FROM pages""",
)
def _(spark, sf):
    key = F.col("page_id")
    reference = F.concat(F.regexp_replace("url", "#.*$", ""), F.lit("?rss="), key, F.lit("#top"))
    requests = table(spark, sf, "pages").select(
        "page_id", F.lit("rss_feed").alias("source_type"), reference.alias("reference"),
        F.when(key % 2 == 0, F.concat(F.lit("Page!  "), key)).otherwise("").alias("label"), F.lit("").alias("domain"),
        F.array(F.lit("a  b"), F.lit("?"), F.lit("c")).alias("tags"), F.lit("public_context").alias("privacy_class"), F.lit("").alias("cadence"),
    )
    registered = subscriptions.register_subscriptions(requests)
    page = F.regexp_extract("reference", r"rss=(\d+)$", 1).cast("bigint").alias("page_id")
    given = F.when(F.startswith("label", F.lit("Page ")), F.col("label")).alias("label")
    return registered.select(page, "subscription_id", given, "domain", "tags", "cadence")


@query(
    "d17_envelope_identity",
    """SELECT event_id AS n, substring(sha256('context_signals:sig_' || event_id % 2000), 1, 32) AS event_id, 'context_signals:sig_' || event_id % 2000 AS idempotency_key FROM events""",
)
def _(spark, sf):
    signal = envelope.envelope(view(spark, sf, "v_signals").withColumn("summary", F.col("event_id").cast("string")), envelope.SIGNAL, AS_OF)
    return signal.select(F.get_json_object("payload", "$.summary").cast("bigint").alias("n"), "event_id", "idempotency_key")


STANDARD_COUNTS = """SELECT 'weather_forecast' AS source_name, 'weather_hour' AS event_type, count(*) AS n FROM v_weather
    UNION ALL SELECT 'context_signals', 'context_signal', count(*) FROM v_signals
    UNION ALL SELECT 'daily_context_profile', 'recommendation', count(*) FROM v_recs
    UNION ALL SELECT 'daily_context_profile', 'daily_context_profile', count(*) FROM v_profiles
    UNION ALL SELECT 'sleep_quality', 'sleep_quality_night', count(*) FROM v_sleep
    UNION ALL SELECT 'activity_diary', 'activity_week_summary', count(DISTINCT user_id) FROM v_activity WHERE logged_at >= TIMESTAMP '{as_of}' - INTERVAL 7 DAY
    UNION ALL SELECT 'decision_feedback', 'decision_metrics_7d', count(DISTINCT user_id) FROM v_feedback WHERE created_at >= TIMESTAMP '{as_of}' - INTERVAL 7 DAY
    UNION ALL SELECT 'data_source_runs', 'data_source_run', count(DISTINCT component) + 1 FROM v_logs
    UNION ALL SELECT 'place_spots', 'public_place_spot', count(*) FROM v_spots
    UNION ALL SELECT 'activity_files', 'activity_file_summary', count(DISTINCT user_id) FROM v_scores"""


@query(
    "d18_standard_envelopes",
    STANDARD_COUNTS.format(as_of=AS_OF),
    ("v_weather", "v_signals", "v_recs", "v_profiles", "v_sleep", "v_activity", "v_feedback", "v_logs", "v_spots", "v_scores"),
)
def _(spark, sf):
    """The ten standing envelopes; rows count only when their payload is valid JSON."""
    at = lambda df: df.withColumn("generated_at", F.lit(AS_OF).cast("timestamp"))
    side = inputs(spark, sf)
    nights, _rejected = sleep.normalize_sleep(sleep_rows(spark, sf))
    points = table(spark, sf, "events").select(
        F.col("user_id").alias("track_id"), F.col("event_id").alias("idx"), F.lit(0.0).alias("lat"), F.lit(0.0).alias("lon"),
        F.col("value").alias("ele"), F.col("ts").cast("string").alias("time"),
    )
    routes = tracks.route_summary(points).withColumns({"source_file": F.col("track_id").cast("string"), "activity_type": F.lit("walk")})
    spots = view(spark, sf, "v_spots").withColumns({"tags": F.array("tag"), "observed_at": F.lit(AS_OF).cast("timestamp")})
    frames = {
        "weather": view(spark, sf, "v_weather"),
        "signal": view(spark, sf, "v_signals"),
        "recommendation": view(spark, sf, "v_recs"),
        "daily_context": view(spark, sf, "v_profiles"),
        "sleep": nights,
        "week_summary": at(side["week"]),
        "decision_metrics": at(side["metrics"]),
        "run": logs.run_health(view(spark, sf, "v_logs"), AS_OF),
        "place": spots,
        "activity_file": routes,
    }
    result = None
    for name, df in frames.items():
        events = envelope.envelope(df, envelope.STANDARD[name], AS_OF)
        counts = events.filter(F.try_parse_json("payload").isNotNull() & (F.length("event_id") == 32)).groupBy("source_name", "event_type").agg(rollups.rows("n"))
        result = counts if result is None else result.unionByName(counts)
    return result


@query(
    "d18_place_and_signal_envelopes",
    f"""WITH s AS (SELECT 'context_signals:' || signal_id AS key, 'context_signals' AS source_name,
        strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time, '' AS metrics, '' AS tags,
        json_object('signal_id', signal_id, 'domain', domain, 'source', source, 'title', title, 'direction', direction,
            'urgency', urgency, 'confidence', confidence, 'summary', summary,
            'occurred_at', strftime(occurred_at, '%Y-%m-%dT%H:%M:%S.%fZ'),
            'ingested_at', strftime(ingested_at, '%Y-%m-%dT%H:%M:%S.%fZ'))::VARCHAR AS payload FROM v_signals),
    p AS (SELECT 'place_spots:' || spot_id || ':' || source AS key, 'place_spots' AS source_name,
        strftime(TIMESTAMP '{AS_OF}', '%Y-%m-%dT%H:%M:%S.%fZ') AS event_time,
        'latitude=' || CAST(latitude AS VARCHAR) || ',longitude=' || CAST(longitude AS VARCHAR) AS metrics, 'places' AS tags,
        json_object('spot_id', spot_id, 'label', label, 'latitude', latitude, 'longitude', longitude, 'tags', [tag], 'source', source,
            'observed_at', strftime(TIMESTAMP '{AS_OF}', '%Y-%m-%dT%H:%M:%S.%fZ'))::VARCHAR AS payload FROM v_spots)
    SELECT key AS idempotency_key, substring(sha256(key), 1, 32) AS event_id, source_name, event_time, metrics, tags, payload
    FROM (SELECT * FROM s UNION ALL SELECT * FROM p)""",
    ("v_signals", "v_spots"),
)
def _(spark, sf):
    """Whole rows of two envelopes: id, key, time, metrics, tags and payload."""
    spots = view(spark, sf, "v_spots").withColumns({"tags": F.array("tag"), "observed_at": F.lit(AS_OF).cast("timestamp")})
    both = envelope.envelope(view(spark, sf, "v_signals"), envelope.SIGNAL, AS_OF).unionByName(
        envelope.envelope(spots, envelope.PLACE, AS_OF)
    )
    pairs = F.transform(F.array_sort(F.map_entries("metrics")), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string")))
    return both.select(
        "idempotency_key", "event_id", "source_name", "event_time", F.array_join(pairs, ",").alias("metrics"),
        F.array_join("tags", ",").alias("tags"), "payload",
    )


# ---------- messages ----------
@query(
    "d19_diary_messages",
    f"""SELECT event_id, CASE WHEN event_id % 13 IN (1, 2, 3) THEN CASE event_id % 13 WHEN 1 THEN 'unknown activity' WHEN 2 THEN 'mood must be an integer from 1 to 10' ELSE 'missing /log fields' END END AS error,
    CASE WHEN event_id % 13 = 1 THEN 'chess' ELSE {ACTIVITY} END AS activity_type, CASE WHEN event_id % 13 = 3 THEN NULL ELSE 1 + event_id % 10 END AS intensity,
    event_id % 2 = 1 AND event_id % 4 = 1 AS pain_flag, CASE WHEN event_id % 2 = 0 AND event_id % 13 <> 3 THEN 'dry  run ' || event_id ELSE 'dry run' END AS notes,
    CASE WHEN event_id % 2 = 1 OR event_id % 13 = 3 THEN 'north spot' END AS location_label FROM events""".replace(
        "event_id % 2 = 1 AND event_id % 4 = 1 AS pain_flag", "(event_id % 2 = 1 OR event_id % 13 = 3) AND event_id % 4 = 1 AS pain_flag"
    ),
    text=("intensity",),
)
def _(spark, sf):
    e = F.col("event_id")
    activity = F.when(e % 13 == 1, "chess").otherwise(F.expr(ACTIVITY))
    mood = F.when(e % 13 == 2, "11").otherwise("5")
    compact = F.concat_ws(" ", F.lit("/log"), activity, (1 + e % 10).cast("string"), mood, F.lit("4"), F.lit("good"), F.concat(F.lit("dry  run "), e))
    keyed = F.concat(
        F.lit("/log activity="), activity, F.when(e % 13 == 3, F.lit("")).otherwise(F.concat(F.lit(" intensity="), 1 + e % 10)),
        F.lit(" mood="), mood, F.lit(" fatigue=4 result=good loc=north_spot notes=dry_run pain="), F.when(e % 4 == 1, "yes").otherwise("no"),
    )
    rows = table(spark, sf, "events").select("event_id", F.when((e % 2 == 0) & (e % 13 != 3), compact).otherwise(keyed).alias("text"))
    parsed = messages.parse_log_messages(rows)
    return parsed.select("event_id", "error", "activity_type", "intensity", "pain_flag", "notes", "location_label")


@query(
    "d19_capture_messages",
    """SELECT event_id, CASE event_id % 8 WHEN 0 THEN 'sleep' WHEN 1 THEN 'mood' WHEN 2 THEN 'pain' WHEN 3 THEN 'plan' WHEN 4 THEN 'activity' WHEN 5 THEN 'trade_note' WHEN 6 THEN 'note' END AS capture_type,
    CASE event_id % 8 WHEN 0 THEN 450 WHEN 1 THEN CASE WHEN event_id % 12 BETWEEN 1 AND 10 THEN event_id % 12 END WHEN 2 THEN event_id % 11 WHEN 4 THEN 6 END AS value,
    CASE event_id % 8 WHEN 0 THEN 'deep one' WHEN 1 THEN 'calm' WHEN 2 THEN 'wrist after moto' WHEN 3 THEN 'finish ' || event_type WHEN 4 THEN 'cones' WHEN 5 THEN 'SPY watch' WHEN 6 THEN 'remember ' || user_id ELSE 'x' END AS note,
    CASE WHEN event_id % 8 = 7 THEN 'unsupported capture command' WHEN event_id % 8 = 1 AND event_id % 12 NOT BETWEEN 1 AND 10 THEN 'mood must be an integer from 1 to 10' END AS error,
    event_id % 8 = 2 AND event_id % 11 > 0 AS pain_flag FROM events""",
    text=("value",),
)
def captures(spark, sf):
    e = F.col("event_id")
    text = (
        F.when(e % 8 == 0, F.lit("/sleep 7.5h quality=82 deep_one"))
        .when(e % 8 == 1, F.concat(F.lit("/mood "), e % 12, F.lit(" calm")))
        .when(e % 8 == 2, F.concat(F.lit("/pain "), e % 11, F.lit(" wrist after moto")))
        .when(e % 8 == 3, F.concat(F.lit("/plan finish "), "event_type"))
        .when(e % 8 == 4, F.lit("/moto 6 ok cones loc=old_yard"))
        .when(e % 8 == 5, F.lit("/trade SPY watch"))
        .when(e % 8 == 6, F.concat(F.lit("/note remember "), "user_id"))
        .otherwise("/dance x")
    )
    parsed = messages.parse_capture_messages(table(spark, sf, "events").select("event_id", text.alias("text")))
    return parsed.select("event_id", "capture_type", "value", "note", "error", "pain_flag")


@query(
    "d19_captured_lessons",
    """SELECT event_id, 'moto_lesson' AS activity_type, CAST(CASE WHEN event_id % 2 = 0 THEN 6 ELSE 5 END AS BIGINT) AS intensity,
    CAST(CASE WHEN event_id % 11 BETWEEN 1 AND 10 THEN event_id % 11 END AS BIGINT) AS mood, 'old yard' AS location_label,
    CASE WHEN event_id % 11 = 0 THEN 'mood must be an integer from 1 to 10' END AS error FROM events""",
    text=("mood",),
)
def _(spark, sf):
    e = F.col("event_id")
    text = F.concat(F.lit("/moto "), F.when(e % 2 == 0, "6 ").otherwise(""), F.lit("good slow turns loc=old_yard mood="), e % 11)
    parsed = messages.parse_capture_messages(table(spark, sf, "events").select("event_id", text.alias("text")))
    rows = messages.capture_activities(parsed.drop("text"))
    return rows.select("event_id", "activity_type", "intensity", "mood", "location_label", "error")


@query(
    "d20_feedback_messages",
    f"""WITH e AS (SELECT event_id, CASE WHEN event_id % 14 = 13 THEN 'chess' ELSE {ACTIVITY} END AS activity FROM events)
    SELECT event_id, activity, CASE event_id % 5 WHEN 0 THEN 'followed' WHEN 1 THEN 'skipped' WHEN 2 THEN 'changed' WHEN 3 THEN 'followed' ELSE 'skipped' END AS action,
    CASE event_id % 5 WHEN 0 THEN 'bad' WHEN 1 THEN 'skipped' WHEN 2 THEN NULL WHEN 3 THEN 'good' ELSE 'skipped' END AS result,
    CASE event_id % 5 WHEN 0 THEN 'dry session' WHEN 1 THEN 'rain' WHEN 2 THEN 'more  words here' ELSE 'telegram button' END AS note,
    CASE WHEN activity = 'chess' THEN 'unknown activity' END AS error FROM e""",
)
def _(spark, sf):
    e = F.col("event_id")
    activity = F.when(e % 14 == 13, "chess").otherwise(F.expr(ACTIVITY))
    text = (
        F.when(e % 5 == 0, F.concat(F.lit("/done "), activity, F.lit(" bad dry_session")))
        .when(e % 5 == 1, F.concat(F.lit("/skip "), activity, F.lit(" rain")))
        .when(e % 5 == 2, F.concat(F.lit("/feedback "), activity, F.lit(" changed maybe more  words here")))
        .when(e % 5 == 3, F.concat(F.lit("fb:done:"), activity, F.lit(":strange")))
        .otherwise(F.concat(F.lit("fb:skip:"), activity))
    )
    parsed = messages.parse_feedback(table(spark, sf, "events").select("event_id", text.alias("text")))
    return parsed.select("event_id", "activity", "action", "result", "note", "error")


@query(
    "d21_repaired_rows",
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'order_' || event_id ELSE event_type END AS order_id,
    CASE WHEN event_id % 3 = 0 THEN CAST(1 AS DOUBLE) ELSE value END AS amount, CASE WHEN event_id % 5 = 0 THEN 0 ELSE user_id END AS qty,
    CASE WHEN event_id % 2 = 0 THEN 'SETTLED' ELSE 'PENDING' END AS status FROM events""",
)
def _(spark, sf):
    e = F.col("event_id")
    damaged = table(spark, sf, "events").select(
        "event_id",
        F.when(e % 4 == 0, "").otherwise(F.col("event_type")).alias("order_id"),
        F.when(e % 3 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(e % 5 == 0, None).otherwise(F.col("user_id").cast("string")).alias("qty"),
        F.when(e % 2 == 0, "SETTLED").otherwise("unknown").alias("status"),
    )
    return repair.repair(
        damaged,
        {
            "order_id": repair.Repair("str", F.concat(F.lit("order_"), e)),
            "amount": repair.Repair("float", F.lit(1.0)),
            "qty": repair.Repair("int", F.lit(0)),
            "status": repair.Repair("enum", F.lit("PENDING"), repair.PAYMENT_STATUS),
        },
    )


@query(
    "d22_daily_decision_chain",
    f"""WITH {MEASURES}, {READINESS}, users AS (SELECT DISTINCT user_id, 'loc_' || user_id % 14 AS location_id FROM v_activity)
    SELECT user_id, activity, location_id, score FROM users JOIN readiness USING (location_id)""",
    ("v_weather", "v_activity"),
)
def _(spark, sf):
    """Weather to per-user scores, the first half of the daily chain; d03/d05 cover the rest."""
    activity = view(spark, sf, "v_activity")
    locations = activity.select("user_id").distinct().withColumn(
        "location_id", F.concat(F.lit("loc_"), F.col("user_id") % 14)
    )
    chain = daily.DailyInputs(view(spark, sf, "v_weather"), locations, activity, None, None, None)
    return daily.user_scores(chain).select("user_id", "activity", "location_id", "score")


CHAIN = f"""{MEASURES}, {READINESS}, followed AS (SELECT DISTINCT user_id, 'loc_' || user_id % 14 AS location_id FROM v_activity),
    best AS (SELECT user_id, activity, location_id, score, decision, explanation FROM followed JOIN readiness USING (location_id)),
    recent AS {CONTEXT.split("recent AS", 1)[1]}, {RECS}"""
CHAIN_VIEWS = ("v_weather", *PEOPLE)


def chain_inputs(spark, sf):
    activity = view(spark, sf, "v_activity")
    locations = activity.select("user_id").distinct().withColumn(
        "location_id", F.concat(F.lit("loc_"), F.col("user_id") % 14)
    )
    nights, _rejected = sleep.normalize_sleep(sleep_rows(spark, sf), keep=("user_id",))
    return daily.DailyInputs(
        view(spark, sf, "v_weather"), locations, activity, view(spark, sf, "v_feedback"), view(spark, sf, "v_signals"), nights
    )


@query("d22_chain_recommendations", f"WITH {CHAIN} SELECT * FROM recs", CHAIN_VIEWS)
def _(spark, sf):
    """Weather to recommendations for every user in one lazy chain."""
    return daily.daily_recommendations(chain_inputs(spark, sf), AS_OF)


@query(
    "d22_chain_profiles",
    f"""WITH {CHAIN}, {PROFILE} SELECT user_id, activity AS top_activity, CAST(score AS BIGINT) AS top_score, state AS readiness_state,
    {SUMMARY} AS context_summary FROM stated""",
    CHAIN_VIEWS,
)
def _(spark, sf):
    """Weather to daily profiles for every user in one lazy chain."""
    rows = daily.daily_profiles(chain_inputs(spark, sf), AS_OF)
    return rows.select("user_id", "top_activity", "top_score", "readiness_state", "context_summary")
