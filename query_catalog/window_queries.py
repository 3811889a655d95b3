"""Latest-row, window, top-k and set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contextlake.operators import asof, latest, logs, rollups, rules, signals
from contextlake.sources import files

from .adapters import AS_OF, table, view
from .registry import half_up, query
from .rollup_queries import FAILED, useful_days, weekly_sql, RATE


@query(
    "w01_latest_readiness",
    """SELECT activity, location_id, CAST(score AS BIGINT) AS score, decision, explanation, computed_at AS latest_computed_at
    FROM v_scores QUALIFY row_number() OVER (PARTITION BY activity, location_id ORDER BY computed_at DESC, score_id DESC) = 1""",
    ("v_scores",),
)
def latest_readiness(spark, sf):
    newest = latest.latest_by(
        view(spark, sf, "v_scores"),
        ["activity", "location_id"],
        [F.col("computed_at").desc(), F.col("score_id").desc()],
    )
    return newest.select(
        "activity", "location_id", "score", "decision", "explanation",
        F.col("computed_at").alias("latest_computed_at"),
    )


@query(
    "w01_latest_readiness_by_column",
    """SELECT activity, location_id, CAST(arg_max(score, computed_at) AS BIGINT) AS score,
    arg_max(decision, computed_at) AS decision, arg_max(explanation, computed_at) AS explanation,
    max(computed_at) AS latest_computed_at FROM v_scores GROUP BY 1, 2""",
    ("v_scores",),
)
def _(spark, sf):
    return latest.latest_values(
        view(spark, sf, "v_scores"),
        ["activity", "location_id"],
        ["score", "decision", "explanation"],
        "computed_at",
        "latest_computed_at",
    )


PROFILE_COLUMNS = (
    "profile_date", "timezone", "top_activity", "top_decision", "top_score", "readiness_state",
    "sessions_7d", "avg_mood_7d", "avg_fatigue_7d", "pain_sessions_7d", "useful_decision_days_7d",
    "follow_rate_7d", "open_goal_count", "signal_count_7d", "highest_signal_domain",
    "highest_signal_urgency", "context_summary",
)
INTS = ("top_score", "sessions_7d", "pain_sessions_7d", "useful_decision_days_7d", "open_goal_count",
        "signal_count_7d", "highest_signal_urgency")
LATEST_PROFILE = "SELECT {columns}, generated_at AS latest_generated_at FROM v_profiles QUALIFY row_number() OVER (PARTITION BY profile_date, timezone ORDER BY generated_at DESC, profile_id DESC) = 1".format(
    columns=", ".join(
        f"CAST({c} AS BIGINT) AS {c}" if c in INTS
        else f"CAST({c} AS VARCHAR) AS {c}" if c == "profile_date" else c
        for c in PROFILE_COLUMNS
    )
)


@query("w01_latest_daily_context", LATEST_PROFILE, ("v_profiles",))
def latest_profiles(spark, sf):
    newest = latest.keep_latest(
        view(spark, sf, "v_profiles"), ["profile_date", "timezone"], ["generated_at", "profile_id"]
    )
    return newest.select(*PROFILE_COLUMNS, F.col("generated_at").alias("latest_generated_at"))


RUNS = """SELECT source_name, status, error_count, observed_at FROM (
    SELECT component AS source_name, status, CAST(event_id % 3 AS BIGINT) AS error_count, ts AS observed_at, event_id FROM v_logs)
    QUALIFY row_number() OVER (PARTITION BY source_name ORDER BY observed_at DESC, event_id DESC) = 1"""


@query("w02_latest_source_runs", f"SELECT * FROM ({RUNS}) ORDER BY error_count = 0, source_name LIMIT 200", ("v_logs",))
def _(spark, sf):
    runs = view(spark, sf, "v_logs").select(
        F.col("component").alias("source_name"),
        "status",
        (F.col("event_id") % 3).alias("error_count"),
        F.col("ts").alias("observed_at"),
        "event_id",
    )
    return logs.latest_runs(runs, [F.col("event_id").desc()]).drop("event_id")


@query(
    "w03_payment_share",
    """SELECT payment_status, count(*) AS payments, round(count(*) / sum(count(*)) OVER (), 4) AS share
    FROM v_payments GROUP BY payment_status""",
    ("v_payments",),
)
def _(spark, sf):
    return latest.share(view(spark, sf, "v_payments"), ["payment_status"], "payments")


@query(
    "w04_daylight_window",
    """WITH ranked AS (SELECT location_id, forecast_time, is_day, temperature_c,
        row_number() OVER (PARTITION BY location_id ORDER BY is_day DESC, forecast_time) AS rn,
        bool_or(is_day) OVER (PARTITION BY location_id) AS any_day FROM v_weather)
    SELECT location_id, forecast_time, is_day, temperature_c FROM ranked WHERE rn <= 8 AND is_day = any_day""",
    ("v_weather",),
)
def _(spark, sf):
    window = rules.daylight_window(view(spark, sf, "v_weather"))
    return window.select("location_id", "forecast_time", "is_day", "temperature_c")


@query(
    "w05_best_score_per_activity",
    """SELECT user_id, activity, location_id, CAST(score AS BIGINT) AS score, decision FROM v_scores
    QUALIFY row_number() OVER (PARTITION BY user_id, activity ORDER BY score DESC, location_id) = 1""",
    ("v_scores",),
)
def _(spark, sf):
    scores = view(spark, sf, "v_scores").select("user_id", "activity", "location_id", "score", "decision")
    return rules.best_scores(scores, "user_id")


@query(
    "w06_consecutive_climb",
    f"""WITH vals AS (SELECT user_id, event_id, CAST(value AS DECIMAL(12,2)) AS value FROM events),
    pts AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY event_id) AS prev FROM vals)
    SELECT user_id, count(*) AS point_count,
    {half_up('CAST(coalesce(sum(greatest(value - prev, 0)), 0) AS DOUBLE)', 1)} AS elevation_gain_m
    FROM pts GROUP BY user_id""",
)
def _(spark, sf):
    from contextlake.operators import tracks

    points = table(spark, sf, "events").select(
        F.col("user_id").alias("track_id"),
        F.col("event_id").alias("idx"),
        F.lit(0.0).alias("lat"),
        F.lit(0.0).alias("lon"),
        F.col("value").alias("ele"),
        F.col("ts").cast("string").alias("time"),
    )
    routes = tracks.route_summary(points, chunk_points=1_000)
    return routes.select(F.col("track_id").alias("user_id"), "point_count", "elevation_gain_m")


@query(
    "w07_first_and_last",
    """SELECT user_id, arg_min(event_type, event_id) AS first_type, arg_max(event_type, event_id) AS last_type,
    min(ts) AS started_at, max(ts) AS ended_at FROM events GROUP BY user_id""",
)
def _(spark, sf):
    return table(spark, sf, "events").groupBy("user_id").agg(
        F.min_by("event_type", "event_id").alias("first_type"),
        F.max_by("event_type", "event_id").alias("last_type"),
        F.min("ts").alias("started_at"),
        F.max("ts").alias("ended_at"),
    )


@query(
    "w08_row_number_in_document",
    """WITH l AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
    SELECT doc_id, unnest(range(1, len(lines) + 1)) AS row_number, unnest(list_transform(lines, lambda x: length(x))) AS characters FROM l""",
)
def _(spark, sf):
    """Every document as a JSON list of its lines; records are numbered by position."""
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(F.length(line).alias("characters")))
    documents = table(spark, sf, "documents").select("doc_id", F.to_json(lines).alias("rows"))
    rows = files.explode_json_rows(documents, "rows")
    return rows.select(
        "doc_id", "row_number", F.get_json_object("row_json", "$.characters").cast("bigint").alias("characters")
    )


@query(
    "w09_recent_failures",
    f"""SELECT event_id, component, action, status, message FROM v_logs WHERE {FAILED} ORDER BY ts DESC, event_id DESC LIMIT 5""",
    ("v_logs",),
)
def _(spark, sf):
    recent = logs.recent_failures(view(spark, sf, "v_logs"), [F.col("ts").desc(), F.col("event_id").desc()])
    return recent.select("event_id", "component", "action", "status", "message")


@query(
    "t01_newest_weeks",
    weekly_sql("CAST(feedback_date - CAST(dayofweek(feedback_date) AS INT) AS DATE)", half_up(RATE, 3))
    + " ORDER BY 1 DESC LIMIT 12",
    ("v_feedback",),
)
def _(spark, sf):
    return latest.top_n(useful_days(spark, sf), [F.col("week_start").desc()], 12)


SIGNAL_DAY = f"""SELECT CAST(CAST(occurred_at AS DATE) AS VARCHAR) AS signal_date, domain, source, direction,
    count(*) AS signals, CAST(max(urgency) AS BIGINT) AS max_urgency, {half_up('avg(confidence)', 2)} AS avg_confidence
    FROM v_signals GROUP BY 1, 2, 3, 4"""


@query(
    "t01_newest_signal_days",
    f"{SIGNAL_DAY} ORDER BY 1 DESC, max_urgency DESC, domain, source, direction LIMIT 50",
    ("v_signals",),
)
def _(spark, sf):
    daily = rollups.signal_daily(view(spark, sf, "v_signals")).drop("latest_ingested_at")
    order = [F.col("signal_date").desc(), F.col("max_urgency").desc(), "domain", "source", "direction"]
    return latest.top_n(daily, order, 50)


RECENT = f"occurred_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY"
SIGNAL_FIELDS = "signal_id, event_id, domain, CAST(urgency AS BIGINT) AS urgency, CAST(confidence AS BIGINT) AS confidence, occurred_at"
SIGNAL_ORDER = "urgency DESC, confidence DESC, occurred_at DESC, signal_id"


@query(
    "t02_recent_signals",
    f"SELECT {SIGNAL_FIELDS} FROM v_signals WHERE {RECENT} ORDER BY {SIGNAL_ORDER} LIMIT 5",
    ("v_signals",),
)
def _(spark, sf):
    top = signals.recent_signals(view(spark, sf, "v_signals"), 5, AS_OF)
    return top.select("signal_id", "event_id", "domain", "urgency", "confidence", "occurred_at")


@query(
    "t03_top_signals_per_user",
    f"""SELECT user_id, {SIGNAL_FIELDS} FROM v_signals WHERE {RECENT}
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY {SIGNAL_ORDER}) <= 3""",
    ("v_signals",),
)
def _(spark, sf):
    top = signals.recent_signals(view(spark, sf, "v_signals"), 3, AS_OF, ("user_id",))
    return top.select("user_id", "signal_id", "event_id", "domain", "urgency", "confidence", "occurred_at")


@query(
    "t03_signal_lines",
    """SELECT user_id, string_agg(domain || '/' || source || ': ' || title || ' (' || direction || ', urgency ' || urgency || '/10)',
    chr(10) ORDER BY rn) AS signal_lines FROM (SELECT *, row_number() OVER (PARTITION BY user_id
        ORDER BY urgency DESC, confidence DESC, signal_id, event_id) AS rn FROM v_signals) WHERE rn <= 3 GROUP BY user_id""",
    ("v_signals",),
)
def _(spark, sf):
    from contextlake.operators.digests import signal_text

    order = [F.col("urgency").desc(), F.col("confidence").desc(), F.col("signal_id"), F.col("event_id")]
    return latest.top_text(view(spark, sf, "v_signals"), ["user_id"], order, signal_text(), 3, "signal_lines")


@query(
    "t04_dashboard_readiness",
    """SELECT activity, location_id, CAST(score AS BIGINT) AS score, decision, explanation, computed_at AS latest_computed_at
    FROM (SELECT * FROM v_scores QUALIFY row_number() OVER (PARTITION BY activity, location_id ORDER BY computed_at DESC, score_id DESC) = 1)
    ORDER BY score DESC, activity, location_id LIMIT 20""",
    ("v_scores",),
)
def _(spark, sf):
    return latest.top_n(latest_readiness(spark, sf), [F.col("score").desc(), "activity", "location_id"], 20)


@query(
    "t04_dashboard_weather",
    """SELECT location_id, CAST(CAST(forecast_time AS DATE) AS VARCHAR) AS forecast_date, max(temperature_c) AS max_temperature_c,
    round(sum(precipitation_mm), 4) AS precipitation_mm, round(sum(snowfall_cm), 4) AS snowfall_cm,
    max(wind_gust_kmh) AS max_wind_gust_kmh FROM v_weather GROUP BY 1, 2 ORDER BY 2 DESC, 1 LIMIT 30""",
    ("v_weather",),
)
def _(spark, sf):
    daily = rollups.weather_daily(view(spark, sf, "v_weather")).select(
        "location_id", "forecast_date", "max_temperature_c", F.round("precipitation_mm", 4).alias("precipitation_mm"),
        F.round("snowfall_cm", 4).alias("snowfall_cm"), "max_wind_gust_kmh",
    )
    return latest.top_n(daily, [F.col("forecast_date").desc(), "location_id"], 30)


@query(
    "t04_dashboard_recommendations",
    f"""SELECT CAST(CAST(generated_at AS DATE) AS VARCHAR) AS recommendation_date, activity, decision, recommendation_type,
    count(*) AS recommendations, {half_up('avg(score)', 2)} AS avg_score FROM v_recs GROUP BY 1, 2, 3, 4
    ORDER BY 1, 2, 3, 4 LIMIT 60""",
    ("v_recs",),
)
def _(spark, sf):
    daily = rollups.recommendation_daily(view(spark, sf, "v_recs")).drop("latest_generated_at")
    return latest.top_n(daily, ["recommendation_date", "activity", "decision", "recommendation_type"], 60)


@query(
    "t04_dashboard_contexts",
    f"SELECT * FROM ({LATEST_PROFILE}) ORDER BY profile_date DESC, latest_generated_at DESC, timezone LIMIT 7",
    ("v_profiles",),
)
def _(spark, sf):
    order = [F.col("profile_date").desc(), F.col("latest_generated_at").desc(), "timezone"]
    return latest.top_n(latest_profiles(spark, sf), order, 7)


@query("t05_newest_positions", "SELECT event_id, event_type, ts FROM events ORDER BY event_id DESC LIMIT 2")
def _(spark, sf):
    newest = table(spark, sf, "events").select("event_id", "event_type", "ts")
    return latest.top_n(newest, [F.col("event_id").desc()], 2)


@query(
    "t06_best_learned_activity",
    f"""WITH p AS (SELECT user_id, activity, count(*) AS feedback_events,
        count(*) FILTER (WHERE result = 'good') AS good_results,
        {half_up("CAST(count(*) FILTER (WHERE action = 'followed') AS DOUBLE) / greatest(count(*), 1)", 3)} AS follow_rate
        FROM v_feedback WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY GROUP BY 1, 2)
    SELECT user_id, activity, feedback_events, good_results, follow_rate FROM p QUALIFY row_number() OVER (
        PARTITION BY user_id ORDER BY follow_rate DESC, good_results DESC, feedback_events DESC, activity) = 1""",
    ("v_feedback",),
)
def _(spark, sf):
    profile = rollups.feedback_profile(view(spark, sf, "v_feedback"), 30, AS_OF, user_col="user_id")
    best = rules.learned_activity(profile)
    return best.select("user_id", "activity", "feedback_events", "good_results", "follow_rate")


@query(
    "u01_metric_rows",
    """SELECT 'spots' AS metric, CAST(count(*) AS VARCHAR) AS value FROM v_spots
    UNION ALL SELECT 'activity_rows', CAST(count(*) AS VARCHAR) FROM v_activity
    UNION ALL SELECT 'weather_locations', CAST(count(DISTINCT location_id) AS VARCHAR) FROM v_weather
    UNION ALL SELECT 'readiness_rows', CAST(count(*) AS VARCHAR) FROM v_scores""",
    ("v_spots", "v_activity", "v_weather", "v_scores"),
)
def _(spark, sf):
    count = lambda name: view(spark, sf, name).agg(rollups.rows("n"))
    locations = view(spark, sf, "v_weather").agg(F.countDistinct("location_id").alias("n"))
    return rollups.metric_rows(
        [
            ("spots", count("v_spots"), "n"),
            ("activity_rows", count("v_activity"), "n"),
            ("weather_locations", locations, "n"),
            ("readiness_rows", count("v_scores"), "n"),
        ]
    )


@query(
    "u02_event_lists_as_one_landing_set",
    """SELECT source_name, event_type, count(*) AS events, count(DISTINCT event_id) AS ids FROM (
        SELECT 'context_signals' AS source_name, 'context_signal' AS event_type, signal_id AS event_id FROM v_signals
        UNION ALL SELECT 'weather_forecast', 'weather_hour', location_id || CAST(forecast_time AS VARCHAR) FROM v_weather)
    GROUP BY 1, 2""",
    ("v_signals", "v_weather"),
)
def _(spark, sf):
    from contextlake.operators.envelope import SIGNAL, WEATHER, envelope

    events = envelope(view(spark, sf, "v_signals"), SIGNAL, AS_OF).unionByName(
        envelope(view(spark, sf, "v_weather"), WEATHER, AS_OF)
    )
    return events.groupBy("source_name", "event_type").agg(
        rollups.rows("events"), F.countDistinct("event_id").alias("ids")
    )


@query(
    "u03_first_occurrence",
    """SELECT text_hash, doc_id, source FROM (SELECT substring(sha256(text), 1, 16) AS text_hash, doc_id, source,
        row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1""",
)
def _(spark, sf):
    """First document per text; the comparison key is the hash of the whole text."""
    hashed = table(spark, sf, "documents").select(
        F.sha2("text", 256).alias("text_key"), "doc_id", "source"
    )
    first = latest.latest_by(hashed, ["text_key"], [F.col("doc_id").asc()])
    return first.select(F.substring("text_key", 1, 16).alias("text_hash"), "doc_id", "source")


@query(
    "u03_ordered_distinct_list",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'a|' || event_type WHEN event_type = 'view' THEN 'view' ELSE event_type || '|view' END AS labels FROM events""",
)
def _(spark, sf):
    first = F.when(F.col("event_id") % 2 == 0, F.lit("a"))
    last = F.when(F.col("event_id") % 2 == 1, F.lit("view"))
    labels = F.array_distinct(F.array_compact(F.array(first, "event_type", first, "event_type", last)))
    return table(spark, sf, "events").select("event_id", labels.alias("labels"))


@query(
    "u04_set_difference",
    """SELECT CAST(c_custkey AS VARCHAR) AS name, 'buyers' AS missing_from FROM customer
    WHERE c_custkey NOT IN (SELECT customer_id FROM v_ri_orders)
    UNION ALL SELECT DISTINCT CAST(customer_id AS VARCHAR), 'customers' FROM v_ri_orders
    WHERE customer_id NOT IN (SELECT c_custkey FROM customer)""",
    ("v_ri_orders",),
)
def _(spark, sf):
    from contextlake.operators.quality import set_difference

    customers = table(spark, sf, "customer").select(F.col("c_custkey").cast("string").alias("name"))
    buyers = view(spark, sf, "v_ri_orders").select(F.col("customer_id").cast("string").alias("name"))
    return set_difference(customers, buyers, "customers", "buyers")


@query(
    "j09_known_then",
    """WITH asked AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
    facts AS (SELECT user_id, ts, max(event_id) AS fact_id, max_by(value, event_id) AS fact_value FROM events
        WHERE event_type = 'click' GROUP BY user_id, ts)
    SELECT asked.event_id, fact_id, fact_value FROM asked ASOF LEFT JOIN facts ON asked.user_id = facts.user_id AND asked.ts >= facts.ts""",
    text=("fact_id",),
)
def _(spark, sf):
    """Each purchase with the last click of its user up to then; chunks of six hours carry over."""
    from datetime import timedelta

    events = table(spark, sf, "events")
    asked = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    facts = events.filter("event_type = 'click'").select("event_id", "user_id", "ts", "value")
    found = asof.known_then(asked, facts, ["user_id"], "ts", "ts", tie=["event_id"], chunk=timedelta(hours=6))
    return found.select("event_id", F.col("known.event_id").alias("fact_id"), F.col("known.value").alias("fact_value"))


@query(
    "d03_scores_known_when_recommended",
    """WITH asked AS (SELECT event_id, user_id % 7 AS place, ts FROM events WHERE event_id % 3 = 0),
    facts AS (SELECT user_id % 7 AS place, ts + INTERVAL 1 HOUR AS since, max(event_id) AS fact_id FROM events WHERE event_id % 3 = 1 GROUP BY 1, 2)
    SELECT asked.event_id, fact_id FROM asked ASOF LEFT JOIN facts ON asked.place = facts.place AND asked.ts > facts.since""",
    text=("fact_id",),
)
def _(spark, sf):
    """Scores are known an hour after their event; a recommendation sees those from before it, not from its own moment."""
    events = table(spark, sf, "events").withColumn("place", F.col("user_id") % 7)
    asked = events.filter("event_id % 3 = 0").select("event_id", "place", "ts")
    facts = events.filter("event_id % 3 = 1").select(
        "event_id", "place", (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("since")
    )
    found = asof.known_then(asked, facts, ["place"], "ts", "since", tie=["event_id"], inclusive=False)
    return found.select("event_id", F.col("known.event_id").alias("fact_id"))
