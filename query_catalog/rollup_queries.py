"""Rollups: one query per aggregation of the inventory."""

from __future__ import annotations

from pyspark.sql import functions as F

from contextlake.functions.times import minute
from contextlake.operators import logs, quality, rollups, rules, sleep, tracks
from contextlake.plans import daily

from contextlake.session import work_dir

from .adapters import AS_OF, table, view
from .registry import half_up, query


@query(
    "a01_source_event_span",
    """SELECT source_name, event_type, count(*) AS events, min(event_time) AS min_event_time,
    max(event_time) AS max_event_time FROM v_medallion GROUP BY source_name, event_type""",
    ("v_medallion",),
)
def _(spark, sf):
    return rollups.grouped(
        view(spark, sf, "v_medallion"),
        ["source_name", "event_type"],
        rollups.rows("events"),
        F.min("event_time").alias("min_event_time"),
        F.max("event_time").alias("max_event_time"),
    )


@query(
    "a02_valid_by_privacy_class",
    """SELECT source_name, privacy_class, count(*) AS valid_events FROM v_medallion
    WHERE event_time IS NOT NULL AND source_name IS NOT NULL AND event_type IS NOT NULL
    GROUP BY source_name, privacy_class""",
    ("v_medallion",),
)
def _(spark, sf):
    from contextlake.plans.medallion import to_silver

    silver = to_silver(view(spark, sf, "v_medallion"))
    return rollups.grouped(silver, ["source_name", "privacy_class"], rollups.rows("valid_events"))


@query(
    "a03_decision_events",
    """SELECT event_type, count(*) AS decision_events FROM v_medallion
    WHERE source_name = 'daily_context_profile' OR event_type LIKE 'decision_%' GROUP BY event_type""",
    ("v_medallion",),
)
def _(spark, sf):
    from contextlake.plans.medallion import to_gold

    return rollups.grouped(to_gold(view(spark, sf, "v_medallion")), ["event_type"], rollups.rows("decision_events"))


@query(
    "a04_sleep_daily_from_json",
    """SELECT CAST(CAST(slept AS DATE) AS VARCHAR) AS sleep_date, count(*) AS nights,
    round(avg(minutes), 6) AS avg_duration_minutes, round(avg(quality), 6) AS avg_quality_score,
    round(avg(recovery), 6) AS avg_recovery_score,
    round(avg(CAST(minutes AS DOUBLE) / (minutes + 30)), 6) AS avg_sleep_efficiency
    FROM v_sleep GROUP BY 1""",
    ("v_sleep",),
)
def _(spark, sf):
    nights = view(spark, sf, "v_sleep").select(
        F.lit("sleep_quality").alias("source_name"),
        F.lit("sleep_quality_night").alias("event_type"),
        F.col("slept").alias("event_time"),
        F.to_json(
            F.struct(
                F.col("minutes").alias("duration_minutes"),
                F.col("quality").alias("quality_score"),
                F.col("recovery").alias("recovery_score"),
                (F.col("minutes") / (F.col("minutes") + 30)).alias("sleep_efficiency"),
            )
        ).alias("json_payload"),
    )
    daily_rows = sleep.sleep_daily(nights)
    averages = [c for c in daily_rows.columns if c.startswith("avg_")]
    return daily_rows.select("sleep_date", "nights", *[F.round(c, 6).alias(c) for c in averages])


@query(
    "a05_weather_daily",
    """SELECT location_id, CAST(CAST(forecast_time AS DATE) AS VARCHAR) AS forecast_date,
    count(*) AS hourly_rows, min(temperature_c) AS min_temperature_c, max(temperature_c) AS max_temperature_c,
    round(sum(precipitation_mm), 4) AS precipitation_mm, round(sum(rain_mm), 4) AS rain_mm,
    round(sum(snowfall_cm), 4) AS snowfall_cm, max(snow_depth_cm) AS max_snow_depth_cm,
    max(wind_gust_kmh) AS max_wind_gust_kmh, min(visibility_m) AS min_visibility_m,
    max(fetched_at) AS latest_fetch_at FROM v_weather GROUP BY 1, 2""",
    ("v_weather",),
)
def _(spark, sf):
    rolled = rollups.weather_daily(view(spark, sf, "v_weather"))
    sums = {c: F.round(c, 4) for c in ("precipitation_mm", "rain_mm", "snowfall_cm")}
    return rolled.withColumns(sums)


@query(
    "a06_activity_daily",
    f"""SELECT CAST(CAST(logged_at AS DATE) AS VARCHAR) AS activity_date, activity_type, count(*) AS sessions,
    {half_up('avg(intensity)', 2)} AS avg_intensity, {half_up('avg(mood)', 2)} AS avg_mood,
    {half_up('avg(fatigue)', 2)} AS avg_fatigue,
    count(*) FILTER (WHERE pain_flag) AS pain_sessions,
    count(*) FILTER (WHERE result = 'good') AS good_sessions,
    count(*) FILTER (WHERE result = 'skipped') AS skipped_sessions
    FROM v_activity GROUP BY 1, 2""",
    ("v_activity",),
)
def _(spark, sf):
    return rollups.activity_daily(view(spark, sf, "v_activity"))


@query(
    "a07_recommendation_daily",
    f"""SELECT CAST(CAST(generated_at AS DATE) AS VARCHAR) AS recommendation_date, recommendation_type, activity,
    decision, count(*) AS recommendations, {half_up('avg(score)', 2)} AS avg_score,
    max(generated_at) AS latest_generated_at FROM v_recs GROUP BY 1, 2, 3, 4""",
    ("v_recs",),
)
def _(spark, sf):
    return rollups.recommendation_daily(view(spark, sf, "v_recs"))


@query(
    "a07_recommendation_daily_unrounded",
    """SELECT CAST(CAST(generated_at AS DATE) AS VARCHAR) AS recommendation_date, recommendation_type, activity,
    decision, count(*) AS recommendations, round(avg(score), 6) AS avg_score,
    max(generated_at) AS latest_generated_at FROM v_recs GROUP BY 1, 2, 3, 4""",
    ("v_recs",),
)
def _(spark, sf):
    rolled = rollups.recommendation_daily(view(spark, sf, "v_recs"), digits=None)
    return rolled.withColumn("avg_score", F.round("avg_score", 6))


FEEDBACK_DAILY = f"""SELECT CAST(created_at AS DATE) AS feedback_date, activity, action,
    count(*) AS feedback_events, count(*) FILTER (WHERE action = 'followed') AS followed_events,
    count(*) FILTER (WHERE action = 'skipped') AS skipped_events, max(created_at) AS latest_feedback_at,
    {half_up("CAST(count(*) FILTER (WHERE action = 'followed') AS DOUBLE) / greatest(count(*), 1)", 3)} AS follow_rate
    FROM v_feedback GROUP BY 1, 2, 3"""


@query(
    "a08_feedback_daily",
    f"SELECT * REPLACE (CAST(feedback_date AS VARCHAR) AS feedback_date) FROM ({FEEDBACK_DAILY})",
    ("v_feedback",),
)
def _(spark, sf):
    return rollups.feedback_daily(view(spark, sf, "v_feedback"))


def weekly_sql(week: str, rate: str) -> str:
    return f"""SELECT CAST({week} AS VARCHAR) AS week_start,
    count(DISTINCT CASE WHEN followed_events > 0 THEN feedback_date END) AS useful_decision_days,
    CAST(sum(followed_events) AS BIGINT) AS total_followed_events,
    CAST(sum(skipped_events) AS BIGINT) AS total_skipped_events,
    {rate} AS follow_rate FROM ({FEEDBACK_DAILY}) GROUP BY 1"""


RATE = "CAST(sum(followed_events) AS DOUBLE) / greatest(sum(feedback_events), 1)"


@query(
    "a09_useful_decision_days",
    weekly_sql("CAST(feedback_date - CAST(dayofweek(feedback_date) AS INT) AS DATE)", half_up(RATE, 3)),
    ("v_feedback",),
)
def useful_days(spark, sf):
    """Flagship: days of each week on which advice was followed."""
    return rollups.useful_decision_days(rollups.feedback_daily(view(spark, sf, "v_feedback")))


@query(
    "a09_useful_decision_days_monday",
    weekly_sql(
        "CAST(date_trunc('week', feedback_date) AS DATE)",
        "round(CAST(sum(followed_events) AS DOUBLE) / nullif(sum(feedback_events), 0), 6)",
    ),
    ("v_feedback",),
)
def _(spark, sf):
    weekly = rollups.useful_decision_days(
        rollups.feedback_daily(view(spark, sf, "v_feedback")), "monday", digits=None
    )
    return weekly.withColumn("follow_rate", F.round("follow_rate", 6))


@query(
    "a10_signal_daily",
    f"""SELECT CAST(CAST(occurred_at AS DATE) AS VARCHAR) AS signal_date, domain, source, direction,
    count(*) AS signals, CAST(max(urgency) AS BIGINT) AS max_urgency,
    {half_up('avg(confidence)', 2)} AS avg_confidence, max(ingested_at) AS latest_ingested_at
    FROM v_signals GROUP BY 1, 2, 3, 4""",
    ("v_signals",),
)
def _(spark, sf):
    return rollups.signal_daily(view(spark, sf, "v_signals"))


@query(
    "a10_signal_daily_deduplicated",
    f"""WITH newest AS (SELECT * FROM v_signals QUALIFY row_number() OVER (
        PARTITION BY signal_id ORDER BY ingested_at DESC, event_id DESC) = 1)
    SELECT CAST(CAST(occurred_at AS DATE) AS VARCHAR) AS signal_date, domain, source, direction,
    count(*) AS signals, CAST(max(urgency) AS BIGINT) AS max_urgency,
    {half_up('avg(confidence)', 2)} AS avg_confidence, max(ingested_at) AS latest_ingested_at
    FROM newest GROUP BY 1, 2, 3, 4""",
    ("v_signals",),
)
def _(spark, sf):
    from contextlake.operators.latest import keep_latest

    newest = keep_latest(view(spark, sf, "v_signals"), ["signal_id"], ["ingested_at", "event_id"])
    return rollups.signal_daily(newest)


PROFILE_SQL = f"""SELECT {{keys}} activity, count(*) AS feedback_events,
    count(*) FILTER (WHERE action = 'followed') AS followed_events,
    count(*) FILTER (WHERE action = 'skipped') AS skipped_events,
    count(*) FILTER (WHERE result = 'good') AS good_results,
    count(*) FILTER (WHERE result = 'bad') AS bad_results,
    max(created_at) AS latest_feedback_at,
    {half_up("CAST(count(*) FILTER (WHERE action = 'followed') AS DOUBLE) / greatest(count(*), 1)", 3)} AS follow_rate
    FROM v_feedback WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL {{days}} DAY GROUP BY ALL"""


@query("a11_feedback_profile", PROFILE_SQL.format(keys="", days=30), ("v_feedback",))
def _(spark, sf):
    return rollups.feedback_profile(view(spark, sf, "v_feedback"), 30, AS_OF)


@query("a11_feedback_profile_per_user", PROFILE_SQL.format(keys="user_id,", days=10), ("v_feedback",))
def _(spark, sf):
    return rollups.feedback_profile(view(spark, sf, "v_feedback"), 10, AS_OF, user_col="user_id")


WEEK_SQL = f"""WITH recent AS (SELECT * FROM v_activity WHERE logged_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY),
    acts AS (SELECT user_id, string_agg(activity_type || ' ' || n, ', ' ORDER BY n DESC, activity_type) AS by_activity
        FROM (SELECT user_id, activity_type, count(*) AS n FROM recent GROUP BY 1, 2) GROUP BY 1),
    results AS (SELECT user_id, string_agg(result || ' ' || n, ', ' ORDER BY n DESC, result) AS by_result
        FROM (SELECT user_id, result, count(*) AS n FROM recent GROUP BY 1, 2) GROUP BY 1),
    totals AS (SELECT user_id, count(*) AS sessions, {half_up('avg(intensity)', 1)} AS avg_intensity,
        {half_up('avg(mood)', 1)} AS avg_mood, {half_up('avg(fatigue)', 1)} AS avg_fatigue,
        count(*) FILTER (WHERE pain_flag) AS pain_sessions, max(logged_at) AS latest_logged_at
        FROM recent GROUP BY 1)
    SELECT * FROM totals JOIN acts USING (user_id) JOIN results USING (user_id)"""


@query("a12_week_summary", WEEK_SQL, ("v_activity",))
def _(spark, sf):
    week = rollups.week_summary(view(spark, sf, "v_activity"), "user_id", AS_OF)
    pair = lambda label: lambda x: F.format_string("%s %d", x[label], x["sessions"])
    return week.withColumns(
        {
            "by_activity": F.concat_ws(", ", F.transform("by_activity", pair("activity_type"))),
            "by_result": F.concat_ws(", ", F.transform("by_result", pair("result"))),
        }
    )


def metrics_sql(keys: str) -> str:
    n = "count(*) FILTER (WHERE action = 'followed')"
    d = "nullif(count(*) FILTER (WHERE action IN ('followed', 'skipped')), 0)"
    return f"""SELECT {keys} count(DISTINCT CAST(created_at AS DATE)) FILTER (WHERE action = 'followed') AS useful_decision_days,
    {n} AS followed_events, count(*) FILTER (WHERE action = 'skipped') AS skipped_events,
    max(created_at) AS updated_at, coalesce({half_up(f'CAST({n} AS DOUBLE) / {d}', 3)}, 0) AS follow_rate
    FROM v_feedback WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY {'GROUP BY user_id' if keys else ''}"""


@query("a13_decision_metrics", metrics_sql(""), ("v_feedback",))
def _(spark, sf):
    return rollups.decision_metrics(view(spark, sf, "v_feedback"), 7, AS_OF)


@query("a13_decision_metrics_per_user", metrics_sql("user_id,"), ("v_feedback",))
def _(spark, sf):
    return rollups.decision_metrics(view(spark, sf, "v_feedback"), 7, AS_OF, "user_id")


@query(
    "a14_score_ranges",
    """SELECT activity, decision, count(*) AS score_rows, CAST(min(score) AS BIGINT) AS min_score,
    CAST(max(score) AS BIGINT) AS max_score, max(computed_at) AS latest_computed_at
    FROM v_scores GROUP BY activity, decision""",
    ("v_scores",),
)
def _(spark, sf):
    return rollups.grouped(
        view(spark, sf, "v_scores"),
        ["activity", "decision"],
        rollups.rows("score_rows"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.max("computed_at").alias("latest_computed_at"),
    )


@query(
    "a14_recommendation_ranges",
    """SELECT recommendation_type, activity, decision, count(*) AS recommendations,
    CAST(min(score) AS BIGINT) AS min_score, CAST(max(score) AS BIGINT) AS max_score,
    max(generated_at) AS latest_generated_at FROM v_recs GROUP BY 1, 2, 3""",
    ("v_recs",),
)
def _(spark, sf):
    return rollups.grouped(
        view(spark, sf, "v_recs"),
        ["recommendation_type", "activity", "decision"],
        rollups.rows("recommendations"),
        F.min("score").alias("min_score"),
        F.max("score").alias("max_score"),
        F.max("generated_at").alias("latest_generated_at"),
    )


MINUTES = """SELECT date_trunc('minute', event_time) AS minute, count(*) AS orders,
    CAST(sum(amount) AS DOUBLE) AS gross_sales, count(DISTINCT user_id) AS active_customers FROM v_sales"""


@query("a15_sales_per_minute", f"{MINUTES} GROUP BY 1", ("v_sales",))
def _(spark, sf):
    return rollups.per_minute_sales(view(spark, sf, "v_sales"), "event_time", "amount", "user_id", window=None)


@query(
    "a15_sales_last_hour",
    f"""{MINUTES} WHERE event_time >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 1 HOUR
    GROUP BY 1 ORDER BY 1 DESC LIMIT 60""",
    ("v_sales",),
)
def _(spark, sf):
    recent = rollups.per_minute_sales(
        view(spark, sf, "v_sales"), "event_time", "amount", "user_id", "2024-01-30 12:00:00", "1 hour"
    )
    return recent.orderBy(F.col("minute").desc()).limit(60)


@query(
    "a16_net_stock_movement",
    """SELECT product_id, CAST(sum(quantity_delta) AS BIGINT) AS net_inventory_delta, count(*) AS inventory_events
    FROM v_stock_changes GROUP BY product_id HAVING abs(sum(quantity_delta)) > 25""",
    ("v_stock_changes",),
)
def _(spark, sf):
    return rollups.net_movement(view(spark, sf, "v_stock_changes"), "product_id", "quantity_delta", 25, None)


@query(
    "a16_top_stock_movement",
    """SELECT product_id, CAST(sum(quantity_delta) AS BIGINT) AS net_inventory_delta, count(*) AS inventory_events
    FROM v_stock_changes GROUP BY product_id HAVING abs(sum(quantity_delta)) > 25
    ORDER BY abs(sum(quantity_delta)) DESC, product_id LIMIT 50""",
    ("v_stock_changes",),
)
def _(spark, sf):
    return rollups.net_movement(view(spark, sf, "v_stock_changes"), "product_id", "quantity_delta", 25, 50)


COUNTED = ("customer", "part", "nation", "supplier", "lineitem", "orders", "events", "documents")


@query(
    "a17_table_counts",
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in COUNTED),
)
def _(spark, sf):
    return rollups.table_counts({t: table(spark, sf, t) for t in COUNTED})


KEYS = {"customer.c_custkey": ("customer", "c_custkey"), "part.p_partkey": ("part", "p_partkey"),
        "lineitem.l_orderkey": ("lineitem", "l_orderkey"), "documents.text": ("documents", "text")}


@query(
    "a18_duplicate_keys",
    " UNION ALL ".join(
        f"SELECT '{name}' AS key_name, count(*) - count(DISTINCT {c}) AS duplicate_count FROM {t}"
        for name, (t, c) in KEYS.items()
    ),
)
def _(spark, sf):
    parts = [quality.duplicate_count(table(spark, sf, t), c, name) for name, (t, c) in KEYS.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


@query(
    "a19_stock_sanity",
    """SELECT count(*) FILTER (WHERE qty < 0) AS negative_warehouse_qty,
    count(*) FILTER (WHERE reserved_qty < 0) AS negative_reserved_qty,
    count(*) FILTER (WHERE reserved_qty > qty) AS reserved_above_qty,
    count(*) FILTER (WHERE reserved_qty = qty) AS fully_reserved FROM v_stock""",
    ("v_stock",),
)
def _(spark, sf):
    return view(spark, sf, "v_stock").agg(
        rollups.rows_if(F.col("qty") < 0, "negative_warehouse_qty"),
        rollups.rows_if(F.col("reserved_qty") < 0, "negative_reserved_qty"),
        rollups.rows_if(F.col("reserved_qty") > F.col("qty"), "reserved_above_qty"),
        rollups.rows_if(F.col("reserved_qty") == F.col("qty"), "fully_reserved"),
    )


@query("a20_ingest_profile")
def _(spark, sf):
    return rollups.ingest_profile(
        view(spark, sf, "v_bronze"), "event_source", "event_time", "ingested_at", "record_key"
    )


@query(
    "a20_ingest_profile_error_bound",
    """SELECT event_source, count(*) AS rows_loaded, count(*) FILTER (WHERE event_time IS NULL) AS missing_event_ts,
    count(*) FILTER (WHERE ingested_at IS NULL) AS missing_ingested_at, true AS within_five_percent FROM v_bronze GROUP BY 1""",
    ("v_bronze",),
)
def _(spark, sf):
    """The approximate key count next to the exact one."""
    bronze = view(spark, sf, "v_bronze")
    exact = bronze.groupBy("event_source").agg(F.countDistinct("record_key").alias("exact_keys"))
    profile = rollups.ingest_profile(bronze, "event_source", "event_time", "ingested_at", "record_key")
    error = F.abs(F.col("approx_keys") - F.col("exact_keys")) / F.col("exact_keys")
    return (
        profile.join(exact, "event_source")
        .withColumn("within_five_percent", error <= 0.05)
        .drop("approx_keys", "exact_keys")
    )


@query(
    "a21_rows_per_ingest_minute",
    """SELECT event_source, date_trunc('minute', ingested_at) AS ingest_minute, count(*) AS rows_loaded
    FROM v_bronze GROUP BY 1, 2""",
    ("v_bronze",),
)
def _(spark, sf):
    bronze = view(spark, sf, "v_bronze")
    return rollups.grouped(
        bronze.withColumn("ingest_minute", minute("ingested_at")),
        ["event_source", "ingest_minute"],
        rollups.rows("rows_loaded"),
    )


@query(
    "a22_duplicate_groups",
    """SELECT source, count(*) AS duplicate_records FROM (
        SELECT source, lang, text FROM documents GROUP BY source, lang, text HAVING count(*) > 1) GROUP BY source""",
)
def _(spark, sf):
    return rollups.duplicate_groups(table(spark, sf, "documents"), ["source", "lang", "text"], "source")


@query(
    "a23_rows_per_source_day",
    """SELECT event_source, CAST(CAST(event_time AS DATE) AS VARCHAR) AS date, count(*) AS "count"
    FROM v_bronze GROUP BY 1, 2""",
    ("v_bronze",),
)
def _(spark, sf):
    return rollups.daily_rollup(
        view(spark, sf, "v_bronze"), "event_time", ["event_source"], [rollups.rows("count")], "date"
    )


@query(
    "a24_segment_values",
    f"""SELECT segment, count(*) AS customer_count, {half_up('CAST(sum(lifetime_value) AS DOUBLE) / count(*)', 4)} AS avg_lifetime_value,
    CAST(max(lifetime_value) AS DOUBLE) AS max_lifetime_value FROM v_segments GROUP BY segment""",
    ("v_segments",),
)
def _(spark, sf):
    return rollups.grouped(
        view(spark, sf, "v_segments"),
        ["segment"],
        rollups.rows("customer_count"),
        F.round(F.avg(F.col("lifetime_value").cast("decimal(20,10)")), 4).alias("avg_lifetime_value"),
        F.max("lifetime_value").alias("max_lifetime_value"),
    )


@query(
    "a24_monthly_orders",
    f"""SELECT CAST(year(order_date) AS BIGINT) AS year, CAST(month(order_date) AS BIGINT) AS month, count(*) AS order_count,
    CAST(sum(total_amount) AS DOUBLE) AS total_revenue,
    {half_up('CAST(sum(total_amount) AS DOUBLE) / count(*)', 4)} AS avg_order_value FROM v_orders GROUP BY 1, 2""",
    ("v_orders",),
)
def _(spark, sf):
    return (
        view(spark, sf, "v_orders")
        .groupBy(F.year("order_date").alias("year"), F.month("order_date").alias("month"))
        .agg(
            rollups.rows("order_count"),
            F.sum("total_amount").alias("total_revenue"),
            F.round(F.avg(F.col("total_amount").cast("decimal(20,10)")), 4).alias("avg_order_value"),
        )
    )


FAILED = "lower(status) IN ('error', 'failed', 'failure', 'skipped')"


@query(
    "a25_run_health",
    f"""WITH named AS (SELECT component AS source_name, * FROM v_logs UNION ALL SELECT 'runtime' AS source_name, * FROM v_logs),
    last_failure AS (SELECT source_name, coalesce(nullif(message, ''), action) AS m FROM named WHERE {FAILED}
        QUALIFY row_number() OVER (PARTITION BY source_name ORDER BY ts DESC, event_id DESC) = 1),
    counts AS (SELECT source_name, string_agg(status || '=' || n, ',' ORDER BY status) AS status_counts
        FROM (SELECT source_name, status, count(*) AS n FROM named GROUP BY 1, 2) GROUP BY 1),
    folded AS (SELECT source_name, count(*) AS row_count, count(*) FILTER (WHERE {FAILED}) AS error_count,
        max(ts) AS latest_event_time FROM named GROUP BY 1)
    SELECT source_name, CASE WHEN error_count > 0 THEN 'failed' ELSE 'ok' END AS status,
    CASE WHEN error_count > 0 THEN 'has_failures' ELSE 'fresh' END AS quality_state,
    CAST(floor(greatest(date_diff('microsecond', latest_event_time, TIMESTAMP '{AS_OF}'), 0) / 60000000) AS BIGINT) AS freshness_minutes,
    row_count, error_count, latest_event_time, status_counts,
    CASE WHEN m IS NULL THEN '' WHEN m LIKE 'token=%' THEN 'credential=[redacted] rejected'
        WHEN m LIKE 'chat id%' THEN 'chat identifier missing' ELSE m END AS last_error
    FROM folded JOIN counts USING (source_name) LEFT JOIN last_failure USING (source_name)""",
    ("v_logs",),
)
def _(spark, sf):
    health = logs.run_health(view(spark, sf, "v_logs"), AS_OF, order=["event_id"])
    pairs = F.transform(
        F.array_sort(F.map_entries("status_counts")),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return health.withColumn("status_counts", F.concat_ws(",", pairs)).drop("observed_at")


@query(
    "a26_log_summary",
    """SELECT section, name, events, latest_event_time FROM (
    SELECT 'total' AS section, 'events' AS name, count(*) AS events, max(ts) AS latest_event_time FROM v_logs UNION ALL
    SELECT 'status', status, count(*), max(ts) FROM v_logs GROUP BY status UNION ALL
    SELECT 'component', component, count(*), max(ts) FROM v_logs GROUP BY component)""",
    ("v_logs",),
)
def _(spark, sf):
    rows = view(spark, sf, "v_logs").drop("event_time").withColumnRenamed("ts", "event_time")
    return logs.log_summary(rows)


@query(
    "a27_sleep_summary",
    f"""WITH last AS (SELECT * FROM v_sleep QUALIFY row_number() OVER (
        PARTITION BY user_id ORDER BY slept + minutes * INTERVAL 1 MINUTE DESC, minutes DESC, quality DESC) = 1)
    SELECT s.user_id, count(*) AS nights, CAST(any_value(l.minutes) AS BIGINT) AS latest_duration_minutes,
    CAST(any_value(l.quality) AS BIGINT) AS latest_quality_score,
    CAST(any_value(l.recovery) AS BIGINT) AS latest_recovery_score,
    {half_up('avg(s.minutes)', 1)} AS avg_duration_minutes, {half_up('avg(s.quality)', 1)} AS avg_quality_score,
    {half_up('avg(s.recovery)', 1)} AS avg_recovery_score,
    {half_up('CAST(sum(CAST(round(CAST(s.minutes AS DOUBLE) / (s.minutes + 30) + 1e-12, 3) AS DECIMAL(9,3))) AS DOUBLE) / count(*)', 3)} AS avg_sleep_efficiency
    FROM v_sleep s JOIN last l USING (user_id) GROUP BY 1""",
    ("v_sleep",),
)
def _(spark, sf):
    valid, _rejected = sleep.normalize_sleep(sleep_rows(spark, sf), keep=("user_id",))
    return sleep.sleep_summary(valid).drop("latest_woke_at")


def sleep_rows(spark, sf):
    """Nights as text columns, the shape of an export."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    rows = view(spark, sf, "v_sleep")
    woke = F.col("slept").cast("timestamp") + F.make_dt_interval(mins=F.col("minutes"))
    return rows.select(
        "event_id",
        "user_id",
        F.date_format("slept", iso).alias("slept_at"),
        F.date_format(woke, iso).alias("woke_at"),
        (F.col("minutes") + 30).cast("string").alias("in_bed_minutes"),
        F.col("quality").cast("string").alias("quality_score"),
        F.col("recovery").cast("string").alias("recovery_score"),
        F.lit("").alias("source"),
    )


KM = (
    "6371.0088 * 2 * atan2(sqrt(h), sqrt(1 - h))"
)


@query(
    "a28_route_summary",
    f"""WITH pts AS (SELECT user_id AS track_id, event_id AS idx, CAST(event_id % 900 AS DOUBLE) / 10 - 45 AS lat,
        CAST((event_id * 7 + user_id) % 1800 AS DOUBLE) / 10 - 90 AS lon, CAST(value AS DECIMAL(12,2)) AS ele, ts AS t FROM events),
    pairs AS (SELECT *, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon, lag(ele) OVER w AS pele FROM pts
        WINDOW w AS (PARTITION BY track_id ORDER BY idx)),
    hav AS (SELECT *, pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2) AS h FROM pairs)
    SELECT track_id, round(coalesce(sum({KM}), 0), 3) AS distance_km,
    {half_up('CAST(coalesce(sum(greatest(ele - pele, 0)), 0) AS DOUBLE)', 1)} AS elevation_gain_m, count(*) AS point_count,
    {half_up("floor(date_diff('microsecond', arg_min(t, idx), arg_max(t, idx)) / 1000000) / 60.0", 2)} AS duration_minutes
    FROM hav GROUP BY 1""",
)
def _(spark, sf):
    """One track per user, points in event order; chunks are kept small to exercise the borders."""
    key = F.col("event_id")
    degrees = lambda c, m, half: (c % m).cast("double") / 10 - half
    points = table(spark, sf, "events").select(
        F.col("user_id").alias("track_id"),
        key.alias("idx"),
        degrees(key, 900, 45).alias("lat"),
        degrees(key * 7 + F.col("user_id"), 1800, 90).alias("lon"),
        F.col("value").alias("ele"),
        F.col("ts").cast("string").alias("time"),
    )
    return tracks.route_summary(points, chunk_points=500).drop("started_at", "ended_at")


@query(
    "a29_weather_window_measures",
    """WITH ranked AS (SELECT *, row_number() OVER (PARTITION BY location_id ORDER BY is_day DESC, forecast_time) AS rn,
        bool_or(is_day) OVER (PARTITION BY location_id) AS any_day FROM v_weather),
    w AS (SELECT * FROM ranked WHERE rn <= 8 AND is_day = any_day)
    SELECT location_id, round(sum(rain_mm + precipitation_mm), 6) AS wet_mm, round(sum(precipitation_mm), 6) AS precipitation_mm,
    round(sum(rain_mm), 6) AS rain_mm, max(wind_gust_kmh) AS max_gust, min(temperature_c) AS min_temp,
    max(temperature_c) AS max_temp, max(snow_depth_cm) AS max_depth, round(sum(snowfall_cm), 6) AS snowfall_cm,
    min(visibility_m) AS min_visibility FROM w GROUP BY location_id""",
    ("v_weather",),
)
def _(spark, sf):
    measures = rules.window_measures(rules.daylight_window(view(spark, sf, "v_weather")))
    sums = ("wet_mm", "precipitation_mm", "rain_mm", "snowfall_cm")
    return measures.withColumns({c: F.round(c, 6) for c in sums})


@query(
    "a30_sessions_this_week",
    """SELECT activity_type, count(*) AS sessions FROM v_activity
    WHERE CAST(logged_at AS DATE) >= DATE '2024-01-28' GROUP BY activity_type""",
    ("v_activity",),
)
def _(spark, sf):
    from contextlake.functions.times import week_start

    daily_rows = rollups.activity_daily(view(spark, sf, "v_activity"))
    this_week = week_start(F.lit("2024-01-31").cast("date"), "sunday")
    return (
        daily_rows.filter(F.col("activity_date") >= this_week)
        .groupBy("activity_type")
        .agg(F.sum("sessions").alias("sessions"))
    )


@query(
    "a31_kpis",
    f"""WITH weekly AS ({weekly_sql("CAST(feedback_date - CAST(dayofweek(feedback_date) AS INT) AS DATE)", half_up(RATE, 3))}),
    latest AS (SELECT * FROM v_profiles QUALIFY row_number() OVER (PARTITION BY profile_date, timezone ORDER BY generated_at DESC, profile_id DESC) = 1),
    done AS (SELECT user_id, activity_type AS activity, count(*) AS n FROM v_activity
        WHERE logged_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1, 2),
    goals AS (SELECT coalesce(n, 0) AS done, target FROM (SELECT DISTINCT user_id FROM v_activity)
        CROSS JOIN (VALUES ('skate', 2), ('volleyball', 1), ('moto_lesson', 1), ('gym', 1), ('walk', 2)) g(activity, target)
        LEFT JOIN done USING (user_id, activity))
    SELECT 'Best action' AS metric, top_activity || ' ' || top_score AS value FROM (SELECT * FROM latest ORDER BY profile_date DESC, top_score DESC, top_activity DESC LIMIT 1)
    UNION ALL SELECT 'Useful decision days', CAST(arg_max(useful_decision_days, week_start) AS VARCHAR) FROM weekly
    UNION ALL SELECT 'Follow rate', CAST(arg_max(follow_rate, week_start) AS VARCHAR) FROM weekly
    UNION ALL SELECT 'Recommendations', CAST(count(*) AS VARCHAR) FROM v_recs
    UNION ALL SELECT 'Context signals', CAST(count(*) AS VARCHAR) FROM v_signals
    UNION ALL SELECT 'Source health', CAST(count(*) AS VARCHAR) FROM (SELECT component FROM v_logs WHERE {FAILED} GROUP BY 1 UNION ALL SELECT 'runtime' WHERE EXISTS (SELECT 1 FROM v_logs WHERE {FAILED}))
    UNION ALL SELECT 'Goals covered', CAST(count(*) FILTER (WHERE done >= target) AS VARCHAR) FROM goals
    UNION ALL SELECT 'Goals total', CAST(count(*) AS VARCHAR) FROM goals""",
    ("v_feedback", "v_profiles", "v_activity", "v_recs", "v_signals", "v_logs"),
)
def _(spark, sf):
    from contextlake.operators.latest import keep_latest

    activity = view(spark, sf, "v_activity")
    return daily.kpis(
        keep_latest(view(spark, sf, "v_profiles"), ["profile_date", "timezone"], ["generated_at", "profile_id"]),
        useful_days(spark, sf),
        rollups.recommendation_daily(view(spark, sf, "v_recs")),
        rollups.signal_daily(view(spark, sf, "v_signals")),
        logs.run_health(view(spark, sf, "v_logs"), AS_OF, order=["event_id"]),
        rules.goal_progress(activity, rollups.weekly_counts(activity, "user_id", AS_OF)),
    )


@query(
    "a20_sketches_of_any_span",
    """WITH spans AS (
        SELECT event_source, 'hour' AS span, date_trunc('hour', ingested_at) AS start, record_key FROM v_bronze WHERE ingested_at IS NOT NULL
        UNION ALL SELECT event_source, 'day', date_trunc('day', ingested_at), record_key FROM v_bronze WHERE ingested_at IS NOT NULL
        UNION ALL SELECT event_source, 'month', date_trunc('month', ingested_at), record_key FROM v_bronze WHERE ingested_at IS NOT NULL)
    SELECT event_source, span, start, count(*) AS rows, count(DISTINCT record_key) AS exact_keys, true AS within_bound FROM spans GROUP BY ALL""",
    ("v_bronze",),
)
def _(spark, sf):
    """Stored minute sketches united to hours, days and months, next to exact counts; the bound is four standard errors."""
    bronze = view(spark, sf, "v_bronze").filter("ingested_at IS NOT NULL")
    path = work_dir(spark, "a20-sketches")
    rollups.minute_sketches(bronze, "event_source", "ingested_at", "record_key").write.parquet(path)
    minutes = spark.read.parquet(path)
    result = None
    for span in ("hour", "day", "month"):
        start = F.date_trunc(span, "minute").alias("start")
        united = rollups.sketched_keys(rollups.merge_sketches(minutes, ["event_source", start]))
        exact = bronze.groupBy("event_source", F.date_trunc(span, "ingested_at").alias("start")).agg(
            F.count_distinct("record_key").alias("exact_keys")
        )
        bound = F.greatest(F.lit(1.0), 4 * rollups.SKETCH_ERROR * F.col("exact_keys"))
        part = united.join(exact, ["event_source", "start"]).select(
            "event_source", F.lit(span).alias("span"), "start", "rows", "exact_keys",
            (F.abs(F.col("approx_keys") - F.col("exact_keys")) <= bound).alias("within_bound"),
        )
        result = part if result is None else result.unionByName(part)
    return result
