"""Data-quality queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contextlake.operators import quality, rollups, suite_state
from contextlake.schemas import READINESS_DECISIONS, SIGNAL_DOMAINS
from contextlake.session import config_frame, work_dir

from .adapters import AS_OF, table, view
from .registry import query

SUITE_TABLES = {
    "spots": "v_spots",
    "activity": "v_activity",
    "weather": "v_weather",
    "scores": "v_scores",
    "recommendations": "v_recs",
    "feedback": "v_feedback",
    "signals": "v_signals",
    "profiles": "v_profiles",
}


def bad(dataset: str, check: str, condition: str) -> str:
    return (
        f"SELECT '{check}' AS id, '{dataset}' AS dataset, 'error' AS severity, "
        f"CAST(count(*) FILTER (WHERE {condition}) AS DOUBLE) AS observed, count(*) FILTER (WHERE {condition}) = 0 AS passed FROM {SUITE_TABLES[dataset]}"
    )


def some(dataset: str, check: str, op: str) -> str:
    return (
        f"SELECT '{check}', '{dataset}', 'error', CAST(count(*) AS DOUBLE), count(*) {op} 0 FROM {SUITE_TABLES[dataset]}"
    )


def fresh(dataset: str, check: str, c: str) -> str:
    age = f"floor(date_diff('microsecond', max({c}), TIMESTAMP '{AS_OF}') / 1000000) / 60.0"
    return (
        f"SELECT '{check}', '{dataset}', 'warning', CAST({age} AS DOUBLE), {age} <= 360 FROM {SUITE_TABLES[dataset]}"
    )


BAD_COORDINATES = "latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180"
BAD_FEEDBACK = "action NOT IN ('followed', 'skipped', 'changed') OR (result IS NOT NULL AND result NOT IN ('good', 'ok', 'bad', 'skipped'))"
SUITE_SQL = " UNION ALL ".join(
    [
        bad("spots", "spots_have_valid_coordinates", BAD_COORDINATES),
        some("spots", "spots_have_rows", ">"),
        bad("spots", "spots_have_labels", "label IS NULL OR trim(label) = ''"),
        bad("activity", "diary_scores_in_range", "intensity NOT BETWEEN 1 AND 10 OR mood NOT BETWEEN 1 AND 10 OR fatigue NOT BETWEEN 1 AND 10"),
        bad("activity", "diary_known_types", "activity_type NOT IN ('skate', 'snowboard', 'volleyball', 'moto_lesson', 'gym', 'walk', 'rest')"),
        bad("activity", "diary_known_results", "result NOT IN ('good', 'ok', 'bad', 'skipped')"),
        some("weather", "weather_has_rows", ">"),
        fresh("weather", "weather_has_recent_fetch", "fetched_at"),
        bad("weather", "weather_values_are_reasonable", "temperature_c NOT BETWEEN -60 AND 45 OR precipitation_mm < 0 OR wind_speed_kmh < 0 OR wind_gust_kmh < 0"),
        some("scores", "readiness_has_rows", ">"),
        fresh("scores", "readiness_has_recent_compute", "computed_at"),
        bad("scores", "readiness_scores_are_valid", "score NOT BETWEEN 0 AND 100 OR decision NOT IN ('go', 'caution', 'skip') OR explanation = ''"),
        some("recommendations", "recommendations_have_rows", ">"),
        fresh("recommendations", "recommendations_have_recent_compute", "generated_at"),
        bad("recommendations", "recommendations_are_valid", "score NOT BETWEEN 0 AND 100 OR decision NOT IN ('go', 'caution', 'recover') OR reasons IS NULL OR trim(reasons) = ''"),
        some("feedback", "feedback_rows", ">="),
        bad("feedback", "feedback_actions_are_valid", BAD_FEEDBACK),
        some("signals", "signal_rows", ">="),
        bad("signals", "context_signals_are_valid", "domain NOT IN ('market', 'github', 'career', 'wellbeing', 'system') OR direction NOT IN ('positive', 'negative', 'neutral') OR urgency NOT BETWEEN 1 AND 10 OR confidence NOT BETWEEN 1 AND 100 OR trim(title) = ''"),
        some("profiles", "profiles_have_rows", ">"),
        bad("profiles", "profiles_are_valid", "top_score NOT BETWEEN 0 AND 100 OR top_decision NOT IN ('go', 'caution', 'recover') OR sessions_7d < 0 OR avg_mood_7d NOT BETWEEN 0 AND 10 OR avg_fatigue_7d NOT BETWEEN 0 AND 10 OR useful_decision_days_7d NOT BETWEEN 0 AND 7 OR follow_rate_7d NOT BETWEEN 0 AND 1 OR highest_signal_urgency NOT BETWEEN 0 AND 10 OR trim(context_summary) = ''"),
    ]
)
SUITE_VIEWS = tuple(SUITE_TABLES.values())


def suite_frames(spark, sf):
    return {name: view(spark, sf, v) for name, v in SUITE_TABLES.items()}


@query("q01_expectation_suite", f"SELECT id, dataset, severity, round(observed, 4) AS observed, passed FROM ({SUITE_SQL})", SUITE_VIEWS)
def _(spark, sf):
    results = quality.run_expectations(suite_frames(spark, sf), quality.core_suite(), AS_OF)
    return results.withColumn("observed", F.round("observed", 4))


@query(
    "q02_failed_checks",
    f"SELECT dataset, count(*) AS checks, count(*) FILTER (WHERE NOT passed) AS failed FROM ({SUITE_SQL}) GROUP BY dataset",
    SUITE_VIEWS,
)
def _(spark, sf):
    results = quality.run_expectations(suite_frames(spark, sf), quality.core_suite(), AS_OF)
    return results.groupBy("dataset").agg(rollups.rows("checks"), rollups.rows_if(~F.col("passed"), "failed"))


@query(
    "q03_violation_counters",
    f"""SELECT 'spots_missing_labels' AS check_name, CAST(count(*) FILTER (WHERE label IS NULL OR trim(label) = '') AS VARCHAR) AS observed_value FROM v_spots
    UNION ALL SELECT 'spots_bad_coordinates', CAST(count(*) FILTER (WHERE {BAD_COORDINATES}) AS VARCHAR) FROM v_spots
    UNION ALL SELECT 'feedback_bad_actions', CAST(count(*) FILTER (WHERE {BAD_FEEDBACK}) AS VARCHAR) FROM v_feedback""",
    ("v_spots", "v_feedback"),
)
def _(spark, sf):
    spots = quality.violation_counters(
        view(spark, sf, "v_spots"),
        {
            "spots_missing_labels": [F.col("label").isNull(), quality.blank("label")],
            "spots_bad_coordinates": quality.bad_coordinates(),
        },
    )
    feedback = quality.violation_counters(view(spark, sf, "v_feedback"), {"feedback_bad_actions": quality.bad_feedback()})
    return spots.unionByName(feedback)


@query(
    "q04_freshness",
    f"""SELECT max(ts) AS latest_at, round(floor(date_diff('microsecond', max(ts), TIMESTAMP '{AS_OF}') / 1000000) / 60.0, 4) AS age_minutes,
    CASE WHEN date_diff('second', max(ts), TIMESTAMP '{AS_OF}') / 60.0 > 360 THEN 'error' ELSE 'ok' END AS status FROM events""",
)
def _(spark, sf):
    result = quality.freshness(table(spark, sf, "events"), "ts", 360, as_of=AS_OF)
    return result.withColumn("age_minutes", F.round("age_minutes", 4))


@query(
    "q05_quarantine",
    """SELECT coalesce(reason, 'ok') AS outcome, count(*) AS n FROM (SELECT CASE WHEN l_quantity > 45 THEN 'quantity too large'
        WHEN l_discount > 0.08 THEN 'discount too large' END AS reason FROM lineitem) GROUP BY 1""",
)
def _(spark, sf):
    rules = {"quantity too large": F.col("l_quantity") > 45, "discount too large": F.col("l_discount") > 0.08}
    valid, rejected = quality.split_valid(table(spark, sf, "lineitem"), rules)
    good = valid.agg(rollups.rows("n")).select(F.lit("ok").alias("outcome"), "n")
    return good.unionByName(rejected.groupBy(F.col("reject_reason").alias("outcome")).agg(rollups.rows("n")))


@query(
    "q06_registry_rules",
    """SELECT rule, count(*) AS sources FROM (
    SELECT 'unknown privacy_class' AS rule FROM customer WHERE c_custkey % 5 = 0
    UNION ALL SELECT 'pii without commit_policy' FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0
    UNION ALL SELECT 'landing_path must include source name' FROM customer WHERE c_custkey % 7 = 0
    UNION ALL SELECT 'silver_table outside silver' FROM customer WHERE c_custkey % 11 = 0
    UNION ALL SELECT 'event_time_field must be required' FROM customer WHERE c_custkey % 13 = 0
    UNION ALL SELECT 'idempotency_key must be listed' FROM customer WHERE c_custkey % 17 = 0
    UNION ALL SELECT 'missing producer' FROM customer WHERE c_custkey % 19 = 0) GROUP BY rule""",
)
def _(spark, sf):
    """A registry with one source per customer and planted defects."""
    return broken_registry(spark, sf).groupBy("rule").agg(rollups.rows("sources"))


@query(
    "q06_registry_rules_by_source",
    """SELECT 'src_' || c_custkey AS source_name, rule FROM (
    SELECT c_custkey, 'unknown privacy_class' AS rule FROM customer WHERE c_custkey % 5 = 0
    UNION ALL SELECT c_custkey, 'pii without commit_policy' FROM customer WHERE c_custkey % 2 = 0 AND c_custkey % 3 <> 0
    UNION ALL SELECT c_custkey, 'landing_path must include source name' FROM customer WHERE c_custkey % 7 = 0
    UNION ALL SELECT c_custkey, 'silver_table outside silver' FROM customer WHERE c_custkey % 11 = 0
    UNION ALL SELECT c_custkey, 'event_time_field must be required' FROM customer WHERE c_custkey % 13 = 0
    UNION ALL SELECT c_custkey, 'idempotency_key must be listed' FROM customer WHERE c_custkey % 17 = 0
    UNION ALL SELECT c_custkey, 'missing producer' FROM customer WHERE c_custkey % 19 = 0)""",
)
def _(spark, sf):
    """Which source breaks which rule."""
    return broken_registry(spark, sf).select("source_name", "rule")


def broken_registry(spark, sf):
    """A registry with one source per customer and planted defects."""
    key = F.col("c_custkey")
    name = F.concat(F.lit("src_"), key)
    fields = F.array(F.lit("occurred_at"), F.lit("kind"))
    registry = table(spark, sf, "customer").select(
        name.alias("source_name"),
        F.when(key % 19 != 0, F.lit("job")).alias("producer"),
        F.when(key % 5 == 0, "secret").otherwise("public_context").alias("privacy_class"),
        F.lit("local_raw_only").alias("raw_policy"),
        F.lit("summarized_landing_only").alias("local_policy"),
        (key % 2 == 0).alias("pii"),
        F.when(key % 3 == 0, "never export").alias("commit_policy"),
        F.concat(F.lit("lake/landing/"), F.when(key % 7 == 0, F.lit("other")).otherwise(name), F.lit("/dt={dt}/events.jsonl")).alias("landing_path"),
        F.concat(F.lit("lake.bronze."), name).alias("bronze_table"),
        F.concat(F.when(key % 11 == 0, F.lit("lake.bronze.")).otherwise(F.lit("lake.silver.")), name).alias("silver_table"),
        F.array(F.lit("daily")).alias("consumers"),
        fields.alias("required_fields"),
        F.when(key % 13 == 0, "seen_at").otherwise("occurred_at").alias("event_time_field"),
        F.when(key % 17 != 0, fields).alias("idempotency_key"),
    )
    return quality.check_registry(
        registry, ["public_context", "derived_context"], ["local_raw_only", "summarized_landing_only"], ["producer"],
        "lake.bronze.", "lake.silver.",
    )


@query(
    "q07_landing_rules",
    """SELECT rule, count(*) AS lines FROM (
    SELECT 'line is not valid JSON' AS rule FROM v_signals WHERE event_id % 10 = 1
    UNION ALL SELECT 'unregistered source' FROM v_signals WHERE event_id % 10 = 2
    UNION ALL SELECT 'source_name does not match path' FROM v_signals WHERE event_id % 10 = 2
    UNION ALL SELECT 'payload contains a forbidden key' FROM v_signals WHERE event_id % 10 = 3
    UNION ALL SELECT 'unexpected lake_version' FROM v_signals WHERE event_id % 10 = 4
    UNION ALL SELECT 'payload must be a non-empty object' FROM v_signals WHERE event_id % 10 = 5
    UNION ALL SELECT 'missing tags' FROM v_signals WHERE event_id % 10 = 6) GROUP BY rule""",
    ("v_signals",),
)
def _(spark, sf):
    lines, registry = damaged_landing(spark, sf)
    return quality.validate_landing_lines(lines, registry, ["event_key"]).groupBy("rule").agg(rollups.rows("lines"))


@query(
    "q07_landing_rules_by_line",
    """SELECT event_key, rule FROM (
    SELECT event_id AS event_key, 'line is not valid JSON' AS rule FROM v_signals WHERE event_id % 10 = 1
    UNION ALL SELECT event_id, 'unregistered source' FROM v_signals WHERE event_id % 10 = 2
    UNION ALL SELECT event_id, 'source_name does not match path' FROM v_signals WHERE event_id % 10 = 2
    UNION ALL SELECT event_id, 'payload contains a forbidden key' FROM v_signals WHERE event_id % 10 = 3
    UNION ALL SELECT event_id, 'unexpected lake_version' FROM v_signals WHERE event_id % 10 = 4
    UNION ALL SELECT event_id, 'payload must be a non-empty object' FROM v_signals WHERE event_id % 10 = 5
    UNION ALL SELECT event_id, 'missing tags' FROM v_signals WHERE event_id % 10 = 6)""",
    ("v_signals",),
)
def _(spark, sf):
    """Which line breaks which rule."""
    lines, registry = damaged_landing(spark, sf)
    return quality.validate_landing_lines(lines, registry, ["event_key"]).select("event_key", "rule")


def damaged_landing(spark, sf):
    """Landing lines with one planted defect in six of ten."""
    from contextlake.operators.envelope import SIGNAL, envelope
    from contextlake.sinks.tables import landing_objects

    numbered = view(spark, sf, "v_signals").withColumn("summary", F.col("event_id").cast("string"))
    events = landing_objects(envelope(numbered, SIGNAL, AS_OF))
    lines = events.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("line"))
    key = F.get_json_object("line", "$.payload.summary").cast("bigint")
    keyed = lines.withColumn("event_key", key)
    d = F.col("event_key") % 10
    damaged = (
        F.when(d == 1, F.substring("line", F.lit(1), F.length("line") - 1))
        .when(d == 3, F.regexp_replace("line", '"payload":\\{', '"payload":{"Home-Address":"x",'))
        .when(d == 4, F.regexp_replace("line", '"lake_version":"[^"]*"', '"lake_version":"v0"'))
        .when(d == 5, F.regexp_replace("line", '"payload":\\{.*\\}\\}$', '"payload":{}}'))
        .when(d == 6, F.regexp_replace("line", '"tags":', '"labels":'))
        .otherwise(F.col("line"))
    )
    path = F.when(d == 2, "lake/landing/stray/dt=2024-01-31/events.jsonl").otherwise(
        "lake/landing/context_signals/dt=2024-01-31/events.jsonl"
    )
    rows = keyed.select("event_key", path.alias("path"), damaged.alias("line"))
    registry = config_frame(spark, [("context_signals",), ("weather_forecast",)], "source_name string")
    return quality.landing_lines(rows), registry


@query(
    "q07_sources_never_seen",
    "SELECT 'weather_forecast' AS source_name FROM events WHERE event_id = (SELECT min(event_id) FROM events)",
)
def _(spark, sf):
    lines, registry = damaged_landing(spark, sf)
    return quality.missing_sources(registry, lines.select(F.col("path_source").alias("source_name")).distinct())


@query(
    "a32_landing_audit",
    """SELECT CASE WHEN event_id % 10 = 2 THEN 'stray' ELSE 'context_signals' END AS path_source, count(*) FILTER (WHERE event_id % 10 <> 1) AS rows,
    CAST(0 AS BIGINT) AS forbidden_lines, count(*) FILTER (WHERE event_id % 10 = 1) AS invalid_json,
    count(*) FILTER (WHERE event_id % 10 = 2) AS source_mismatches FROM v_signals GROUP BY 1""",
    ("v_signals",),
)
def _(spark, sf):
    lines, _registry = damaged_landing(spark, sf)
    return quality.landing_audit(lines)


@query(
    "q08_column_tests",
    """SELECT 'decision' AS column_name, 'accepted_values' AS test, count(*) FILTER (WHERE decision NOT IN ('go', 'caution', 'skip')) AS failures FROM v_scores
    UNION ALL SELECT 'score', 'not_null', count(*) FILTER (WHERE score IS NULL) FROM v_scores
    UNION ALL SELECT 'score_id', 'unique', (SELECT count(*) FROM (SELECT score_id FROM v_scores GROUP BY 1 HAVING count(*) > 1))
    UNION ALL SELECT 'signal_id', 'unique', (SELECT count(*) FROM (SELECT signal_id FROM v_signals GROUP BY 1 HAVING count(*) > 1))
    UNION ALL SELECT 'source_name', 'not_null', count(*) FILTER (WHERE source_name IS NULL) FROM v_medallion
    UNION ALL SELECT 'domain', 'accepted_values', count(*) FILTER (WHERE domain NOT IN ('market', 'github', 'career', 'wellbeing', 'system')) FROM v_signals""",
    ("v_scores", "v_signals", "v_medallion"),
)
def _(spark, sf):
    scores = quality.column_tests(
        view(spark, sf, "v_scores"), ["score"], ["score_id"], {"decision": READINESS_DECISIONS}
    )
    found = quality.column_tests(view(spark, sf, "v_signals"), unique=["signal_id"], accepted={"domain": SIGNAL_DOMAINS})
    medallion = quality.column_tests(view(spark, sf, "v_medallion"), ["source_name"])
    return scores.unionByName(found).unionByName(medallion)


@query(
    "q09_source_freshness",
    f"""SELECT event_type, CASE WHEN age > 1440 THEN 'error' WHEN age > 360 THEN 'warn' ELSE 'ok' END AS status FROM (
        SELECT event_type, date_diff('second', max(ts), TIMESTAMP '{AS_OF}') / 60.0 AS age FROM events GROUP BY 1)""",
)
def _(spark, sf):
    """Warn after 6 hours, error after 24, one row per source from one grouped pass."""
    from contextlake.functions.times import age_minutes

    newest = table(spark, sf, "events").groupBy("event_type").agg(F.max("ts").alias("latest"))
    age = age_minutes("latest", AS_OF)
    return newest.select("event_type", F.when(age > 1440, "error").when(age > 360, "warn").otherwise("ok").alias("status"))


@query(
    "q10_constraints",
    """SELECT 'primary_key_not_null' AS "constraint", count(*) FILTER (WHERE l_orderkey IS NULL OR l_linenumber IS NULL) AS violations FROM lineitem
    UNION ALL SELECT 'quantity_positive', count(*) FILTER (WHERE NOT (l_quantity > 5)) FROM lineitem
    UNION ALL SELECT 'primary_key_unique', coalesce((SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)), 0)
    UNION ALL SELECT 'orders_exist', (SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'))""",
)
def _(spark, sf):
    finished = table(spark, sf, "orders").filter("o_orderstatus <> 'P'")
    return quality.check_constraints(
        table(spark, sf, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        {"quantity_positive": F.col("l_quantity") > 5},
        {"orders_exist": (finished, "l_orderkey", "o_orderkey")},
    )


@query(
    "q11_uncovered_sources",
    """SELECT 'src_' || c_custkey AS source_name FROM customer WHERE c_custkey % 4 <> 0
    AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def _(spark, sf):
    key = F.col("c_custkey")
    registry = table(spark, sf, "customer").select(
        F.concat(F.lit("src_"), key).alias("source_name"),
        F.when(key % 4 == 0, "planned-import").otherwise("import").alias("producer"),
    )
    observed = table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(
        F.concat(F.lit("src_"), "o_custkey").alias("source_name")
    )
    return quality.uncovered_sources(registry, observed).select("source_name")


@query(
    "q12_payload_shapes",
    """SELECT event_id, rule FROM (SELECT event_id, '$.hourly.rain length must match time' AS rule FROM events WHERE event_id % 3 = 0
    UNION ALL SELECT event_id, 'missing latitude' FROM events WHERE event_id % 4 = 0
    UNION ALL SELECT event_id, '$.urgency must be 1..10' FROM events WHERE event_id % 12 NOT BETWEEN 1 AND 10
    UNION ALL SELECT event_id, '$.full_name has a wrong form' FROM events WHERE event_id % 5 = 0)""",
)
def _(spark, sf):
    e = F.col("event_id")
    payload = F.struct(
        F.when(e % 4 != 0, F.lit(59.9)).alias("latitude"),
        F.struct(
            F.array(F.lit("00:00"), F.lit("01:00")).alias("time"),
            F.when(e % 3 == 0, F.array(F.lit(1.0))).otherwise(F.array(F.lit(1.0), F.lit(2.0))).alias("rain"),
        ).alias("hourly"),
        (e % 12).alias("urgency"),
        F.when(e % 5 == 0, "plain").otherwise("owner/name").alias("full_name"),
    )
    rows = table(spark, sf, "events").select("event_id", F.to_json(payload).alias("payload"))
    return quality.check_payloads(
        rows, "payload", ["event_id"], ["latitude", "hourly"], ("$.hourly.time", ["$.hourly.rain"]),
        {"$.urgency": (1, 10)}, {"$.full_name": "^[^/]+/[^/]+$"},
    )


@query(
    "q01_suite_over_loads",
    f"SELECT id, dataset, severity, round(observed, 4) AS observed, passed FROM ({SUITE_SQL}) WHERE dataset IN ('feedback', 'scores')",
    SUITE_VIEWS,
)
def _(spark, sf):
    """Loads of two tables, each checked by its own partitions; one partition is written twice. Numbers of the full scan."""
    names = ("feedback", "scores")
    state = suite_state.SuiteState(spark, work_dir(spark, "q01-state"), quality.core_suite())
    for name in names:
        rows = view(spark, sf, SUITE_TABLES[name])
        part = F.pmod(F.xxhash64(*rows.columns), F.lit(3))
        path = work_dir(spark, f"q01-{name}")
        rows = rows.withColumn("part", F.when(part > 0, part))
        for load, wanted in enumerate((F.col("part") == 1, F.col("part") == 1, F.col("part").isNull(), F.col("part") == 2)):
            brought = rows.filter(wanted)
            # The first load of a partition holds half of it; the second replaces it.
            some = brought.filter(F.xxhash64(*rows.columns) % 2 == 0) if load == 0 else brought
            some.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part").parquet(path)
            state.add(load, name, spark.read.schema(rows.schema).parquet(path), "part", brought)
        if name == "scores":
            state.compact(name)
    result = state.results(names, AS_OF)
    return result.withColumn("observed", F.round("observed", 4))
