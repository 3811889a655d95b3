"""Projections, filters and predicates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contextlake.functions import times, wire
from contextlake.operators import quality, rollups
from contextlake.plans import medallion

from .adapters import AS_OF, table, view
from .registry import query


def bus(spark, sf) -> DataFrame:
    """Events as bus records: magic byte, 4-byte id, JSON payload; every 10th value is damaged."""
    events = table(spark, sf, "events")
    header = F.unhex(F.lpad(F.hex("event_id"), 10, "0"))
    good = F.concat(header, F.encode("props", "utf-8"))
    broken = (
        F.when(F.col("event_id") % 40 == 10, F.unhex(F.lit("00")))
        .when(F.col("event_id") % 40 == 20, F.concat(F.unhex(F.lit("0A")), F.substring(good, 2, 100)))
        .when(F.col("event_id") % 40 == 30, F.lit(None).cast("binary"))
        .otherwise(F.concat(header, F.encode(F.lit('{"k": '), "utf-8")))
    )
    return events.select(
        F.col("event_type").alias("topic"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.when(F.col("event_id") % 10 == 0, broken).otherwise(good).alias("value"),
        (F.col("user_id") % 3).cast("int").alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )


# What each bus record holds, as DuckDB sees it.
WIRE = """wire AS (SELECT *, CASE WHEN event_id % 10 <> 0 THEN 'good' WHEN event_id % 40 = 10 THEN 'short'
    WHEN event_id % 40 = 20 THEN 'magic' WHEN event_id % 40 = 30 THEN 'null' ELSE 'cut' END AS state,
    length(props) AS n FROM events)"""
STATE_SIZE = "CASE state WHEN 'good' THEN n WHEN 'short' THEN -4 WHEN 'magic' THEN n WHEN 'cut' THEN 6 END"
STATE_ID = "CASE WHEN state IN ('short', 'null') THEN NULL ELSE event_id END"


@query(
    "p01_bronze_projection",
    f"""WITH {WIRE} SELECT event_type AS event_source, ts AS event_time, {STATE_ID} AS schema_id,
    CAST({STATE_SIZE} AS BIGINT) AS payload_size, CASE WHEN state = 'good' THEN props END AS json_payload,
    user_id % 3 AS "partition", event_id AS "offset" FROM wire""",
    text=("payload_size", "schema_id",),
)
def _(spark, sf):
    return medallion.to_bronze(bus(spark, sf))


@query("p02_schema_id", f"WITH {WIRE} SELECT event_id, {STATE_ID} AS schema_id FROM wire", text=("schema_id",))
def _(spark, sf):
    return bus(spark, sf).select(F.col("offset").alias("event_id"), wire.schema_id("value").alias("schema_id"))


@query(
    "p03_payload_size",
    f"""WITH {WIRE} SELECT event_id, CAST({STATE_SIZE} AS BIGINT) AS payload_size,
    CAST(greatest(coalesce({STATE_SIZE}, 0), 0) AS BIGINT) AS clamped_size FROM wire""",
    text=("payload_size",),
)
def _(spark, sf):
    return bus(spark, sf).select(
        F.col("offset").alias("event_id"),
        wire.payload_size("value").alias("payload_size"),
        wire.payload_size("value", clamp=True).alias("clamped_size"),
    )


@query(
    "p04_decoded_payload",
    f"WITH {WIRE} SELECT event_id, CASE WHEN state = 'good' THEN props END AS json_payload FROM wire",
)
def _(spark, sf):
    return bus(spark, sf).select(
        F.col("offset").alias("event_id"), wire.decode_json_payload("value").alias("json_payload")
    )


@query(
    "p05_decoded_payload_with_errors",
    f"""WITH {WIRE} SELECT event_id, CASE state WHEN 'good' THEN props
    WHEN 'magic' THEN '{{"error":"invalid magic byte: 10","schema_id":' || event_id || '}}'
    WHEN 'cut' THEN '{{"error":"payload decode error","schema_id":' || event_id || '}}'
    ELSE '{{"error":"invalid or missing value"}}' END AS json_payload FROM wire""",
)
def _(spark, sf):
    return bus(spark, sf).select(
        F.col("offset").alias("event_id"), wire.decode_json_payload("value", "json").alias("json_payload")
    )


@query(
    "p06_landing_to_bronze",
    f"""SELECT event_id, 'contextlake.v1' AS lake_version, source_name, event_type, event_time,
    TIMESTAMP '{AS_OF}' AS ingested_at, privacy_class, json_payload, TIMESTAMP '{AS_OF}' AS loaded_at FROM v_medallion""",
    ("v_medallion",),
)
def _(spark, sf):
    landing = view(spark, sf, "v_medallion").select(
        F.lit("contextlake.v1").alias("lake_version"),
        "event_id",
        "source_name",
        "event_type",
        F.coalesce(F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"), F.lit("not a time")).alias("event_time"),
        F.lit("2024-01-31T00:00:00Z").alias("ingested_at"),
        "privacy_class",
        F.col("json_payload").alias("payload"),
        F.lit("landing/events.jsonl").alias("landing_file"),
    )
    return medallion.landing_to_bronze(landing, AS_OF).drop("landing_file")


@query(
    "p07_silver",
    """SELECT event_id, source_name, event_type FROM v_medallion
    WHERE event_time IS NOT NULL AND source_name IS NOT NULL AND event_type IS NOT NULL""",
    ("v_medallion",),
)
def _(spark, sf):
    return medallion.to_silver(view(spark, sf, "v_medallion")).select("event_id", "source_name", "event_type")


@query(
    "p08_gold",
    """SELECT event_id, source_name, event_type FROM v_medallion
    WHERE source_name = 'daily_context_profile' OR event_type LIKE 'decision_%'""",
    ("v_medallion",),
)
def _(spark, sf):
    return medallion.to_gold(view(spark, sf, "v_medallion")).select("event_id", "source_name", "event_type")


@query(
    "p09_typed_projection",
    """SELECT o_orderdate AS event_time, CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_custkey AS VARCHAR) AS user_id,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS amount, CAST(NULL AS DOUBLE) AS cost_per_unit FROM orders""",
)
def _(spark, sf):
    return medallion.project(
        table(spark, sf, "orders"),
        {
            "event_time": "o_orderdate",
            "order_id": F.col("o_orderkey").cast("string"),
            "user_id": F.col("o_custkey").cast("string"),
            "amount": F.col("o_totalprice").cast("decimal(12,2)"),
            "cost_per_unit": F.lit(None).cast("decimal(12,2)"),
        },
    )


@query(
    "p10_staging_projections",
    """SELECT 'scores' AS model, activity, location_id AS detail, CAST(score AS BIGINT) AS score, computed_at AS at FROM v_scores
    UNION ALL SELECT 'recommendations', activity, decision, CAST(score AS BIGINT), generated_at FROM v_recs
    UNION ALL SELECT 'feedback', activity, action, NULL, created_at FROM v_feedback
    UNION ALL SELECT 'signals', domain, signal_id, CAST(urgency AS BIGINT), occurred_at FROM v_signals
    UNION ALL SELECT 'weather', location_id, CAST(is_day AS VARCHAR), CAST(visibility_m AS BIGINT), forecast_time FROM v_weather
    UNION ALL SELECT 'profiles', top_activity, timezone, CAST(top_score AS BIGINT), generated_at FROM v_profiles
    UNION ALL SELECT 'spots', label, source, NULL, NULL FROM v_spots""",
    ("v_scores", "v_recs", "v_feedback", "v_signals", "v_weather", "v_profiles", "v_spots"),
    text=("score",),
)
def _(spark, sf):
    """The seven staging models, each reduced to comparable columns and stacked."""
    stage = lambda name, model, df=None: medallion.stage(
        view(spark, sf, name) if df is None else df, model
    )
    spots = view(spark, sf, "v_spots").withColumns(
        {"tags": F.array("tag"), "updated_at": F.lit(None).cast("timestamp_ntz")}
    )
    parts = [
        ("scores", stage("v_scores", "readiness_scores"), "activity", "location_id", "score", "computed_at"),
        ("recommendations", stage("v_recs", "recommendation_events"), "activity", "decision", "score", "generated_at"),
        ("feedback", stage("v_feedback", "decision_feedback_events"), "activity", "action", None, "created_at"),
        ("signals", stage("v_signals", "signal_events"), "domain", "signal_id", "urgency", "occurred_at"),
        ("weather", stage("v_weather", "weather_hourly"), "location_id", "is_day", "visibility_m", "forecast_time"),
        ("profiles", stage("v_profiles", "daily_context_profiles"), "top_activity", "timezone", "top_score", "generated_at"),
        ("spots", stage("v_spots", "spots", spots), "label", "source", None, "updated_at"),
    ]
    result = None
    for model, df, activity, detail, score, at in parts:
        score_col = F.lit(None).cast("bigint") if score is None else F.col(score).cast("bigint")
        rows = df.select(
            F.lit(model).alias("model"),
            F.col(activity).alias("activity"),
            F.col(detail).cast("string").alias("detail"),
            score_col.alias("score"),
            F.col(at).alias("at"),
        )
        result = rows if result is None else result.unionByName(rows)
    return result


@query(
    "p11_violation_predicates",
    """SELECT count(*) FILTER (WHERE latitude NOT BETWEEN -90 AND 90 OR longitude NOT BETWEEN -180 AND 180) AS bad_coordinates,
    count(*) FILTER (WHERE label IS NULL OR trim(label) = '') AS blank_labels,
    count(*) FILTER (WHERE source NOT IN ('config')) AS other_sources,
    count(*) FILTER (WHERE latitude < 0) AS negative_latitude FROM v_spots""",
    ("v_spots",),
)
def _(spark, sf):
    return view(spark, sf, "v_spots").agg(
        rollups.rows_if(quality.any_of(*quality.bad_coordinates()), "bad_coordinates"),
        rollups.rows_if(quality.any_of(F.col("label").isNull(), quality.blank("label")), "blank_labels"),
        rollups.rows_if(quality.not_in("source", ["config"]), "other_sources"),
        rollups.rows_if(F.col("latitude") < 0, "negative_latitude"),
    )


MARKERS = ("token", "password", "secret", "api_key", "home_address")


@query(
    "p12_forbidden_text_rows",
    f"SELECT count(*) AS forbidden_payload_rows FROM documents WHERE regexp_matches(text, '({'|'.join(MARKERS)})')",
)
def _(spark, sf):
    return quality.forbidden_rows(table(spark, sf, "documents"), "text", MARKERS)


@query(
    "p13_recent_rows",
    f"""SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY""",
)
def _(spark, sf):
    events = table(spark, sf, "events").select("event_id", "ts")
    return events.filter(times.recent("ts", "7 days", AS_OF))


@query(
    "p14_hex_preview",
    f"""WITH {WIRE} SELECT event_id, CASE state
    WHEN 'good' THEN substring(printf('%010X', event_id) || hex(encode(props)), 1, 40)
    WHEN 'short' THEN '00' WHEN 'magic' THEN '0A' || substring(printf('%010X', event_id), 3) || substring(hex(encode(props)), 1, 30)
    WHEN 'cut' THEN printf('%010X', event_id) || hex(encode('{{"k": ')) END AS preview FROM wire""",
)
def _(spark, sf):
    return bus(spark, sf).select(F.col("offset").alias("event_id"), wire.hex_preview("value").alias("preview"))


@query(
    "p15_browse",
    "SELECT event_id, ts, user_id, event_type, value, props FROM events ORDER BY event_id LIMIT 100",
)
def _(spark, sf):
    return table(spark, sf, "events").orderBy("event_id").limit(100)
