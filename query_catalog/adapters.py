"""Domain-shaped views over the supplied tables.

Each view is a list of expressions that Spark SQL and DuckDB both understand,
so the query and its oracle start from the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@dataclass(frozen=True)
class View:
    source: str
    columns: dict[str, str]
    group_by: tuple[str, ...] = ()
    distinct: bool = False


def choose(selector: str, *values: str | None) -> str:
    """CASE over 0, 1, 2, …; None gives NULL."""
    whens = " ".join(
        f"WHEN {i} THEN '{v}'" for i, v in enumerate(values) if v is not None
    )
    return f"CASE CAST({selector} AS INT) {whens} ELSE NULL END"


def digit(place: int) -> str:
    return f"CAST(floor(event_id / {place}) % 10 AS INT)"


ACTIVITY = choose("event_id % 7", "skate", "snowboard", "volleyball", "moto_lesson", "gym", "walk", "rest")
OUTDOOR = choose("event_id % 4", "skate", "snowboard", "moto_lesson", "volleyball")
LOCATION = "'loc_' || CAST(user_id % 14 AS STRING)"
SCORE = "CAST(event_id % 101 AS INT)"


def double(expr: str, scale: int = 1) -> str:
    return f"CAST({expr} AS DOUBLE)" if scale == 1 else f"CAST({expr} AS DOUBLE) / {scale}"


def bucket(score: str, worst: str) -> str:
    return f"CASE WHEN {score} >= 75 THEN 'go' WHEN {score} >= 50 THEN 'caution' ELSE '{worst}' END"


VIEWS: dict[str, View] = {
    "v_activity": View(
        "events",
        {
            "event_id": "event_id",
            "user_id": "user_id",
            "activity_type": ACTIVITY,
            "intensity": "CAST(1 + event_id % 10 AS INT)",
            "mood": f"1 + {digit(10)}",
            "fatigue": f"1 + {digit(100)}",
            "pain_flag": "event_id % 11 = 0",
            "result": choose("event_id % 4", "good", "ok", "bad", "skipped"),
            "logged_at": "ts",
        },
    ),
    "v_feedback": View(
        "events",
        {
            "event_id": "event_id",
            "user_id": "user_id",
            "activity": ACTIVITY,
            "action": "CASE event_type WHEN 'purchase' THEN 'followed' WHEN 'signup' THEN 'followed'"
            " WHEN 'view' THEN 'skipped' WHEN 'error' THEN 'skipped' ELSE 'changed' END",
            "result": choose("event_id % 5", "good", "ok", "bad", "skipped", None),
            "note": "props",
            "created_at": "ts",
        },
    ),
    "v_weather": View(
        "events",
        {
            "location_id": LOCATION,
            "forecast_time": "ts",
            "temperature_c": f"{double('event_id % 400', 10)} - 10",
            "precipitation_mm": f"CASE WHEN event_id % 9 = 0 THEN {double('event_id % 7', 10)} ELSE {double('0')} END",
            "rain_mm": f"CASE WHEN event_id % 18 = 0 THEN {double('event_id % 7', 10)} ELSE {double('0')} END",
            "snowfall_cm": f"CASE WHEN event_id % 13 = 0 THEN {double('event_id % 6', 10)} ELSE {double('0')} END",
            "snow_depth_cm": double("event_id % 8"),
            "wind_speed_kmh": double("event_id % 30"),
            "wind_gust_kmh": double("event_id % 43"),
            "visibility_m": double("4900 + event_id % 5000"),
            "is_day": "hour(ts) BETWEEN 8 AND 20",
            "fetched_at": "ts",
        },
    ),
    "v_scores": View(
        "events",
        {
            "score_id": "event_id",
            "user_id": "user_id",
            "activity": OUTDOOR,
            "location_id": LOCATION,
            "score": SCORE,
            "decision": bucket("(event_id % 101)", "skip"),
            "explanation": "'rule ' || CAST(event_id % 3 AS STRING)",
            "computed_at": "ts",
        },
    ),
    "v_recs": View(
        "events",
        {
            "rec_id": "event_id",
            "user_id": "user_id",
            "recommendation_type": "CASE WHEN event_id % 10 = 0 THEN 'weekly' ELSE 'daily' END",
            "activity": OUTDOOR,
            "location_id": LOCATION,
            "score": SCORE,
            "decision": bucket("(event_id % 101)", "recover"),
            "reasons": "'because of ' || event_type",
            "generated_at": "ts",
        },
    ),
    "v_signals": View(
        "events",
        {
            "event_id": "event_id",
            "user_id": "user_id",
            "signal_id": "'sig_' || CAST(event_id % 2000 AS STRING)",
            "domain": choose("event_id % 5", "market", "github", "career", "wellbeing", "system"),
            "source": "event_type",
            "title": "'signal about ' || event_type",
            "direction": choose("event_id % 3", "positive", "negative", "neutral"),
            "urgency": "CAST(1 + event_id % 10 AS INT)",
            "confidence": "CAST(1 + event_id % 100 AS INT)",
            "summary": "props",
            "occurred_at": "ts",
            "ingested_at": "ts",
        },
    ),
    "v_profiles": View(
        "events",
        {
            "profile_id": "event_id",
            "profile_date": "CAST(ts AS DATE)",
            "timezone": choose("user_id % 3", "UTC", "Europe/Berlin", "Asia/Tokyo"),
            "top_activity": OUTDOOR,
            "top_decision": bucket("(event_id % 101)", "recover"),
            "top_score": SCORE,
            "readiness_state": choose("event_id % 3", "good_window", "trusted_go", "recovery_first"),
            "sessions_7d": "CAST(event_id % 12 AS INT)",
            "avg_mood_7d": double("event_id % 100", 10),
            "avg_fatigue_7d": double("event_id % 90", 10),
            "pain_sessions_7d": "CAST(event_id % 3 AS INT)",
            "useful_decision_days_7d": "CAST(event_id % 8 AS INT)",
            "follow_rate_7d": double("event_id % 101", 100),
            "open_goal_count": "CAST(event_id % 5 AS INT)",
            "signal_count_7d": "CAST(event_id % 40 AS INT)",
            "highest_signal_domain": choose("event_id % 5", "market", "github", "career", "wellbeing", "system"),
            "highest_signal_urgency": "CAST(event_id % 11 AS INT)",
            "context_summary": "'state for ' || event_type || '; confidence=' || CAST(event_id % 101 AS STRING)"
            " || '/100; data_gaps=' || CASE WHEN event_id % 4 = 0 THEN 'none' ELSE 'sleep_recovery_missing, context_signals_stale' END",
            "generated_at": "ts",
        },
    ),
    "v_spots": View(
        "customer",
        {
            "spot_id": "'loc_' || CAST(c_custkey AS STRING)",
            "label": "CASE WHEN c_custkey % 50 = 0 THEN ' ' ELSE c_name END",
            "latitude": double("c_custkey % 200 - 100"),
            "longitude": double("c_custkey % 400 - 200"),
            "source": "CASE WHEN c_custkey % 3 = 0 THEN 'config' ELSE 'overpass' END",
            "tag": "c_mktsegment",
        },
    ),
    "v_users": View("customer", {"user_id": "c_custkey", "country": "'N' || CAST(c_nationkey AS STRING)"}),
    "v_segments": View(
        "customer",
        {
            "user_id": "c_custkey",
            "segment": "c_mktsegment",
            "lifetime_value": "CAST(c_acctbal AS DECIMAL(12,2))",
        },
    ),
    "v_customers": View(
        "customer", {"customer_id": "c_custkey", "name": "c_name", "segment": "c_mktsegment"}
    ),
    "v_orders": View(
        "orders",
        {
            "order_id": "o_orderkey",
            "customer_id": "o_custkey",
            "total_amount": "CAST(o_totalprice AS DECIMAL(12,2))",
            "order_date": "o_orderdate",
            "status": "o_orderstatus",
        },
    ),
    "v_products": View(
        "part",
        {"product_id": "p_partkey", "category": "p_brand", "price_usd": "CAST(p_retailprice AS DECIMAL(12,2))"},
    ),
    "v_product_suppliers": View(
        "lineitem",
        {
            "product_id": "l_partkey",
            "supplier_id": "l_suppkey",
            "cost_usd": "CAST((l_partkey * 7 + l_suppkey * 3) % 1000 AS DECIMAL(12,2))",
            "lead_time_days": "(l_partkey + l_suppkey) % 30",
        },
        distinct=True,
    ),
    "v_inventory": View(
        "lineitem",
        {"product_id": "l_partkey", "qty": "CAST(sum(l_quantity) AS BIGINT)"},
        group_by=("l_partkey",),
    ),
    "v_stock": View(
        "lineitem",
        {
            "warehouse_id": "l_suppkey % 25",
            "product_id": "l_partkey",
            "qty": "CAST(sum(l_quantity) AS BIGINT)",
            "reserved_qty": "CAST(sum(CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0 END) AS BIGINT)",
        },
        group_by=("l_suppkey % 25", "l_partkey"),
    ),
    "v_warehouses": View(
        "nation",
        {"warehouse_id": "CAST(n_nationkey AS BIGINT)", "region": "n_regionkey", "country": "n_name"},
    ),
    "v_suppliers": View("supplier", {"supplier_id": "s_suppkey", "name": "s_name"}),
    "v_payments": View(
        "orders",
        {"payment_id": "o_orderkey", "payment_status": "o_orderstatus", "event_time": "o_orderdate"},
    ),
    "v_stock_changes": View(
        "lineitem",
        {
            "product_id": "l_partkey",
            "quantity_delta": "CASE WHEN l_returnflag = 'R' THEN CAST(l_quantity AS BIGINT)"
            " ELSE -CAST(l_quantity AS BIGINT) END",
            "event_time": "l_shipdate",
        },
    ),
    "v_ri_orders": View(
        "orders",
        {
            "order_id": "o_orderkey",
            "customer_id": "CASE WHEN o_orderkey % 97 = 0 THEN o_custkey + 1000000 ELSE o_custkey END",
        },
    ),
    "v_sales": View(
        "events",
        {"event_time": "ts", "user_id": "user_id", "amount": "CAST(value AS DECIMAL(12,2))"},
    ),
    "v_bronze": View(
        "events",
        {
            "event_source": "event_type",
            "event_time": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END",
            "ingested_at": "CASE WHEN event_id % 29 = 0 THEN NULL ELSE ts END",
            "record_key": "CAST(user_id AS STRING)",
            "json_payload": "props",
            "partition": "CAST(user_id % 3 AS INT)",
            "offset_id": "event_id",
        },
    ),
    "v_medallion": View(
        "events",
        {
            "event_id": "event_id",
            "source_name": "CASE WHEN event_type = 'error' THEN 'daily_context_profile'"
            " WHEN event_id % 23 = 0 THEN NULL ELSE 'src_' || event_type END",
            "event_type": "CASE event_type WHEN 'click' THEN 'decision_feedback' WHEN 'view' THEN 'decisionXview' ELSE event_type END",
            "event_time": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END",
            "privacy_class": choose("event_id % 3", "public_context", "derived_context", "private_behavior_summary"),
            "json_payload": "props",
        },
    ),
    "v_logs": View(
        "events",
        {
            "event_id": "event_id",
            "event_time": "CAST(ts AS STRING)",
            "ts": "ts",
            "component": "event_type",
            "action": "'act_' || CAST(event_id % 4 AS STRING)",
            "status": choose("event_id % 6", "ok", "ok", "error", "failed", "skipped", "Warning"),
            "message": "CASE WHEN event_id % 3 = 0 THEN 'token=abc' || CAST(event_id AS STRING) || ' rejected'"
            " WHEN event_id % 3 = 1 THEN 'chat id missing' ELSE '' END",
        },
    ),
    "v_sleep": View(
        "events",
        {
            "event_id": "event_id",
            "user_id": "user_id",
            "slept": "ts",
            "minutes": "CAST(240 + event_id % 300 AS INT)",
            "quality": "CAST(1 + event_id % 100 AS INT)",
            "recovery": "CAST(1 + floor(event_id / 7) % 100 AS INT)",
        },
    ),
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spec = VIEWS[name]
    df = table(spark, sf_dir, spec.source)
    if spec.group_by:
        from pyspark.sql import functions as F

        keys = [F.expr(e).alias(a) for a, e in spec.columns.items() if e in spec.group_by]
        aggs = [F.expr(e).alias(a) for a, e in spec.columns.items() if e not in spec.group_by]
        return df.groupBy(*keys).agg(*aggs).select(*spec.columns)
    result = df.selectExpr(*[f"{e} AS `{a}`" for a, e in spec.columns.items()])
    return result.distinct() if spec.distinct else result


def view_sql(name: str) -> str:
    spec = VIEWS[name]
    columns = ", ".join(f'{e} AS "{a}"' for a, e in spec.columns.items())
    distinct = "DISTINCT " if spec.distinct else ""
    group = f" GROUP BY {', '.join(spec.group_by)}" if spec.group_by else ""
    return f"SELECT {distinct}{columns} FROM {spec.source}{group}"


def with_views(sql: str, names: tuple[str, ...]) -> str:
    """Put the views in front of a query as common table expressions."""
    if not names:
        return sql
    views = ",\n".join(f"{name} AS ({view_sql(name)})" for name in names)
    if sql.upper().startswith("WITH "):
        return f"WITH {views},\n{sql[5:]}"
    return f"WITH {views}\n{sql}"
