"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from query_catalog import QUERIES  # noqa: E402

HEADLINES = (
    "a04_sleep_daily_from_json",
    "a05_weather_daily",
    "a06_activity_daily",
    "a08_feedback_daily",
    "a09_useful_decision_days",
    "a12_week_summary",
    "a13_decision_metrics_per_user",
    "a15_sales_per_minute",
    "a16_top_stock_movement",
    "a18_duplicate_keys",
    "a22_duplicate_groups",
    "a25_run_health",
    "a28_route_summary",
    "w01_latest_readiness",
    "w01_latest_daily_context",
    "w03_payment_share",
    "w04_daylight_window",
    "j03_category_profile",
    "j04_stock_by_region",
    "j06_ri_check",
    "j07_top_customers",
    "p01_bronze_projection",
    "p12_forbidden_text_rows",
    "f06_sanitize_message",
    "f04_word_count",
    "s01_bus_stream",
    "s08_rows_of_json_documents",
    "k01_bounded_append",
    "k08_upsert",
    "k18_medallion_load_is_repeatable",
    "d01_readiness_scores",
    "d03_recommendations",
    "d05_daily_profile",
    "d08_weekly_review",
    "d13_redacted_payloads",
    "d17_envelope_identity",
    "d19_diary_messages",
    "q01_expectation_suite",
    "q10_constraints",
    "r06_live_minutes",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINES
    if names == ["all"]:
        names = list(QUERIES)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    # One untimed query starts the JIT and the catalog.
    QUERIES["a03_decision_events"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds: dict[str, float] = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
