"""Join queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from contextlake.operators import quality, retail, rollups, rules
from contextlake.session import config_frame

from .adapters import AS_OF, table, view
from .registry import half_up, query


def dec_avg(expr: str, digits: int) -> str:
    return half_up(f"CAST(sum({expr}) AS DOUBLE) / count({expr})", digits)


@query(
    "j01_customers_by_segment",
    f"""SELECT country, segment, count(*) AS customers, {dec_avg('lifetime_value', 2)} AS avg_lifetime_value
    FROM v_users JOIN v_segments USING (user_id) GROUP BY country, segment""",
    ("v_users", "v_segments"),
)
def _(spark, sf):
    return retail.customers_by_segment(view(spark, sf, "v_users"), view(spark, sf, "v_segments"))


SUPPLIER = f"""SELECT category, count(DISTINCT supplier_id) AS suppliers, {dec_avg('cost_usd', 2)} AS avg_supplier_cost_usd,
    {dec_avg('lead_time_days', 1)} AS avg_lead_time_days
    FROM v_products LEFT JOIN v_product_suppliers USING (product_id) GROUP BY category"""


@query("j02_supplier_metrics", SUPPLIER, ("v_products", "v_product_suppliers"))
def _(spark, sf):
    return retail.supplier_metrics(view(spark, sf, "v_products"), view(spark, sf, "v_product_suppliers"))


@query(
    "j03_category_profile",
    f"""SELECT * FROM (SELECT category, count(*) AS products, {dec_avg('price_usd', 2)} AS avg_price_usd FROM v_products GROUP BY category)
    JOIN ({SUPPLIER}) USING (category)""",
    ("v_products", "v_product_suppliers"),
)
def _(spark, sf):
    return retail.category_profile(view(spark, sf, "v_products"), view(spark, sf, "v_product_suppliers"))


@query(
    "j04_stock_by_region",
    f"""SELECT CAST(region AS BIGINT) AS region, country, count(DISTINCT warehouse_id) AS warehouses, count(DISTINCT product_id) AS stocked_products,
    CAST(sum(qty) AS BIGINT) AS available_qty, CAST(sum(reserved_qty) AS BIGINT) AS reserved_qty,
    {half_up('CAST(sum(reserved_qty) AS DOUBLE) / nullif(sum(qty), 0)', 4)} AS reserved_ratio
    FROM v_stock JOIN v_warehouses USING (warehouse_id) GROUP BY region, country""",
    ("v_stock", "v_warehouses"),
)
def _(spark, sf):
    return retail.stock_by_region(view(spark, sf, "v_stock"), view(spark, sf, "v_warehouses"))


@query(
    "j05_category_stock",
    f"""SELECT category, count(*) AS product_count, {dec_avg('price_usd', 2)} AS avg_price_usd,
    CAST(sum(qty) AS BIGINT) AS global_inventory_qty FROM v_products JOIN v_inventory USING (product_id) GROUP BY category""",
    ("v_products", "v_inventory"),
)
def _(spark, sf):
    return retail.category_stock(view(spark, sf, "v_products"), view(spark, sf, "v_inventory"))


@query(
    "j05_stock_sanity",
    """SELECT count(*) FILTER (WHERE qty < 0) AS negative_global_qty, count(*) FILTER (WHERE price_usd <= 0) AS non_positive_product_prices
    FROM v_inventory JOIN v_products USING (product_id)""",
    ("v_products", "v_inventory"),
)
def _(spark, sf):
    joined = view(spark, sf, "v_inventory").join(view(spark, sf, "v_products"), "product_id")
    return joined.agg(
        rollups.rows_if(F.col("qty") < 0, "negative_global_qty"),
        rollups.rows_if(F.col("price_usd") <= 0, "non_positive_product_prices"),
    )


REFERENCES = (
    ("inventory.product_id missing in products", "v_inventory", "product_id", "v_products", "product_id"),
    ("warehouse_inventory.product_id missing in products", "v_stock", "product_id", "v_products", "product_id"),
    ("warehouse_inventory.warehouse_id missing in warehouses", "v_stock", "warehouse_id", "v_warehouses", "warehouse_id"),
    ("customer_segments.user_id missing in users", "v_segments", "user_id", "v_users", "user_id"),
    ("product_suppliers.product_id missing in products", "v_product_suppliers", "product_id", "v_products", "product_id"),
    ("product_suppliers.supplier_id missing in suppliers", "v_product_suppliers", "supplier_id", "v_suppliers", "supplier_id"),
    ("orders.customer_id missing in customers", "v_ri_orders", "customer_id", "v_customers", "customer_id"),
)


@query(
    "j06_ri_check",
    " UNION ALL ".join(
        f"SELECT '{n}' AS check_name, count(*) AS issue_count FROM {c} LEFT JOIN {p} ON {c}.{ck} = {p}.{pk} WHERE {p}.{pk} IS NULL"
        for n, c, ck, p, pk in REFERENCES
    ),
    ("v_inventory", "v_products", "v_stock", "v_warehouses", "v_segments", "v_users", "v_product_suppliers",
     "v_suppliers", "v_ri_orders", "v_customers"),
)
def _(spark, sf):
    parts = [
        quality.ri_check(view(spark, sf, child), view(spark, sf, parent), ck, pk, name)
        for name, child, ck, parent, pk in REFERENCES
    ]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


TOP_SPEND = f"""SELECT customer_id, name, segment, count(order_id) AS total_orders, CAST(sum(total_amount) AS DOUBLE) AS total_spent,
    {dec_avg('total_amount', 2)} AS avg_order_value FROM v_customers LEFT JOIN v_orders USING (customer_id)
    GROUP BY customer_id, name, segment HAVING count(order_id) > 0"""


@query("j07_top_customers", f"{TOP_SPEND} ORDER BY sum(total_amount) DESC, customer_id LIMIT 10", ("v_customers", "v_orders"))
def _(spark, sf):
    return retail.customer_orders(view(spark, sf, "v_customers"), view(spark, sf, "v_orders"))


@query("j07_customer_orders", TOP_SPEND, ("v_customers", "v_orders"))
def _(spark, sf):
    return retail.customer_orders(view(spark, sf, "v_customers"), view(spark, sf, "v_orders"), n=None)


@query(
    "j08_latest_score_per_spot",
    """SELECT spot_id, label, source, CAST(1 AS BIGINT) AS tag_count, max(computed_at) AS latest_score_at
    FROM v_spots LEFT JOIN v_scores ON location_id = spot_id GROUP BY ALL
    ORDER BY latest_score_at DESC NULLS LAST, label, spot_id LIMIT 50""",
    ("v_spots", "v_scores"),
)
def _(spark, sf):
    spots = view(spark, sf, "v_spots").withColumn("tags", F.array("tag"))
    return retail.latest_score_per_spot(spots, view(spark, sf, "v_scores"))


@query(
    "j09_score_enrichment",
    f"""WITH best AS (SELECT user_id, activity, location_id, score FROM v_scores
        QUALIFY row_number() OVER (PARTITION BY user_id, activity ORDER BY score DESC, location_id) = 1),
    done AS (SELECT user_id, activity_type AS activity, count(*) AS sessions FROM v_activity
        WHERE logged_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1, 2),
    fb AS (SELECT user_id, activity, count(*) AS feedback_events FROM v_feedback
        WHERE created_at >= TIMESTAMP '{AS_OF}' - INTERVAL 30 DAY GROUP BY 1, 2)
    SELECT user_id, activity, location_id, CAST(score AS BIGINT) AS score, coalesce(sessions, 0) AS sessions,
    coalesce(feedback_events, 0) AS feedback_events,
    CAST(CASE activity WHEN 'skate' THEN 2 WHEN 'volleyball' THEN 1 WHEN 'moto_lesson' THEN 1 ELSE 0 END AS BIGINT) AS goal
    FROM best LEFT JOIN done USING (user_id, activity) LEFT JOIN fb USING (user_id, activity)""",
    ("v_scores", "v_activity", "v_feedback"),
)
def _(spark, sf):
    best = rules.best_scores(view(spark, sf, "v_scores"), "user_id")
    counts = rollups.weekly_counts(view(spark, sf, "v_activity"), "user_id", AS_OF)
    feedback = rollups.feedback_profile(view(spark, sf, "v_feedback"), 30, AS_OF, user_col="user_id")
    keys = ["user_id", "activity"]
    joined = best.join(counts, keys, "left").join(feedback.select(*keys, "feedback_events"), keys, "left")
    zero = F.lit(0)
    return joined.select(
        *keys, "location_id", "score",
        F.coalesce("sessions", zero).alias("sessions"),
        F.coalesce("feedback_events", zero).alias("feedback_events"),
        rules.config_lookup(rules.WEEKLY_GOALS, F.col("activity")).alias("goal"),
    )


@query(
    "j10_goal_progress",
    f"""WITH done AS (SELECT user_id, activity_type AS activity, count(*) AS n FROM v_activity
        WHERE logged_at >= TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1, 2)
    SELECT user_id, activity, coalesce(n, 0) AS done, CAST(target AS BIGINT) AS target,
    least(1.0, CAST(coalesce(n, 0) AS DOUBLE) / target) AS progress
    FROM (SELECT DISTINCT user_id FROM v_activity)
    CROSS JOIN (VALUES ('skate', 2), ('volleyball', 1), ('moto_lesson', 1), ('gym', 1), ('walk', 2)) g(activity, target)
    LEFT JOIN done USING (user_id, activity)""",
    ("v_activity",),
)
def _(spark, sf):
    activity = view(spark, sf, "v_activity")
    return rules.goal_progress(activity, rollups.weekly_counts(activity, "user_id", AS_OF))


LOCATIONS = [(f"loc_{i}",) for i in range(10)]


@query(
    "j11_weather_of_known_locations",
    f"""SELECT location_id, count(*) AS hours, max(temperature_c) AS max_temperature_c FROM v_weather
    WHERE location_id IN ({', '.join(repr(r[0]) for r in LOCATIONS)}) GROUP BY location_id""",
    ("v_weather",),
)
def _(spark, sf):
    """Configured locations meet stored weather on the location key."""
    locations = config_frame(spark, LOCATIONS, "location_id string")
    joined = view(spark, sf, "v_weather").join(locations, "location_id")
    return joined.groupBy("location_id").agg(
        rollups.rows("hours"), F.max("temperature_c").alias("max_temperature_c")
    )


REGISTERED = [("src_click",), ("src_view",), ("daily_context_profile",), ("sleep_quality",)]
REGISTERED_SQL = "(VALUES " + ", ".join(f"('{r[0]}')" for r in REGISTERED) + ") r(source_name)"


@query(
    "j12_registered_and_missing_sources",
    f"""SELECT source_name, 'registered' AS kind, count(*) AS events FROM v_medallion
        WHERE source_name IN (SELECT source_name FROM {REGISTERED_SQL}) GROUP BY 1
    UNION ALL SELECT source_name, 'unregistered', count(*) FROM v_medallion
        WHERE source_name NOT IN (SELECT source_name FROM {REGISTERED_SQL}) GROUP BY 1
    UNION ALL SELECT source_name, 'never observed', 0 FROM {REGISTERED_SQL}
        WHERE source_name NOT IN (SELECT source_name FROM v_medallion WHERE source_name IS NOT NULL)""",
    ("v_medallion",),
)
def _(spark, sf):
    registry = config_frame(spark, REGISTERED, "source_name string")
    observed = (
        view(spark, sf, "v_medallion")
        .filter(F.col("source_name").isNotNull())
        .groupBy("source_name")
        .agg(rollups.rows("events"))
    )
    label = lambda df, kind: df.select("source_name", F.lit(kind).alias("kind"), "events")
    known = label(observed.join(registry, "source_name", "left_semi"), "registered")
    unknown = label(observed.join(registry, "source_name", "left_anti"), "unregistered")
    missing = quality.missing_sources(registry, observed).withColumn("events", F.lit(0).cast("bigint"))
    return known.unionByName(unknown).unionByName(label(missing, "never observed"))


@query(
    "j13_name_alignment",
    """WITH a AS (SELECT DISTINCT p_brand AS name FROM part WHERE p_size <= 25),
    b AS (SELECT DISTINCT p_brand AS name FROM part WHERE p_retailprice > 1000)
    SELECT name, 'priced' AS missing_from FROM a WHERE name NOT IN (SELECT name FROM b)
    UNION ALL SELECT name, 'sized' FROM b WHERE name NOT IN (SELECT name FROM a)""",
)
def _(spark, sf):
    part = table(spark, sf, "part").withColumnRenamed("p_brand", "name")
    return quality.set_difference(
        part.filter("p_size <= 25"), part.filter("p_retailprice > 1000"), "sized", "priced"
    )
