"""Retail profiles: joins of products, suppliers, stock, customers and orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numbers import ratio
from .rollups import rows


def customers_by_segment(users: DataFrame, segments: DataFrame) -> DataFrame:
    return (
        users.join(segments, "user_id")
        .groupBy("country", "segment")
        .agg(rows("customers"), F.round(F.avg("lifetime_value"), 2).alias("avg_lifetime_value"))
    )


def supplier_metrics(products: DataFrame, product_suppliers: DataFrame) -> DataFrame:
    """Suppliers, cost and lead time per category; categories without suppliers stay."""
    joined = products.select("product_id", "category").join(product_suppliers, "product_id", "left")
    return joined.groupBy("category").agg(
        F.countDistinct("supplier_id").alias("suppliers"),
        F.round(F.avg("cost_usd"), 2).alias("avg_supplier_cost_usd"),
        F.round(F.avg("lead_time_days"), 1).alias("avg_lead_time_days"),
    )


def category_profile(products: DataFrame, product_suppliers: DataFrame) -> DataFrame:
    """Product and supplier metrics, both aggregated before they meet."""
    product_metrics = products.groupBy("category").agg(
        rows("products"), F.round(F.avg("price_usd"), 2).alias("avg_price_usd")
    )
    return product_metrics.join(supplier_metrics(products, product_suppliers), "category")


def stock_by_region(stock: DataFrame, warehouses: DataFrame) -> DataFrame:
    """Stock per region and country; rows are summed per warehouse and product before anything distinct is counted."""
    pairs = stock.groupBy("warehouse_id", "product_id").agg(
        F.sum("qty").alias("qty"), F.sum("reserved_qty").alias("reserved_qty")
    )
    return (
        pairs.join(warehouses, "warehouse_id")
        .groupBy("region", "country")
        .agg(
            F.countDistinct("warehouse_id").alias("warehouses"),
            F.countDistinct("product_id").alias("stocked_products"),
            F.sum("qty").alias("available_qty"),
            F.sum("reserved_qty").alias("reserved_qty"),
        )
        .withColumn("reserved_ratio", ratio(F.col("reserved_qty"), F.col("available_qty"), 4, None))
    )


def category_stock(products: DataFrame, inventory: DataFrame) -> DataFrame:
    return (
        products.join(inventory, "product_id")
        .groupBy("category")
        .agg(
            rows("product_count"),
            F.round(F.avg("price_usd"), 2).alias("avg_price_usd"),
            F.sum("qty").alias("global_inventory_qty"),
        )
    )


def customer_orders(
    customers: DataFrame, orders: DataFrame, min_orders: int = 1, n: int | None = 10
) -> DataFrame:
    """Customers ranked by spend. Orders are summed per customer before the join."""
    spend = orders.groupBy("customer_id").agg(
        rows("total_orders"),
        F.round(F.sum("total_amount"), 2).alias("total_spent"),
        F.round(F.avg("total_amount"), 2).alias("avg_order_value"),
    )
    joined = customers.join(spend, "customer_id", "left").withColumn(
        "total_orders", F.coalesce("total_orders", F.lit(0))
    )
    kept = joined.filter(F.col("total_orders") >= min_orders)
    return kept if n is None else kept.orderBy(F.col("total_spent").desc(), "customer_id").limit(n)


def latest_score_per_spot(spots: DataFrame, scores: DataFrame, n: int | None = 50) -> DataFrame:
    """Spots with their newest score time; scores are reduced before the join."""
    newest = scores.groupBy(F.col("location_id").alias("spot_id")).agg(
        F.max("computed_at").alias("latest_score_at")
    )
    joined = spots.join(newest, "spot_id", "left").select(
        "spot_id", "label", "source", F.size("tags").alias("tag_count"), "latest_score_at"
    )
    if n is None:
        return joined
    return joined.orderBy(F.col("latest_score_at").desc_nulls_last(), "label", "spot_id").limit(n)
