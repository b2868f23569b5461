"""Per-user feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.functions.context import fixed_lifecycle
from cartwright.plans.prep import with_user


def behavior_features(orders: DataFrame, lines: DataFrame) -> DataFrame:
    """total_orders, avg_days_between_orders, total_products, unique_products, reorder_ratio."""
    by_order = orders.groupBy("user_id").agg(
        F.countDistinct("order_id").alias("total_orders"),
        F.avg("days_since_prior_order").alias("avg_days_between_orders"),
    )
    # Reduced to (user, product) first, so that one busy user is counted by many tasks.
    by_product = (
        with_user(lines, orders)
        .groupBy("user_id", "product_id")
        .agg(
            F.count("product_id").alias("lines"),
            F.sum("reordered").alias("again"),
            F.count("reordered").alias("known"),
        )
        .groupBy("user_id")
        .agg(
            F.sum("lines").alias("total_products"),
            F.count("product_id").alias("unique_products"),
            F.try_divide(F.sum("again"), F.sum("known")).alias("reorder_ratio"),
        )
    )
    joined = by_order.join(by_product, "user_id", "left")
    return joined.select(
        "user_id",
        "total_orders",
        F.coalesce("avg_days_between_orders", F.lit(0.0)).alias("avg_days_between_orders"),
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total_products", "unique_products")],
        F.coalesce("reorder_ratio", F.lit(0.0)).alias("reorder_ratio"),
    )


def preference_features(
    orders: DataFrame, lines: DataFrame, products: DataFrame, departments: DataFrame
) -> DataFrame:
    """Share of each department in the lines of a user."""
    named = products.select("product_id", "department_id").join(departments, "department_id")
    # Repeat purchases are counted before the product is looked up.
    counts = (
        with_user(lines, orders)
        .where(F.col("user_id").isNotNull())
        .groupBy("user_id", "product_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(named.select("product_id", "department"), "product_id")
        .where(F.col("department").isNotNull())
        .groupBy("user_id", "department")
        .agg(F.sum("n").alias("purchase_count"))
    )
    # One row per department is left of a user here.
    total = F.sum("purchase_count").over(Window.partitionBy("user_id"))
    return counts.select("user_id", "department", (F.col("purchase_count") / total).alias("preference_score"))


def lifecycle_features(orders: DataFrame) -> DataFrame:
    out = orders.groupBy("user_id").agg(
        F.min("order_number").alias("first_order"),
        F.max("order_number").alias("last_order"),
        F.countDistinct("order_id").alias("total_orders"),
        F.coalesce(F.sum("days_since_prior_order"), F.lit(0.0)).alias("active_days"),
    )
    return out.withColumn("active_span", F.col("last_order") - F.col("first_order")).withColumn(
        "lifecycle_stage", fixed_lifecycle(F.col("total_orders"))
    )
