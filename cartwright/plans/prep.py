"""Cleaning, star join, baskets and the context of every order."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.config import CONTEXT_LEVELS, MIN_BASKET_ITEMS, TRAIN_DEFAULTS
from cartwright.functions import context as ctx
from cartwright.operators.quantiles import quantile_struct
from cartwright.operators.ranking import first_row, top_n

HASH_RANGE = 16**8


def require_columns(df: DataFrame, columns: Sequence[str]) -> None:
    """Raise if a column is missing; looks at the schema only."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def clean_orders(orders: DataFrame) -> DataFrame:
    narrow = {c: F.col(c).cast("tinyint") for c in ("order_dow", "order_hour_of_day")}
    return orders.dropna(subset=["user_id"]).withColumns(narrow)


def clean_lines(lines: DataFrame, order: Sequence[str] = ("line_number",)) -> DataFrame:
    """One row per (order, product): the first one in ``order``."""
    kept = first_row(lines, ["order_id", "product_id"], list(order))
    return kept.withColumn("reordered", F.col("reordered").cast("tinyint")) if "reordered" in kept.columns else kept


def clean_products(products: DataFrame) -> DataFrame:
    return products.withColumn("product_name", F.trim(F.lower("product_name")))


def finite_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Drop rows in which any of the columns is null, NaN or infinite."""
    keep = F.lit(True)
    for c in columns:
        v = F.col(c).cast("double")
        keep = keep & v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return df.where(keep)


def hash_sample(df: DataFrame, key: str, ratio: float, seed: int = 42) -> DataFrame:
    """Repeatable row sample: the same keys are chosen whatever the partitioning."""
    text = F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))
    draw = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")
    return df.where(draw < int(ratio * HASH_RANGE))


def merge_sales(
    lines: DataFrame, orders: DataFrame, products: DataFrame, aisles: DataFrame, departments: DataFrame
) -> DataFrame:
    """One wide row per order line."""
    return (
        lines.join(orders, "order_id", "left")
        .join(products, "product_id", "left")
        .join(aisles, "aisle_id", "left")
        .join(departments, "department_id", "left")
    )


def with_user(lines: DataFrame, orders: DataFrame) -> DataFrame:
    if "user_id" in lines.columns:
        return lines
    return lines.join(orders.select("order_id", "user_id"), "order_id", "left")


def baskets(
    orders: DataFrame, lines: DataFrame, max_items: int | None = None, min_items: int = MIN_BASKET_ITEMS
) -> DataFrame:
    """Orders with the array of their products in line order: all, or the first ``max_items`` if given."""
    rows = lines.select("order_id", F.col("line_number").alias("pos"), "product_id")
    if max_items is not None:
        rows = top_n(rows, ["order_id"], [F.col("pos"), F.col("product_id")], max_items, "_first").drop("_first")
    lists = rows.groupBy("order_id").agg(F.array_sort(F.collect_list(F.struct("pos", "product_id"))).alias("l"))
    lists = lists.select("order_id", F.col("l.product_id").alias("products")).where(F.size("products") >= min_items)
    return lists.join(orders, "order_id").withColumn("basket_size", F.size("products"))


def order_context(orders: DataFrame) -> DataFrame:
    """Temporal context; the basket size category is added when a basket is there."""
    out = orders.withColumns(
        {
            "time_bucket": ctx.time_bucket(F.col("order_hour_of_day")),
            "is_weekend": ctx.is_weekend(F.col("order_dow")),
            "day_of_week": F.col("order_dow").cast("int"),
        }
    )
    if "basket_size" in out.columns:
        out = out.withColumn("basket_size_category", ctx.basket_size_category(F.col("basket_size")))
    return out


def purchase_frequency(behavior_features: DataFrame, probs: tuple[float, float] = (0.33, 0.67)) -> DataFrame:
    """low / medium / high by the quantiles of total_orders over users."""
    cut = quantile_struct(
        behavior_features, {"low": ("total_orders", probs[0]), "high": ("total_orders", probs[1])}
    )
    n = F.col("total_orders")
    label = F.when(n <= F.col("_cut.low"), "low").when(n <= F.col("_cut.high"), "medium").otherwise("high")
    return behavior_features.withColumn("_cut", cut).select("user_id", label.alias("purchase_frequency"))


def attach_optional(df: DataFrame, table: DataFrame | None, column: str, default) -> DataFrame:
    """Left join a (user_id, column) table if there is one; the default fills the gaps."""
    if table is None:
        return df.withColumn(column, F.lit(default))
    joined = df.join(table.select("user_id", column), "user_id", "left")
    return joined.withColumn(column, F.coalesce(F.col(column), F.lit(default)))


def attach_users(orders: DataFrame, *tables: DataFrame | None) -> DataFrame:
    """Rows with the columns of the user tables that are given.

    The user tables are joined to each other first, so the rows are shuffled once. Orders that get
    them before they meet their lines are shuffled as narrow rows, and baskets are not shuffled by user at all.
    """
    given = [t for t in tables if t is not None]
    if not given:
        return orders
    users = given[0]
    for table in given[1:]:
        users = users.join(table, "user_id", "full")
    return orders.join(users, "user_id", "left")


def transactions_context(
    basket_orders: DataFrame,
    purchase_freq: DataFrame | None = None,
    lifecycle: DataFrame | None = None,
    preference: DataFrame | None = None,
    behavior: DataFrame | None = None,
    levels: Mapping[str, Sequence[str]] = CONTEXT_LEVELS,
) -> DataFrame:
    """Baskets with the eight context dimensions and one key per level.

    User columns may be on the baskets already (``attach_users``); what is missing gets its default.
    """
    out = attach_users(order_context(basket_orders), purchase_freq, lifecycle, preference, behavior)
    defaults = {
        "purchase_frequency": "medium",
        "lifecycle_stage": TRAIN_DEFAULTS["lifecycle_stage"],
        "preference_cluster": TRAIN_DEFAULTS["preference_cluster"],
        "behavior_cluster": TRAIN_DEFAULTS["behavior_cluster"],
    }
    filled: dict[str, Column] = {
        c: F.coalesce(F.col(c), F.lit(v)) if c in out.columns else F.lit(v) for c, v in defaults.items()
    }
    out = out.withColumns(filled).withColumns(ctx.context_columns(levels))
    dims = ["time_bucket", "is_weekend", "day_of_week", "basket_size_category", *defaults]
    return out.select("order_id", "user_id", "products", *dims, *[f"context_{level}" for level in levels])


def context_cardinality(txns: DataFrame, levels: Sequence[str] = tuple(CONTEXT_LEVELS)) -> DataFrame:
    """Distinct contexts per level, from the distinct leaf contexts."""
    leaves = txns.select(*[f"context_{level}" for level in levels]).distinct()
    counted = leaves.select(F.explode(ctx.context_array(levels)).alias("c")).select("c.*").distinct()
    return counted.groupBy("context_level").agg(F.count(F.lit(1)).alias("contexts"))
