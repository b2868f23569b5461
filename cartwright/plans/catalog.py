"""Product lookups and user profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.config import DEFAULT_PRICE
from cartwright.functions import labels
from cartwright.plans.evaluate import last_purchases

PAGE_BLOCK_BITS = 16


def search(products: DataFrame, text: str | None = None, department_id: int | None = None, regex: bool = False) -> DataFrame:
    """Products whose name contains ``text`` in any case, optionally of one department."""
    out = products
    if department_id is not None:
        out = out.where(F.col("department_id") == department_id)
    if text:
        name = F.col("product_name")
        hit = name.rlike(f"(?i){text}") if regex else F.lower(name).contains(text.lower())
        out = out.where(F.coalesce(hit, F.lit(False)))
    return out


def page(products: DataFrame, number: int = 1, size: int = 20) -> DataFrame:
    """One page by id, with the total number of matches on every row.

    Blocks of ids are counted, and only the blocks that the page lies in are ordered, so a deep page
    costs what the first one does.
    """
    low, high = (number - 1) * size, number * size
    blocked = products.withColumn("_block", F.shiftright("product_id", PAGE_BLOCK_BITS))
    counts = blocked.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy("_block"))
    counts = counts.withColumn("_before", upto - F.col("_n"))
    held = counts.where((F.col("_before") < high) & (F.col("_before") + F.col("_n") > low)).select("_block", "_before")
    total = products.agg(F.count(F.lit(1)).alias("n")).scalar()
    place = F.col("_before") + F.row_number().over(Window.partitionBy("_block").orderBy("product_id"))
    rows = blocked.join(held, "_block").withColumn("_place", place).where((F.col("_place") > low) & (F.col("_place") <= high))
    return rows.select(*products.columns).orderBy("product_id").withColumn("total", total)


def lookup(products: DataFrame, product_id: int) -> DataFrame:
    return products.where(F.col("product_id") == product_id)


def lookup_many(ids: DataFrame, products: DataFrame) -> DataFrame:
    """Products for a table of ids; unknown ids keep a row of nulls."""
    return ids.select("product_id").distinct().join(products, "product_id", "left")


def departments(products_departments: DataFrame) -> DataFrame:
    return products_departments.select("department_id", F.col("department").alias("department_name")).distinct()


def with_constant_price(products: DataFrame, price: float = DEFAULT_PRICE) -> DataFrame:
    return products.withColumn("price", F.lit(price))


def enrich(rows: DataFrame, products: DataFrame) -> DataFrame:
    """Recommendation rows with name, price and department; unknown products get defaults."""
    info = products.select(F.col("product_id").alias("item_id"), "product_name", "price", "department_id")
    out = rows.join(info, "item_id", "left")
    unknown = F.concat(F.lit(labels.PRODUCT_PREFIX), F.col("item_id").cast("string"))
    return out.withColumns(
        {
            "product_name": F.coalesce("product_name", unknown),
            "price": F.coalesce("price", F.lit(DEFAULT_PRICE)),
        }
    )


def label(value: Column, texts: dict) -> Column:
    chosen = None
    for key, text in texts.items():
        chosen = F.when(value == key, text) if chosen is None else chosen.when(value == key, text)
    return chosen.otherwise(labels.UNKNOWN_TEXT)


def recent_purchases(lines: DataFrame, products: DataFrame, n: int = 5) -> DataFrame:
    """The last n purchases of every user with product names."""
    last = last_purchases(lines.select("user_id", "order_number", "line_number", "product_id"), n)
    named = last.join(products.select("product_id", "product_name"), "product_id", "left")
    unknown = F.concat(F.lit(labels.PRODUCT_PREFIX), F.col("product_id").cast("string"))
    return named.select("user_id", "recency", "product_id", F.coalesce("product_name", unknown).alias("product_name"))


def user_profile(segments: DataFrame, recent: DataFrame | None = None) -> DataFrame:
    """Segments with their texts and, if given, the recent purchases as an array."""
    out = segments.select(
        "user_id",
        "behavior_cluster",
        label(F.col("behavior_cluster"), labels.BEHAVIOR_TEXT).alias("behavior_text"),
        "preference_cluster",
        label(F.col("preference_cluster"), labels.PREFERENCE_TEXT).alias("preference_text"),
        "lifecycle_stage",
        label(F.col("lifecycle_stage"), labels.LIFECYCLE_TEXT).alias("lifecycle_text"),
    )
    if recent is None:
        return out
    item = F.array_sort(F.collect_list(F.struct("recency", "product_id", "product_name")))
    lists = recent.groupBy("user_id").agg(item.alias("recent_purchases"))
    return out.join(lists, "user_id", "left")


def fallback_profile(users: DataFrame) -> DataFrame:
    """The profile shown with the static fallback."""
    return users.select(
        "user_id",
        F.lit(0).alias("behavior_cluster"),
        F.lit(labels.FALLBACK_BEHAVIOR_TEXT).alias("behavior_text"),
        F.lit(0).alias("preference_cluster"),
        F.lit("unknown").alias("lifecycle_stage"),
        F.lit(labels.FALLBACK_LIFECYCLE_TEXT).alias("lifecycle_text"),
    )
