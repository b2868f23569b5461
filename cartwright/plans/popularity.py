"""Popularity tables: (tier, tier_key, product_id, cnt, rank)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.config import POPULAR_LIST_SIZE
from cartwright.operators.ranking import top_n


def popular_global(purchases: DataFrame, n: int = POPULAR_LIST_SIZE) -> DataFrame:
    """The n products with the most purchases; ties go to the smaller id."""
    counts = purchases.groupBy("product_id").agg(F.count(F.lit(1)).alias("cnt"))
    best = counts.orderBy(F.col("cnt").desc(), "product_id").limit(n)
    listed = best.agg(F.array_sort(F.collect_list(F.struct((-F.col("cnt")).alias("neg"), "product_id"))).alias("l"))
    rows = listed.select(F.posexplode("l").alias("pos", "x"))
    return rows.select("x.product_id", (-F.col("x.neg")).alias("cnt"), (F.col("pos") + 1).alias("rank"))


def popular_by(purchases: DataFrame, keys: DataFrame, on: str, key: str, n: int = POPULAR_LIST_SIZE) -> DataFrame:
    """The n most purchased products for each value of ``key``, found through ``on``.

    Purchases are reduced to (user, product) counts before the join when ``on`` is the user;
    per order there is nothing to reduce.
    """
    if on == "order_id":
        reduced = purchases.select(on, "product_id", F.lit(1).cast("bigint").alias("cnt"))
    else:
        reduced = purchases.groupBy(on, "product_id").agg(F.count(F.lit(1)).alias("cnt"))
    counts = (
        reduced.join(keys.select(on, key), on)
        .groupBy(key, "product_id")
        .agg(F.sum("cnt").alias("cnt"))
        .where(F.col(key).isNotNull())
    )
    return top_n(counts, [key], [F.col("cnt").desc(), F.col("product_id")], n)


def as_tier(table: DataFrame, tier: str, key: str | None) -> DataFrame:
    value = F.lit("") if key is None else F.col(key).cast("string")
    return table.select(F.lit(tier).alias("tier"), value.alias("tier_key"), "product_id", "cnt", "rank")


def popularity_lists(tiers: DataFrame) -> DataFrame:
    """One array of product ids per (tier, tier_key), best first; lists have a fixed length."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "product_id")))["product_id"]
    return tiers.groupBy("tier", "tier_key").agg(ranked.alias("items"))
