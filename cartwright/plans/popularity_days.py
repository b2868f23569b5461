"""Popularity kept as counts per day, which add up.

A day's table holds (day, tier, tier_key, product_id, cnt). Lists of any span of days come from sums
of the days' tables, so purchases are read once, when they arrive. Late purchases are more counts of
their day; purchases that are taken back are counts below zero. What sums to zero is not listed.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.config import POPULAR_LIST_SIZE
from cartwright.operators.ranking import top_n

KEYS = ["tier", "tier_key", "product_id"]


def day_counts(purchases: DataFrame, tiers: Mapping[str, str | None], day: str = "order_date", weight: int = 1) -> DataFrame:
    """Counts per day of each tier: ``tiers`` names the column of its key, or None for one list of all.

    Purchases without a key of a tier do not count there; purchases without a day or a product count nowhere.
    ``weight`` -1 takes purchases back. Purchases are first reduced to the combinations of a
    day, so only those are counted once per tier.
    """
    columns = sorted({c for c in tiers.values() if c is not None})
    rows = purchases.select(F.col(day).cast("date").alias("day"), "product_id", *columns)
    rows = rows.where(F.col("day").isNotNull() & F.col("product_id").isNotNull())
    small = rows.groupBy("day", "product_id", *columns).agg((F.count(F.lit(1)) * weight).alias("cnt"))
    entries = [
        F.struct(F.lit(tier).alias("tier"), (F.lit("") if c is None else F.col(c).cast("string")).alias("tier_key"))
        for tier, c in tiers.items()
    ]
    spread = small.select("day", "product_id", "cnt", F.explode(F.array(*entries)).alias("t"))
    spread = spread.select("day", "t.tier", "t.tier_key", "product_id", "cnt").where(F.col("tier_key").isNotNull())
    return spread.groupBy("day", *KEYS).agg(F.sum("cnt").alias("cnt"))


def merged(counts: DataFrame, by_day: bool = True) -> DataFrame:
    """The sum of counts from any number of batches, per day or over all days given."""
    keys = ["day", *KEYS] if by_day else KEYS
    return counts.groupBy(*keys).agg(F.sum("cnt").alias("cnt")).where("cnt <> 0")


def lists(counts: DataFrame, n: int = POPULAR_LIST_SIZE) -> DataFrame:
    """(tier, tier_key, product_id, cnt, rank): the n most purchased products of each key over
    the days given; ties go to the smaller id."""
    totals = merged(counts, by_day=False).where("cnt > 0")
    return top_n(totals, ["tier", "tier_key"], [F.col("cnt").desc(), F.col("product_id")], n).select(*KEYS, "cnt", "rank")
