"""Data behind the exploratory charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.lineage import build_side, stage
from cartwright.operators.quantiles import exact_quantiles, unpivot


def dataset_cardinality(lines: DataFrame) -> DataFrame:
    """Distinct users, orders and products, each reduced on its own before counting."""
    names = {"users": "user_id", "orders": "order_id", "products": "product_id"}
    counts = {n: lines.select(c).distinct().agg(F.count(c).alias("n")).scalar() for n, c in names.items()}
    return lines.sparkSession.range(1).select(*[v.alias(k) for k, v in counts.items()])


def histogram(df: DataFrame, column: str, bins: int, log: bool = False) -> DataFrame:
    """(bin, low, high, count) of equal-width bins; the last one includes its upper end.

    With ``log`` the bins have equal width in log10 and values at or below 0 are left out.
    """
    x = F.col(column).cast("double")
    values = df.where(x > 0).select(F.log10(x).alias("x")) if log else df.where(x.isNotNull()).select(x.alias("x"))
    ends = values.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi")).alias("e")).scalar()
    lo, width = F.col("_e.lo"), (F.col("_e.hi") - F.col("_e.lo")) / bins
    slot = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col("x") - lo) / width), F.lit(bins - 1)))
    slots = values.withColumn("_e", ends).select(slot.cast("int").alias("bin"))
    counts = slots.groupBy("bin").agg(F.count(F.lit(1)).alias("count")).withColumn("_e", ends)
    low, high = lo + F.col("bin") * width, lo + (F.col("bin") + 1) * width
    if log:
        low, high = F.pow(F.lit(10.0), low), F.pow(F.lit(10.0), high)
    return counts.select("bin", low.alias("low"), high.alias("high"), "count")


def describe(df: DataFrame, columns: Sequence[str], upper: dict[str, float] | None = None) -> DataFrame:
    """count, mean, sample deviation, min, quartiles and max per column; ``upper`` clips first."""
    clipped = {c: F.least(F.col(c), F.lit(v)) for c, v in (upper or {}).items()}
    long = unpivot(df.withColumns(clipped) if clipped else df, columns)
    base = long.groupBy("feature").agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    return base.join(quartiles(long, ["feature"]), "feature")


def quartiles(long: DataFrame, group: Sequence[str]) -> DataFrame:
    table = exact_quantiles(long, [0.25, 0.5, 0.75], group)
    pick = {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    return table.groupBy(*group).agg(
        *[F.max(F.when(F.col("q") == p, F.col("quantile"))).alias(n) for n, p in pick.items()]
    )


def boxplot(df: DataFrame, columns: Sequence[str], by: str) -> DataFrame:
    """Box-plot numbers per group: quartiles and the whiskers at 1.5 times their distance."""
    long = unpivot(df, columns, keep=[by])
    box = stage(quartiles(long, [by, "feature"]), "quartiles")
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    inside = (
        long.join(build_side(box), [by, "feature"])
        .where(F.col("value").between(F.col("q25") - reach, F.col("q75") + reach))
        .groupBy(by, "feature")
        .agg(F.min("value").alias("whisker_low"), F.max("value").alias("whisker_high"))
    )
    return box.join(inside, [by, "feature"])


def crosstab(df: DataFrame, row: str, column: str) -> DataFrame:
    """Counts of each pair and their share of the row."""
    counts = df.groupBy(row, column).agg(F.count(F.lit(1)).alias("num_users"))
    total = F.sum("num_users").over(Window.partitionBy(row))
    return counts.withColumn("ratio", F.col("num_users") / total)
