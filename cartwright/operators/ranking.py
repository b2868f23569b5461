"""Row numbers, top-n and first-row selection that hold when one group is a third of the data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.lineage import stage

HOT_GROUP_ROWS = 1_000_000

# Spark keeps only the first n rows of each group before the shuffle while n is at most
# spark.sql.optimizer.windowGroupLimitThreshold (1000 by default).
MAP_SIDE_LIMIT = 1000
SALTS = 64


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, name: str = "rank") -> DataFrame:
    """Rows 1..n of each group in ``order`` (which must be total), numbered in ``name``.

    Up to ``MAP_SIDE_LIMIT`` the rows are cut to n per group inside each map task. Above it
    the group is cut per salt first, so no task sorts more than a slice of a large group.
    """
    if n > MAP_SIDE_LIMIT:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(SALTS))
        sliced = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_r", F.row_number().over(sliced))
            .where(F.col("_r") <= n)
            .drop("_r", "_salt")
        )
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(name, F.row_number().over(w)).where(F.col(name) <= n)


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the least by ``order``; copies are reduced before the shuffle."""
    rest = [c for c in df.columns if c not in keys and c not in order]
    least = F.min(F.struct(*order, *rest)).alias("_first")
    return df.groupBy(*keys).agg(least).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in [*order, *rest]])


def split_hot(df: DataFrame, group: Sequence[str], limit: int = HOT_GROUP_ROWS) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary groups, rows of groups with more than ``limit`` rows).

    There are at most ``rows / limit`` hot groups; how their table is joined is left to the planner,
    which measures it.
    """
    keys = [F.col(g).alias(f"_hot_{g}") for g in group]
    hot = df.groupBy(*group).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > limit).select(*keys)
    # Groups are counted once; without a hot one, nothing is left to join.
    hot = stage(hot, "hot-groups")
    if hot.isEmpty():
        return df, df.where(F.lit(False))
    same = [F.col(g) == F.col(f"_hot_{g}") for g in group]
    return df.join(hot, same, "left_anti"), df.join(hot, same, "left_semi")


def block_row_number(
    df: DataFrame, group: Sequence[str], order: Sequence[str], blocks: Sequence[str], name: str
) -> DataFrame:
    """``row_number() over (partition by group order by order)`` without one task per group.

    ``blocks`` are columns that coarsen the order step by step: sorting a group by ``order``
    must also sort it by ``blocks``. Rows are numbered within (group, blocks) and shifted by
    the sizes of the blocks before them.
    """
    sizes = df.groupBy(*group, *blocks).agg(F.count(F.lit(1)).alias("_size"))
    starts = None
    for depth in range(len(blocks), 0, -1):
        outer, inner = [*group, *blocks[: depth - 1]], blocks[depth - 1]
        level = sizes.groupBy(*outer, inner).agg(F.sum("_size").alias("_size"))
        before = Window.partitionBy(*outer).orderBy(inner).rowsBetween(Window.unboundedPreceding, -1)
        level = level.select(*outer, inner, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias(f"_start{depth}"))
        starts = level if starts is None else starts.join(level, [*outer, inner])
    shift = F.col("_start1")
    for depth in range(2, len(blocks) + 1):
        shift = shift + F.col(f"_start{depth}")
    inside = Window.partitionBy(*group, *blocks).orderBy(*order)
    return (
        df.withColumn("_r", F.row_number().over(inside))
        .join(starts, [*group, *blocks])
        .select(*[F.col(c) for c in df.columns], (F.col("_r") + shift).alias(name))
    )


def grouped_row_number(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[str],
    blocks: Sequence[str],
    name: str,
    hot_rows: int = HOT_GROUP_ROWS,
) -> DataFrame:
    """Row number per group: a plain window, and ``block_row_number`` for the hot groups only."""
    plain, hot = split_hot(df, group, hot_rows)
    w = Window.partitionBy(*group).orderBy(*order)
    numbered = plain.withColumn(name, F.row_number().over(w).cast("bigint"))
    return numbered.unionByName(block_row_number(hot, group, order, blocks, name))
