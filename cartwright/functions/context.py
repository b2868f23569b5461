"""Order context: time bucket, weekend, basket size, and the hierarchical context key."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwright.config import CONTEXT_LEVELS, GLOBAL_KEY, TIME_BUCKETS


def time_bucket(hour: Column) -> Column:
    """Left-closed six-hour bins; hours outside [0, 24) have no bucket."""
    night, morning, afternoon, evening = TIME_BUCKETS
    return (
        F.when((hour >= 0) & (hour < 6), night)
        .when((hour >= 6) & (hour < 12), morning)
        .when((hour >= 12) & (hour < 18), afternoon)
        .when((hour >= 18) & (hour < 24), evening)
    )


def is_weekend(dow: Column) -> Column:
    return dow.isin(0, 6).cast("int")


def basket_size_category(size: Column) -> Column:
    return F.when(size < 5, "small").when(size < 15, "medium").otherwise("large")


def fixed_lifecycle(total_orders: Column) -> Column:
    """Right-closed bins (0,3], (3,10], (10,50], (50,inf)."""
    return (
        F.when((total_orders > 0) & (total_orders <= 3), "new")
        .when((total_orders > 3) & (total_orders <= 10), "regular")
        .when((total_orders > 10) & (total_orders <= 50), "loyal")
        .when(total_orders > 50, "vip")
    )


def dimension_text(dim: str) -> Column:
    """Text of one dimension; booleans read as 0/1 and null as ``unknown``."""
    return F.coalesce(F.col(dim).cast("string"), F.lit("unknown"))


def context_key(dims: Sequence[str]) -> Column:
    """``dim=value|dim=value``, or the global key when there are no dimensions."""
    if not dims:
        return F.lit(GLOBAL_KEY)
    return F.concat_ws("|", *[F.concat(F.lit(f"{d}="), dimension_text(d)) for d in dims])


def context_columns(levels: Mapping[str, Sequence[str]] = CONTEXT_LEVELS) -> dict[str, Column]:
    return {f"context_{level}": context_key(dims) for level, dims in levels.items()}


def context_array(levels: Sequence[str] = tuple(CONTEXT_LEVELS)) -> Column:
    """The contexts of one transaction as structs, from its ``context_L*`` columns."""
    return F.array(
        *[
            F.struct(F.lit(level).alias("context_level"), F.col(f"context_{level}").alias("context_key"))
            for level in levels
        ]
    )


def key_parts(key: Column) -> Column:
    return F.split(key, r"\|")


def infer_level(key: Column, levels: Mapping[str, Sequence[str]] = CONTEXT_LEVELS) -> Column:
    """Most specific level all of whose dimensions occur in the key."""
    dims = F.map_keys(F.str_to_map(key, F.lit(r"\|"), F.lit("=")))
    by_size = sorted(levels.items(), key=lambda kv: -len(kv[1]))
    chosen = F.when(key == GLOBAL_KEY, F.lit("L5"))
    for level, wanted in by_size:
        if wanted:
            needed = F.array(*[F.lit(d) for d in wanted])
            chosen = chosen.when(F.size(F.array_except(needed, dims)) == 0, F.lit(level))
    return chosen.otherwise(F.lit("L5"))


def level_bit(level: Column, levels: Sequence[str] = tuple(CONTEXT_LEVELS)) -> Column:
    """One bit per level, so that a set of levels is a number and needs no list while grouping."""
    chosen = None
    for i, name in enumerate(levels):
        test = level == name
        chosen = F.when(test, F.lit(1 << i)) if chosen is None else chosen.when(test, F.lit(1 << i))
    return chosen.otherwise(F.lit(0))


def levels_of(mask: Column, levels: Sequence[str] = tuple(CONTEXT_LEVELS)) -> Column:
    """The level names of a bit mask, in order."""
    names = [F.when(mask.bitwiseAND(F.lit(1 << i)) != 0, F.lit(name)) for i, name in enumerate(levels)]
    return F.array_compact(F.array(*names))
