"""Basket arrays."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_text_basket(text: Column) -> Column:
    """``"[1, 2 ,3]"`` to an array of trimmed, non-empty strings."""
    bare = F.regexp_replace(text, r"[\[\]]", "")
    return F.filter(F.transform(F.split(bare, ","), lambda x: F.trim(x)), lambda x: x != "")


def parse_json_basket(text: Column) -> Column:
    """``"[1, 2, 3]"`` to an array of longs; malformed text gives null."""
    return F.from_json(text, "array<bigint>")


def normal_basket(items: Column) -> Column:
    """All distinct items in numeric order."""
    return F.array_sort(F.array_distinct(items))


def set_text(items: Column) -> Column:
    """Members joined by ``|`` in the array's own order."""
    return F.array_join(F.transform(items, lambda x: x.cast("string")), "|")
