"""Shared shaping of query results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.functions.baskets import set_text
from registry.fixture import Fixture

__all__ = ["Column", "DataFrame", "F", "Fixture", "SparkSession", "near", "set_text", "shown"]


def near(x: Column | str, digits: int = 6) -> Column:
    """Round half up by plain arithmetic, as ``half_up`` does in the SQL."""
    x = F.col(x) if isinstance(x, str) else x
    scale = float(10**digits)
    return F.floor(x * scale + 0.5) / F.lit(scale)


def shown(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Round the named columns."""
    return df.withColumns({c: near(c, digits) for c in columns})
