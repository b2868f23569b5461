"""Store of popularity counts per day.

Every batch writes a folder of its own, ``runs/<number>``, in partitions of a month and in order of the day, and after it one
line of the ``log`` that names the batch and the runs that hold from then on. The newest line is what readers
see, so a batch that dies half-way changes nothing, and a batch that is delivered again is known by its name
and left out. ``compact`` adds the runs up into one, as a run of its own. Readers of a line go on
reading its runs; ``expire`` drops runs that the newest line no longer names. One writer at a time.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.plans.popularity_days import merged
from cartwright.sources.run_log import append as _append
from cartwright.sources.run_log import log as _log
from cartwright.sources.run_log import newest, numbers, remove
from cartwright.sources.run_log import next_number as _next

COUNTS = "day date, tier string, tier_key string, product_id long, cnt long, month int"


def add(counts: DataFrame, path: str, batch: str) -> bool:
    """Add the counts of a batch; False, with nothing done, if a batch of that name is there."""
    spark = counts.sparkSession
    log = _log(spark, path)
    if log is not None and not log.where(F.col("batch") == batch).isEmpty():
        return False
    number = _next(spark, path)
    _write(counts, path, number)
    _append(spark, path, number, batch, [*newest(log)[1], number])
    return True


def read(spark: SparkSession, path: str, first: dt.date | None = None, last: dt.date | None = None) -> DataFrame:
    """Counts of the days from ``first`` to ``last``, one row per day and key; other months are not
    read, and other days are left out by the statistics of the files."""
    runs = newest(_log(spark, path))[1]
    if not runs:
        return spark.createDataFrame([], COUNTS).drop("month")
    rows = _open(spark, path, runs)
    if first is not None:
        rows = rows.where((F.col("day") >= F.lit(first)) & (F.col("month") >= F.lit(_month_number(first))))
    if last is not None:
        rows = rows.where((F.col("day") <= F.lit(last)) & (F.col("month") <= F.lit(_month_number(last))))
    return merged(rows)


def compact(spark: SparkSession, path: str) -> int | None:
    """Add all runs up into one; its number, or None if there is nothing to add up."""
    runs = newest(_log(spark, path))[1]
    if len(runs) < 2:
        return None
    number = _next(spark, path)
    _write(merged(_open(spark, path, runs)), path, number)
    _append(spark, path, number, None, [number])
    return number


def expire(spark: SparkSession, path: str) -> list[int]:
    """Drop the runs that no reader of the newest line needs; their numbers."""
    held = set(newest(_log(spark, path))[1])
    gone = [n for n in numbers(spark, path) if n not in held]
    for n in gone:
        remove(spark, f"{path}/runs/{n}")
    return gone


def _month_number(day: dt.date) -> int:
    return day.year * 12 + day.month


def _write(counts: DataFrame, path: str, number: int) -> None:
    month = (F.year("day") * 12 + F.month("day")).alias("month")
    rows = counts.select("day", "tier", "tier_key", "product_id", "cnt", month)
    # Few files a month; a month with very many rows is split.
    rows = rows.hint("rebalance", "month").sortWithinPartitions("month", "day")
    rows.write.mode("error").partitionBy("month").parquet(f"{path}/runs/{number}")


def _open(spark: SparkSession, path: str, runs: list[int]) -> DataFrame:
    # Each run is opened by itself: the folders of runs are not a column of the table.
    tables = [spark.read.schema(COUNTS).parquet(f"{path}/runs/{n}") for n in runs]
    return reduce(DataFrame.unionByName, tables)
