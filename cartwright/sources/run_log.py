"""Runs and their log, as the stores of this folder keep them.

A store writes every change into a folder of its own, ``runs/<number>``, and after it one line of the
``log``, which names the batch and the runs that hold from then on. The newest line is what
readers see, so a change that dies half-way is never seen. One writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LOG = "number long, batch string, runs array<long>"


def log(spark: SparkSession, path: str) -> DataFrame | None:
    place, system = _place(spark, f"{path}/log")
    if not system.exists(place) or not system.globStatus(_place(spark, f"{path}/log/*.json")[0]):
        return None
    return spark.read.schema(LOG).json(f"{path}/log")


def newest(lines: DataFrame | None) -> tuple[int, list[int]]:
    """(number, runs that hold) of the newest line; (0, []) without one."""
    if lines is None:
        return 0, []
    row = lines.agg(F.max("number").alias("number"), F.max_by("runs", "number").alias("runs")).first()
    return row["number"], list(row["runs"])


def append(spark: SparkSession, path: str, number: int, batch: str | None, runs: list[int]) -> None:
    line = spark.createDataFrame([(number, batch, runs)], LOG)
    line.coalesce(1).write.mode("append").json(f"{path}/log")


def numbers(spark: SparkSession, path: str) -> list[int]:
    place, system = _place(spark, f"{path}/runs")
    return sorted(int(s.getPath().getName()) for s in system.listStatus(place)) if system.exists(place) else []


def next_number(spark: SparkSession, path: str) -> int:
    """Runs of batches that died, and lines whose runs are gone, count as well, so no number is used twice."""
    return max([newest(log(spark, path))[0], *numbers(spark, path)]) + 1


def remove(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
