"""Versioned store of the rules table.

Every save writes a folder of its own, ``versions/<number>``, and after it one line of the
``log`` that says what the folder holds. The highest number in the log is the current version, so a save
that dies half-way changes nothing for readers. A reader keeps to the version it began with;
older versions stay until ``expire`` drops them.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RULE_VERSION = 2
CONTEXT_VERSION = "v2"
RULE_COLUMNS = (
    "context_level",
    "context_key",
    "rule_id",
    "antecedent",
    "consequent",
    "confidence",
    "lift",
    "support",
    "score",
)

LOG = "number long, rules long, contexts long, version int, context_version string, created_at string, columns string"


def bad_rules(rules: DataFrame) -> DataFrame:
    """Rows that are not usable as rules."""
    present = F.lit(True)
    for c in RULE_COLUMNS:
        present = present & F.col(c).isNotNull()
    shape = (
        (F.size("antecedent") > 0)
        & ~F.array_contains("antecedent", F.col("consequent"))
        & F.col("confidence").between(0.0, 1.0)
        & (F.col("lift") > 0)
        & F.col("support").between(0.0, 1.0)
    )
    return rules.where(~F.coalesce(present & shape, F.lit(False)))


def versions(spark: SparkSession, path: str) -> DataFrame | None:
    """The log: a row for each version that was saved whole; None where nothing was saved."""
    place, system = _place(spark, f"{path}/log")
    if not system.exists(place) or not system.globStatus(_place(spark, f"{path}/log/*.json")[0]):
        return None
    return spark.read.schema(LOG).json(f"{path}/log")


def current(spark: SparkSession, path: str) -> int | None:
    """The number of the newest version that was saved whole."""
    log = versions(spark, path)
    return None if log is None else log.agg(F.max("number")).first()[0]


def save(rules: DataFrame, path: str) -> int:
    """Write the rules as a new version, partitioned by level, and then its line of the log; the
    number of the version. Two saves at a time must not use one store."""
    missing = [c for c in RULE_COLUMNS if c not in rules.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    spark = rules.sparkSession
    place, system = _place(spark, f"{path}/versions")
    # Folders of saves that died count as well, so a number is never used twice.
    taken = [int(s.getPath().getName()) for s in system.listStatus(place)] if system.exists(place) else []
    number = max([*taken, current(spark, path) or 0]) + 1
    folder = f"{path}/versions/{number}"
    rules.write.mode("error").partitionBy("context_level").parquet(folder)
    written = spark.read.schema(rules.schema).parquet(folder)
    line = written.agg(
        F.lit(number).cast("long").alias("number"),
        F.count(F.lit(1)).alias("rules"),
        F.countDistinct("context_level", "context_key").alias("contexts"),
        F.lit(RULE_VERSION).alias("version"),
        F.lit(CONTEXT_VERSION).alias("context_version"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss").alias("created_at"),
        F.lit(written.schema.json()).alias("columns"),
    )
    line.coalesce(1).write.mode("append").json(f"{path}/log")
    return number


def load(spark: SparkSession, path: str, validate: bool = True, number: int | None = None) -> DataFrame:
    """Read the current version, or one by its number; refuses rules of another layout and, with
    ``validate``, malformed rows. What is returned goes on reading that version when others are saved."""
    log = versions(spark, path)
    wanted = current(spark, path) if number is None else number
    line = None if log is None else log.where(F.col("number") == wanted).first()
    if line is None or line["version"] != RULE_VERSION or line["context_version"] != CONTEXT_VERSION:
        raise ValueError(f"rule store at {path} has no version {wanted} or an unsupported one")
    rules = spark.read.schema(StructType.fromJson(json.loads(line["columns"]))).parquet(f"{path}/versions/{wanted}")
    missing = [c for c in RULE_COLUMNS if c not in rules.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    if validate and not bad_rules(rules).isEmpty():
        raise ValueError(f"rule store at {path} holds malformed rules")
    return rules


def expire(spark: SparkSession, path: str, keep: int = 2) -> list[int]:
    """Drop all but the newest ``keep`` whole versions, and what saves that died before the current
    version left; the numbers that went."""
    log = versions(spark, path)
    if log is None:
        return []
    whole = sorted(r["number"] for r in log.select("number").distinct().collect())
    held, newest = set(whole[-max(keep, 1) :]), whole[-1]
    place, system = _place(spark, f"{path}/versions")
    found = [int(s.getPath().getName()) for s in system.listStatus(place)]
    gone = sorted(n for n in found if n not in held and n < newest)
    for n in gone:
        system.delete(_place(spark, f"{path}/versions/{n}")[0], True)
    return gone


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
