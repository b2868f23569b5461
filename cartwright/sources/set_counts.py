"""Store of itemset counts that grow with batches of transactions (``plans.rule_updates``).

A run (``sources.run_log``) holds the blocks of its batch and the whole state after it. A batch that
is delivered again is known by its name and left out; readers of an earlier run go on reading its
state. ``expire`` drops states that are no longer the newest; blocks stay, as sets that become frequent
are counted in them.
"""

from __future__ import annotations

from dataclasses import fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.config import Mining
from cartwright.lineage import temporary
from cartwright.operators.vertical import BLOCKS
from cartwright.plans import rule_updates as updates
from cartwright.sources import run_log

STATE = {"leaves": updates.LEAVES, "items": updates.ITEMS, "contexts": updates.CONTEXTS, "sets": updates.SETS}


def add(txns: DataFrame, path: str, batch: str, m: Mining = Mining(), max_size: int | None = None) -> bool:
    """Count a batch in; False, with nothing done, if a batch of that name is there."""
    spark = txns.sparkSession
    log = run_log.log(spark, path)
    if log is not None and not log.where(F.col("batch") == batch).isEmpty():
        return False
    number = run_log.next_number(spark, path)
    newest, runs = run_log.newest(log)
    with temporary():
        after = updates.advance(_state(spark, path, newest, runs), txns, m, max_size)
        for table in fields(after):
            getattr(after, table.name).write.mode("error").parquet(f"{path}/runs/{number}/{table.name}")
    run_log.append(spark, path, number, batch, [*runs, number])
    return True


def read(spark: SparkSession, path: str) -> DataFrame:
    """The frequent itemsets of all batches so far, as ``rules.frequent_itemsets`` gives them."""
    return updates.itemsets(_state(spark, path, *run_log.newest(run_log.log(spark, path))))


def expire(spark: SparkSession, path: str) -> list[int]:
    """Drop what the newest line does not need; the numbers of the runs concerned."""
    newest, runs = run_log.newest(run_log.log(spark, path))
    gone = [n for n in run_log.numbers(spark, path) if n != newest]
    for n in gone:
        if n not in runs:
            run_log.remove(spark, f"{path}/runs/{n}")
            continue
        for table in STATE:
            run_log.remove(spark, f"{path}/runs/{n}/{table}")
    return gone


def _state(spark: SparkSession, path: str, newest: int, runs: list[int]) -> updates.State:
    if not runs:
        return updates.empty(spark)
    blocks = spark.read.schema(BLOCKS).parquet(*[f"{path}/runs/{n}/blocks" for n in runs])
    tables = {name: spark.read.schema(schema).parquet(f"{path}/runs/{newest}/{name}") for name, schema in STATE.items()}
    return updates.State(blocks=blocks, **tables)
