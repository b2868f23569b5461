"""Quantities of cart items as a base and the changes since, in key buckets.

A micro-batch writes the items it touches, as one run of changes, and a manifest that names the
runs which make up the state after it. It reads the state before it from the manifest of the batch
before, only the buckets it touches, and so does a batch that is replayed: what a manifest names
stays until the second manifest after it is written. What is written follows the size of the batch.

Compaction is a step of its own: when the changes hold more than half as many rows as the base,
both become a new base, and when there are ``MANY_RUNS`` of them they become one run. Each row
is so rewritten a few times at most while the state doubles.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.plans.cart import CART

BUCKETS = 256
MANY_RUNS = 32
SMALL_BASE = 100_000

ROWS = "user_id long, product_id long, qty long, batch long, bucket int"


@dataclass(frozen=True)
class Manifest:
    """The runs of a state: folder name and rows of the base, if there is one, and of the changes."""

    batch: int = -1
    base: list = field(default_factory=list)
    changes: list = field(default_factory=list)

    def folders(self) -> set[str]:
        return {name for name, _ in [*self.base, *self.changes]}


def bucket():
    return F.pmod(F.xxhash64(*CART), F.lit(BUCKETS)).cast("int")


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _remove(spark: SparkSession, path: str) -> None:
    place, system = _place(spark, path)
    system.delete(place, True)


def manifest(spark: SparkSession, state: str, batch: int) -> Manifest:
    """The manifest a batch has left; that of the batch before the first is empty."""
    place, system = _place(spark, f"{state}/manifest/{batch}/_SUCCESS")
    if not system.exists(place):
        if batch >= 0:
            raise ValueError(f"no manifest of batch {batch} in {state}")
        return Manifest(batch)
    return Manifest(**json.loads(spark.read.text(f"{state}/manifest/{batch}").first()[0]))


def latest(spark: SparkSession, state: str) -> Manifest:
    """The manifest of the last batch that ended."""
    place, system = _place(spark, f"{state}/manifest")
    batches = [int(s.getPath().getName()) for s in system.listStatus(place)] if system.exists(place) else []
    done = [b for b in batches if system.exists(_place(spark, f"{state}/manifest/{b}/_SUCCESS")[0])]
    return manifest(spark, state, max(done, default=-1))


def _runs(spark: SparkSession, state: str, folders: list) -> DataFrame:
    paths = [f"{state}/runs/run={name}" for name, rows in folders if rows]
    if not paths:
        return spark.createDataFrame([], ROWS)
    return spark.read.schema(f"{ROWS}, run string").option("basePath", f"{state}/runs").parquet(*paths).drop("run")


def quantities(spark: SparkSession, state: str, of: Manifest, buckets: list[int] | None = None) -> DataFrame:
    """(user_id, product_id, qty, batch): the last quantity of each item, 0 where it has left the cart."""
    rows = _runs(spark, state, [*of.base, *of.changes])
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(buckets))
    return rows.groupBy(*CART).agg(F.max_by("qty", "batch").alias("qty"), F.max("batch").alias("batch"))


def read_carts(spark: SparkSession, state: str) -> DataFrame:
    """(user_id, product_id, qty) of what is in the carts now."""
    return quantities(spark, state, latest(spark, state)).where("qty > 0").select(*CART, "qty")


def _write_run(rows: DataFrame, state: str, name: str) -> list:
    """Write a run, (user_id, product_id, qty, batch); its name and rows."""
    spark = rows.sparkSession
    dealt = rows.select(*CART, "qty", "batch", bucket().alias("bucket")).repartition("bucket")
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{state}/runs/run={name}")
    return [name, _runs(spark, state, [[name, 1]]).count()]


def _write_manifest(spark: SparkSession, state: str, new: Manifest) -> None:
    line = spark.createDataFrame([(json.dumps(asdict(new)),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{state}/manifest/{new.batch}")


def compacted(spark: SparkSession, state: str, now: Manifest) -> Manifest:
    """The same state in fewer runs, if it is time for that."""
    base, changed = sum(n for _, n in now.base), sum(n for _, n in now.changes)
    if 2 * changed > max(base, SMALL_BASE):
        rows = quantities(spark, state, now).where("qty > 0")
        return replace(now, base=[_write_run(rows, state, f"base-{now.batch}")], changes=[])
    if len(now.changes) >= MANY_RUNS:
        rows = quantities(spark, state, replace(now, base=[]))
        return replace(now, changes=[_write_run(rows, state, f"merged-{now.batch}")])
    return now


def commit(spark: SparkSession, state: str, before: Manifest, batch: int, touched: DataFrame) -> Manifest:
    """Write what a batch has touched, (user_id, product_id, qty), and the manifest after it; drop
    what neither this manifest nor the one before names."""
    run = _write_run(touched.withColumn("batch", F.lit(batch).cast("long")), state, f"batch-{batch}")
    changes = [*before.changes, run] if run[1] else before.changes
    new = compacted(spark, state, Manifest(batch, before.base, changes))
    older = Manifest()
    if batch >= 2:
        place, system = _place(spark, f"{state}/manifest/{batch - 2}/_SUCCESS")
        older = manifest(spark, state, batch - 2) if system.exists(place) else older
    _write_manifest(spark, state, new)
    named = new.folders() | before.folders()
    written = {run[0]}
    for name in (older.folders() | written) - named:
        _remove(spark, f"{state}/runs/run={name}")
    if batch >= 2:
        _remove(spark, f"{state}/manifest/{batch - 2}")
    return new
