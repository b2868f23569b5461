"""Fact tables written in buckets of one key, so that joins and groupings on the key need no exchange.

A fact table is shuffled once, when it is written. Tables with the same key and number of buckets are joined bucket
by bucket; the number follows the rows of the largest table and is a power of two.
"""

from __future__ import annotations

import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame

from cartwright.lineage import folder

ROWS_PER_BUCKET = 2_000_000
LEAST_BUCKETS = 8


def bucket_count(rows: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """The power of two that keeps buckets of a table of ``rows`` near ``rows_per_bucket``."""
    needed = max(LEAST_BUCKETS, -(-rows // rows_per_bucket))
    return 1 << (needed - 1).bit_length()


def stage_buckets(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """Write ``df`` in ``buckets`` files by a hash of ``key``, in order of it, and continue from the table.

    The table lies in the shared folder of ``spark.checkpoint.dir``. Without one it is kept, dealt the
    same way, in Spark's storage, from which lost parts are computed again. All rows of a key fall into one
    bucket: take a key whose rows are bounded (an order), not one that can hold a large share (a user).
    """
    spark = df.sparkSession
    dealt = df.repartition(buckets, key)
    place = folder(spark)
    if place is None:
        kept = dealt.persist(StorageLevel.MEMORY_AND_DISK)
        kept.write.format("noop").mode("overwrite").save()
        return kept
    table = f"{name.replace('-', '_')}_{uuid.uuid4().hex}"
    writer = dealt.write.bucketBy(buckets, key).sortBy(key).option("path", f"{place}/cartwright/{table}")
    writer.format("parquet").saveAsTable(table)
    return spark.table(table)
