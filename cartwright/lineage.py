"""Intermediate tables.

``stage`` writes a DataFrame as parquet into the shared folder the cluster names in
``spark.checkpoint.dir`` and reads it back. That cuts the lineage in a way that survives the
loss of executors, and it gives the optimizer the true size of the table, so that a later
join broadcasts it only when it is below ``spark.sql.autoBroadcastJoinThreshold`` and
shuffles it otherwise. A session without a shared folder keeps the table in Spark's own
storage (memory and disk of the executors), from which lost parts are computed again.
"""

from __future__ import annotations

import gc
import re
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, NumericType, StringType

ROW_BYTES = 32
# Least seconds between two collections of the driver's garbage, and when the last one was.
TIDY_SECONDS = 3.0
_TIDIED = [0.0]


def folder(spark: SparkSession) -> str | None:
    """The shared checkpoint folder of the session, if it has one."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return configured.rstrip("/") if configured else None


def stream_folder(spark: SparkSession) -> str:
    """Where streams keep their checkpoints and output: the shared folder, else the warehouse."""
    return folder(spark) or spark.conf.get("spark.sql.warehouse.dir").rstrip("/")


_SCOPES: list[list[tuple[SparkSession, str | None, DataFrame]]] = []


@contextmanager
def temporary() -> Iterator[None]:
    """Remove, at the end, the tables that are staged within."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for spark, path, table in _SCOPES.pop():
            if path is None:
                table.unpersist()
                continue
            place = spark._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def _note(df: DataFrame, path: str | None) -> None:
    if _SCOPES:
        _SCOPES[-1].append((df.sparkSession, path, df))


def stage(df: DataFrame, name: str, outlive: bool = False) -> DataFrame:
    """Make ``df`` once and continue from the written (or stored) table. The work is done here,
    not when the result is read. With ``outlive``, the table stays when the scope it is made in
    ends."""
    place = folder(df.sparkSession)
    if place is None:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        if not outlive:
            _note(kept, None)
        kept.write.format("noop").mode("overwrite").save()
        return kept
    path = f"{place}/cartwright/{name}-{uuid.uuid4().hex}"
    if not outlive:
        _note(df, path)
    df.write.mode("error").parquet(path)
    tidy(df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> bool:
    """Let the driver collect its garbage if its heap has grown to half of what it may take; True if it did.

    Plans, broadcasts and shuffle files of finished jobs go only then, and a driver that is left to
    itself takes all it may before it looks.
    """
    heap = spark._jvm.Runtime.getRuntime()
    if 2 * heap.totalMemory() < heap.maxMemory() or time.monotonic() < _TIDIED[0] + TIDY_SECONDS:
        return False
    gc.collect()
    spark._jvm.System.gc()
    _TIDIED[0] = time.monotonic()
    return True


def build_side(staged: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """A written table as the smaller side of a join: broadcast if it is small, else merged.

    The size is measured in the rows themselves (a compressed file can be far smaller) and held
    against ``spark.sql.autoBroadcastJoinThreshold``. A merge join leaves it to adaptive execution
    to split keys that hold a large share of the rows.
    """
    limit = broadcast_limit(staged.sparkSession) if max_bytes is None else max_bytes
    if limit <= 0:
        return staged.hint("merge")
    size = staged.agg(F.sum(sum((_width(f.name, f.dataType) for f in staged.schema), F.lit(ROW_BYTES)))).first()[0] or 0
    return F.broadcast(staged) if size <= limit else staged.hint("merge")


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast threshold in bytes; 0 or less: no broadcasts."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10m").strip().lower()
    number, unit = re.fullmatch(r"(-?\d+)\s*([a-z]*)", text).groups()
    return int(number) * 1024 ** "bkmgt".index(unit[:1] or "b")


def _width(name: str, kind: DataType) -> Column:
    """Bytes of a value in memory, nearly."""
    value = F.col(f"`{name}`")
    if isinstance(kind, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(value), F.lit(0)) + 16
    if isinstance(kind, ArrayType):
        part = 16 if isinstance(kind.elementType, NumericType) else 256
        return F.coalesce(F.size(value), F.lit(0)) * part + 32
    return F.lit(16)
