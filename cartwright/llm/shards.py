"""Documents dealt to shards of near equal bytes, equal texts together.

Longest-processing-time scheduling: the groups, largest first, go to the least-loaded shard. The
groups are not walked one by one. Their sizes are put into classes (the leading 10 binary digits
of the size, so exact below 1,024 and within 0.2 % above), of which there are at most 1,024 plus
512 for each doubling, however many groups there are. The schedule runs over the classes: the
groups of a class, all of about its mean size, fill the least-loaded shards up to a common level,
and a heap hands out the last ones. That gives each shard a run of places in each class; the
groups take their places by numbering within the class.

A group is never split, so one group of more than a shard's share makes its shard the largest.

Defined cases: a null text counts 8 bytes and all null texts are one group; its checksum is null.
Repeated rows are members of their group like any others and get slots of their own.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.lineage import stage
from cartwright.operators.ranking import block_row_number

SHARDS = 24
ROW_BYTES = 8
BLOCKS = 4096


def size_class(size: Column) -> Column:
    """The size with all but its 10 leading binary digits set to zero."""
    spare = F.greatest(F.length(F.bin(size)) - 10, F.lit(0))
    return (size - F.pmod(size, F.pow(F.lit(2.0), spare).cast("long"))).cast("long")


def schedule(classes: Sequence[tuple[int, int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """(class, shard, first place, last place + 1) from (class, groups, bytes)."""
    loads = [0.0] * shards
    runs = []
    for name, count, total in sorted(classes, reverse=True):
        each = total / count
        given = [0] * shards
        if count > shards:
            # The highest common level that whole groups reach without running out of groups.
            low, high = min(loads), min(loads) + total + each
            for _ in range(60):
                level = (low + high) / 2
                if sum(max(int((level - x) / each), 0) for x in loads) <= count:
                    low = level
                else:
                    high = level
            given = [max(int((low - x) / each), 0) for x in loads]
        heap = [(loads[s] + given[s] * each, s) for s in range(shards)]
        heapq.heapify(heap)
        for _ in range(count - sum(given)):
            load, s = heapq.heappop(heap)
            given[s] += 1
            heapq.heappush(heap, (load + each, s))
        at = 0
        for s, n in enumerate(given):
            loads[s] += n * each
            if n:
                runs.append((name, s, at, at + n))
            at += n
    return runs


def assign(docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS, blocks: int = BLOCKS) -> DataFrame:
    """(id, size, text_crc32, shard, slot); slots count from 0 in each shard."""
    spark = docs.sparkSession
    body = F.encode(F.col(text), "UTF-8")
    rows = docs.select(
        F.col(id).alias("id"),
        (F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("long") + ROW_BYTES).alias("size"),
        F.crc32(body).alias("crc"),
        F.coalesce(F.sha2(F.col(text), 256), F.lit("")).alias("grp"),
    )
    rows = stage(rows, "shard-rows")
    groups = rows.groupBy("grp").agg(F.sum("size").alias("bytes"))
    # Blocks of a class are ranges of the digest, which is what groups are numbered by.
    block = F.conv(F.substring("grp", 1, 8), 16, 10).cast("long")
    groups = groups.withColumns(
        {"class": size_class(F.col("bytes")), "block": F.floor(F.coalesce(block, F.lit(0)) * blocks / F.lit(2**32)).cast("int")}
    )
    groups = stage(groups, "shard-groups")
    plan = groups.groupBy("class").agg(F.count(F.lit(1)).alias("n"), F.sum("bytes").alias("bytes")).collect()
    runs = schedule([(r["class"], r["n"], r["bytes"]) for r in plan], shards)
    numbered = block_row_number(groups, ["class"], ["grp"], ["block"], "place")
    table = spark.createDataFrame(runs, "class long, shard int, low long, high long")
    dealt = numbered.join(F.broadcast(table), (numbered["class"] == table["class"]) & (F.col("place") > F.col("low")) & (F.col("place") <= F.col("high")))
    placed = rows.join(dealt.select("grp", "shard"), "grp")
    placed = placed.select("id", "size", "crc", "shard", F.pmod(F.xxhash64("id", "crc"), F.lit(blocks)).cast("int").alias("block"))
    placed = stage(placed.withColumn("row", F.monotonically_increasing_id()), "shard-placed")
    slotted = block_row_number(placed, ["shard"], ["block", "id", "row"], ["block"], "slot")
    return slotted.select(
        F.col("id").alias(id), "size", F.col("crc").alias("text_crc32"), "shard", (F.col("slot") - 1).cast("long").alias("slot")
    )
