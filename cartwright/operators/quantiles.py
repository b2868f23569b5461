"""Exact linearly interpolated quantiles without gathering a column in one task.

Values become 64-bit whole numbers in the same order. Of these, the leading 16 bits are counted
in each task and the counts added up; the wanted position falls into one of the counted buckets,
and only the rows of that bucket are counted by the next 16 bits, and so on. After four rounds
the bucket is one value. A round shuffles at most 65,536 counts for each task and bucket and no
values, whatever the data are; all groups and probabilities go through the same four rounds.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from cartwright.lineage import build_side, stage

# The function that runs in tasks travels with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DIGIT = 16
SMALL_GROUP = 100_000


def unpivot(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Long form (keep..., feature, value)."""
    pairs = F.explode(
        F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    return df.select(*keep, pairs.alias("_p")).select(*keep, "_p.feature", "_p.value")


def exact_quantiles(
    values: DataFrame, probs: Sequence[float], group: Sequence[str] = ("feature",), small: int = SMALL_GROUP
) -> DataFrame:
    """(group..., q, quantile) for a table (group..., value); nulls are ignored, NaN is the largest value.

    Sizes of groups are counted here. Where none has more than ``small`` rows, one aggregation
    orders each of them; larger ones are selected by digits. Both give the same values.
    """
    values = values.where(F.col("value").isNotNull()).select(*group, F.col("value").cast("double").alias("value"))
    sizes = values.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    largest = sizes.agg(F.max("n")).first()[0] or 0
    wanted = F.explode(F.array(*[F.lit(float(p)) for p in sorted(set(probs))]))
    if largest <= small:
        lists = values.groupBy(*group).agg(F.array_sort(F.collect_list("value")).alias("l"))
        at = lists.withColumn("q", wanted).withColumn("pos", F.col("q") * (F.size("l") - 1))
        ends = at.select(*group, "q", "pos", F.get("l", F.floor("pos").cast("int")).alias("a"), F.get("l", F.ceil("pos").cast("int")).alias("b"))
    else:
        at = stage(sizes.withColumn("q", wanted).withColumn("pos", F.col("q") * (F.col("n") - 1)).drop("n"), "quantile-positions")
        places = at.select(*group, F.explode(F.array(F.floor("pos"), F.ceil("pos"))).alias("place")).distinct()
        found = values_at(values, places, group)
        one = found.select(*group, F.col("place").alias("_low"), F.col("value").alias("a"))
        two = found.select(*group, F.col("place").alias("_high"), F.col("value").alias("b"))
        ends = at.withColumns({"_low": F.floor("pos"), "_high": F.ceil("pos")}).join(one, [*group, "_low"]).join(two, [*group, "_high"])
    value = F.col("a") + (F.col("b") - F.col("a")) * (F.col("pos") - F.floor("pos"))
    return ends.select(*group, "q", value.alias("quantile"))


def values_at(values: DataFrame, places: DataFrame, group: Sequence[str]) -> DataFrame:
    """(group..., place, value): the values that stand at some places of their group's order, counted
    from 0, by four rounds of counting digits."""
    keyed = values.mapInArrow(_keyed, StructType([*values.schema.fields, StructField("key", LongType())]))
    # Of each place: the bits known so far, and how many rows of these bits stand before it.
    open_ = places.select(*group, "place", F.lit(0).cast("long").alias("prefix"), F.col("place").alias("left"))
    for known in range(0, 64, DIGIT):
        prefix = F.shiftright("key", 64 - known) if known else F.lit(0).cast("long")
        digit = F.shiftright("key", 64 - known - DIGIT)
        rows = keyed.select(*group, prefix.alias("prefix"), digit.alias("next"), "value")
        if known:
            rows = rows.join(build_side(open_.select(*group, "prefix").distinct()), [*group, "prefix"], "left_semi")
        counts = rows.groupBy(*group, "prefix", "next").agg(F.count(F.lit(1)).alias("c"), F.min("value").alias("value"))
        upto = F.sum("c").over(Window.partitionBy(*group, "prefix").orderBy("next"))
        counts = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("c"))
        met = counts.join(open_.select(*group, "place", "prefix", "left"), [*group, "prefix"]).where("left >= before and left < upto")
        open_ = met.select(*group, "place", F.col("next").alias("prefix"), (F.col("left") - F.col("before")).alias("left"), "value")
        open_ = stage(open_, f"quantile-digits-{known}")
    return open_.select(*group, "place", "value")


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds whole numbers in the order of the doubles. Both zeros are one value, and so are all NaN."""
    for batch in batches:
        value = batch.column("value").to_numpy(zero_copy_only=False) + 0.0
        bits = np.where(np.isnan(value), np.nan, value).view(np.int64)
        key = bits ^ ((bits >> 63) & np.int64((1 << 63) - 1))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], [*batch.schema.names, "key"])


def quantile_struct(df: DataFrame, wanted: dict[str, tuple[str, float]]):
    """Scalar struct column: name -> quantile ``(column, probability)`` of ``df``."""
    columns = sorted({c for c, _ in wanted.values()})
    probs = sorted({p for _, p in wanted.values()})
    table = exact_quantiles(unpivot(df, columns), probs)
    picked = [
        F.max(F.when((F.col("feature") == c) & (F.col("q") == float(p)), F.col("quantile"))).alias(name)
        for name, (c, p) in wanted.items()
    ]
    return table.agg(*picked).select(F.struct(*wanted).alias("t")).scalar()
