"""Keys for rows whose ids may be null or shared, and dropping rows by them.

Rows of a table in files are named by file and place, which needs no copy of the rows; other
rows are written with a key. Rows are dropped without shuffling those that stay: a Bloom filter of
fixed size over the keys to drop lets nearly all others through at once, and only what it holds
is compared. The input must give the same rows each time it is read, as tables in files do.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.lineage import broadcast_limit, build_side, stage
from cartwright.llm import bloom

FILE_ROWS_BITS = 40
FILTER_BITS, PROBES = 1 << 25, 4


def free_name(docs: DataFrame, name: str) -> str:
    while name.lower() in [c.lower() for c in docs.columns]:
        name += "_"
    return name


def keyed(docs: DataFrame, name: str) -> tuple[DataFrame, str]:
    """(the rows with a whole number of their own, its name)."""
    key = free_name(docs, "row_key")
    path, place = free_name(docs, "_file"), free_name(docs, "_place")
    try:
        located = docs.select("*", F.col("_metadata.file_path").alias(path), F.col("_metadata.row_index").alias(place))
    except AnalysisException:
        return stage(docs.withColumn(key, F.monotonically_increasing_id()), name), key
    number = F.row_number().over(Window.orderBy(path)).cast("long")
    files = stage(located.select(path).distinct().select(path, number.alias(key)), f"{name}-files", outlive=True)
    numbered = located.join(build_side(files), path)
    return numbered.select(*[f"`{c}`" for c in docs.columns], (F.shiftleft(key, FILE_ROWS_BITS) + F.col(place)).alias(key)), key


def without(rows: DataFrame, gone: DataFrame, key: str) -> DataFrame:
    """The rows whose key is not in ``gone``, a written table of distinct keys."""
    if gone.agg(F.count(F.lit(1))).first()[0] * 48 <= broadcast_limit(rows.sparkSession):
        return rows.join(F.broadcast(gone), key, "left_anti")
    marks = bloom.build(gone.select(key), FILTER_BITS, PROBES)
    shared = rows.sparkSession.sparkContext.broadcast(marks)
    flag = free_name(rows, "suspect")

    @F.pandas_udf("boolean")
    def suspected(keys: pd.Series) -> pd.Series:
        return pd.Series(bloom.holds(shared.value, keys.to_numpy(np.int64).view(np.uint64), FILTER_BITS, PROBES))

    flagged = rows.withColumn(flag, suspected(F.col(key)))
    rest = flagged.where(flag).join(gone.hint("merge"), key, "left_anti")
    return flagged.where(~F.col(flag)).unionByName(rest).drop(flag)
