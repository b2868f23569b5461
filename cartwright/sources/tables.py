"""Readers and writers for files of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.plans.prep import require_columns, trim_headers
from cartwright.sources.schemas import SCHEMAS


def read_csv(spark: SparkSession, path: str, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    """A CSV file with a header; columns are found by their trimmed names.

    The header line fixes the order of the columns and the schema their types, so only the
    first line is read ahead. Files may lack columns of the schema, or have others. The files of a
    folder must have the same header: each is checked against the first when it is read.
    """
    header = spark.read.csv(path, header=True, inferSchema=False).columns
    kinds = {f.name: f.dataType.simpleString() for f in SCHEMAS[table].fields}
    schema = ", ".join(f"`{c}` {kinds.get(c.strip(), 'string')}" for c in header)
    df = trim_headers(spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path))
    if columns is None:
        return df
    require_columns(df, columns)
    return df.select(*columns)


def load_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The five raw tables; prior and train lines are one table."""
    raw = {t: read_csv(spark, f"{folder}/{t}.csv", t) for t in ("aisles", "departments", "products", "orders")}
    prior = read_csv(spark, f"{folder}/order_products__prior.csv", "order_products")
    train = read_csv(spark, f"{folder}/order_products__train.csv", "order_products")
    raw["order_products"] = prior.unionByName(train)
    return raw


def read_optional(spark: SparkSession, path: str, table: str) -> DataFrame | None:
    """A table if the file is there, else None."""
    try:
        return read_csv(spark, path, table)
    except AnalysisException as missing:
        if "PATH_NOT_FOUND" in str(missing):
            return None
        raise


def write_table(df: DataFrame, path: str, kind: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    writer = df.write.mode("overwrite").partitionBy(*partition_by)
    writer.option("header", True).csv(path) if kind == "csv" else writer.format(kind).save(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Append run statistics as JSON lines, stamped with the time of the run."""
    stamp = F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss")
    rows.withColumn("timestamp", stamp).write.mode("append").json(f"{path}/json")
    rows.withColumn("timestamp", stamp).write.mode("append").option("header", True).csv(f"{path}/csv")


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_json_files(spark: SparkSession, path: str) -> DataFrame:
    """All JSON documents of a folder, each with the name of its file."""
    df = spark.read.option("multiLine", True).json(path)
    return df.select("*", F.col("_metadata.file_name").alias("source_file"))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
