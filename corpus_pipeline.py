"""Documents to token ids, in five stages.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps, whole, with the columns of
``documents``; the last returns ids of tokens instead of texts. ``run`` writes the rows of each
stage where the cluster's shared folder is and reads them back for the next.

Defined cases: an empty table passes through all stages. Rows without a text or with an empty one
are judged like any other: the classifier scores them, line dedup leaves them alone, near-dedup keeps
one of them, and they have no token. Rows without an id and rows that repeat one are judged by their
texts in near-dedup and decontamination: each group of near copies keeps one row, whatever its ids
are. Columns beyond those of ``documents`` are carried along.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.lineage import stage, temporary
from cartwright.llm import decontaminate, line_dedup, near_copies, quality_model, row_keys, sentencepiece_codec, simhash

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def _same_columns(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return rows.select(*docs.columns)


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the quality model scores at its threshold or above."""
    machine = quality_model.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = quality_model.score(docs, machine, keep_text=True)
    return _same_columns(scored.where(F.col("score") >= quality_model.THRESHOLD), docs)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier document holds; ``n_chars`` is counted anew."""
    left = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        left = left.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return _same_columns(left, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near copies: the least by id, rows without an id last.

    Near copies are linked by SimHash, as in ``op4_simhash``, or have a Jaccard similarity of 0.8."""
    rows, key = row_keys.keyed(docs, "near-copy-rows")
    with temporary():
        groups = simhash.near_duplicates(rows, key, more=near_copies.similar(rows, key)).select(key, "component_id")
        named = stage(rows.select("doc_id", key).join(groups, key), "near-copy-groups")
        order = F.struct(F.col("doc_id").isNull().alias("nameless"), F.col("doc_id").alias("id"), F.col(key).alias("key"))
        least = named.groupBy("component_id").agg(F.min(order)["key"].alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1")
        gone = named.join(least, "component_id").where(F.col(key) != F.col("least")).select(key)
        gone = stage(gone, "near-copies", outlive=True)
    return _same_columns(row_keys.without(rows, gone, key), docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents with a passage of the benchmark."""
    rows, key = row_keys.keyed(docs, "contaminated-rows")
    with temporary():
        found = decontaminate.decontaminate(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id=key)
        gone = stage(found.where("n_hit > 0").select(key), "contaminated", outlive=True)
    return _same_columns(row_keys.without(rows, gone, key), docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of each document."""
    ids = sentencepiece_codec.encode(docs.select("doc_id", "text"), keep_text=False)
    return ids.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", classify),
    ("line_dedup", drop_lines),
    ("simhash_near_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("sentencepiece", tokenize),
]

# A fitted classifier has no SQL; tests hold the stages against plain Python versions.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
