"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.lineage import stage
from cartwright.llm import chat_format, decontaminate, licenses, line_dedup, oracles, oracles_more, quality_model, quality_rules, sentencepiece_codec, shards, simhash, source_audit, suffix_dedup, url_filter, vector_codes

__all__ = ["ORACLES", "QUERIES"]

ORACLES = {**oracles.ORACLES, "op11_source_audit": oracles_more.AUDIT, "op13_vector_codes": oracles_more.vector_codes()}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows found in documents."""
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op2_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards of near equal bytes."""
    dealt = shards.assign(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the cascade."""
    judged = quality_rules.judge(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and the groups their links form."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that an earlier document holds, dropped."""
    left = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return left.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ids of every document, and whether they decode to its text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = sentencepiece_codec.encode(docs, keep_text=False, check="round_trip")
    return coded.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"), "ids", "round_trip")


def op7_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices and expressions of documents."""
    return licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = quality_model.fit(docs, table(spark, sf_dir, "labels"))
    return quality_model.score(docs, machine).select(
        "doc_id",
        quality_model.held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= quality_model.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and the verdict of every page."""
    judged = url_filter.judge(table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 bytes that an earlier document has, removed."""
    left = suffix_dedup.dedup_passages(table(spark, sf_dir, "documents"))
    return left.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op11_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources against each other and against their language."""
    return source_audit.audit(table(spark, sf_dir, "documents").select("lang", "source", "text"))


def op12_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as text, read back; one more of them says control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    odd = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.read_back(chat_format.format_conversations(rows.unionByName(odd)))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The code of every usable vector, under codebooks of all of them."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    codebooks = vector_codes.fit(vectors)
    coded = stage(vector_codes.encode(vectors, codebooks).select("vec_id", "label", "code", "error"), "vector-codes")
    return vector_codes.group_errors(coded).select(
        "vec_id", "code", "error", "label_error", F.lit(codebooks.sha256()).alias("codebooks_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_shards": op2_shards,
    "op3_quality_rules": op3_quality_rules,
    "op4_simhash": op4_simhash,
    "op5_line_dedup": op5_line_dedup,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_licenses": op7_licenses,
    "op8_quality_model": op8_quality_model,
    "op9_url_filter": op9_url_filter,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_source_audit": op11_source_audit,
    "op12_chat_format": op12_chat_format,
    "op13_vector_codes": op13_vector_codes,
}
