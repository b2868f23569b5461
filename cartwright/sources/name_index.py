"""Posting lists of the grams of product names, for searches that do not read all names.

A gram is three characters of a lower-cased name; the last two of a name begin shorter ones. ``build``
writes, for each gram and block of ids, the ordered ids of the products whose name holds it, so no list
is longer than a block, in buckets of the gram's first character and in order of the gram. A search reads the buckets of
its grams, and of these the parts that can hold them; what is left after the lists met is compared
with the text itself, so results are those of ``plans.catalog.search``.

A text of one or two characters is looked up as the beginning of grams. Products without a name or an id
are in no list. The index is of the products it was built from: later ones are not found.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.lineage import build_side, stage
from cartwright.plans import catalog

GRAM = 3
BLOCK_BITS = 16
BUCKETS = 64
POSTINGS = "gram string, block long, ids array<long>, bucket int"
TOTALS = "gram string, products long"


def build(products: DataFrame, path: str) -> None:
    """Write ``postings`` and, for searches of many texts, how many products each gram has."""
    name = F.lower("product_name")
    named = products.select("product_id", name.alias("name")).where("product_id IS NOT NULL AND length(name) > 0")
    gram = F.explode(F.expr(f"array_distinct(transform(sequence(1, length(name)), i -> substring(name, i, {GRAM})))"))
    pairs = named.select("product_id", gram.alias("gram"))
    lists = pairs.groupBy("gram", F.shiftright("product_id", BLOCK_BITS).alias("block")).agg(F.collect_set("product_id").alias("ids"))
    rows = lists.select("gram", "block", F.sort_array("ids").alias("ids"), F.pmod(F.ascii("gram"), F.lit(BUCKETS)).alias("bucket"))
    rows = rows.hint("rebalance", "bucket").sortWithinPartitions("bucket", "gram", "block")
    rows.write.mode("error").partitionBy("bucket").parquet(f"{path}/postings")
    postings = _postings(products.sparkSession, path)
    totals = postings.groupBy("gram").agg(F.sum(F.size("ids")).alias("products"))
    totals.write.mode("error").parquet(f"{path}/totals")


def candidates(spark: SparkSession, path: str, text: str) -> DataFrame:
    """(product_id) of products whose names hold all grams of a text, which is not empty."""
    text = text.lower()
    grams = sorted({text[i : i + GRAM] for i in range(len(text) - GRAM + 1)}) or [text]
    lists = _postings(spark, path).where(F.col("bucket").isin(sorted({ord(g[0]) % BUCKETS for g in grams})))
    if len(text) < GRAM:
        return lists.where(F.col("gram").startswith(text)).select(F.explode("ids").alias("product_id")).distinct()
    lists = lists.where(F.col("gram").isin(grams))
    # The shortest list comes first; the others can only take ids away from it.
    per = lists.groupBy("block").agg(F.array_sort(F.collect_list(F.struct(F.size("ids").alias("n"), "ids"))).alias("l"))
    met = per.where(F.size("l") == len(grams)).select(F.col("l.ids").alias("l"))
    both = F.reduce(F.expr("slice(l, 2, size(l))"), F.col("l")[0], F.array_intersect)
    return met.select(F.explode(both).alias("product_id"))


def search(products: DataFrame, path: str, text: str) -> DataFrame:
    """The products whose name contains ``text`` in any case; all of them for an empty text."""
    if not text:
        return products
    found = products.join(candidates(products.sparkSession, path, text), "product_id", "left_semi")
    return catalog.search(found, text)


def search_many(texts: DataFrame, products: DataFrame, path: str) -> DataFrame:
    """(text, product_id, product_name) for a table of texts, each text once; an empty one finds nothing.

    Only the lists of a text's rarest gram are read, and every product in them is compared.
    """
    spark = products.sparkSession
    postings = _postings(spark, path)
    asked = texts.select("text", F.lower("text").alias("low")).where("length(low) > 0").distinct()
    long, short = asked.where(F.length("low") >= GRAM), asked.where(F.length("low") < GRAM)
    gram = F.explode(F.expr(f"transform(sequence(1, length(low) - {GRAM - 1}), i -> substring(low, i, {GRAM}))"))
    totals = spark.read.schema(TOTALS).parquet(f"{path}/totals")
    counted = long.select("text", "low", gram.alias("gram")).join(totals, "gram", "left")
    rarest = counted.groupBy("text", "low").agg(
        F.min(F.struct("products", "gram")).alias("least"), F.bool_and(F.col("products").isNotNull()).alias("all_known")
    )
    keys = [rarest.where("all_known").select("text", "low", F.col("least.gram").alias("gram"))]
    for size in range(1, GRAM):
        begins = totals.select("gram", F.substring("gram", 1, size).alias("low"))
        keys.append(short.where(F.length("low") == size).join(begins, "low").select("text", "low", "gram"))
    wanted = keys[0].unionByName(keys[1]).unionByName(keys[2])
    wanted = build_side(stage(wanted.withColumn("bucket", F.pmod(F.ascii("gram"), F.lit(BUCKETS))), "wanted-grams"))
    pairs = postings.join(wanted, ["bucket", "gram"]).select("text", "low", F.explode("ids").alias("product_id"))
    # A short text can stand at the beginning of several grams of a name.
    pairs = pairs.where(F.length("low") >= GRAM).unionByName(pairs.where(F.length("low") < GRAM).distinct())
    named = pairs.join(products.select("product_id", "product_name"), "product_id")
    return named.where(F.contains(F.lower("product_name"), F.col("low"))).select("text", "product_id", "product_name")


def _postings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(POSTINGS).parquet(f"{path}/postings")
