"""Cart state and cart boosts as streams of cart events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwright.functions.context import time_bucket
from cartwright.lineage import temporary
from cartwright.plans.cart import CART, applied, folded_actions
from cartwright.plans.recommend import Options, Tables, cart_boost, recommend
from cartwright.streaming import cart_store


def cart_state_stream(events: DataFrame, out: str, state: str, checkpoint: str):
    """Write (user_id, product_id, qty, ts) of every item a micro-batch touches; qty 0: it left the cart.

    The actions of a micro-batch are folded into one function per item, like those of a whole log,
    and applied to the quantities before it. Within a micro-batch they go by event time. Between
    micro-batches they go by arrival: an action that arrives late is applied when it arrives, after
    actions of a later time that were there before it, as the shop does. Returns the running query.

    The quantities are kept in a store (``streaming.cart_store``) to which a micro-batch adds what it
    touches; a batch that is replayed starts from the same state and gives the same result.
    ``cart_store.read_carts`` reads what is in the carts now.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        apply_batch(batch, batch_id, out, state)

    return (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def apply_batch(batch: DataFrame, batch_id: int, out: str, state: str) -> None:
    """Apply the actions of one micro-batch to the quantities that the one before has left."""
    spark = batch.sparkSession
    batch = batch.select("event_id", "ts", *CART, "action", "delta")
    last = batch.groupBy(*CART).agg(F.max("ts").alias("ts"))
    changes = folded_actions(batch).join(last, CART).withColumn("bucket", cart_store.bucket()).persist()
    try:
        buckets = [r[0] for r in changes.select("bucket").distinct().collect()]
        known = cart_store.manifest(spark, state, batch_id - 1)
        before = cart_store.quantities(spark, state, known, buckets).select(*CART, F.col("qty").alias("held"))
        qty = applied(F.col("f"), F.coalesce("held", F.lit(0)))
        after = changes.join(before, CART, "left").select(*CART, qty.alias("qty"), "ts")
        after.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    finally:
        changes.unpersist()
    # What was written is the result; it is not worked out a second time.
    touched = spark.read.schema("user_id long, product_id long, qty long").parquet(f"{out}/batch={batch_id}")
    cart_store.commit(spark, state, known, batch_id, touched)


def boost_requests(adds: DataFrame, top_k: int = 5) -> DataFrame:
    """One request per add-to-cart event: the basket is the added product."""
    return adds.select(
        F.col("event_id").alias("request_id"),
        "user_id",
        F.array("product_id").alias("basket"),
        time_bucket(F.hour("ts")).alias("time_bucket"),
        F.dayofweek("ts").isin(1, 7).alias("is_weekend"),
        F.lit(top_k).alias("top_k"),
    )


def boost_batch(adds: DataFrame, tables: Tables, opts: Options = Options(), top_k: int = 5) -> DataFrame:
    requests = boost_requests(adds, top_k)
    return cart_boost(recommend(requests, tables, opts), requests)


def boost_stream(adds: DataFrame, tables: Tables, out: str, checkpoint: str, opts: Options = Options()):
    """Write the boosts of every micro-batch of add events; returns the streaming query.

    Each micro-batch overwrites its own folder, so a replayed batch does not double its rows.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        with temporary():
            boost_batch(batch, tables, opts).write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return (
        adds.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
