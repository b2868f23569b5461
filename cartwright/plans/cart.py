"""Cart state from a log of cart actions.

Applying an action to a quantity q >= 0 is a function of the form "c while q <= t, else q + s",
and such functions are closed under composition. A log can therefore be folded in chunks whose
results are folded again, so a single very active cart is not replayed by one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cartwright.operators.ranking import HOT_GROUP_ROWS, grouped_row_number

CHUNK = 65_536
CART = ["user_id", "product_id"]
ALWAYS = 1 << 60


def action_function(action: Column, delta: Column) -> Column:
    """add: q + 1. remove: 0. delta: max(q + delta, 0), and nothing for a missing item."""
    below = F.when(action == "remove", F.lit(ALWAYS)).when(action == "delta", F.greatest(-delta, F.lit(0)))
    step = F.when(action == "add", F.lit(1)).when(action == "delta", delta).otherwise(F.lit(0))
    return F.struct(
        F.coalesce(below, F.lit(-1)).cast("bigint").alias("t"),
        F.lit(0).cast("bigint").alias("c"),
        step.cast("bigint").alias("s"),
    )


def then(f: Column, g: Column) -> Column:
    """The function that applies ``f`` and then ``g``."""
    return F.struct(
        F.greatest(f["t"], g["t"] - f["s"]).alias("t"),
        F.when(f["c"] <= g["t"], g["c"]).otherwise(f["c"] + g["s"]).alias("c"),
        (f["s"] + g["s"]).alias("s"),
    )


def _fold(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Compose the functions ``f`` of each group in the order of ``n``."""
    same = F.struct(
        F.lit(-1).cast("bigint").alias("t"), F.lit(0).cast("bigint").alias("c"), F.lit(0).cast("bigint").alias("s")
    )
    steps = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("n", "f"))).alias("steps"))
    return steps.withColumn("f", F.aggregate("steps", same, lambda a, x: then(a, x["f"]))).drop("steps")


def folded_actions(events: DataFrame, chunk: int = CHUNK, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """(user_id, product_id, f): what the events do to the quantity of each cart item.

    ``events`` is (event_id, ts, user_id, product_id, action, delta), applied in order of
    (ts, event_id).
    """
    rows = events.withColumns({"_hour": F.date_trunc("hour", "ts"), "_second": F.date_trunc("second", "ts")})
    numbered = grouped_row_number(rows, CART, ["ts", "event_id"], ["_hour", "_second"], "n", hot_rows)
    steps = numbered.select(
        *CART,
        F.floor((F.col("n") - 1) / chunk).alias("chunk"),
        "n",
        action_function(F.col("action"), F.col("delta")).alias("f"),
    )
    chunks = _fold(steps, [*CART, "chunk"]).withColumnRenamed("chunk", "n")
    return _fold(chunks, CART)


def applied(f: Column, qty: Column) -> Column:
    return F.when(qty <= f["t"], f["c"]).otherwise(qty + f["s"])


def cart_state(events: DataFrame, chunk: int = CHUNK, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """(user_id, product_id, qty) of the items that are left in each cart; every cart starts empty."""
    whole = folded_actions(events, chunk, hot_rows)
    qty = applied(F.col("f"), F.lit(0).cast("bigint"))
    return whole.select(*CART, qty.alias("qty")).where(F.col("qty") > 0)


def cart_totals(state: DataFrame, products: DataFrame) -> DataFrame:
    """Items, quantity and amount per user."""
    priced = state.join(products.select("product_id", "price"), "product_id", "left")
    amount = F.sum(F.col("qty") * F.coalesce("price", F.lit(0.0)))
    return priced.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("items"), F.sum("qty").alias("total_qty"), amount.alias("total_amount")
    )
