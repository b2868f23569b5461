"""Retail tables derived from the TPC-H style tables.

A *product* is a part (``grain="part"``) or a brand (``grain="brand"``); the department is the
part type and the aisle is the brand. Rules need items that recur together, which brands do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwright.operators.ranking import HOT_GROUP_ROWS, block_row_number, first_row, split_hot

ID_BLOCK_BITS = 16


class Retail:
    def __init__(self, spark: SparkSession, path: str, grain: str = "part", hot_rows: int = HOT_GROUP_ROWS):
        self.spark, self.path, self.grain, self.hot_rows = spark, path.rstrip("/"), grain, hot_rows

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")

    # ---- dimensions -------------------------------------------------------------------

    def _names(self, column: str) -> Column:
        """Sorted distinct names of a small dimension; an id is a position in it."""
        return self.table("part").agg(F.array_sort(F.collect_set(column)).alias("names")).scalar()

    def _dimension(self, column: str, key: str, name: str) -> DataFrame:
        names = self.table("part").agg(F.array_sort(F.collect_set(column)).alias("names"))
        exploded = names.select(F.posexplode("names").alias("pos", name))
        return exploded.select((F.col("pos") + 1).cast("bigint").alias(key), name)

    def departments(self) -> DataFrame:
        return self._dimension("p_type", "department_id", "department")

    def aisles(self) -> DataFrame:
        return self._dimension("p_brand", "aisle_id", "aisle")

    def products(self) -> DataFrame:
        part = self.table("part")
        brand = F.array_position(self._names("p_brand"), F.col("p_brand")).cast("bigint")
        if self.grain == "part":
            return part.select(
                F.col("p_partkey").alias("product_id"),
                F.col("p_name").alias("product_name"),
                brand.alias("aisle_id"),
                F.array_position(self._names("p_type"), F.col("p_type")).cast("bigint").alias("department_id"),
                F.col("p_retailprice").alias("price"),
            )
        # The department of a brand is the most frequent type of its parts.
        usual = (
            part.groupBy("p_brand", "p_type")
            .agg(F.count(F.lit(1)).alias("n"), F.min("p_retailprice").alias("price"))
            .groupBy("p_brand")
            .agg(F.min(F.struct((-F.col("n")).alias("n"), "p_type")).alias("t"), F.min("price").alias("price"))
        )
        return usual.select(
            brand.alias("product_id"),
            F.col("p_brand").alias("product_name"),
            brand.alias("aisle_id"),
            F.array_position(self._names("p_type"), F.col("t.p_type")).cast("bigint").alias("department_id"),
            "price",
        )

    def users(self) -> DataFrame:
        return self.table("customer").select(F.col("c_custkey").alias("user_id"))

    # ---- facts ------------------------------------------------------------------------

    def order_heads(self) -> DataFrame:
        """Orders without their place in the user's history; a scan, no shuffle."""
        return self.table("orders").select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderdate").cast("date").alias("order_date"),
            (F.dayofweek("o_orderdate") - 1).alias("order_dow"),
            # The dates carry no time of day, so the hour is derived from the order id.
            F.pmod(F.col("o_orderkey") * 7, F.lit(24)).cast("int").alias("order_hour_of_day"),
        )

    def orders(self) -> DataFrame:
        """Orders with order_number, days_since_prior_order and eval_set (train = last order)."""
        heads = self.order_heads()
        columns = heads.columns
        plain, hot = split_hot(heads, ["user_id"], self.hot_rows)
        seq = Window.partitionBy("user_id").orderBy("order_date", "order_id")
        everything = Window.partitionBy("user_id")
        plain = plain.select(
            *columns,
            F.row_number().over(seq).cast("bigint").alias("order_number"),
            F.lag("order_date").over(seq).alias("_prior"),
            F.count(F.lit(1)).over(everything).alias("_orders"),
        )
        # A hot user is numbered by day and block of ids; the order before is found by its number.
        hot = hot.withColumn("_block", F.shiftright("order_id", ID_BLOCK_BITS))
        hot = block_row_number(hot, ["user_id"], ["order_date", "order_id"], ["order_date", "_block"], "order_number")
        before = hot.select("user_id", (F.col("order_number") + 1).alias("order_number"), F.col("order_date").alias("_prior"))
        totals = hot.groupBy("user_id").agg(F.count(F.lit(1)).alias("_orders"))
        hot = hot.join(before, ["user_id", "order_number"], "left").join(totals, "user_id")
        both = plain.unionByName(hot.select(*plain.columns))
        return both.select(
            *columns,
            F.col("order_number").cast("int").alias("order_number"),
            F.datediff("order_date", "_prior").cast("double").alias("days_since_prior_order"),
            F.when(F.col("order_number") == F.col("_orders"), "train").otherwise("prior").alias("eval_set"),
        )

    def raw_lines(self) -> DataFrame:
        """Order lines as delivered: an (order, product) pair may occur more than once."""
        lines = self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_linenumber").alias("line_number"),
            F.col("l_suppkey").alias("supplier_id"),
            F.col("l_quantity").alias("quantity"),
            F.col("l_extendedprice").alias("extended_price"),
        )
        if self.grain == "part":
            return lines
        brands = self.table("part").select(
            F.col("p_partkey").alias("product_id"),
            F.array_position(self._names("p_brand"), F.col("p_brand")).cast("bigint").alias("brand_id"),
        )
        return lines.join(brands, "product_id").drop("product_id").withColumnRenamed("brand_id", "product_id")

    def basket_lines(self, *extra: str) -> DataFrame:
        """(order_id, product_id, line_number), one row per pair, the least line kept.

        Lines of parts can bring further columns along.
        """
        if self.grain == "part":
            kept = first_row(
                self.raw_lines(),
                ["order_id", "product_id"],
                ["line_number", "supplier_id", "quantity", "extended_price"],
            )
            return kept.select("order_id", "product_id", "line_number", *extra)
        return self.raw_lines().groupBy("order_id", "product_id").agg(F.min("line_number").alias("line_number"))

    def order_products(self, orders: DataFrame | None = None, *extra: str) -> DataFrame:
        """Clean lines with user_id, order_number, eval_set and the reordered flag."""
        orders = self.orders() if orders is None else orders
        lines = self.basket_lines(*extra).join(orders.select("order_id", "user_id", "order_number", "eval_set"), "order_id")
        # One pass over the lines: a user buys a product in no more lines than the user has orders.
        before = F.min("order_number").over(Window.partitionBy("user_id", "product_id"))
        return lines.withColumn("_first", before).select(
            "order_id",
            "product_id",
            "line_number",
            *extra,
            (F.col("order_number") > F.col("_first")).cast("int").alias("reordered"),
            "user_id",
            "order_number",
            "eval_set",
        )

    def cart_events(self) -> DataFrame:
        """click = add, error = delta -1, signup = remove; the product is ``props.k``."""
        return cart_actions(self.table("events"))


def cart_actions(events: DataFrame) -> DataFrame:
    action = (
        F.when(F.col("event_type") == "click", "add")
        .when(F.col("event_type") == "error", "delta")
        .when(F.col("event_type") == "signup", "remove")
    )
    return events.select(
        "event_id",
        "ts",
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
        action.alias("action"),
        F.when(action == "delta", F.lit(-1)).otherwise(F.lit(0)).alias("delta"),
    ).where(F.col("action").isNotNull())
