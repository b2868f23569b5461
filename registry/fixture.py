"""The input of the registered queries: retail tables and the tables served from."""

from __future__ import annotations

import uuid
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.config import BEHAVIOR_FEATURES, SERVE_DEFAULTS, SERVING_LIST_SIZE, TIME_BUCKETS, Mining
from cartwright.lineage import stage, stream_folder
from cartwright.plans import evaluate, features, popularity, popularity_days, prep, recommend, rules, segments
from cartwright.sources import day_counts, name_index, set_counts
from cartwright.sources.facts import bucket_count, stage_buckets
from cartwright.sources.retail import Retail
from cartwright.sources.tables import write_table

# The library's support. The gates are fixed and below the library's, as the given tables are small: some
# contexts of every level pass. A set counts as frequent from five transactions on.
MINING = Mining(
    min_support=0.002, level_min_txns={"L1": 50, "L2": 100, "L3": 200, "L4": 1000, "L5": 0}, floor=50, least_count=5
)
# The evaluation asks in a context without a time of day.
NEUTRAL = recommend.Options(time_buckets=(*TIME_BUCKETS, "unknown"))
TOP_K = 5
BASKET_SIZE = 10
POINTS = ("total_orders", "total_products", "avg_days_between_orders")


class Fixture:
    _known: dict[tuple[str, str], "Fixture"] = {}

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.part, self.brand = Retail(spark, path, "part"), Retail(spark, path, "brand")

    @classmethod
    def of(cls, spark: SparkSession, path: str) -> "Fixture":
        """One per application and folder, so that the tables served from are built once."""
        key = (spark.sparkContext.applicationId, path)
        if key not in cls._known:
            cls._known[key] = cls(spark, path)
        return cls._known[key]

    mining = MINING

    # ---- features and segments --------------------------------------------------------

    @cached_property
    def buckets(self) -> int:
        """Buckets of the facts, from the row count in the files' footers."""
        return bucket_count(self.part.table("lineitem").count())

    def fact(self, rows: DataFrame, name: str) -> DataFrame:
        return stage_buckets(rows, "order_id", self.buckets, name)

    @cached_property
    def orders(self) -> DataFrame:
        return self.fact(self.part.orders(), "orders")

    @cached_property
    def lines(self) -> DataFrame:
        return self.fact(self.part.order_products(self.orders), "lines")

    @cached_property
    def brand_lines(self) -> DataFrame:
        return self.fact(self.brand.order_products(self.orders), "brand-lines")

    @cached_property
    def behavior(self) -> DataFrame:
        return features.behavior_features(self.orders, self.brand_lines)

    @cached_property
    def features(self) -> DataFrame:
        return stage(self.behavior, "behavior-features")

    @cached_property
    def vectors(self) -> DataFrame:
        model = segments.behavior_bounds(self.features)
        return stage(segments.behavior_vectorize(self.features, model), "behavior-vectors")

    @cached_property
    def k_metrics(self) -> DataFrame:
        """Quality of fits of 2 to 9 clusters, ten restarts each."""
        points = segments.as_vectors(self.vectors, BEHAVIOR_FEATURES)
        return stage(segments.find_k(points, BEHAVIOR_FEATURES, range(2, 10), 42, 10), "k-metrics")

    @cached_property
    def preference(self) -> DataFrame:
        return features.preference_features(self.orders, self.lines, self.part.products(), self.part.departments())

    @cached_property
    def lifecycle(self) -> DataFrame:
        return features.lifecycle_features(self.orders)

    @cached_property
    def stages(self) -> DataFrame:
        return stage(segments.lifecycle_stage(self.lifecycle), "stages")

    @cached_property
    def behavior_clusters(self) -> DataFrame:
        """Repeatable stand-in labels; fitted labels are tested by their own queries."""
        return self.part.users().select("user_id", (F.col("user_id") % 5).cast("int").alias("cluster"))

    @cached_property
    def preference_clusters(self) -> DataFrame:
        label = F.expr("cast((user_id div 5) % 5 as int)")
        return self.part.users().select("user_id", label.alias("cluster"))

    @cached_property
    def user_segments(self) -> DataFrame:
        return stage(
            segments.user_segments(
                self.part.users(), self.behavior_clusters, self.preference_clusters, self.stages, SERVE_DEFAULTS
            ),
            "segments",
        )

    # ---- transactions and rules -------------------------------------------------------

    def transactions(self) -> DataFrame:
        orders = prep.attach_users(
            self.orders,
            prep.purchase_frequency(self.features),
            self.stages,
            self.preference_clusters.withColumnRenamed("cluster", "preference_cluster"),
            self.behavior_clusters.withColumnRenamed("cluster", "behavior_cluster"),
        )
        return prep.transactions_context(prep.baskets(orders, self.brand_lines))

    @cached_property
    def brand_transactions(self) -> DataFrame:
        return stage(self.transactions(), "transactions")

    @cached_property
    def itemsets(self) -> DataFrame:
        return stage(rules.frequent_itemsets(self.brand_transactions, self.mining), "itemsets")

    @cached_property
    def index(self) -> DataFrame:
        found = rules.filter_rules(rules.association_rules(self.itemsets), self.mining)
        return stage(rules.build_index(found, self.mining), "index")

    @cached_property
    def updated_itemsets(self) -> DataFrame:
        """Itemsets from a store that gets the transactions in three batches, by quarters (of all years)."""
        path = f"{stream_folder(self.spark)}/cartwright/set-counts-{uuid.uuid4().hex}"
        quarter = F.quarter("order_date").alias("quarter")
        dated = self.brand_transactions.join(self.part.order_heads().select("order_id", quarter), "order_id")
        for name, quarters in (("first half", (1, 2)), ("autumn", (3,)), ("winter", (4,))):
            set_counts.add(dated.where(F.col("quarter").isin(*quarters)), path, name, self.mining)
        set_counts.expire(self.spark, path)
        return set_counts.read(self.spark, path)

    @property
    def rules(self) -> DataFrame:
        return self.index

    # ---- serving ----------------------------------------------------------------------

    @cached_property
    def prior_lines(self) -> DataFrame:
        return self.brand_lines.where(F.col("eval_set") == "prior")

    @cached_property
    def train_lines(self) -> DataFrame:
        return self.brand_lines.where(F.col("eval_set") == "train")

    @cached_property
    def popularity(self) -> DataFrame:
        bought = self.prior_lines.select("user_id", "order_id", "product_id")
        times = prep.order_context(self.part.order_heads()).select("order_id", "time_bucket")
        behavior = self.behavior_clusters.withColumnRenamed("cluster", "behavior_cluster")
        tier, n = popularity.as_tier, SERVING_LIST_SIZE
        parts = (
            tier(popularity.popular_global(bought, n), "global", None),
            tier(popularity.popular_by(bought, self.stages, "user_id", "lifecycle_stage", n), "lifecycle", "lifecycle_stage"),
            tier(popularity.popular_by(bought, behavior, "user_id", "behavior_cluster", n), "behavior", "behavior_cluster"),
            tier(popularity.popular_by(bought, times, "order_id", "time_bucket", n), "time", "time_bucket"),
        )
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return stage(out, "popularity")

    @cached_property
    def day_counts(self) -> str:
        """The store of popularity per day, filled with a batch for each quarter (of all years), so that the days
        of a batch lie between those of others."""
        path = f"{stream_folder(self.spark)}/cartwright/day-counts-{uuid.uuid4().hex}"
        heads = prep.order_context(self.part.order_heads()).select("order_id", "order_date", "time_bucket")
        behavior = self.behavior_clusters.withColumnRenamed("cluster", "behavior_cluster")
        bought = self.prior_lines.select("user_id", "order_id", "product_id").join(heads, "order_id")
        bought = prep.attach_users(bought, self.stages, behavior)
        tiers = {"global": None, "lifecycle": "lifecycle_stage", "behavior": "behavior_cluster", "time": "time_bucket"}
        counts = stage(popularity_days.day_counts(bought, tiers), "day-counts")
        for quarter in range(1, 5):
            day_counts.add(counts.where(F.quarter("day") == quarter), path, f"quarter-{quarter}")
        day_counts.compact(self.spark, path)
        return path

    @cached_property
    def order_files(self) -> str:
        """The orders as CSV files with columns that no schema knows."""
        path = f"{stream_folder(self.spark)}/cartwright/order-files-{uuid.uuid4().hex}"
        rows = self.orders.withColumns(
            {
                "weekend": F.col("order_dow").isin(0, 6),
                # The first order of a user has no order before it: no number, but a word.
                "gap": F.coalesce(F.col("days_since_prior_order").cast("string"), F.lit("first")),
                # Not a number in a column that has to be one.
                "order_number": F.when(F.col("order_hour_of_day") == 0, "midnight").otherwise(F.col("order_number").cast("string")),
            }
        )
        write_table(rows, path, "csv")
        return path

    @cached_property
    def name_index(self) -> str:
        """Posting lists of the names of all products."""
        path = f"{stream_folder(self.spark)}/cartwright/names-{uuid.uuid4().hex}"
        name_index.build(self.part.products(), path)
        return path

    @cached_property
    def brand_products(self) -> DataFrame:
        products = self.brand.products().join(self.brand.departments(), "department_id")
        return stage(products, "products")

    @cached_property
    def behavior_scores(self) -> DataFrame:
        return stage(
            segments.behavior_department_score(self.prior_lines, self.brand_products, self.behavior_clusters),
            "behavior-scores",
        )

    @cached_property
    def preference_scores(self) -> DataFrame:
        return stage(segments.preference_department_score(self.preference, self.preference_clusters), "preference-scores")

    @cached_property
    def tables(self) -> recommend.Tables:
        return recommend.Tables(
            rules=self.rules,
            popularity=self.popularity,
            products=self.brand_products,
            behavior_scores=self.behavior_scores,
            preference_scores=self.preference_scores,
            segments=self.user_segments,
        )

    @cached_property
    def requests(self) -> DataFrame:
        """One request per user: the last prior purchases in the context of the last order."""
        last = self.orders.where(F.col("eval_set") == "train")
        place = prep.order_context(last).select("user_id", "time_bucket", F.col("is_weekend").cast("boolean").alias("is_weekend"))
        baskets = place.select("user_id").join(evaluate.user_basket(self.prior_lines, BASKET_SIZE), "user_id", "left")
        empty = F.expr("cast(array() as array<bigint>)")
        baskets = baskets.withColumn("basket", F.coalesce("basket", empty))
        return stage(evaluate.requests_for(baskets, TOP_K, place), "requests")

    @cached_property
    def served(self) -> recommend.Stages:
        run = recommend.recommend(self.requests, self.tables)
        return replace(run, final=stage(run.final, "final"))

    @cached_property
    def recommendations(self) -> DataFrame:
        return stage(recommend.recommendation_rows(self.served.final), "recommendations")

    @cached_property
    def evaluated(self) -> DataFrame:
        """Per-user metrics of the neutral-context evaluation with the last five purchases."""
        baskets = evaluate.user_basket(self.prior_lines, 5)
        truth = evaluate.user_ground_truth(self.train_lines)
        baskets = baskets.join(evaluate.evaluation_users(truth), "user_id", "left_semi")
        run = recommend.recommend(evaluate.requests_for(baskets, TOP_K), self.tables, NEUTRAL)
        rows = recommend.recommendation_rows(run.final)
        return stage(evaluate.user_metrics(rows, truth, TOP_K), "user-metrics")
