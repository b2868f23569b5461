"""Offline evaluation: recommendations from prior orders against the held-out last order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.operators.ranking import HOT_GROUP_ROWS, grouped_row_number, top_n

ID_BLOCK_BITS = 16
HISTORY_ORDER = ("order_number", "line_number", "product_id")


def user_history(lines: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """(user_id, position, product_id): every purchase of a user in order.

    One row per purchase, so that a user with very many of them stays spread out.
    """
    rows = lines.select("user_id", *HISTORY_ORDER, F.shiftright("product_id", ID_BLOCK_BITS).alias("_block"))
    blocks = ["order_number", "line_number", "_block"]
    numbered = grouped_row_number(rows, ["user_id"], list(HISTORY_ORDER), blocks, "position", hot_rows)
    return numbered.select("user_id", "position", "product_id")


def user_ground_truth(lines: DataFrame) -> DataFrame:
    """The distinct (user_id, product_id) pairs to be predicted."""
    return lines.select("user_id", "product_id").distinct()


def last_purchases(lines: DataFrame, n: int) -> DataFrame:
    """(user_id, product_id, ..., recency): the n last purchases of a user, 1 = latest."""
    newest = [F.col(c).desc() for c in HISTORY_ORDER]
    return top_n(lines, ["user_id"], newest, n, "recency")


def user_basket(lines: DataFrame, n: int = 10) -> DataFrame:
    """(user_id, basket): the products of the last n purchases, latest first."""
    last = last_purchases(lines.select("user_id", *HISTORY_ORDER), n)
    items = F.array_sort(F.collect_list(F.struct("recency", "product_id")))["product_id"]
    return last.groupBy("user_id").agg(items.alias("basket"))


def requests_for(
    baskets: DataFrame, top_k: int, contexts: DataFrame | None = None, time_bucket: str = "unknown"
) -> DataFrame:
    """One request per user; the context is that of ``contexts`` or the neutral default."""
    if contexts is None:
        place = baskets.withColumns({"time_bucket": F.lit(time_bucket), "is_weekend": F.lit(False)})
    else:
        place = baskets.join(contexts.select("user_id", "time_bucket", "is_weekend"), "user_id")
    return place.select(
        F.col("user_id").alias("request_id"), "user_id", "basket", "time_bucket", "is_weekend", F.lit(top_k).alias("top_k")
    )


def precision(hits: Column, k: int) -> Column:
    return hits / F.lit(float(k)) if k > 0 else F.lit(0.0)


def user_metrics(recs: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Precision, recall, F1 and hit rate at k for every user with at least one recommendation.

    ``recs`` is (user_id, rank, item_id), ``truth`` the distinct relevant pairs.
    """
    top = recs.where(F.col("rank") <= k).select("user_id", F.col("item_id").alias("product_id")).distinct()
    per_rec = recs.groupBy("user_id").agg(F.count(F.lit(1)).alias("n_recs"))
    hits = top.join(truth, ["user_id", "product_id"]).groupBy("user_id").agg(F.count(F.lit(1)).alias("hits"))
    relevant = truth.groupBy("user_id").agg(F.count(F.lit(1)).alias("relevant"))
    joined = per_rec.join(hits, "user_id", "left").join(relevant, "user_id", "left")
    joined = joined.withColumns({c: F.coalesce(c, F.lit(0)) for c in ("hits", "relevant")})
    p = precision(F.col("hits"), k)
    r = F.when(F.col("relevant") == 0, 0.0).otherwise(F.try_divide(F.col("hits"), F.col("relevant")))
    out = joined.withColumns({"precision": p, "recall": r})
    both = F.col("precision") + F.col("recall")
    f1 = F.when(both > 0, 2 * F.col("precision") * F.col("recall") / both).otherwise(0.0)
    hit = F.when(F.col("hits") > 0, 1.0).otherwise(0.0)
    return out.withColumns({"f1": f1, "hit_rate": hit}).select(
        "user_id", "hits", "relevant", "precision", "recall", "f1", "hit_rate"
    )


def user_coverage(users: DataFrame, recs: DataFrame) -> Column:
    """Share of the users with at least one recommendation."""
    served = recs.select("user_id").distinct().withColumn("_s", F.lit(1))
    share = users.select("user_id").distinct().join(served, "user_id", "left")
    return share.agg(F.avg(F.when(F.col("_s").isNull(), 0.0).otherwise(1.0)).alias("c")).scalar()


def item_coverage(recs: DataFrame, catalog: DataFrame) -> Column:
    """Share of the catalog that occurs in any list."""
    used = recs.agg(F.countDistinct("item_id").alias("c")).scalar()
    items = catalog.agg(F.countDistinct("product_id").alias("c")).scalar()
    return F.when(items == 0, 0.0).otherwise(F.try_divide(used, items))


def coverage(users: DataFrame, recs: DataFrame, catalog: DataFrame) -> DataFrame:
    one = users.sparkSession.range(1)
    return one.select(
        F.coalesce(user_coverage(users, recs), F.lit(0.0)).alias("user_coverage"),
        item_coverage(recs, catalog).alias("item_coverage"),
    )


def request_source(metadata: DataFrame) -> DataFrame:
    """The source class of a request: rules, rules+fallback or fallback."""
    kind = (
        F.when((F.col("rule_candidates") > 0) & ~F.col("fallback_used"), "rules")
        .when(F.col("rule_candidates") > 0, "rules+fallback")
        .otherwise("fallback")
    )
    return metadata.select("request_id", kind.alias("source"))


def source_mix(sources: DataFrame) -> DataFrame:
    """Requests and share per source, with the share of requests that rules contributed to."""
    counts = sources.groupBy("source").agg(F.count(F.lit(1)).alias("requests"))
    # One row per source class.
    whole = Window.partitionBy(F.lit(0))
    by_rules = F.when(F.col("source").isin("rules", "rules+fallback"), F.col("requests")).otherwise(0)
    return counts.select(
        "source",
        "requests",
        (F.col("requests") / F.sum("requests").over(whole)).alias("share"),
        (F.sum(by_rules).over(whole) / F.sum("requests").over(whole)).alias("rule_hit_rate"),
    )


def evaluation_users(truth: DataFrame, max_users: int | None = None) -> DataFrame:
    """The users to evaluate: all of them, or the first ones by id."""
    users = truth.select("user_id").distinct()
    return users if max_users is None else users.orderBy("user_id").limit(max_users)


def summarize(metrics: DataFrame, users: DataFrame | None = None) -> DataFrame:
    """Mean metrics over the users (optionally only those of ``users``)."""
    rows = metrics if users is None else metrics.join(users, "user_id", "left_semi")
    names = ("precision", "recall", "f1", "hit_rate")
    return rows.agg(*[F.avg(c).alias(c) for c in names], F.count(F.lit(1)).alias("num_users_evaluated"))


def metric_stability(runs: DataFrame, columns=("precision", "recall", "f1", "hit_rate")) -> DataFrame:
    """Absolute percent change of each metric from one run to the next larger one.

    ``runs`` has one row per evaluation run.
    """
    w = Window.partitionBy(F.lit(0)).orderBy("num_users_evaluated")
    change = [F.abs(F.try_divide(F.col(c), F.lag(c).over(w)) - 1).alias(f"{c}_change") for c in columns]
    last = F.lead("num_users_evaluated").over(w).isNull()
    return runs.select("num_users_evaluated", *columns, *change, last.alias("is_final"))
