import datetime

import pytest
from pyspark.sql import functions as F

from cartwright.config import SERVE_DEFAULTS
from cartwright.plans import features, prep, segments
from cartwright.plans.evaluate import user_history


def test_clean_and_finite(spark):
    orders = spark.createDataFrame([(1, 7, 3, 10), (2, None, 3, 10)], "order_id int, user_id int, order_dow int, order_hour_of_day int")
    clean = prep.clean_orders(orders)
    assert clean.count() == 1 and dict(clean.dtypes)["order_dow"] == "tinyint"
    values = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (float("inf"),), (float("-inf"),)], "x double")
    assert [r.x for r in prep.finite_rows(values, ["x"]).collect()] == [1.0]
    names = spark.createDataFrame([("  Red RING ",)], "product_name string")
    assert prep.clean_products(names).first()[0] == "red ring"


def test_missing_columns_and_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` a` int, `b ` int")
    assert prep.trim_headers(df).columns == ["a", "b"]
    with pytest.raises(ValueError, match="c"):
        prep.require_columns(df, ["c"])


def test_baskets_cap_and_minimum(spark):
    lines = [(1, p, p) for p in range(1, 26)] + [(2, 5, 1)] + [(3, 9, 2), (3, 4, 2)]
    df = spark.createDataFrame(lines, "order_id long, product_id long, line_number int")
    orders = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1)], "order_id long, user_id long")
    got = {r.order_id: r for r in prep.baskets(orders, df).collect()}
    assert set(got) == {1, 3}
    assert got[1].products == list(range(1, 26)) and got[1].basket_size == 25
    assert got[3].products == [4, 9]
    cut = {r.order_id: r for r in prep.baskets(orders, df, max_items=20).collect()}
    assert cut[1].products == list(range(1, 21)) and cut[1].basket_size == 20 and cut[3].products == [4, 9]


def test_transactions_context_defaults(spark):
    rows = [(1, 7, [1, 2], 2, 5, 6)]
    df = spark.createDataFrame(rows, "order_id long, user_id long, products array<long>, basket_size int, order_hour_of_day int, order_dow int")
    row = prep.transactions_context(df).first()
    assert (row.purchase_frequency, row.lifecycle_stage, row.preference_cluster) == ("medium", "new", 0)
    assert row.context_L4 == "time_bucket=night|is_weekend=1" and row.context_L5 == "GLOBAL"


def test_features(spark):
    day = datetime.date(2020, 1, 1)
    orders = spark.createDataFrame(
        [(1, 7, 1, None, day), (2, 7, 2, 4.0, day), (3, 8, 1, None, day)],
        "order_id long, user_id long, order_number int, days_since_prior_order double, d date",
    )
    lines = spark.createDataFrame([(1, 5, 0), (2, 5, 1), (2, 6, 0)], "order_id long, product_id long, reordered int")
    got = {r.user_id: r for r in features.behavior_features(orders, lines).collect()}
    assert (got[7].total_orders, got[7].avg_days_between_orders, got[7].total_products, got[7].unique_products) == (2, 4.0, 3, 2)
    assert got[7].reorder_ratio == pytest.approx(1 / 3)
    assert (got[8].total_products, got[8].reorder_ratio, got[8].avg_days_between_orders) == (0, 0.0, 0.0)
    life = {r.user_id: r for r in features.lifecycle_features(orders).collect()}
    assert (life[7].active_span, life[7].active_days, life[7].lifecycle_stage) == (1, 4.0, "new")


def test_preference_shares_sum_to_one(spark):
    lines = spark.createDataFrame([(1, 5, 0), (1, 6, 0), (1, 6, 0), (2, 9, 0)], "order_id long, product_id long, reordered int")
    orders = spark.createDataFrame([(1, 7), (2, 8)], "order_id long, user_id long")
    products = spark.createDataFrame([(5, 1), (6, 2), (9, 3)], "product_id long, department_id long")
    departments = spark.createDataFrame([(1, "a"), (2, "b")], "department_id long, department string")
    got = sorted(map(tuple, features.preference_features(orders, lines, products, departments).collect()))
    assert got == [(7, "a", pytest.approx(1 / 3)), (7, "b", pytest.approx(2 / 3))]


def test_lifecycle_stage_on_thresholds(spark):
    df = spark.createDataFrame([(i, i, float(i), i) for i in range(1, 12)], "user_id int, total_orders int, active_days double, active_span int")
    got = {r.user_id: r.lifecycle_stage for r in segments.lifecycle_stage(df).collect()}
    # q40 = 5, q70 = 8, q90 = 10, q80 = 9.
    assert [got[i] for i in (4, 5, 8, 9, 10, 11)] == ["new", "regular", "regular", "loyal", "vip", "vip"]


def test_segments_defaults(spark):
    users = spark.createDataFrame([(1,), (2,)], "user_id long")
    behavior = spark.createDataFrame([(1, 3)], "user_id long, cluster int")
    got = {r.user_id: tuple(r)[1:] for r in segments.user_segments(users, behavior, None, None, SERVE_DEFAULTS).collect()}
    assert got == {1: (3, -1, "unknown"), 2: (-1, -1, "unknown")}


def test_vectorizer_with_constant_feature_and_assignment(spark):
    rows = [(i, i, 2.0, 10 * i, 0.5) for i in range(1, 30)]
    df = spark.createDataFrame(rows, "user_id int, total_orders int, avg_days_between_orders double, total_products int, reorder_ratio double")
    vec = segments.behavior_vectorize(df, segments.behavior_bounds(df))
    stats = vec.agg(F.avg("total_orders"), F.stddev_pop("total_orders"), F.max("reorder_ratio")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1) and stats[2] == 0
    points = spark.createDataFrame([(1, 0.0, 1, 1), (2, 9.0, 1, 1), (3, 5.0, 0, 0)], "user_id int, x double, total_products int, unique_products int")
    centers = segments.centroid_column(spark.createDataFrame([(0, 0.0), (1, 10.0)], "cluster int, x double"), ["x"])
    got = {r.user_id: r.cluster for r in segments.assign_cluster(points, ["x"], centers, segments.is_cold(), 7).collect()}
    assert got == {1: 0, 2: 1, 3: 7}


def test_history_of_a_hot_user(spark):
    lines = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40).alias("user_id"),
        (F.col("id") % 17).cast("int").alias("order_number"),
        (F.col("id") % 5).cast("int").alias("line_number"),
        F.col("id").alias("product_id"),
    )
    a = sorted(map(tuple, user_history(lines).collect()))
    assert a == sorted(map(tuple, user_history(lines, hot_rows=100).collect()))
