import re

import pytest
from pyspark.sql import functions as F

from cartwright.plans import prep
from cartwright.sources import facts


def exchanges(df):
    """Hash exchanges of the physical plan."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange hashpartitioning", plan))


@pytest.fixture(params=["folder", "storage"])
def place(request, tmp_path, monkeypatch):
    monkeypatch.setattr(facts, "folder", lambda s: str(tmp_path) if request.param == "folder" else None)
    return request.param


@pytest.fixture
def merged(spark):
    """No broadcasts, as with tables of real size."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def tables(spark):
    orders = spark.range(400).select(F.col("id").alias("order_id"), (F.col("id") % 7).alias("user_id"))
    lines = spark.range(2000).select(
        (F.col("id") % 400).alias("order_id"), F.col("id").alias("product_id"), (F.col("id") % 5).cast("int").alias("line_number")
    )
    return orders, lines


def test_bucket_count():
    assert [facts.bucket_count(n) for n in (0, 16_000_000, 16_000_001, 33_000_000)] == [8, 8, 16, 32]
    assert facts.bucket_count(9, 1) == 16


def test_baskets_and_star_join_need_no_exchange_of_facts(spark, place, merged):
    orders, lines = tables(spark)
    plain = prep.baskets(orders, lines)
    assert exchanges(plain) >= 2
    o, n = facts.stage_buckets(orders, "order_id", 8, "orders"), facts.stage_buckets(lines, "order_id", 8, "lines")
    built = prep.baskets(o, n)
    # What lies below a cached table is not part of the plan that runs.
    head = built._jdf.queryExecution().executedPlan().toString().split("InMemoryRelation")[0]
    assert "Exchange hashpartitioning" not in head
    if place == "folder":
        assert exchanges(built) == 0 and exchanges(n.join(o, "order_id", "left")) == 0
    assert sorted(map(tuple, built.select("order_id", "products").collect())) == sorted(
        map(tuple, plain.select("order_id", "products").collect())
    )


def test_baskets_are_not_shuffled_by_user(spark, tmp_path, monkeypatch, merged):
    monkeypatch.setattr(facts, "folder", lambda s: str(tmp_path))
    orders, lines = tables(spark)
    orders = orders.withColumns({"order_hour_of_day": F.lit(9), "order_dow": F.lit(0)})
    o, n = facts.stage_buckets(orders, "order_id", 8, "orders"), facts.stage_buckets(lines, "order_id", 8, "lines")
    freq = spark.range(6).select(F.col("id").alias("user_id"), F.lit("high").alias("purchase_frequency"))
    after = prep.transactions_context(prep.baskets(o, n), freq)
    before = prep.transactions_context(prep.baskets(prep.attach_users(o, freq), n))
    plan = before._jdf.queryExecution().executedPlan().toString()
    assert all("products" not in part.split("\n")[1] for part in plan.split("Exchange hashpartitioning")[1:])
    assert sorted(map(str, before.collect())) == sorted(map(str, after.select(*before.columns).collect()))
    assert before.where("purchase_frequency = 'medium'").count() == after.where("purchase_frequency = 'medium'").count() > 0
