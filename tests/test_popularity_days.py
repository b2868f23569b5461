import datetime as dt

import pytest
from pyspark.sql import functions as F

from cartwright.plans import popularity
from cartwright.plans import popularity_days as days
from cartwright.sources import day_counts as store

TIERS = {"global": None, "time": "time_bucket"}


@pytest.fixture
def purchases(spark):
    return spark.range(3000).select(
        F.col("id").alias("order_id"),
        (F.pmod(F.xxhash64("id"), F.lit(40))).alias("product_id"),
        F.date_add(F.lit(dt.date(2024, 1, 1)), F.pmod(F.hash("id"), F.lit(9)) * 5).alias("order_date"),
        F.when(F.col("id") % 11 > 0, F.element_at(F.array(F.lit("night"), F.lit("morning")), (F.col("id") % 2 + 1).cast("int"))).alias("time_bucket"),
    )


def rows(df):
    return sorted(map(tuple, df.select("tier", "tier_key", "product_id", "cnt", "rank").collect()))


def whole(purchases, n=10):
    """The lists from all purchases at once."""
    bought = purchases.where("product_id IS NOT NULL")
    a = popularity.as_tier(popularity.popular_global(bought, n), "global", None)
    b = popularity.popular_by(bought, purchases, "order_id", "time_bucket", n)
    return rows(a.unionByName(popularity.as_tier(b, "time", "time_bucket")))


def test_any_split_gives_the_lists_of_all(spark, purchases, tmp_path):
    path = str(tmp_path / "s")
    assert rows(days.lists(store.read(spark, path))) == []
    # The last batch brings late purchases of days that were there before.
    for name, part in (("a", "order_date < '2024-01-12'"), ("b", "order_date >= '2024-01-12' AND order_id % 3 > 0"), ("late", "order_date >= '2024-01-12' AND order_id % 3 = 0")):
        assert store.add(days.day_counts(purchases.where(part), TIERS), path, name)
    assert rows(days.lists(store.read(spark, path), 10)) == whole(purchases)
    # A batch that comes again changes nothing.
    assert not store.add(days.day_counts(purchases, TIERS), path, "late")
    assert rows(days.lists(store.read(spark, path), 10)) == whole(purchases)


def test_days_are_pruned_and_taken_back(spark, purchases, tmp_path):
    path = str(tmp_path / "s")
    store.add(days.day_counts(purchases, TIERS), path, "all")
    span = dt.date(2024, 1, 3), dt.date(2024, 2, 5)
    got = store.read(spark, path, *span)
    assert rows(days.lists(got, 10)) == whole(purchases.where(F.col("order_date").between(*span)))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and "GreaterThanOrEqual(day,2024-01-03)" in plan
    gone = purchases.where("product_id < 20")
    store.add(days.day_counts(gone, TIERS, weight=-1), path, "returned")
    assert rows(days.lists(store.read(spark, path), 10)) == whole(purchases.where("product_id >= 20"))
    assert store.read(spark, path).where("product_id < 20").isEmpty()


def test_compaction_and_readers(spark, purchases, tmp_path):
    path = str(tmp_path / "s")
    assert store.compact(spark, path) is None
    store.add(days.day_counts(purchases.where("order_id < 1000"), TIERS), path, "a")
    store.add(days.day_counts(purchases.where("order_id >= 1000"), TIERS), path, "b")
    before = store.read(spark, path)
    assert store.compact(spark, path) == 3 and store.compact(spark, path) is None
    assert rows(days.lists(before, 10)) == rows(days.lists(store.read(spark, path), 10)) == whole(purchases)
    assert store.expire(spark, path) == [1, 2]
    assert rows(days.lists(store.read(spark, path), 10)) == whole(purchases)
    # Names of batches are known after compaction too.
    assert not store.add(days.day_counts(purchases, TIERS), path, "a")


def test_a_batch_that_dies_changes_nothing(spark, purchases, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    store.add(days.day_counts(purchases, TIERS), path, "a")

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(store, "_append", dies)
        with pytest.raises(RuntimeError):
            store.add(days.day_counts(purchases, TIERS), path, "b")
    assert rows(days.lists(store.read(spark, path), 10)) == whole(purchases)
    assert store.add(days.day_counts(purchases, TIERS), path, "b")
    assert store.expire(spark, path) == [2]
    twice = [(t, k, p, c // 2, r) for t, k, p, c, r in rows(days.lists(store.read(spark, path), 10))]
    assert twice == whole(purchases)


def test_missing_values(spark):
    table = spark.createDataFrame(
        [(1, None, "night"), (None, dt.date(2024, 1, 1), "night"), (2, dt.date(2024, 1, 1), None)],
        "product_id long, order_date date, time_bucket string",
    )
    assert [tuple(r) for r in days.day_counts(table, TIERS).collect()] == [(dt.date(2024, 1, 1), "global", "", 2, 1)]
