"""Operators that must stay exact when a group is split."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cartwright.operators.quantiles import exact_quantiles, values_at
from cartwright.operators.ranking import block_row_number, first_row, grouped_row_number, split_hot, top_n
from cartwright.sources.retail import Retail

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    # One key holds a third of the rows.
    return spark.range(6000).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 50 + 1).alias("k"),
        (F.col("id") * 7919 % 97).alias("a"),
        F.col("id").alias("b"),
    )


def window_numbers(df):
    w = Window.partitionBy("k").orderBy("a", "b")
    return {(r.k, r.b): r.n for r in df.withColumn("n", F.row_number().over(w)).collect()}


@pytest.mark.parametrize("hot_rows", [10**9, 500, 0])
def test_grouped_row_number(skewed, hot_rows):
    df = skewed.withColumn("block", F.shiftright("b", 6))
    got = grouped_row_number(df, ["k"], ["a", "b"], ["a", "block"], "n", hot_rows)
    assert {(r.k, r.b): r.n for r in got.collect()} == window_numbers(skewed)


def test_block_row_number_one_level(skewed):
    got = block_row_number(skewed, ["k"], ["a", "b"], ["a"], "n")
    assert {(r.k, r.b): r.n for r in got.collect()} == window_numbers(skewed)


def test_split_hot(skewed):
    plain, hot = split_hot(skewed, ["k"], 500)
    assert hot.select("k").distinct().collect()[0].k == 0
    assert plain.count() + hot.count() == 6000


@pytest.mark.parametrize("n", [3, 1500])
def test_top_n(skewed, n):
    got = {(r.k, r.b): r.rank for r in top_n(skewed, ["k"], [F.col("a"), F.col("b")], n).collect()}
    assert got == {key: v for key, v in window_numbers(skewed).items() if v <= n}


def test_top_n_cuts_before_the_shuffle(skewed):
    plan = top_n(skewed, ["k"], [F.col("a"), F.col("b")], 3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_first_row(spark):
    df = spark.createDataFrame([(1, 5, "b"), (1, 4, "z"), (1, 4, "a"), (2, 1, "q")], "k int, o int, v string")
    assert sorted(map(tuple, first_row(df, ["k"], ["o", "v"]).collect())) == [(1, 4, "a"), (2, 1, "q")]


@pytest.mark.parametrize("small", [100_000, 10])
def test_exact_quantiles(spark, small):
    rng = np.random.default_rng(1)
    data = {
        "cont": rng.normal(size=9000),
        "ints": rng.integers(0, 30, 9001).astype(float),
        "hot": np.where(rng.random(5000) < 0.4, 7.0, rng.random(5000) * 100),
        "one": np.array([3.0]),
    }
    rows = [(f, float(v)) for f, vs in data.items() for v in vs] + [("ints", None)]
    df = spark.createDataFrame(rows, "feature string, value double")
    probs = [0.0, 0.01, 0.33, 0.5, 0.67, 0.99, 1.0]
    got = {(r.feature, r.q): r.quantile for r in exact_quantiles(df, probs, small=small).collect()}
    for f, vs in data.items():
        if f == "one" and small == 10:
            assert got[(f, 0.5)] == 3.0
        for p in probs:
            assert got[(f, p)] == pytest.approx(np.quantile(vs, p), abs=1e-12), (f, p)


@pytest.mark.parametrize("hot_rows", [0, 12])
def test_order_sequence_of_hot_users(spark, hot_rows):
    plain = Retail(spark, SMALL).orders()
    split = Retail(spark, SMALL, hot_rows=hot_rows).orders()
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, split.select(*plain.columns).collect()))


def test_quantiles_of_large_groups_count_digits(spark):
    """Half a million values of all kinds in one group: exact at any place, without ordering values."""
    n = 500_000
    x = (F.col("id") * 7919 % n - n // 2).cast("double")
    value = F.when(F.col("id") % 5 == 0, x * 1e-300).when(F.col("id") % 7 == 0, F.lit(-0.0)).otherwise(x * 1e250)
    values = spark.range(n).select(F.lit("x").alias("feature"), value.alias("value")).cache()
    probs = [0.0, 0.01, 0.31, 0.5, 0.777, 1.0]
    data = np.array([r.value for r in values.select("value").collect()])
    got = {r.q: r.quantile for r in exact_quantiles(values, probs).collect()}
    ordered = np.sort(data)
    for p in probs:
        low, high = ordered[int(np.floor(p * (n - 1)))], ordered[int(np.ceil(p * (n - 1)))]
        assert got[p] == low + (high - low) * (p * (n - 1) - np.floor(p * (n - 1)))


def test_places_of_odd_values(spark):
    inf, nan = float("inf"), float("nan")
    data = [nan, inf, -inf, 0.0, -0.0, 5e-324, -5e-324, 1.0, 1.0, nan, 1.7976931348623157e308]
    values = spark.createDataFrame([("a", x) for x in data] + [("b", 2.0)], "g string, value double")
    places = spark.createDataFrame([("a", i) for i in range(len(data))] + [("b", 0)], "g string, place long")
    got = {(r.g, r.place): r.value for r in values_at(values, places, ["g"]).collect()}
    want = np.sort(np.array(data))
    assert [got["a", i] for i in range(9)] == want[:9].tolist() and np.isnan([got["a", 9], got["a", 10]]).all() and got["b", 0] == 2.0


def test_quantiles_of_nothing(spark):
    for small in (0, 10):
        assert exact_quantiles(spark.createDataFrame([("a", None)], "feature string, value double"), [0.5], small=small).count() == 0
