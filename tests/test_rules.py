import itertools
import random
from collections import Counter

import pytest
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import functions as F

from cartwright.config import Mining
from cartwright.operators import vertical
from cartwright.plans import prep, rules
from cartwright.sources import rule_store
from registry.fixture import Fixture

SMALL = "/root/testdata/sf0.001"
OPEN = Mining(min_support=0.02, level_min_txns={}, floor=30)


@pytest.fixture(scope="module")
def txns(spark):
    return Fixture.of(spark, SMALL).brand_transactions


@pytest.fixture(scope="module")
def mining():
    return Mining(min_support=0.02, level_min_txns={"L1": 0, "L2": 0, "L3": 0, "L4": 0, "L5": 0}, floor=30)


def test_same_counts_and_rules_as_fpgrowth(spark, txns, mining):
    sets = rules.frequent_itemsets(txns, mining).cache()
    key = sets.where("context_level = 'L4'").select("context_key").first()[0]
    for level, where in (("L5", F.lit(True)), ("L4", F.col("context_L4") == key)):
        items = txns.where(where).select(F.array_distinct("products").alias("items"))
        model = FPGrowth(itemsCol="items", minSupport=0.02, minConfidence=0.1).fit(items)
        want = {tuple(sorted(r["items"])): r.freq for r in model.freqItemsets.collect()}
        mine = sets.where((F.col("context_level") == level) & ((F.lit(level) == "L5") | (F.col("context_key") == key)))
        assert {tuple(r["items"]): r.cnt for r in mine.collect()} == want
        found = rules.association_rules(mine).where("confidence >= 0.1")
        got = {(tuple(r.antecedent), r.consequent): (r.confidence, r.lift, r.support) for r in found.collect()}
        expected = {
            (tuple(sorted(r.antecedent)), r.consequent[0]): (r.confidence, r.lift, r.support)
            for r in model.associationRules.collect()
        }
        assert got.keys() == expected.keys()
        for k, v in got.items():
            assert v == pytest.approx(expected[k])


def test_adaptive_steps(spark):
    sizes = [99, 100, 200000, 200001, 500000, 500001]
    df = spark.createDataFrame([("L5", str(n), n) for n in sizes], "context_level string, context_key string, n long")
    got = {r.n: (r.min_support, r.max_antecedent) for r in rules.adaptive_params(df).collect()}
    assert [got[n] for n in sizes] == [(0.002, 3), (0.002, 3), (0.002, 3), (0.01, 2), (0.01, 2), (0.02, 1)]
    assert {r.n for r in rules.passing_contexts(df).collect()} == set(sizes) - {99}


def test_one_support_for_contexts_of_every_size(spark):
    rows = [("L5", str(n), n) for n in (1000, 200_001, 600_000)]
    df = spark.createDataFrame(rows, "context_level string, context_key string, n long")
    got = {r.n: (r.min_support, r.min_count) for r in rules.mining_params(df, Mining(min_support=0.002)).collect()}
    assert got == {1000: (0.002, 2), 200_001: (0.002, 401), 600_000: (0.002, 1200)}


def long_baskets(spark):
    """60 orders; half hold the same five products, one holds 25."""
    baskets = [[1, 2, 3, 4, 5] if i % 2 else [1 + i % 5, 90 + i % 3] for i in range(59)] + [list(range(30, 55))]
    keys = ", ".join(f"context_{level} string" for level in rules.LEVELS)
    rows = [(i, b, *["GLOBAL" if level == "L5" else f"{level}=x" for level in rules.LEVELS]) for i, b in enumerate(baskets)]
    return spark.createDataFrame(rows, f"order_id long, products array<long>, {keys}")


def test_sets_grow_until_nothing_is_frequent(spark):
    m = Mining(min_support=0.4, level_min_txns={"L5": 0, **{f"L{i}": 1000 for i in range(1, 5)}}, floor=30)
    sets = {tuple(r["items"]): r.cnt for r in rules.frequent_itemsets(long_baskets(spark), m).collect()}
    assert sets[(1, 2, 3, 4, 5)] == 29 and len(sets) == 31
    found = rules.mine(long_baskets(spark), m)
    assert found.agg(F.max(F.size("antecedent"))).first()[0] in (None, 3)


def test_long_baskets_count_whole(spark):
    m = Mining(min_support=1 / 60, level_min_txns={"L5": 0, **{f"L{i}": 1000 for i in range(1, 5)}}, floor=30)
    sets = rules.frequent_itemsets(long_baskets(spark), m, max_size=2)
    assert sets.where("size = 2 and items[0] >= 30 and items[1] < 60").count() == 25 * 24 // 2


def test_rules_are_cut_only_on_request(spark):
    rows = [("L5", "GLOBAL", [1], c, 0.5, 2.0 + c / 10000, 0.1) for c in range(2, 4002)]
    df = spark.createDataFrame(
        rows, "context_level string, context_key string, antecedent array<long>, consequent long, confidence double, lift double, support double"
    )
    assert rules.filter_rules(df).count() == 4000 and rules.build_index(df).count() == 4000
    assert rules.filter_rules(df, per_context=3000).count() == 3000 and rules.build_index(df, per_antecedent=10).count() == 10


def test_log_has_the_outcome_of_the_run(spark, txns, mining):
    index, log = rules.mine_logged(txns, mining)
    rows = log.collect()
    assert index.count() > 0 and {(r.status, r.error) for r in rows} == {("success", "")} and rows[0].run_time > 0
    broken = txns.withColumn("products", F.transform("products", lambda p: F.raise_error(F.lit("unreadable")).cast("bigint")))
    index, log = rules.mine_logged(broken, mining)
    rows = log.collect()
    assert index is None and {r.status for r in rows} == {"failed"} and "unreadable" in rows[0].error and len(rows) > 0


def test_cap_is_exact_and_repeatable(spark, txns, mining):
    rows = rules.context_transactions(txns, mining).select("context_level", "context_key", "order_id")
    capped = rules.cap_transactions(rows, 37, bucket_digits=1)
    sizes = {(r[0], r[1]): r[2] for r in rows.groupBy("context_level", "context_key").count().collect()}
    got = {(r[0], r[1]): r[2] for r in capped.groupBy("context_level", "context_key").count().collect()}
    assert got == {k: min(v, 37) for k, v in sizes.items()}
    again = rules.cap_transactions(rows.repartition(3), 37, bucket_digits=2)
    assert sorted(map(tuple, capped.collect())) == sorted(map(tuple, again.collect()))


def test_index_dedupes_and_counts(spark):
    rows = [
        ("L5", "GLOBAL", [1], 2, 0.5, 2.0, 0.1),
        ("L5", "GLOBAL", [1], 2, 0.9, 2.0, 0.1),
        ("L5", "GLOBAL", [1], 3, 0.9, 1.0, 0.1),
        ("L5", "GLOBAL", [], 3, 0.9, 2.0, 0.1),
        ("L5", "GLOBAL", [4], 3, 0.9, 12.0, 0.1),
    ]
    df = spark.createDataFrame(
        rows, "context_level string, context_key string, antecedent array<long>, consequent long, confidence double, lift double, support double"
    )
    index = rules.build_index(df)
    got = {(tuple(r.antecedent), r.consequent): r for r in index.collect()}
    assert set(got) == {((1,), 2), ((4,), 3)}
    assert got[((1,), 2)].confidence == 0.9 and got[((4,), 3)].lift == 10.0
    s = rules.build_stats(df, index).first()
    assert tuple(s) == (5, 1, 1, 2, 3, 2)


def test_rule_store(spark, txns, mining, tmp_path):
    index = rules.build_index(rules.filter_rules(rules.association_rules(rules.frequent_itemsets(txns, mining)), mining))
    rule_store.save(index, str(tmp_path / "store"))
    back = rule_store.load(spark, str(tmp_path / "store"))
    assert back.count() == index.count() > 0
    bad = index.limit(1).withColumn("confidence", F.lit(2.0))
    rule_store.save(bad, str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="malformed"):
        rule_store.load(spark, str(tmp_path / "bad"))


def some_rules(spark, n):
    rows = [("L5", "GLOBAL", f"r{i}", [1], i + 2, 0.5, 2.0, 0.1, 0.4) for i in range(n)]
    kinds = "context_level string, context_key string, rule_id string, antecedent array<long>, consequent long"
    return spark.createDataFrame(rows, f"{kinds}, confidence double, lift double, support double, score double")


def test_a_save_that_dies_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "store")
    assert rule_store.current(spark, path) is None and rule_store.save(some_rules(spark, 3), path) == 1
    broken = some_rules(spark, 5).withColumn("score", F.when(F.col("consequent") > 4, F.raise_error(F.lit("lost"))).otherwise(0.1).cast("double"))
    with pytest.raises(Exception, match="lost"):
        rule_store.save(broken, path)
    (tmp_path / "store" / "versions" / "2").mkdir(exist_ok=True)
    assert rule_store.current(spark, path) == 1 and rule_store.load(spark, path).count() == 3
    assert rule_store.save(some_rules(spark, 4), path) == 3 and rule_store.load(spark, path).count() == 4


def test_a_reader_keeps_its_version(spark, tmp_path):
    path = str(tmp_path / "store")
    rule_store.save(some_rules(spark, 3), path)
    reader = rule_store.load(spark, path)
    for n in (4, 5):
        rule_store.save(some_rules(spark, n), path)
    assert reader.count() == 3 and rule_store.load(spark, path, number=2).count() == 4
    assert rule_store.expire(spark, path) == [1] and rule_store.expire(spark, path) == []
    assert rule_store.load(spark, path).count() == 5 and rule_store.load(spark, path, number=2).count() == 4
    with pytest.raises(Exception, match="1"):
        rule_store.load(spark, path, number=1)
    assert rule_store.load(spark, path, number=3).columns == rule_store.load(spark, path, number=2).columns
    with pytest.raises(ValueError, match="no version"):
        rule_store.load(spark, str(tmp_path / "nowhere"))


def test_mining_plan_has_no_python(txns, mining):
    plan = rules.frequent_itemsets(txns, mining)._jdf.queryExecution().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan and "SinglePartition" not in plan


def test_cardinality_of_levels(txns):
    got = {r.context_level: r.contexts for r in prep.context_cardinality(txns).collect()}
    assert got["L5"] == 1 and got["L4"] == 8 and got["L1"] >= got["L2"] >= got["L3"]


def test_blocks_count_like_transactions(spark, monkeypatch):
    """Several blocks per group, dense and sparse items, sets of one to four items."""
    rng = random.Random(4)
    monkeypatch.setattr(vertical, "BLOCK", 64)
    monkeypatch.setattr(vertical, "PORTION", 2)
    rows = [(i, i % 2, sorted(rng.sample(range(12), rng.randrange(6)) + ([50] if i == 7 else []) + ([99] if i % 9 else [])), 350) for i in range(700)]
    df = spark.createDataFrame(rows, "id long, g long, items array<long>, size long")
    blocks = vertical.blocks(df, "g", "items", "id", "size").cache()
    assert blocks.count() > 8 and {r[0] for r in blocks.groupBy("grp").agg(F.sum("n")).select("sum(n)").collect()} == {350}
    want = Counter((g, s) for _, g, items, _ in rows for k in range(1, 5) for s in itertools.combinations(items, k))
    singles = vertical.count_singles(blocks).groupBy("grp", "set").agg(F.sum("cnt").alias("cnt")).collect()
    assert {(r.grp, tuple(r["set"])): r.cnt for r in singles} == {k: n for k, n in want.items() if len(k[1]) == 1}
    alive = blocks.withColumn("alive", F.array(*[F.lit(i).cast("long") for i in [*range(12), 99]]))
    pairs = vertical.count_pairs(alive).groupBy("grp", "set").agg(F.sum("cnt").alias("cnt")).collect()
    assert {(r.grp, tuple(r["set"])): r.cnt for r in pairs} == {k: n for k, n in want.items() if len(k[1]) == 2 and 50 not in k[1]}
    for size in (3, 4):
        sets = [list(s) for s in itertools.combinations([*range(12), 50, 99, 1000], size)]
        lists = spark.createDataFrame([(7, p, sets[p::3]) for p in range(3)], "owner long, piece long, sets array<array<long>>")
        got = vertical.count_sets(blocks.withColumn("owner", F.lit(7).cast("long")), lists).collect()
        both = {s: want[0, s] + want[1, s] for s in map(tuple, sets)}
        assert {tuple(sets[r.piece :: 3][r.pos]): r.cnt for r in got} == {s: n for s, n in both.items() if n}


def test_least_count(spark):
    df = spark.createDataFrame([("L1", "k", n) for n in (60, 3000)], "context_level string, context_key string, n long")
    got = {r.n: r.min_count for r in rules.mining_params(df, Mining(least_count=5)).collect()}
    assert got == {60: 5, 3000: 6}


def test_every_level_is_mined(spark):
    f = Fixture.of(spark, "/root/testdata/sf0.01")
    params = rules.passing_contexts(rules.context_counts(f.brand_transactions), f.mining)
    assert {r.context_level for r in params.select("context_level").distinct().collect()} == set(rules.LEVELS)
