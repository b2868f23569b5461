"""What keeps the driver small: garbage goes between jobs, and no plan counts a whole level at once."""

import pytest
from pyspark.sql import functions as F

from cartwright import lineage
from cartwright.config import Mining
from cartwright.operators import vertical
from cartwright.plans import rule_updates, rules


@pytest.fixture
def baskets(spark):
    keys = [f"context_{level}" for level in rules.LEVELS]
    rows = [(i, [1, 2, 3, 4 + i % 2], *["k"] * (len(keys) - 1), "GLOBAL") for i in range(20)]
    return spark.createDataFrame(rows, "order_id long, products array<long>, " + ", ".join(f"{k} string" for k in keys))


M = Mining(min_support=0.2, level_min_txns={f"L{i}": 0 for i in range(1, 6)}, floor=1, least_count=2)


def test_garbage_goes_when_the_heap_is_half_full(spark, monkeypatch):
    class Heap:
        total = 100

        def totalMemory(self):  # noqa: N802
            return self.total

        def maxMemory(self):  # noqa: N802
            return 300

    class Session:
        class _jvm:  # noqa: N801
            class Runtime:
                getRuntime = Heap  # noqa: N815

            class System:
                done = 0

                @classmethod
                def gc(cls):
                    cls.done += 1

    monkeypatch.setattr(lineage, "_TIDIED", [0.0])
    assert not lineage.tidy(Session)
    monkeypatch.setattr(Heap, "total", 200)
    assert lineage.tidy(Session) and not lineage.tidy(Session)
    assert Session._jvm.System.done == 1


@pytest.mark.parametrize("mine", [lambda t: rules.frequent_itemsets(t, M), lambda t: rule_updates.advance(rule_updates.empty(t.sparkSession), t, M)])
def test_counts_of_a_level_are_a_job_of_their_own(baskets, monkeypatch, mine):
    """The counts of the sets are written before anything is joined to them."""
    staged, counted = [], []
    real, count = lineage.stage, vertical.count_sets

    def noted(df, name, *more):
        staged.append((name, df))
        return real(df, name, *more)

    def watched(*some):
        counted.append(count(*some))
        return counted[-1]

    monkeypatch.setattr(vertical, "count_sets", watched)
    for module in (rules, rule_updates):
        monkeypatch.setattr(module, "stage", noted)
    mine(baskets)
    assert counted and [df for name, df in staged if name == "set-counts"] == counted


def test_the_rules_of_a_build_are_made_once(spark, monkeypatch):
    from registry import rule

    seen = []
    monkeypatch.setattr(rule, "stage", lambda df, name: seen.append(name) or df.limit(0))

    class Some:
        mining = rule.rules.Mining()
        itemsets = spark.createDataFrame([("L5", "GLOBAL", [1], 1, 5, 9)], "context_level string, context_key string, items array<long>, size int, cnt long, n long")

    monkeypatch.setattr(rule.Fixture, "of", classmethod(lambda *_: Some))
    assert rule.QUERIES["rule_build_stats"](spark, "").count() == 1 and seen == ["rules-found"]
