"""Weights and contexts of rules, against plain Python; rows for each (signature, context, rule) are never made."""

import math
import random
from collections import Counter, defaultdict

import pytest

from cartwright.operators import weights
from cartwright.plans import recommend as R


def matrices(seed, unit_scale=1.0):
    rnd = random.Random(seed)
    entries = [(c, a, k, rnd.random() * unit_scale, rnd.choice([0, 1, 2, 4])) for c in range(12) for a in range(9) for k in (3, 5) if rnd.random() < 0.4]
    matches = [(s, c, rnd.choice([0.6, 0.75, 1.0])) for s in range(7) for c in range(13) if rnd.random() < 0.5]
    return entries, matches


# The last sums are too large to be exact in doubles.
@pytest.mark.parametrize("portion,scale", [(1 << 21, 1.0), (16, 1.0), (64, 1e7)])
def test_sums_are_those_of_the_join(spark, monkeypatch, portion, scale):
    entries, matches = matrices(1, scale)
    want, bits = Counter(), defaultdict(int)
    for s, c, r in matches:
        for c2, a, k, w, bit in entries:
            if c == c2:
                x = w * r * 1e9
                want[s, a, k] += math.floor(x) + (x - math.floor(x) >= 0.5)
                bits[s, a, k] |= bit
    monkeypatch.setattr(weights, "PORTION", portion)
    e = spark.createDataFrame(entries, "context long, antecedent_id long, consequent long, weighted double, bit int")
    m = spark.createDataFrame(matches, "signature long, context long, match_ratio double")
    got = weights.sums(e, m, 1e9).collect()
    assert {(r.signature, r.antecedent_id, r.consequent): (r.units, r.level_mask) for r in got} == {k: (v, bits[k]) for k, v in want.items()}
    assert len(got) == len(want)
    assert weights.sums(e.limit(0), m, 1e9).count() == 0 and weights.sums(e, m.limit(0), 1e9).count() == 0


REQUESTS = "request_id long, signature long, basket array<long>, top_k int"


def test_traces_of_many_requests(spark):
    """Ids that are missing or come twice, baskets whose rules have several anchors."""
    rnd = random.Random(2)
    keys = ["a=1", "a=2", "a=1|b=1", "a=2|b=1", "GLOBAL"]
    levels = dict(zip(keys, ["L4", "L4", "L3", "L3", "L5"]))
    rules = [(levels[k], k, sorted(rnd.sample(range(8), n)), c, 0.5) for k in keys for n in (1, 2) for c in (8, 9, 1) for _ in range(3)]
    rules = [r for i, r in enumerate(rules) if r[:4] not in [x[:4] for x in rules[:i]] and r[3] not in r[2]]
    matches = [(s, levels[k], k, 1.0 if k == "GLOBAL" else 0.75) for s in range(3) for i, k in enumerate(keys) if (s + i) % 2 == 0]
    requests = [(None if i == 0 else i // 2 if i < 6 else i, i % 3, rnd.sample(range(10), rnd.randrange(8)), 5) for i in range(40)]
    want = Counter()
    for request, signature, basket, _ in requests:
        for s, level, key, ratio in matches:
            n = sum(1 for r in rules if r[1] == key and s == signature and set(r[2]) <= set(basket) and r[3] not in basket)
            if n:
                want[request, level, key, ratio] += n
    frame = spark.createDataFrame
    popular = frame([("global", "", p, 100 - p, p) for p in range(8)], "tier string, tier_key string, product_id long, cnt long, rank int")
    got = R.matched_contexts(
        frame(requests, REQUESTS),
        frame(matches, "signature long, context_level string, context_key string, match_ratio double"),
        frame(rules, "context_level string, context_key string, antecedent array<long>, consequent long, score double"),
        popular,
    )
    rows = got.collect()
    assert {(r.request_id, r.context_level, r.context_key, r.match_ratio): r.hits for r in rows} == dict(want) and len(rows) == len(want)
    # Contexts travel as bits, not as lists of keys for each signature and rule.
    assert "collect_list(struct(context_level" not in got._jdf.queryExecution().optimizedPlan().toString()
