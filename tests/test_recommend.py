import pytest
from pyspark.sql import functions as F

from cartwright.plans import catalog, recommend as R

CTX = "time_bucket=night|is_weekend=0"


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


RULES = "context_level string, context_key string, antecedent array<long>, consequent long, score double"
POPULAR = "tier string, tier_key string, product_id long, cnt long, rank int"
REQUESTS = "request_id long, user_id long, basket array<long>, time_bucket string, is_weekend boolean, top_k int"
SEGMENTS = "user_id long, behavior_cluster int, preference_cluster int, lifecycle_stage string"


@pytest.fixture(scope="module")
def tables(spark):
    rules = [
        ("L5", "GLOBAL", [9, 10], 3, 0.5),
        ("L5", "GLOBAL", [9], 4, 0.4),
        ("L5", "GLOBAL", [9, 10, 11], 5, 0.9),
        ("L5", "GLOBAL", [9], 10, 0.9),
        ("L4", CTX, [9], 4, 0.4),
        ("L3", CTX + "|behavior_cluster=1", [9], 6, 0.6),
    ]
    popular = [("global", "", p, 100 - p, i + 1) for i, p in enumerate([1, 2, 3, 4, 5, 6])]
    popular += [("lifecycle", "new", 7, 5, 1), ("lifecycle", "new", 8, 4, 2)]
    products = [(p, 1 + p % 2, "odd" if p % 2 else "even") for p in range(1, 12)]
    return R.Tables(
        rules=frame(spark, rules, RULES),
        popularity=frame(spark, popular, POPULAR),
        products=frame(spark, products, "product_id long, department_id long, department string"),
        behavior_scores=frame(spark, [(1, 1, 0.7), (1, 2, 0.3)], "cluster int, department_id long, score double"),
        preference_scores=frame(spark, [(2, "odd", 0.6), (2, "even", 0.4)], "cluster int, department string, score double"),
        segments=frame(spark, [(1, 1, 2, "new"), (2, 5, 5, "loyal")], SEGMENTS),
    )


def run(spark, tables, rows, **opts):
    requests = frame(spark, rows, REQUESTS)
    return R.recommend(requests, tables, R.Options(**opts))


def test_match_ratios(spark):
    sig = "time_bucket=night|is_weekend=0|lifecycle_stage=new|preference_cluster=2|behavior_cluster=1"
    keys = {
        "L5": "GLOBAL",
        "L4": "time_bucket=night|is_weekend=1",
        "L3": "time_bucket=night|is_weekend=1|behavior_cluster=1",
        "L1": "time_bucket=day|is_weekend=0|lifecycle_stage=new|preference_cluster=2|behavior_cluster=3",
        "L2": "time_bucket=day|is_weekend=1|behavior_cluster=1|preference_cluster=2",
    }
    got = R.context_match(
        frame(spark, [(sig,)], "signature string"), frame(spark, list(keys.items()), "context_level string, context_key string")
    )
    # 1/2 and 2/4 fall short of 0.6; 3/5 is just enough.
    assert {r.context_level: round(r.match_ratio, 6) for r in got.collect()} == {"L5": 1.0, "L3": 0.666667, "L1": 0.6}


def test_containment_scores_levels_and_exclusion(spark, tables):
    st = run(spark, tables, [(1, 1, [10, 9], "night", False, 2)])
    got = {r.product_id: r for r in st.candidates.collect()}
    # {9,10} matches whatever the order of ids; 5 needs item 11; 10 is in the basket.
    assert set(got) == {3, 4, 6}
    assert got[3].rule_score == pytest.approx(0.5 * 0.3)
    assert got[4].rule_score == pytest.approx(0.4 * 0.3 + 0.4 * 1.2) and got[4].levels == ["L4", "L5"]
    assert got[6].rule_score == pytest.approx(0.6 * 1.5) and got[6].levels == ["L3"]
    assert [got[p].position for p in (6, 4, 3)] == [1, 2, 3]


def test_unknown_user_gets_relaxed_contexts(spark, tables):
    st = run(spark, tables, [(1, 99, [9], "night", False, 2)])
    row = st.contexts.first()
    assert (row.behavior_cluster, row.preference_cluster, row.lifecycle_stage) == (-1, -1, "unknown")
    got = {r.product_id: r.rule_score for r in st.candidates.collect()}
    assert got[6] == pytest.approx(0.6 * 1.5 * 2 / 3)


def test_matched_context_trace(spark, tables):
    st = run(spark, tables, [(1, 1, [9], "night", False, 2)])
    rows = R.matched_contexts(st.contexts, st.matches, tables.rules, tables.popularity).collect()
    assert {(r.context_level, r.hits, r.level_weight) for r in rows} == {("L5", 2, 0.3), ("L4", 1, 1.2), ("L3", 1, 1.5)}


def test_fallback_tiers_and_positions(spark, tables):
    st = run(spark, tables, [(1, 1, [], "night", False, 1), (2, 2, [], "night", False, 1)])
    got = {}
    for r in st.pool.orderBy("request_id", "position").collect():
        got.setdefault(r.request_id, []).append((r.product_id, r.source))
    # No time list; the stage of user 1 has one, user 2 falls through to the global list.
    assert got[1] == [(7, ["POPULAR"]), (8, ["POPULAR"])]
    assert [p for p, _ in got[2]] == [1, 2, 3]


def test_insurance_fill_and_metadata(spark, tables):
    st = run(spark, tables, [(1, 1, [], "night", False, 5)])
    rows = R.recommendation_rows(st.final).orderBy("rank").collect()
    assert [r.item_id for r in rows][2:] == [1, 2, 3] and {r.item_id for r in rows[:2]} == {7, 8}
    assert rows[2].source == ["INSURANCE"] and rows[2].score == 0.0 and rows[2].context_level == []
    m = R.recommendation_metadata(st.final).first()
    assert (m.rule_candidates, m.fallback_used, m.insurance_used, m.final_returned) == (0, True, True, 5)
    assert (m.rule_item_count, m.popular_item_count, m.insurance_item_count) == (0, 2, 3)


def test_no_lists_at_all(spark, tables):
    bare = R.Tables(**{**tables.__dict__, "popularity": tables.popularity.limit(0)})
    st = run(spark, bare, [(1, 1, [2], "night", False, 2), (2, 1, [], "night", False, 2)])
    rows = {}
    for r in R.recommendation_rows(st.final).collect():
        rows.setdefault(r.request_id, []).append((r.item_id, r.source))
    # Products of the basket's department by id; a request without basket and lists gets nothing.
    assert set(rows) == {1} and all(s == ["SIMILAR_DEPT"] for _, s in rows[1])
    pool = sorted(r.product_id for r in st.pool.collect())
    assert pool == [2, 4, 6, 8, 10]
    m = {r.request_id: r.final_returned for r in R.recommendation_metadata(st.final).collect()}
    assert m == {1: 2, 2: 0}


def test_basket_may_be_excluded_from_the_fallback(spark, tables):
    rows = [(1, 1, [7], "night", False, 1)]
    with_it = {r.product_id for r in run(spark, tables, rows).pool.collect()}
    without = {r.product_id for r in run(spark, tables, rows, exclude_basket=True).pool.collect()}
    assert with_it == {7, 8} and without == {8}


@pytest.mark.parametrize("n,stage,heads", [(1, "new", 1), (3, "new", 1), (4, "loyal", 1), (10, "loyal", 3), (10, "vip", 3)])
def test_lifecycle_head_and_tail(spark, n, stage, heads):
    rows = [(1, i, i, stage, 1.0) for i in range(1, n + 1)]
    pool = frame(spark, rows, "request_id int, product_id int, position int, lifecycle_stage string, preference_score double")
    got = [r.lifecycle_score for r in R.lifecycle_scores(pool).orderBy("position").collect()]
    head, tail = {"new": (1.15, 1.0), "loyal": (0.95, 1.1), "vip": (1.0, 1.0)}[stage]
    assert got == [head] * heads + [tail] * (n - heads)


def test_ranking_normalises_each_source(spark):
    schema = "request_id int, product_id int, top_k int, rule_score double, behavior_score double, preference_score double, lifecycle_score double"
    rows = [
        (1, 1, 3, 2.0, -1.0, 0.5, 0.5),
        (1, 2, 3, 4.0, 1.0, 0.5, 0.7),
        (1, 3, 3, None, None, 0.5, 0.9),
        (2, 9, 3, 0.1, 0.1, 0.0, 0.0),
    ]
    got = {(r.request_id, r.product_id): (r.rank, r.score) for r in R.rank_pool(frame(spark, rows, schema)).collect()}
    # All equal gives 1, a missing source gives 0.
    assert got[(1, 2)] == (1, pytest.approx(0.5 + 0.2 + 0.2 + 0.05))
    assert got[(1, 3)] == (2, pytest.approx(0.2 + 0.1))
    assert got[(1, 1)] == (3, pytest.approx(0.2))
    assert got[(2, 9)] == (1, pytest.approx(1.0))
    with pytest.raises(ValueError):
        R.rank_pool(frame(spark, rows, schema), {"rule": 0.0})


def test_hot_request_context_and_item(spark, tables):
    """A third of the requests share context and basket; results stay one list per request."""
    rows = [(i, 1 if i % 3 == 0 else i, [9, 10], "night", False, 2) for i in range(300)]
    st = run(spark, tables, rows)
    per = R.recommendation_rows(st.final).groupBy("request_id").agg(F.count("item_id").alias("n"), F.countDistinct("item_id").alias("d"))
    assert {(r.n, r.d) for r in per.collect()} == {(2, 2)} and per.count() == 300


def test_cart_boost_skips_the_added_product(spark, tables):
    requests = frame(spark, [(1, 1, [7], "night", False, 5)], REQUESTS)
    st = R.recommend(requests, tables)
    row = R.cart_boost(st, requests).first()
    assert row.added_product_id == 7 and row.boost_product_id not in (7, None)


def test_request_validation(spark):
    rows = [("night", 1), ("noon", 5), ("evening", 0), ("evening", 100), ("evening", 101), (None, 5)]
    got = R.validate_requests(frame(spark, rows, "time_bucket string, top_k int")).collect()
    assert [r.reject_reason for r in got] == [None, "time_bucket", "top_k", None, "top_k", "time_bucket"]
    assert [r.valid for r in got] == [True, False, False, True, False, False]


def test_invalid_requests_come_back_with_a_reason(spark, tables):
    rows = [(1, 1, [9], "night", False, 2), (2, 1, [9], "noon", False, 2), (3, 2, [], "night", True, 101), (4, 2, [9], None, True, 0)]
    st = run(spark, tables, rows)
    checked = {r.request_id: r.reject_reason for r in R.validate_requests(frame(spark, rows, REQUESTS)).collect()}
    final = {r.request_id: r for r in st.final.collect()}
    assert {i: r.reject_reason for i, r in final.items()} == checked
    assert {i for i, r in final.items() if len(r["items"])} == {1}
    meta = {r.request_id: r for r in R.recommendation_metadata(st.final).collect()}
    assert (meta[2].final_returned, meta[2].fallback_used, meta[2].reject_reason) == (0, False, "time_bucket")
    assert run(spark, tables, rows, time_buckets=("night", "noon")).final.where("size(items) > 0").count() == 2


def test_a_list_of_eighty(spark, tables):
    popular = frame(spark, [("global", "", p, 500 - p, p) for p in range(1, 301)], POPULAR)
    products = frame(spark, [(p, 1, "odd") for p in range(1, 301)], "product_id long, department_id long, department string")
    wide = R.Tables(**{**tables.__dict__, "popularity": popular, "products": products})
    rows = R.recommendation_rows(run(spark, wide, [(1, 1, [9], "night", False, 80), (2, 2, [], "night", False, 100)]).final)
    assert {(r[0], r[1]) for r in rows.groupBy("request_id").count().collect()} == {(1, 80), (2, 100)}


def test_rules_match_on_all_items_of_a_basket(spark, tables):
    basket = list(range(20, 44)) + [99]
    rules = frame(spark, [("L5", "GLOBAL", [43, 99], 3, 0.5)], RULES)
    wide = R.Tables(**{**tables.__dict__, "rules": rules})
    assert [r.product_id for r in run(spark, wide, [(1, 1, basket, "night", False, 2)]).candidates.collect()] == [3]


def test_a_rule_is_anchored_on_its_rarest_item(spark, tables):
    got = {tuple(r.antecedent): r.anchor for r in R.anchors(tables.rules, tables.popularity).collect()}
    assert got[(9, 10)] == 9
    bought = frame(spark, [("global", "", 9, 50, 1), ("global", "", 10, 5, 2)], POPULAR)
    got = {tuple(r.antecedent): r.anchor for r in R.anchors(tables.rules, bought).collect()}
    assert got[(9, 10)] == 10 and got[(9, 10, 11)] == 11


def test_catalog(spark):
    products = frame(
        spark,
        [(2, "Red Ring", 5.0, 1), (1, "bolt", 6.0, 2), (3, None, 7.0, 1)],
        "product_id long, product_name string, price double, department_id long",
    )
    assert [r.product_id for r in catalog.search(products, "rING").collect()] == [2]
    assert [r.product_id for r in catalog.search(products, "r.d|b", regex=True).orderBy("product_id").collect()] == [1, 2]
    assert catalog.search(products, None, 1).count() == 2
    page = catalog.page(products, 2, 2).collect()
    assert [(r.product_id, r.total) for r in page] == [(3, 3)]
    many = frame(spark, [(7 * i,) for i in range(30_000)], "product_id long")
    assert [r.product_id for r in catalog.page(many, 1001, 20).collect()] == [7 * i for i in range(20_000, 20_020)]
    assert [r.product_id for r in catalog.page(many, 1500, 20).collect()] == [7 * i for i in range(29_980, 30_000)]
    assert catalog.page(many, 1501, 20).collect() == []
    assert catalog.lookup(products, 1).first().product_name == "bolt"
    got = {r.item_id: r for r in catalog.enrich(frame(spark, [(1,), (77,)], "item_id long"), products).collect()}
    assert got[77].product_name.endswith("#77") and got[77].price == 100000.0 and got[1].price == 6.0
    assert catalog.with_constant_price(products).first().price == 100000.0
    profile = catalog.user_profile(frame(spark, [(1, 9, 1, "vip")], SEGMENTS)).first()
    assert profile.behavior_text == "Không xác định" and profile.lifecycle_text == "Khách VIP"
    first = R.static_fallback(products, 2).orderBy("item_id").collect()
    assert [(r.item_id, r.score) for r in first] == [(1, 0.95), (2, 0.9)]
    assert catalog.fallback_profile(frame(spark, [(1,)], "user_id long")).first().lifecycle_stage == "unknown"
