"""Queries on recommendation and its evaluation."""

from cartwright.config import SERVE_DEFAULTS
from cartwright.plans import evaluate, recommend
from cartwright.plans.catalog import enrich, with_constant_price
from registry.common import F, Fixture, set_text, shown
from registry.fixture import TOP_K
from registry.sql import half_up, statement

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = statement(sql)
        return fn

    return add


@query(
    "validate_requests",
    """SELECT event_id, hour_text AS time_bucket, top_k, CASE WHEN hour_text NOT IN ('night', 'morning', 'afternoon', 'evening')
              THEN 'time_bucket' WHEN top_k NOT BETWEEN 1 AND 100 THEN 'top_k' END AS reject_reason,
              hour_text IN ('night', 'morning', 'afternoon', 'evening') AND top_k BETWEEN 1 AND 100 AS valid
       FROM (SELECT event_id, CASE WHEN hour(ts) < 6 THEN 'night' WHEN hour(ts) < 12 THEN 'morning'
                    WHEN hour(ts) < 18 THEN 'noon' ELSE 'evening' END AS hour_text,
                    CAST(floor(value) AS INTEGER) AS top_k FROM events)""",
)
def validate_requests(spark, path):
    """Events read as requests: their afternoon has a wrong name and their top_k may be 0."""
    hour = F.hour("ts")
    bucket = F.when(hour < 6, "night").when(hour < 12, "morning").when(hour < 18, "noon").otherwise("evening")
    events = Fixture.of(spark, path).part.table("events")
    rows = events.select("event_id", bucket.alias("time_bucket"), F.floor("value").cast("int").alias("top_k"))
    return recommend.validate_requests(rows)


@query(
    "user_basket",
    "SELECT user_id, array_to_string(basket, '|') AS basket FROM x_requests WHERE len(basket) > 0",
)
def user_basket(spark, path):
    out = evaluate.user_basket(Fixture.of(spark, path).prior_lines, 10)
    return out.withColumn("basket", set_text(F.col("basket")))


@query(
    "user_history",
    """SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY order_number, line_number, product_id) AS position,
              product_id FROM x_prior""",
)
def user_history(spark, path):
    return evaluate.user_history(Fixture.of(spark, path).prior_lines)


@query("user_ground_truth", "SELECT DISTINCT user_id, product_id FROM x_train")
def user_ground_truth(spark, path):
    return evaluate.user_ground_truth(Fixture.of(spark, path).train_lines)


@query(
    "request_context",
    """SELECT request_id, time_bucket, weekend AS is_weekend, behavior_cluster, preference_cluster, lifecycle_stage, signature
       FROM x_r_ctx""",
)
def request_context(spark, path):
    f = Fixture.of(spark, path)
    out = recommend.request_context(f.requests, f.user_segments)
    return out.select("request_id", "time_bucket", "is_weekend", *SERVE_DEFAULTS, "signature")


@query("context_match", f"SELECT signature, context_level, context_key, {half_up('match_ratio')} AS match_ratio FROM x_r_match")
def context_match(spark, path):
    f = Fixture.of(spark, path)
    sigs = recommend.signatures(recommend.request_context(f.requests, f.user_segments))
    out = recommend.context_match(sigs, f.rules.select("context_level", "context_key").distinct())
    return shown(out, "match_ratio")


@query(
    "rule_matches",
    """SELECT request_id, array_to_string(antecedent, '|') AS antecedent, product_id, CAST(sum(units) AS BIGINT) AS units
       FROM x_r_hits GROUP BY request_id, antecedent, product_id""",
)
def rule_matches(spark, path):
    out = Fixture.of(spark, path).served.rule_hits
    return out.select("request_id", set_text(F.col("antecedent")).alias("antecedent"), "product_id", "units")


@query(
    "rule_candidates",
    """SELECT request_id, product_id, rule_score, array_to_string(levels, '|') AS levels, CAST(position AS INTEGER) AS position
       FROM x_r_cands""",
)
def rule_candidates(spark, path):
    out = recommend.rule_candidates(Fixture.of(spark, path).served.rule_hits)
    return out.withColumn("levels", F.array_join("levels", "|"))


@query(
    "matched_contexts",
    f"""SELECT request_id, context_level, context_key, count(*) AS hits, {half_up("any_value(match_ratio)")} AS match_ratio,
               CASE context_level WHEN 'L1' THEN 2.0 WHEN 'L2' THEN 1.8 WHEN 'L3' THEN 1.5 WHEN 'L4' THEN 1.2 ELSE 0.3 END::DOUBLE
               AS level_weight FROM x_r_hits GROUP BY 1, 2, 3""",
)
def matched_contexts(spark, path):
    f = Fixture.of(spark, path)
    return shown(recommend.matched_contexts(f.served.contexts, f.served.matches, f.rules, f.popularity), "match_ratio")


@query(
    "fallback_recall",
    f"SELECT request_id, product_id, {half_up('score')} AS score, source, position FROM x_r_fallback",
)
def fallback_recall(spark, path):
    f = Fixture.of(spark, path)
    sigs = recommend.signatures(f.served.contexts)
    lists = recommend.signature_fallback(sigs, f.popularity)
    return shown(recommend.fallback_recall(f.served.summary, lists, f.brand_products), "score")


@query(
    "similar_department_recall",
    f"""SELECT request_id, product_id, CAST(r AS INTEGER) AS position FROM (
          SELECT request_id, product_id, row_number() OVER (PARTITION BY request_id ORDER BY product_id) AS r
          FROM (SELECT DISTINCT request_id, b.department FROM (SELECT request_id, unnest(basket) AS product_id FROM x_requests) q
                JOIN x_brands b ON b.product_id = q.product_id) d JOIN x_brands p ON p.department = d.department)
        WHERE r <= {3 * TOP_K}""",
)
def similar_department_recall(spark, path):
    f = Fixture.of(spark, path)
    return recommend.similar_department(f.requests, f.brand_products, F.col("top_k") * 3)


@query(
    "behavior_scores",
    f"""SELECT request_id, product_id, {half_up("behavior_weight")} AS behavior_weight, {half_up("behavior_score")} AS behavior_score
        FROM x_r_pool WHERE rule_score IS NOT NULL""",
)
def behavior_scores(spark, path):
    pool = Fixture.of(spark, path).served.pool.where(F.col("rule_score").isNotNull())
    return shown(pool.select("request_id", "product_id", "behavior_weight", "behavior_score"), "behavior_weight", "behavior_score")


@query("preference_scores", f"SELECT request_id, product_id, department, {half_up('preference_score')} AS preference_score FROM x_r_pool")
def preference_scores(spark, path):
    pool = Fixture.of(spark, path).served.pool
    return shown(pool.select("request_id", "product_id", "department", "preference_score"), "preference_score")


@query("lifecycle_scores", f"SELECT request_id, product_id, {half_up('lifecycle_score')} AS lifecycle_score FROM x_r_life")
def lifecycle_scores(spark, path):
    pool = Fixture.of(spark, path).served.pool
    return shown(pool.select("request_id", "product_id", "lifecycle_score"), "lifecycle_score")


@query("ranked", f"SELECT request_id, CAST(rank AS INTEGER) AS rank, product_id, {half_up('score')} AS score FROM x_r_ranked")
def ranked(spark, path):
    return shown(Fixture.of(spark, path).served.ranked.select("request_id", "rank", "product_id", "score"), "score")


@query("recommend", f"SELECT request_id, user_id, rank, item_id, {half_up('score')} AS score, source, context_level FROM x_r_recs")
def recommend_query(spark, path):
    """The flagship: ranked, source-tagged recommendations for every user."""
    f = Fixture.of(spark, path)
    rows = recommend.recommendation_rows(f.served.final)
    texts = {c: F.array_join(c, "|") for c in ("source", "context_level")}
    return shown(rows.withColumns(texts), "score")


@query("recommend_metadata", "SELECT * FROM x_r_meta")
def recommend_metadata(spark, path):
    return recommend.recommendation_metadata(Fixture.of(spark, path).served.final)


@query(
    "insurance_fill",
    """SELECT request_id, CAST(rank AS INTEGER) AS rank, product_id FROM (
         SELECT request_id, n + row_number() OVER (PARTITION BY request_id ORDER BY q.rank) AS rank, product_id
         FROM (SELECT request_id, count(*) AS n FROM x_r_ranked WHERE source = 'RULE' GROUP BY 1) h JOIN x_popularity q ON q.tier = 'global'
         WHERE n < 20 AND NOT EXISTS (SELECT 1 FROM x_r_ranked k WHERE k.request_id = h.request_id AND k.product_id = q.product_id
                                      AND k.source = 'RULE'))
       WHERE rank <= 20""",
)
def insurance_fill(spark, path):
    """Rule results alone filled up to 20 items from the global list; the filled rows."""
    f = Fixture.of(spark, path)
    only_rules = f.served.ranked.where(F.array_contains("source", recommend.RULE))
    filled = recommend.insurance_fill(f.served.summary.withColumn("top_k", F.lit(20)), only_rules, f.popularity)
    rows = recommend.recommendation_rows(filled).where(F.array_contains("source", recommend.INSURANCE))
    return rows.select("request_id", "rank", F.col("item_id").alias("product_id"))


@query(
    "enrich_recs",
    """SELECT request_id, rank, item_id, coalesce(product_name, 'Sản phẩm #' || item_id) AS product_name,
              100000.0::DOUBLE AS price, department_id
       FROM x_r_recs r LEFT JOIN x_brands b ON b.product_id = r.item_id""",
)
def enrich_recs(spark, path):
    """Recommendations with names and the constant price."""
    f = Fixture.of(spark, path)
    return enrich(f.recommendations.select("request_id", "rank", "item_id"), with_constant_price(f.brand_products))


# ---- evaluation -----------------------------------------------------------------------

METRICS = ("precision", "recall", "f1", "hit_rate")


@query(
    "precision_recall_at_k",
    "SELECT user_id, hits, relevant, " + ", ".join(f"{half_up(m)} AS {m}" for m in METRICS) + " FROM x_user_metrics",
)
def precision_recall_at_k(spark, path):
    return shown(Fixture.of(spark, path).evaluated, *METRICS)


@query(
    "offline_eval",
    "SELECT "
    + ", ".join(f"{half_up(f'avg({m})')} AS {m}" for m in METRICS)
    + ", count(*) AS num_users_evaluated FROM x_user_metrics",
)
def offline_eval(spark, path):
    """History from prior orders, truth from the last one, all users."""
    return shown(evaluate.summarize(Fixture.of(spark, path).evaluated), *METRICS)


@query(
    "coverage",
    f"""SELECT {half_up("avg(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END)")} AS user_coverage,
               {half_up("any_value(used / items)")} AS item_coverage
        FROM (SELECT c.user_id, (SELECT count(DISTINCT item_id) FROM x_r_recs) AS used, (SELECT count(*) FROM x_brands) AS items,
                     coalesce(r.n, 0) AS n
              FROM (SELECT DISTINCT user_id FROM x_r_ctx) c
              LEFT JOIN (SELECT user_id, count(*) AS n FROM x_r_recs GROUP BY 1) r ON r.user_id = c.user_id)""",
)
def coverage(spark, path):
    f = Fixture.of(spark, path)
    out = evaluate.coverage(f.requests.select("user_id"), f.recommendations, f.brand_products)
    return shown(out, "user_coverage", "item_coverage")


@query(
    "source_mix",
    f"""SELECT source, requests, {half_up("requests / sum(requests) OVER ()")} AS share,
               {half_up("sum(CASE WHEN source IN ('rules', 'rules+fallback') THEN requests ELSE 0 END) OVER () / sum(requests) OVER ()")}
               AS rule_hit_rate
        FROM (SELECT CASE WHEN rule_candidates >= {TOP_K} THEN 'rules' WHEN rule_candidates > 0 THEN 'rules+fallback' ELSE 'fallback' END
                     AS source, count(*) AS requests FROM x_r_meta GROUP BY 1)""",
)
def source_mix(spark, path):
    metadata = recommend.recommendation_metadata(Fixture.of(spark, path).served.final)
    return shown(evaluate.source_mix(evaluate.request_source(metadata)), "share", "rule_hit_rate")


RUNS = (10, 100, None)
RUN_SQL = " UNION ALL ".join(
    "SELECT count(*) AS num_users_evaluated, "
    + ", ".join(f"{half_up(f'avg({m})')} AS {m}" for m in METRICS)
    + f" FROM (SELECT * FROM x_user_metrics ORDER BY user_id{'' if n is None else f' LIMIT {n}'})"
    for n in RUNS
)


@query(
    "metric_stability",
    "SELECT num_users_evaluated, "
    + ", ".join(METRICS)
    + ", "
    + ", ".join(
        f"{half_up(f'abs({m} / nullif(lag({m}) OVER (ORDER BY num_users_evaluated), 0) - 1)')} AS {m}_change" for m in METRICS
    )
    + f", lead(num_users_evaluated) OVER (ORDER BY num_users_evaluated) IS NULL AS is_final FROM ({RUN_SQL})",
)
def metric_stability(spark, path):
    """Nested evaluation runs over the first 10, the first 100 and all users."""
    metrics = Fixture.of(spark, path).evaluated
    runs = None
    for n in RUNS:
        users = evaluate.evaluation_users(metrics, n)
        run = shown(evaluate.summarize(metrics, users), *METRICS)
        runs = run if runs is None else runs.unionByName(run)
    return shown(evaluate.metric_stability(runs), *[f"{m}_change" for m in METRICS])

