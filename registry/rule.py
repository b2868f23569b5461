"""Queries on context transactions, itemsets, rules and popularity."""

import datetime as dt

from cartwright.config import SERVING_LIST_SIZE, TOP_RULES_PER_ANTECEDENT, TOP_RULES_PER_CONTEXT
from cartwright.functions.scoring import antecedent_text
from cartwright.lineage import stage
from cartwright.operators.ranking import top_n
from cartwright.plans import popularity, popularity_days, prep, rules
from cartwright.sources import day_counts
from registry.common import F, Fixture, set_text, shown
from registry.sql import PARTS, PASSES, TIME_BUCKET, half_up, statement

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = statement(sql)
        return fn

    return add


CTX = ("context_level", "context_key")
SQL_ANT = "array_to_string(antecedent, '|') AS antecedent"


@query(
    "context_counts",
    f"""SELECT context_level, context_key, n, {PASSES} AS passes FROM x_ctx_counts""",
)
def context_counts(spark, path):
    f = Fixture.of(spark, path)
    counts = rules.context_counts(f.brand_transactions)
    passes = (F.col("n") >= rules.level_gate(f.mining)) & (F.col("n") >= f.mining.floor)
    return counts.withColumn("passes", passes)


@query(
    "context_top",
    """SELECT context_level, context_key, n, CAST(r AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY context_level ORDER BY n DESC, context_key) AS r FROM x_ctx_counts) WHERE r <= 10""",
)
def context_top(spark, path):
    """The ten most frequent contexts of every level."""
    counts = rules.context_counts(Fixture.of(spark, path).brand_transactions)
    return top_n(counts, ["context_level"], [F.col("n").desc(), F.col("context_key")], 10)


@query(
    "context_sample",
    """SELECT context_level, context_key FROM x_ctx_counts
       ORDER BY md5(context_level || ':' || context_key || ':42'), context_level, context_key LIMIT 20""",
)
def context_sample(spark, path):
    """The sampling operator: twenty random context keys."""
    return rules.sample_keys(rules.context_counts(Fixture.of(spark, path).brand_transactions), 20)


@query(
    "context_transactions",
    f"""SELECT t.context_level, t.context_key, order_id, array_to_string(products, '|') AS items
        FROM x_txn_ctx t JOIN (SELECT * FROM x_ctx_counts WHERE {PASSES}) c
             ON c.context_level = t.context_level AND c.context_key = t.context_key""",
)
def context_transactions(spark, path):
    f = Fixture.of(spark, path)
    out = rules.context_transactions(f.brand_transactions, f.mining)
    return out.withColumn("items", set_text(F.col("items")))


CAP = 400


@query(
    "capped_transactions",
    f"""SELECT context_level, context_key, order_id FROM (
          SELECT t.context_level, t.context_key, order_id, row_number() OVER (
                 PARTITION BY t.context_level, t.context_key ORDER BY md5(order_id || ':42'), order_id) AS r
          FROM x_txn_ctx t JOIN (SELECT * FROM x_ctx_counts WHERE {PASSES}) c
               ON c.context_level = t.context_level AND c.context_key = t.context_key) WHERE r <= {CAP}""",
)
def capped_transactions(spark, path):
    """The sampling operator: at most 400 random transactions of each context. Mining does not use it."""
    f = Fixture.of(spark, path)
    out = rules.context_transactions(f.brand_transactions, f.mining)
    return rules.cap_transactions(out.select(*CTX, "order_id"), CAP)


@query(
    "adaptive_params",
    """SELECT context_level, context_key, n * 40 AS n,
              CASE WHEN n * 40 > 500000 THEN 0.02::DOUBLE WHEN n * 40 > 200000 THEN 0.01::DOUBLE ELSE 0.002::DOUBLE END AS min_support,
              CASE WHEN n * 40 > 500000 THEN 1 WHEN n * 40 > 200000 THEN 2 ELSE 3 END AS max_antecedent,
              CAST(ceil(CASE WHEN n * 40 > 500000 THEN 0.02::DOUBLE WHEN n * 40 > 200000 THEN 0.01::DOUBLE
                             ELSE 0.002::DOUBLE END * (n * 40)) AS BIGINT) AS min_count
       FROM x_ctx_counts""",
)
def adaptive_params(spark, path):
    """A table of thresholds by size, for 40 times the transactions. Nothing mines by it."""
    counts = rules.context_counts(Fixture.of(spark, path).brand_transactions)
    return rules.adaptive_params(counts.withColumn("n", F.col("n") * 40))


@query(
    "frequent_itemsets",
    """SELECT context_level, context_key, array_to_string(items, '|') AS items, CAST(len(items) AS INTEGER) AS size, cnt, n
       FROM x_m_sets""",
)
def frequent_itemsets(spark, path):
    """All frequent itemsets of all contexts; later queries read the same table."""
    return Fixture.of(spark, path).itemsets.withColumn("items", set_text(F.col("items")))


@query(
    "itemsets_updated",
    """SELECT context_level, context_key, array_to_string(items, '|') AS items, CAST(len(items) AS INTEGER) AS size, cnt, n
       FROM x_m_sets""",
)
def itemsets_updated(spark, path):
    """The same itemsets from counts that grew with three batches."""
    return Fixture.of(spark, path).updated_itemsets.withColumn("items", set_text(F.col("items")))


@query(
    "association_rules",
    f"""SELECT context_level, context_key, {SQL_ANT}, consequent, {half_up("confidence")} AS confidence,
               {half_up("lift")} AS lift, {half_up("support")} AS support FROM x_m_rules""",
)
def association_rules(spark, path):
    out = rules.association_rules(Fixture.of(spark, path).itemsets).drop("n")
    return shown(out.withColumn("antecedent", set_text(F.col("antecedent"))), "confidence", "lift", "support")


@query(
    "rules_filtered",
    f"""SELECT context_level, context_key, {SQL_ANT}, consequent, {half_up("confidence")} AS confidence,
               {half_up("lift")} AS lift, CAST(context_rank AS INTEGER) AS context_rank
        FROM (SELECT *, row_number() OVER (PARTITION BY context_level, context_key
                                           ORDER BY lift DESC, confidence DESC, antecedent, consequent) AS context_rank FROM x_m_kept)
        WHERE context_rank <= 3000""",
)
def rules_filtered(spark, path):
    """The top-n operator: the best 3,000 rules of each context, numbered."""
    f = Fixture.of(spark, path)
    out = rules.filter_rules(rules.association_rules(f.itemsets), f.mining, TOP_RULES_PER_CONTEXT)
    out = out.select(*CTX, set_text(F.col("antecedent")).alias("antecedent"), "consequent", "confidence", "lift", "context_rank")
    return shown(out, "confidence", "lift")


@query(
    "rule_index",
    f"""SELECT context_level, context_key, rule_id, {SQL_ANT}, consequent, confidence, lift, support, score
        FROM x_m_index""",
)
def rule_index(spark, path):
    """All rules of all contexts, scored."""
    f = Fixture.of(spark, path)
    index = rules.build_index(rules.filter_rules(rules.association_rules(f.itemsets), f.mining), f.mining)
    return index.withColumn("antecedent", set_text(F.col("antecedent")))


@query(
    "rule_index_updated",
    f"""SELECT context_level, context_key, rule_id, {SQL_ANT}, consequent, confidence, lift, support, score
        FROM x_m_index""",
)
def rule_index_updated(spark, path):
    """The rules of the updated itemsets, scored."""
    f = Fixture.of(spark, path)
    kept = rules.filter_rules(rules.association_rules(f.updated_itemsets), f.mining)
    return rules.build_index(kept, f.mining).withColumn("antecedent", set_text(F.col("antecedent")))


@query(
    "rules_per_antecedent",
    f"""SELECT context_level, context_key, rule_id, {SQL_ANT}, consequent, confidence, lift, support, score, antecedent_rank
        FROM x_m_index WHERE antecedent_rank <= 10""",
)
def rules_per_antecedent(spark, path):
    """The top-n operator: the ten best rules of each antecedent, numbered."""
    f = Fixture.of(spark, path)
    kept = rules.filter_rules(rules.association_rules(f.itemsets), f.mining)
    index = rules.build_index(kept, f.mining, TOP_RULES_PER_ANTECEDENT)
    return index.withColumn("antecedent", set_text(F.col("antecedent")))


@query(
    "rule_build_stats",
    """SELECT i.*, o.* FROM (SELECT count(*) AS rules_in, 0::BIGINT AS rules_invalid, count(*) FILTER (lift < 1.05) AS rules_low_lift,
              count(DISTINCT (context_level, context_key, antecedent)) AS antecedents_in FROM x_m_rules) i,
             (SELECT count(*) AS rules_kept, count(DISTINCT (context_level, context_key, antecedent)) AS antecedents_out FROM (
                SELECT *, row_number() OVER (PARTITION BY context_level, context_key, antecedent
                   ORDER BY confidence * 0.6::DOUBLE + least(lift, 10.0) * 0.04::DOUBLE + support * 0.36::DOUBLE DESC, consequent) AS r
                FROM x_m_rules WHERE lift >= 1.05) WHERE r <= 10) o""",
)
def rule_build_stats(spark, path):
    """Counters of an index built from all rules, before any filter."""
    f = Fixture.of(spark, path)
    # Read by the counters and by the index, so the rules are made once.
    found = stage(rules.association_rules(f.itemsets), "rules-found")
    return rules.build_stats(found, rules.build_index(found, f.mining, TOP_RULES_PER_ANTECEDENT), f.mining)


@query(
    "rule_stats",
    """SELECT context_level, count(DISTINCT context_key) AS contexts,
              count(DISTINCT (context_key, antecedent)) AS antecedents, count(*) AS rules FROM x_m_index GROUP BY 1""",
)
def rule_stats(spark, path):
    return rules.rule_stats(Fixture.of(spark, path).index)


@query(
    "mining_stats",
    f"""SELECT p.context_level, p.context_key, n AS num_transactions, min_support, 0.1::DOUBLE AS min_confidence,
               coalesce(s.c, 0) AS num_frequent_itemsets, coalesce(r.c, 0) AS num_rules,
               coalesce({half_up("r.a", 4)}, 0) AS avg_confidence, coalesce(r.m, 0) AS max_confidence,
               CAST(NULL AS DOUBLE) AS run_time, 'success' AS status, '' AS error
        FROM x_m_params p
        LEFT JOIN (SELECT context_level, context_key, count(*) AS c FROM x_m_sets GROUP BY 1, 2) s
               ON s.context_level = p.context_level AND s.context_key = p.context_key
        LEFT JOIN (SELECT context_level, context_key, count(*) AS c, max(confidence) AS m,
                          sum(CAST(round(confidence * 10000) AS BIGINT)) / count(*) / 10000 AS a FROM x_m_index GROUP BY 1, 2) r
               ON r.context_level = p.context_level AND r.context_key = p.context_key""",
)
def mining_stats(spark, path):
    f = Fixture.of(spark, path)
    params = rules.mining_params(rules.passing_contexts(rules.context_counts(f.brand_transactions), f.mining), f.mining)
    return rules.mining_stats(f.itemsets, f.index, params, f.mining)


TOP_ORDER = "context_level, context_key, array_to_string(list_sort(list_transform(antecedent, lambda i: CAST(i AS VARCHAR))), '|'), consequent"


@query(
    "top_rules",
    f"""SELECT context_level, context_key, CAST(len(antecedent) AS INTEGER) AS antecedent_size,
               array_to_string(list_sort(list_transform(antecedent, lambda i: CAST(i AS VARCHAR))), '|') AS antecedent,
               consequent, support, confidence, lift FROM x_m_index ORDER BY lift DESC, {TOP_ORDER} LIMIT 10""",
)
def top_rules(spark, path):
    index = Fixture.of(spark, path).index
    flat = index.select(
        *CTX,
        F.size("antecedent").alias("antecedent_size"),
        antecedent_text(F.col("antecedent")).alias("antecedent"),
        "consequent",
        "support",
        "confidence",
        "lift",
    )
    return rules.top_rules(flat, 10)


@query(
    "rule_sample",
    """SELECT context_level, context_key, CAST(len(antecedent) AS INTEGER) AS antecedent_size,
              array_to_string(list_sort(list_transform(antecedent, lambda i: CAST(i AS VARCHAR))), '|') AS antecedent,
              consequent, support, confidence, lift
       FROM x_m_index WHERE (context_level, context_key) IN (
            SELECT (context_level, context_key) FROM (SELECT DISTINCT context_level, context_key FROM x_m_index)
            ORDER BY context_level, context_key LIMIT 5)""",
)
def rule_sample(spark, path):
    """Rules of the first five contexts, flattened for a look at their numbers."""
    return rules.rule_sample(Fixture.of(spark, path).index)


# ---- popularity -----------------------------------------------------------------------


@query(
    "popular_global",
    """SELECT product_id, cnt, CAST(row_number() OVER (ORDER BY cnt DESC, product_id) AS INTEGER) AS rank
       FROM (SELECT product_id, count(*) AS cnt FROM x_part_op GROUP BY 1) ORDER BY cnt DESC, product_id LIMIT 50""",
)
def popular_global(spark, path):
    f = Fixture.of(spark, path)
    return popularity.popular_global(f.part.basket_lines().select("product_id"))


def _popular_sql(key, source):
    return f"""SELECT {key}, product_id, cnt, CAST(r AS INTEGER) AS rank FROM (
                 SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY cnt DESC, product_id) AS r
                 FROM (SELECT {key}, product_id, count(*) AS cnt FROM {source} GROUP BY 1, 2)) WHERE r <= 50"""


@query("popular_by_lifecycle", _popular_sql("lifecycle_stage", "x_part_op JOIN x_stages USING (user_id)"))
def popular_by_lifecycle(spark, path):
    f = Fixture.of(spark, path)
    return popularity.popular_by(f.lines, f.stages, "user_id", "lifecycle_stage")


@query("popular_by_behavior", _popular_sql("behavior_cluster", "x_part_op JOIN x_clusters USING (user_id)"))
def popular_by_behavior(spark, path):
    f = Fixture.of(spark, path)
    clusters = f.behavior_clusters.withColumnRenamed("cluster", "behavior_cluster")
    return popularity.popular_by(f.lines, clusters, "user_id", "behavior_cluster")


PARTS["x_part_times"] = f"""SELECT product_id, {TIME_BUCKET.format(h="order_hour_of_day")} AS time_bucket
                            FROM x_part_lines JOIN x_heads USING (order_id)"""


@query("popular_by_time", _popular_sql("time_bucket", "x_part_times"))
def popular_by_time(spark, path):
    f = Fixture.of(spark, path)
    times = prep.order_context(f.part.order_heads()).select("order_id", "time_bucket")
    return popularity.popular_by(f.part.basket_lines(), times, "order_id", "time_bucket")


@query("popularity_merged", "SELECT tier, tier_key, product_id, cnt, CAST(rank AS INTEGER) AS rank FROM x_popularity")
def popularity_merged(spark, path):
    """The serving lists from counts per day that came in batches."""
    kept = day_counts.read(spark, Fixture.of(spark, path).day_counts)
    return popularity_days.lists(kept, SERVING_LIST_SIZE)


PARTS["x_bought_span"] = """SELECT b.* FROM x_bought b JOIN x_heads h ON h.order_id = b.order_id
                            WHERE order_date BETWEEN DATE '1999-07-01' AND DATE '2000-06-30'"""


@query(
    "popularity_span",
    """SELECT tier, tier_key, product_id, cnt, CAST(r AS INTEGER) AS rank FROM (
         SELECT *, row_number() OVER (PARTITION BY tier, tier_key ORDER BY cnt DESC, product_id) AS r FROM (
           SELECT 'global' AS tier, '' AS tier_key, product_id, count(*) AS cnt FROM x_bought_span GROUP BY ALL
           UNION ALL SELECT 'lifecycle', lifecycle_stage, product_id, count(*) FROM x_bought_span GROUP BY ALL
           UNION ALL SELECT 'behavior', CAST(behavior_cluster AS VARCHAR), product_id, count(*) FROM x_bought_span GROUP BY ALL
           UNION ALL SELECT 'time', time_bucket, product_id, count(*) FROM x_bought_span GROUP BY ALL))
       WHERE r <= 50""",
)
def popularity_span(spark, path):
    """Lists of one year; only the counts of its days are read."""
    kept = day_counts.read(spark, Fixture.of(spark, path).day_counts, dt.date(1999, 7, 1), dt.date(2000, 6, 30))
    return popularity_days.lists(kept)


@query(
    "popularity_lists",
    "SELECT tier, tier_key, array_to_string(list(product_id ORDER BY rank), '|') AS items FROM x_popularity GROUP BY 1, 2",
)
def popularity_lists(spark, path):
    lists = popularity.popularity_lists(Fixture.of(spark, path).popularity)
    return lists.withColumn("items", set_text(F.col("items")))

