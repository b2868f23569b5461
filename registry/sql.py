"""Named parts of the oracle SQL, and the assembly of a statement from the parts it uses."""

from __future__ import annotations

import re

# The statements say what the results should be, in numbers of their own.
TOP_K = 5

PARTS: dict[str, str] = {}


def statement(select: str) -> str:
    """Prefix ``select`` with every part it names, directly or through other parts."""
    order: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\bx_\w+", text):
            if name not in order:
                visit(PARTS[name])
                if name not in order:
                    order.append(name)

    visit(select)
    if not order:
        return select
    return "WITH " + ",\n".join(f"{n} AS MATERIALIZED ({PARTS[n].strip()})" for n in order) + "\n" + select


def half_up(x: str, digits: int = 6) -> str:
    scale = f"1e{digits}"
    return f"(floor(({x}) * {scale} + 0.5) / {scale})"


# ---- retail tables --------------------------------------------------------------------

PARTS["x_heads"] = """
SELECT o_orderkey AS order_id, o_custkey AS user_id, CAST(o_orderdate AS DATE) AS order_date,
       CAST(dayofweek(o_orderdate) AS INTEGER) AS order_dow,
       CAST((o_orderkey * 7) % 24 AS INTEGER) AS order_hour_of_day
FROM orders
"""

PARTS["x_orders"] = """
SELECT *,
       CAST(row_number() OVER w AS INTEGER) AS order_number,
       CAST(date_diff('day', lag(order_date) OVER w, order_date) AS DOUBLE) AS days_since_prior_order,
       CASE WHEN row_number() OVER w = count(*) OVER (PARTITION BY user_id) THEN 'train' ELSE 'prior' END AS eval_set
FROM x_heads
WINDOW w AS (PARTITION BY user_id ORDER BY order_date, order_id)
"""

PARTS["x_departments"] = """
SELECT row_number() OVER (ORDER BY p_type) AS department_id, p_type AS department FROM (SELECT DISTINCT p_type FROM part)
"""

PARTS["x_aisles"] = """
SELECT row_number() OVER (ORDER BY p_brand) AS aisle_id, p_brand AS aisle FROM (SELECT DISTINCT p_brand FROM part)
"""

PARTS["x_products"] = """
SELECT p_partkey AS product_id, p_name AS product_name, aisle_id, department_id, p_retailprice AS price
FROM part JOIN x_aisles ON aisle = p_brand JOIN x_departments ON department = p_type
"""

PARTS["x_brands"] = """
SELECT aisle_id AS product_id, p_brand AS product_name, aisle_id, department_id, p_type AS department, price
FROM (
  SELECT p_brand, p_type, min(price) OVER (PARTITION BY p_brand) AS price,
         row_number() OVER (PARTITION BY p_brand ORDER BY n DESC, p_type) AS r
  FROM (SELECT p_brand, p_type, count(*) AS n, min(p_retailprice) AS price FROM part GROUP BY 1, 2)
) JOIN x_aisles ON aisle = p_brand JOIN x_departments ON department = p_type
WHERE r = 1
"""

PARTS["x_part_lines"] = """
SELECT order_id, product_id, line_number, supplier_id FROM (
  SELECT l_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS line_number, l_suppkey AS supplier_id,
         row_number() OVER (PARTITION BY l_orderkey, l_partkey
                            ORDER BY l_linenumber, l_suppkey, l_quantity, l_extendedprice) AS r
  FROM lineitem) WHERE r = 1
"""

PARTS["x_brand_lines"] = """
SELECT l_orderkey AS order_id, aisle_id AS product_id, min(l_linenumber) AS line_number
FROM lineitem JOIN part ON p_partkey = l_partkey JOIN x_aisles ON aisle = p_brand GROUP BY 1, 2
"""


def _order_products(lines: str) -> str:
    return f"""
SELECT l.order_id, product_id, line_number, user_id, order_number, eval_set,
       CAST(order_number > min(order_number) OVER (PARTITION BY user_id, product_id) AS INTEGER) AS reordered
FROM {lines} l JOIN x_orders o ON o.order_id = l.order_id
"""


PARTS["x_part_op"] = _order_products("x_part_lines")
PARTS["x_brand_op"] = _order_products("x_brand_lines")

# ---- features and segments ------------------------------------------------------------

PARTS["x_behavior"] = """
SELECT o.user_id, total_orders, coalesce(avg_days, 0.0) AS avg_days_between_orders,
       coalesce(total_products, 0) AS total_products, coalesce(unique_products, 0) AS unique_products,
       coalesce(reorder_ratio, 0.0) AS reorder_ratio
FROM (SELECT user_id, count(DISTINCT order_id) AS total_orders, avg(days_since_prior_order) AS avg_days
      FROM x_orders GROUP BY 1) o
LEFT JOIN (SELECT user_id, count(product_id) AS total_products, count(DISTINCT product_id) AS unique_products,
                  avg(reordered) AS reorder_ratio
           FROM x_brand_op GROUP BY 1) p ON p.user_id = o.user_id
"""

PARTS["x_preference"] = """
SELECT user_id, department, n / sum(n) OVER (PARTITION BY user_id) AS preference_score
FROM (SELECT user_id, department, count(*) AS n
      FROM x_part_op JOIN x_products USING (product_id) JOIN x_departments USING (department_id) GROUP BY 1, 2)
"""

PARTS["x_lifecycle"] = """
SELECT *, last_order - first_order AS active_span,
       CASE WHEN total_orders <= 3 THEN 'new' WHEN total_orders <= 10 THEN 'regular'
            WHEN total_orders <= 50 THEN 'loyal' ELSE 'vip' END AS lifecycle_stage
FROM (SELECT user_id, min(order_number) AS first_order, max(order_number) AS last_order,
             count(DISTINCT order_id) AS total_orders, coalesce(sum(days_since_prior_order), 0.0) AS active_days
      FROM x_orders GROUP BY 1)
"""

PARTS["x_thresholds"] = """
SELECT quantile_cont(total_orders, 0.4) AS o40, quantile_cont(total_orders, 0.7) AS o70,
       quantile_cont(total_orders, 0.9) AS o90, quantile_cont(active_days, 0.5) AS d50,
       quantile_cont(active_days, 0.8) AS d80, quantile_cont(active_span, 0.7) AS s70
FROM x_lifecycle
"""

PARTS["x_stages"] = """
SELECT user_id, CASE WHEN total_orders >= o90 AND active_span >= s70 THEN 'vip'
                     WHEN total_orders >= o70 AND active_days >= d80 THEN 'loyal'
                     WHEN total_orders >= o40 THEN 'regular' ELSE 'new' END AS lifecycle_stage
FROM x_lifecycle, x_thresholds
"""

PARTS["x_clusters"] = """
SELECT c_custkey AS user_id, CAST(c_custkey % 5 AS INTEGER) AS behavior_cluster,
       CAST((c_custkey // 5) % 5 AS INTEGER) AS preference_cluster
FROM customer
"""

PARTS["x_frequency"] = """
SELECT user_id, CASE WHEN total_orders <= lo THEN 'low' WHEN total_orders <= hi THEN 'medium' ELSE 'high' END
       AS purchase_frequency
FROM x_behavior, (SELECT quantile_cont(total_orders, 0.33) AS lo, quantile_cont(total_orders, 0.67) AS hi FROM x_behavior)
"""

PARTS["x_segments"] = """
SELECT c.user_id, behavior_cluster, preference_cluster, coalesce(lifecycle_stage, 'unknown') AS lifecycle_stage
FROM x_clusters c LEFT JOIN x_stages s ON s.user_id = c.user_id
"""

# ---- baskets and contexts -------------------------------------------------------------

TIME_BUCKET = """CASE WHEN {h} < 6 THEN 'night' WHEN {h} < 12 THEN 'morning'
                 WHEN {h} < 18 THEN 'afternoon' ELSE 'evening' END"""

PARTS["x_basket_items"] = """
SELECT order_id, product_id, row_number() OVER (PARTITION BY order_id ORDER BY line_number, product_id) AS pos
FROM x_brand_lines
"""

PARTS["x_baskets"] = """
SELECT order_id, list(product_id ORDER BY pos) AS products, CAST(count(*) AS INTEGER) AS basket_size
FROM x_basket_items GROUP BY 1 HAVING count(*) >= 2
"""

PARTS["x_txn"] = f"""
SELECT o.order_id, o.user_id, products, {TIME_BUCKET.format(h="order_hour_of_day")} AS time_bucket,
       CAST(order_dow IN (0, 6) AS INTEGER) AS is_weekend, order_dow AS day_of_week,
       CASE WHEN basket_size < 5 THEN 'small' WHEN basket_size < 15 THEN 'medium' ELSE 'large' END AS basket_size_category,
       coalesce(purchase_frequency, 'medium') AS purchase_frequency, coalesce(lifecycle_stage, 'new') AS lifecycle_stage,
       coalesce(preference_cluster, 0) AS preference_cluster, coalesce(behavior_cluster, 0) AS behavior_cluster
FROM x_baskets b JOIN x_orders o ON o.order_id = b.order_id
LEFT JOIN x_frequency f ON f.user_id = o.user_id
LEFT JOIN x_stages s ON s.user_id = o.user_id
LEFT JOIN x_clusters c ON c.user_id = o.user_id
"""

PARTS["x_keys"] = """
SELECT *, 'time_bucket=' || time_bucket || '|is_weekend=' || is_weekend || '|lifecycle_stage=' || lifecycle_stage ||
          '|preference_cluster=' || preference_cluster || '|behavior_cluster=' || behavior_cluster AS context_L1,
       'time_bucket=' || time_bucket || '|is_weekend=' || is_weekend || '|behavior_cluster=' || behavior_cluster ||
          '|preference_cluster=' || preference_cluster AS context_L2,
       'time_bucket=' || time_bucket || '|is_weekend=' || is_weekend || '|behavior_cluster=' || behavior_cluster AS context_L3,
       'time_bucket=' || time_bucket || '|is_weekend=' || is_weekend AS context_L4,
       'GLOBAL' AS context_L5
FROM x_txn
"""

PARTS["x_txn_ctx"] = " UNION ALL ".join(
    f"SELECT order_id, products, 'L{i}' AS context_level, context_L{i} AS context_key FROM x_keys" for i in range(1, 6)
)

PARTS["x_ctx_counts"] = "SELECT context_level, context_key, count(*) AS n FROM x_txn_ctx GROUP BY 1, 2"

PASSES = "n >= CASE context_level WHEN 'L1' THEN 50 WHEN 'L2' THEN 100 WHEN 'L3' THEN 200 WHEN 'L4' THEN 1000 ELSE 50 END"


# ---- mining ---------------------------------------------------------------------------

PARTS["x_sets"] = """
WITH RECURSIVE grown AS (
  SELECT order_id, [product_id] AS items, product_id AS last FROM x_basket_items
  UNION ALL
  SELECT g.order_id, list_append(items, product_id), product_id
  FROM grown g JOIN x_basket_items b ON b.order_id = g.order_id AND b.product_id > g.last)
SELECT order_id, items FROM grown
"""

PARTS["x_set_counts"] = """
SELECT context_level, context_key, items, count(*) AS cnt
FROM x_txn_ctx JOIN x_sets USING (order_id) GROUP BY 1, 2, 3
"""


PARTS["x_m_params"] = f"""
SELECT context_level, context_key, n, 0.002::DOUBLE AS min_support, CAST(greatest(5, ceil(0.002::DOUBLE * n)) AS BIGINT) AS min_count
FROM x_ctx_counts WHERE {PASSES}
"""

PARTS["x_m_sets"] = """
SELECT c.context_level, c.context_key, items, cnt, n
FROM x_set_counts c JOIN x_m_params p ON p.context_level = c.context_level AND p.context_key = c.context_key
WHERE cnt >= min_count
"""

PARTS["x_m_rules"] = """
SELECT s.context_level, s.context_key, s.antecedent, s.consequent, s.cnt / a.cnt AS confidence,
       (s.cnt / a.cnt) / (c.cnt / s.n) AS lift, s.cnt / s.n AS support
FROM (SELECT *, list_filter(items, lambda i: i <> consequent) AS antecedent
      FROM (SELECT *, unnest(items) AS consequent FROM x_m_sets WHERE len(items) >= 2)) s
JOIN x_m_sets a ON a.context_level = s.context_level AND a.context_key = s.context_key AND a.items = s.antecedent
JOIN x_m_sets c ON c.context_level = s.context_level AND c.context_key = s.context_key AND c.items = [s.consequent]
"""

PARTS["x_m_kept"] = "SELECT * FROM x_m_rules WHERE confidence >= 0.1 AND lift >= 1.05 AND len(antecedent) <= 3"

PARTS["x_m_scored"] = """
SELECT *, confidence * 0.6::DOUBLE + least(lift, 10.0) * 0.04::DOUBLE + support * CAST(1.0::DOUBLE - 0.6::DOUBLE - 0.04::DOUBLE AS DOUBLE)
          AS raw_score
FROM x_m_kept
"""

PARTS["x_m_index"] = f"""
SELECT context_level, context_key, antecedent, consequent,
       md5(array_to_string(list_sort(list_transform(antecedent, lambda i: CAST(i AS VARCHAR))), '|') || '->' || consequent) AS rule_id,
       {half_up("confidence", 4)} AS confidence, {half_up("least(lift, 10.0)", 4)} AS lift,
       {half_up("support", 6)} AS support, {half_up("raw_score", 4)} AS score,
       CAST(row_number() OVER (PARTITION BY context_level, context_key, antecedent ORDER BY raw_score DESC, consequent) AS INTEGER)
       AS antecedent_rank
FROM x_m_scored
"""

# ---- popularity and score tables ------------------------------------------------------

PARTS["x_prior"] = "SELECT * FROM x_brand_op WHERE eval_set = 'prior'"
PARTS["x_train"] = "SELECT * FROM x_brand_op WHERE eval_set = 'train'"

PARTS["x_bought"] = f"""
SELECT p.user_id, p.order_id, p.product_id, lifecycle_stage, behavior_cluster,
       {TIME_BUCKET.format(h="order_hour_of_day")} AS time_bucket
FROM x_prior p JOIN x_heads h ON h.order_id = p.order_id
JOIN x_stages s ON s.user_id = p.user_id JOIN x_clusters c ON c.user_id = p.user_id
"""

PARTS["x_popularity"] = """
SELECT tier, tier_key, product_id, cnt, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY tier, tier_key ORDER BY cnt DESC, product_id) AS rank
  FROM (
    SELECT 'global' AS tier, '' AS tier_key, product_id, count(*) AS cnt FROM x_prior GROUP BY ALL
    UNION ALL SELECT 'lifecycle', lifecycle_stage, product_id, count(*) FROM x_bought GROUP BY ALL
    UNION ALL SELECT 'behavior', CAST(behavior_cluster AS VARCHAR), product_id, count(*) FROM x_bought GROUP BY ALL
    UNION ALL SELECT 'time', time_bucket, product_id, count(*) FROM x_bought GROUP BY ALL))
WHERE rank <= 300
"""

PARTS["x_behavior_scores"] = """
SELECT behavior_cluster, department_id, n / sum(n) OVER (PARTITION BY behavior_cluster) AS score
FROM (SELECT behavior_cluster, department_id, count(*) AS n
      FROM x_prior p JOIN x_clusters c ON c.user_id = p.user_id JOIN x_brands b ON b.product_id = p.product_id GROUP BY 1, 2)
"""

PARTS["x_preference_scores"] = """
SELECT preference_cluster, department,
       CAST(sum(CAST(round(preference_score * 1e9) AS BIGINT)) AS DOUBLE) / 1e9 / count(*) AS score
FROM x_preference JOIN x_clusters USING (user_id) GROUP BY 1, 2
"""

# ---- requests -------------------------------------------------------------------------

PARTS["x_requests"] = f"""
SELECT o.user_id AS request_id, o.user_id,
       coalesce(b.basket, []) AS basket, {TIME_BUCKET.format(h="order_hour_of_day")} AS time_bucket,
       order_dow IN (0, 6) AS is_weekend, {TOP_K} AS top_k
FROM x_orders o LEFT JOIN (
  SELECT user_id, list(product_id ORDER BY r) AS basket FROM (
    SELECT user_id, product_id, row_number() OVER (
             PARTITION BY user_id ORDER BY order_number DESC, line_number DESC, product_id DESC) AS r FROM x_prior)
  WHERE r <= 10 GROUP BY 1) b ON b.user_id = o.user_id
WHERE eval_set = 'train'
"""

PARTS["x_eval_requests"] = f"""
SELECT user_id AS request_id, user_id, list(product_id ORDER BY r) AS basket, 'unknown' AS time_bucket,
       false AS is_weekend, {TOP_K} AS top_k
FROM (SELECT user_id, product_id, row_number() OVER (
             PARTITION BY user_id ORDER BY order_number DESC, line_number DESC, product_id DESC) AS r FROM x_prior)
WHERE r <= 5 AND user_id IN (SELECT user_id FROM x_train) GROUP BY user_id
"""

PARTS["x_cart_requests"] = f"""
SELECT event_id AS request_id, user_id, [b.product_id] AS basket, {TIME_BUCKET.format(h="hour(ts)")} AS time_bucket,
       dayofweek(ts) IN (0, 6) AS is_weekend, 5 AS top_k
FROM events JOIN part ON p_partkey = CAST(json_extract_string(props, '$.k') AS BIGINT) JOIN x_brands b ON b.product_name = p_brand
WHERE event_type = 'click'
"""


def _recommendation(p: str, requests: str) -> None:
    """The recommendation steps for one request table, as parts ``x_{p}_*``."""
    PARTS[f"x_{p}_ctx"] = f"""
SELECT r.*, CAST(is_weekend AS INTEGER) AS weekend, coalesce(behavior_cluster, -1) AS behavior_cluster,
       coalesce(preference_cluster, -1) AS preference_cluster, coalesce(lifecycle_stage, 'unknown') AS lifecycle_stage,
       'time_bucket=' || time_bucket || '|is_weekend=' || CAST(is_weekend AS INTEGER) || '|lifecycle_stage=' ||
       coalesce(lifecycle_stage, 'unknown') || '|preference_cluster=' || coalesce(preference_cluster, -1) ||
       '|behavior_cluster=' || coalesce(behavior_cluster, -1) AS signature
FROM {requests} r LEFT JOIN x_segments s ON s.user_id = r.user_id
"""
    PARTS[f"x_{p}_match"] = f"""
SELECT * FROM (
  SELECT signature, context_level, context_key,
         CASE WHEN context_key = 'GLOBAL' THEN 1.0::DOUBLE ELSE
           len(list_filter(string_split(context_key, '|'), lambda part: list_contains(string_split(signature, '|'), part)))
           / len(string_split(context_key, '|')) END AS match_ratio
  FROM (SELECT DISTINCT signature FROM x_{p}_ctx), (SELECT DISTINCT context_level, context_key FROM x_m_index))
WHERE match_ratio >= 0.6
"""
    PARTS[f"x_{p}_carts"] = f"""
SELECT request_id, top_k, signature, basket, list_distinct(basket) AS cart FROM x_{p}_ctx
"""
    PARTS[f"x_{p}_hits"] = f"""
SELECT request_id, top_k, m.context_level, m.context_key, match_ratio, antecedent, consequent AS product_id,
       CAST(round(score * CASE m.context_level WHEN 'L1' THEN 2.0::DOUBLE WHEN 'L2' THEN 1.8::DOUBLE WHEN 'L3' THEN 1.5::DOUBLE
                  WHEN 'L4' THEN 1.2::DOUBLE ELSE 0.3::DOUBLE END * match_ratio * 1e9) AS BIGINT) AS units
FROM x_{p}_carts c JOIN x_{p}_match m ON m.signature = c.signature
JOIN x_m_index r ON r.context_level = m.context_level AND r.context_key = m.context_key
WHERE list_has_all(cart, antecedent) AND NOT list_contains(basket, consequent)
"""
    PARTS[f"x_{p}_cands"] = f"""
SELECT request_id, product_id, CAST(units AS DOUBLE) / 1e9 AS rule_score, levels, position FROM (
  SELECT request_id, top_k, product_id, sum(units) AS units, list_sort(list(DISTINCT context_level)) AS levels,
         row_number() OVER (PARTITION BY request_id ORDER BY sum(units) DESC, product_id) AS position
  FROM x_{p}_hits GROUP BY request_id, top_k, product_id)
WHERE position <= 3 * top_k
"""
    PARTS[f"x_{p}_need"] = f"""
SELECT c.*, coalesce(n, 0) AS rule_candidates, greatest(top_k - coalesce(n, 0), 0) AS need
FROM x_{p}_ctx c LEFT JOIN (SELECT request_id, count(*) AS n FROM x_{p}_cands GROUP BY 1) k ON k.request_id = c.request_id
"""
    PARTS[f"x_{p}_tier"] = f"""
SELECT request_id, need, rule_candidates,
       CASE WHEN time_bucket IN (SELECT tier_key FROM x_popularity WHERE tier = 'time') THEN 'time'
            WHEN lifecycle_stage IN (SELECT tier_key FROM x_popularity WHERE tier = 'lifecycle') THEN 'lifecycle'
            WHEN CAST(behavior_cluster AS VARCHAR) IN (SELECT tier_key FROM x_popularity WHERE tier = 'behavior') THEN 'behavior'
            ELSE 'global' END AS tier, time_bucket, lifecycle_stage, behavior_cluster
FROM x_{p}_need WHERE need > 0
"""
    PARTS[f"x_{p}_fallback"] = f"""
SELECT t.request_id, q.product_id, CAST(q.rank - 1 AS INTEGER) AS position, 1.0::DOUBLE - (q.rank - 1) * 0.001::DOUBLE AS score,
       'POPULAR' AS source, rule_candidates + q.rank AS pool_position
FROM x_{p}_tier t JOIN x_popularity q ON q.tier = t.tier AND q.tier_key =
     CASE t.tier WHEN 'time' THEN time_bucket WHEN 'lifecycle' THEN lifecycle_stage
                 WHEN 'behavior' THEN CAST(behavior_cluster AS VARCHAR) ELSE '' END
WHERE q.rank <= 3 * need
  AND NOT EXISTS (SELECT 1 FROM x_{p}_cands c WHERE c.request_id = t.request_id AND c.product_id = q.product_id)
"""
    PARTS[f"x_{p}_pool"] = f"""
SELECT k.request_id, k.product_id, k.position, k.rule_score, k.levels, k.source, c.top_k, c.lifecycle_stage,
       b.department_id, b.department,
       coalesce(bs.score, 1.0) AS behavior_weight, k.rule_score * coalesce(bs.score, 1.0) AS behavior_score,
       coalesce(ps.score, 0.0) AS preference_score
FROM (SELECT request_id, product_id, position, rule_score, levels, 'RULE' AS source FROM x_{p}_cands
      UNION ALL SELECT request_id, product_id, pool_position, NULL, [], source FROM x_{p}_fallback) k
JOIN x_{p}_ctx c ON c.request_id = k.request_id
LEFT JOIN x_brands b ON b.product_id = k.product_id
LEFT JOIN x_behavior_scores bs ON bs.behavior_cluster = c.behavior_cluster AND bs.department_id = b.department_id
LEFT JOIN x_preference_scores ps ON ps.preference_cluster = c.preference_cluster AND ps.department = b.department
"""
    PARTS[f"x_{p}_life"] = f"""
SELECT *, preference_score * CASE WHEN i <= greatest(1, floor(n * 0.3::DOUBLE))
            THEN CASE lifecycle_stage WHEN 'new' THEN 1.15::DOUBLE WHEN 'loyal' THEN 0.95::DOUBLE ELSE 1.0::DOUBLE END
            ELSE CASE lifecycle_stage WHEN 'loyal' THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END END AS lifecycle_score
FROM (SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY preference_score DESC, position) AS i,
             count(*) OVER (PARTITION BY request_id) AS n FROM x_{p}_pool)
"""
    scaled = []
    for c in ("rule", "behavior", "preference", "lifecycle"):
        x, lo, hi = f"{c}_score", f"min({c}_score) OVER w", f"max({c}_score) OVER w"
        scaled.append(
            f"CASE WHEN {x} IS NULL THEN 0.0::DOUBLE WHEN {lo} = {hi} THEN 1.0::DOUBLE"
            f" ELSE ({x} - {lo}) / ({hi} - {lo}) END AS {c}_n"
        )
    PARTS[f"x_{p}_scaled"] = f"""
SELECT *, {", ".join(scaled)} FROM x_{p}_life WINDOW w AS (PARTITION BY request_id)
"""
    total = "(0.5::DOUBLE * rule_n + 0.2::DOUBLE * behavior_n + 0.2::DOUBLE * preference_n + 0.1::DOUBLE * lifecycle_n)"
    PARTS[f"x_{p}_ranked"] = f"""
SELECT * FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY score DESC, product_id) AS rank
  FROM (SELECT *, {half_up(total, 9)} AS score FROM x_{p}_scaled)) WHERE rank <= top_k
"""
    PARTS[f"x_{p}_have"] = f"SELECT request_id, top_k, count(*) AS n FROM x_{p}_ranked GROUP BY 1, 2"
    PARTS[f"x_{p}_fill"] = f"""
SELECT * FROM (
  SELECT request_id, top_k, n + row_number() OVER (PARTITION BY request_id ORDER BY q.rank) AS rank, product_id
  FROM x_{p}_have h JOIN x_popularity q ON q.tier = 'global' AND h.n < h.top_k
  WHERE NOT EXISTS (SELECT 1 FROM x_{p}_ranked k WHERE k.request_id = h.request_id AND k.product_id = q.product_id))
WHERE rank <= top_k
"""
    PARTS[f"x_{p}_recs"] = f"""
SELECT k.request_id, user_id, CAST(rank AS INTEGER) AS rank, k.product_id AS item_id, score, source,
       array_to_string(levels, '|') AS context_level
FROM (SELECT request_id, rank, product_id, score, source, levels FROM x_{p}_ranked
      UNION ALL SELECT request_id, rank, product_id, 0.0, 'INSURANCE', [] FROM x_{p}_fill) k
JOIN x_{p}_ctx c ON c.request_id = k.request_id
"""
    PARTS[f"x_{p}_meta"] = f"""
SELECT d.request_id, user_id, CAST(rule_candidates AS INTEGER) AS rule_candidates, rule_candidates < top_k AS fallback_used,
       coalesce(ranked_n, 0) > 0 AND ranked_n < top_k AS insurance_used,
       CAST(coalesce(n, 0) AS INTEGER) AS final_returned, CAST(coalesce(rule_n, 0) AS INTEGER) AS rule_item_count,
       CAST(coalesce(pop_n, 0) AS INTEGER) AS popular_item_count, CAST(coalesce(ins_n, 0) AS INTEGER) AS insurance_item_count,
       CAST(NULL AS VARCHAR) AS reject_reason
FROM x_{p}_need d LEFT JOIN (
  SELECT request_id, count(*) AS n, count(*) FILTER (source <> 'INSURANCE') AS ranked_n, count(*) FILTER (source = 'RULE') AS rule_n,
         count(*) FILTER (source = 'POPULAR') AS pop_n, count(*) FILTER (source = 'INSURANCE') AS ins_n
  FROM x_{p}_recs GROUP BY 1) k ON k.request_id = d.request_id
"""


_recommendation("r", "x_requests")
_recommendation("e", "x_eval_requests")
_recommendation("c", "x_cart_requests")

PARTS["x_user_metrics"] = f"""
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
       CASE WHEN hits > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS hit_rate
FROM (
  SELECT r.user_id, hits, relevant, hits / {float(TOP_K)}::DOUBLE AS precision, hits / relevant AS recall
  FROM (SELECT e.user_id, count(t.product_id) AS hits FROM x_e_recs e
        LEFT JOIN (SELECT DISTINCT user_id, product_id FROM x_train) t
               ON t.user_id = e.user_id AND t.product_id = e.item_id AND e.rank <= {TOP_K} GROUP BY 1) r
  JOIN (SELECT user_id, count(DISTINCT product_id) AS relevant FROM x_train GROUP BY 1) t ON t.user_id = r.user_id)
"""
