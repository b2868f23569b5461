"""Queries on cleaning, joins, features, baskets and contexts."""

from cartwright.functions import baskets as bk
from cartwright.functions.context import context_array, context_columns, infer_level
from cartwright.operators.quantiles import exact_quantiles, unpivot
from cartwright.plans import features, prep, segments
from cartwright.sources import typed
from cartwright.config import BEHAVIOR_FEATURES, TRAIN_DEFAULTS
from registry.common import F, Fixture, near, set_text, shown
from registry.sql import TIME_BUCKET, half_up, statement

QUERIES, ORACLES = {}, {}


def query(name, sql):
    def add(fn):
        QUERIES[name] = fn
        ORACLES[name] = statement(sql)
        return fn

    return add


@query(
    "typed_scan",
    """SELECT order_id, user_id, order_date, order_number, order_dow, order_hour_of_day, days_since_prior_order,
              order_dow IN (0, 6) AS weekend, coalesce(CAST(days_since_prior_order AS VARCHAR), 'first') AS gap
       FROM x_orders WHERE order_hour_of_day <> 0""",
)
def typed_scan(spark, path):
    """Orders from files: known columns by their schema, the others by the types that are found."""
    rows = typed.scan(spark, Fixture.of(spark, path).order_files, "orders").rows
    return rows.drop("eval_set")


@query(
    "malformed_rows",
    """SELECT 'order_number: not int' AS reason, count(*) AS n, sum(order_id) AS ids FROM x_heads
       WHERE order_hour_of_day = 0 HAVING count(*) > 0""",
)
def malformed_rows(spark, path):
    """What the typed scan sets apart, by reason."""
    bad = typed.scan(spark, Fixture.of(spark, path).order_files, "orders").malformed
    ids = F.split("text", ",")[0].cast("bigint")
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum(ids).alias("ids"))


@query(
    "clean_orders",
    """SELECT order_id, user_id, order_number, CAST(order_dow AS TINYINT) AS order_dow,
              CAST(order_hour_of_day AS TINYINT) AS order_hour_of_day, days_since_prior_order, eval_set FROM x_orders""",
)
def clean_orders(spark, path):
    return prep.clean_orders(Fixture.of(spark, path).part.orders()).drop("order_date")


@query(
    "clean_order_products",
    """SELECT l.order_id, l.product_id, l.line_number, l.supplier_id, CAST(reordered AS TINYINT) AS reordered
       FROM x_part_lines l JOIN x_part_op o ON o.order_id = l.order_id AND o.product_id = l.product_id""",
)
def clean_order_products(spark, path):
    f = Fixture.of(spark, path)
    clean = prep.clean_lines(f.part.order_products(f.orders, "supplier_id"))
    return clean.select("order_id", "product_id", "line_number", "supplier_id", "reordered")


@query(
    "clean_products",
    "SELECT product_id, trim(lower(product_name)) AS product_name, aisle_id, department_id, price FROM x_products",
)
def clean_products(spark, path):
    return prep.clean_products(Fixture.of(spark, path).part.products())


@query(
    "finite_features",
    """SELECT user_id, CAST(total_orders AS DOUBLE) / nullif(total_products - unique_products, 0) AS orders_per_repeat
       FROM x_behavior WHERE total_products <> unique_products""",
)
def finite_features(spark, path):
    f = Fixture.of(spark, path).behavior
    repeats = (F.col("total_products") - F.col("unique_products")).cast("double")
    # Users without repeats give a missing value, which the filter must drop.
    ratio = f.select("user_id", F.try_divide(F.col("total_orders"), repeats).alias("orders_per_repeat"))
    return prep.finite_rows(ratio, ["orders_per_repeat"])


@query(
    "merged_sales",
    """SELECT l.order_id, l.product_id, line_number, reordered, l.user_id, l.order_number, order_dow, order_hour_of_day,
              days_since_prior_order, l.eval_set, product_name, p.aisle_id, p.department_id, price, aisle, department
       FROM x_part_op l JOIN x_orders o ON o.order_id = l.order_id
       LEFT JOIN x_products p ON p.product_id = l.product_id
       LEFT JOIN x_aisles a ON a.aisle_id = p.aisle_id LEFT JOIN x_departments d ON d.department_id = p.department_id""",
)
def merged_sales(spark, path):
    f = Fixture.of(spark, path)
    lines = f.lines.select("order_id", "product_id", "line_number", "reordered")
    wide = prep.merge_sales(lines, f.orders, f.part.products(), f.part.aisles(), f.part.departments())
    return wide.drop("order_date")


@query(
    "behavior_features",
    f"""SELECT user_id, total_orders, {half_up("avg_days_between_orders")} AS avg_days_between_orders, total_products,
               unique_products, {half_up("reorder_ratio")} AS reorder_ratio FROM x_behavior""",
)
def behavior_features(spark, path):
    return shown(Fixture.of(spark, path).behavior, "avg_days_between_orders", "reorder_ratio")


@query(
    "preference_features",
    f"SELECT user_id, department, {half_up('preference_score')} AS preference_score FROM x_preference",
)
def preference_features(spark, path):
    return shown(Fixture.of(spark, path).preference, "preference_score")


@query("lifecycle_features", "SELECT * FROM x_lifecycle")
def lifecycle_features(spark, path):
    return Fixture.of(spark, path).lifecycle


@query("purchase_frequency", "SELECT * FROM x_frequency")
def purchase_frequency(spark, path):
    return prep.purchase_frequency(Fixture.of(spark, path).features)


@query(
    "user_segments",
    """SELECT user_id, behavior_cluster, preference_cluster, coalesce(lifecycle_stage, 'new') AS lifecycle_stage
       FROM x_clusters LEFT JOIN x_stages USING (user_id)""",
)
def user_segments(spark, path):
    f = Fixture.of(spark, path)
    return segments.user_segments(f.part.users(), f.behavior_clusters, f.preference_clusters, f.stages, TRAIN_DEFAULTS)


@query(
    "order_context",
    f"""SELECT order_id, {TIME_BUCKET.format(h="order_hour_of_day")} AS time_bucket,
               CAST(order_dow IN (0, 6) AS INTEGER) AS is_weekend, order_dow AS day_of_week FROM x_heads""",
)
def order_context(spark, path):
    heads = Fixture.of(spark, path).part.order_heads()
    return prep.order_context(heads).select("order_id", "time_bucket", "is_weekend", "day_of_week")


@query(
    "baskets",
    """SELECT order_id, user_id, array_to_string(products, '|') AS products, basket_size
       FROM x_baskets JOIN x_heads USING (order_id)""",
)
def baskets(spark, path):
    f = Fixture.of(spark, path)
    out = prep.baskets(f.orders, f.brand_lines)
    return out.select("order_id", "user_id", set_text(F.col("products")).alias("products"), "basket_size")


@query(
    "transactions_context",
    """SELECT order_id, user_id, array_to_string(products, '|') AS products, time_bucket, is_weekend, day_of_week,
              basket_size_category, purchase_frequency, lifecycle_stage, preference_cluster, behavior_cluster,
              context_L1, context_L2, context_L3, context_L4, context_L5 FROM x_keys""",
)
def transactions_context(spark, path):
    f = Fixture.of(spark, path)
    return f.transactions().withColumn("products", set_text(F.col("products")))


@query(
    "context_keys",
    """SELECT user_id, 'time_bucket=unknown|is_weekend=unknown|lifecycle_stage=' || lifecycle_stage || '|preference_cluster=' ||
              preference_cluster || '|behavior_cluster=' || behavior_cluster AS context_L1,
              'time_bucket=unknown|is_weekend=unknown' AS context_L4, 'GLOBAL' AS context_L5 FROM x_segments""",
)
def context_keys(spark, path):
    """Keys with missing dimensions: the time of a user without an order at hand is unknown."""
    blank = {"time_bucket": F.lit(None).cast("string"), "is_weekend": F.lit(None).cast("int")}
    users = Fixture.of(spark, path).user_segments.withColumns(blank)
    keys = context_columns()
    return users.select("user_id", *[keys[c].alias(c) for c in ("context_L1", "context_L4", "context_L5")])


@query(
    "context_cardinality",
    "SELECT context_level, count(DISTINCT context_key) AS contexts FROM x_txn_ctx GROUP BY 1",
)
def context_cardinality(spark, path):
    return prep.context_cardinality(Fixture.of(spark, path).brand_transactions)


@query(
    "infer_level",
    "SELECT context_key, min(context_level) AS level, count(*) AS n FROM x_txn_ctx GROUP BY 1",
)
def infer_level_query(spark, path):
    txns = Fixture.of(spark, path).brand_transactions
    keys = txns.select(F.explode(context_array()).alias("c")).groupBy("c.context_key").agg(F.count(F.lit(1)).alias("n"))
    return keys.select("context_key", infer_level(F.col("context_key")).alias("level"), "n")


@query(
    "parse_basket",
    """SELECT order_id, array_to_string(products, '|') AS items, CAST(len(products) AS INTEGER) AS n_text,
              CAST(len(products) AS INTEGER) AS n_json, CAST(list_sum(products) AS BIGINT) AS total FROM x_baskets""",
)
def parse_basket(spark, path):
    """Baskets written as list text and read back both ways."""
    txns = Fixture.of(spark, path).brand_transactions
    text = F.concat(F.lit("["), F.array_join(F.transform("products", lambda x: x.cast("string")), ", "), F.lit("]"))
    rows = txns.select("order_id", text.alias("t"))
    items, longs = bk.parse_text_basket(F.col("t")), bk.parse_json_basket(F.col("t"))
    return rows.select(
        "order_id",
        F.array_join(items, "|").alias("items"),
        F.size(items).alias("n_text"),
        F.size(longs).alias("n_json"),
        F.aggregate(longs, F.lit(0).cast("bigint"), lambda s, x: s + x).alias("total"),
    )


@query(
    "hash_sample",
    """SELECT order_id, user_id FROM x_heads
       WHERE CAST('0x' || substr(md5(order_id || ':42'), 1, 8) AS BIGINT) < 858993459""",
)
def hash_sample(spark, path):
    heads = Fixture.of(spark, path).part.order_heads().select("order_id", "user_id")
    return prep.hash_sample(heads, "order_id", 0.2)


def _quantile_sql(columns, probs):
    rows = [
        f"SELECT '{c}' AS feature, {p}::DOUBLE AS q, {half_up(f'quantile_cont({c}, {p})')} AS quantile FROM x_behavior"
        for c in columns
        for p in probs
    ]
    return " UNION ALL ".join(rows)


QUANTILES = (0.01, 0.33, 0.5, 0.67, 0.99)


@query("feature_quantiles", _quantile_sql(BEHAVIOR_FEATURES, QUANTILES))
def feature_quantiles(spark, path):
    long = unpivot(Fixture.of(spark, path).features, BEHAVIOR_FEATURES)
    return exact_quantiles(long, QUANTILES).select("feature", "q", near("quantile").alias("quantile"))


@query(
    "reorder_by_department",
    f"""SELECT department, count(*) AS lines, {half_up("avg(reordered)")} AS reorder_ratio
        FROM x_brand_op l JOIN x_brands b ON b.product_id = l.product_id GROUP BY 1""",
)
def reorder_by_department(spark, path):
    """Lines and reorder ratio of each department over the merged table."""
    f = Fixture.of(spark, path)
    lines = f.brand_lines.join(f.brand_products.select("product_id", "department"), "product_id")
    return lines.groupBy("department").agg(F.count(F.lit(1)).alias("lines"), near(F.avg("reordered")).alias("reorder_ratio"))
