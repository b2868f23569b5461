"""Queries on exploration, the product catalog, profiles and carts."""

from cartwright.config import BEHAVIOR_FEATURES
from cartwright.lineage import stream_folder
from cartwright.plans import analysis, cart, catalog, recommend
from cartwright.sources import name_index
from cartwright.sources.retail import cart_actions
from cartwright.streaming import cart as stream
from registry.common import F, Fixture, shown
from registry.sql import PARTS, half_up, statement

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql if sql.startswith("WITH") else statement(sql)
        return fn

    return add


# ---- exploration ----------------------------------------------------------------------


@query(
    "dataset_cardinality",
    "SELECT count(DISTINCT user_id) AS users, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products FROM x_part_op",
)
def dataset_cardinality(spark, path):
    return analysis.dataset_cardinality(Fixture.of(spark, path).lines)


def _histogram_sql(column, bins, log=False):
    x = f"log10({column})" if log else f"CAST({column} AS DOUBLE)"
    where = f"WHERE {column} > 0" if log else f"WHERE {column} IS NOT NULL"
    low, high = "lo + bin * w", "lo + (bin + 1) * w"
    if log:
        low, high = f"pow(10.0::DOUBLE, {low})", f"pow(10.0::DOUBLE, {high})"
    return f"""SELECT bin, {half_up(low)} AS low, {half_up(high)} AS high, count FROM (
        SELECT CAST(CASE WHEN w = 0 THEN 0 ELSE least(floor((x - lo) / w), {bins - 1}) END AS INTEGER) AS bin, lo, w, count(*) AS count
        FROM (SELECT {x} AS x FROM x_behavior {where}),
             (SELECT min(x) AS lo, (max(x) - min(x)) / {bins} AS w FROM (SELECT {x} AS x FROM x_behavior {where})) GROUP BY ALL)"""


@query("histogram", _histogram_sql("avg_days_between_orders", 30))
def histogram(spark, path):
    return shown(analysis.histogram(Fixture.of(spark, path).features, "avg_days_between_orders", 30), "low", "high")


@query("histogram_orders", _histogram_sql("total_orders", 10))
def histogram_orders(spark, path):
    return shown(analysis.histogram(Fixture.of(spark, path).features, "total_orders", 10), "low", "high")


@query("histogram_log", _histogram_sql("total_products", 20, True))
def histogram_log(spark, path):
    return shown(analysis.histogram(Fixture.of(spark, path).features, "total_products", 20, log=True), "low", "high")


STATS = ("mean", "std", "min", "max", "q25", "q50", "q75")


def _describe_sql(columns, clip):
    rows = []
    for c in columns:
        x = f"least({c}, {clip[c]})" if c in clip else c
        rows.append(
            f"""SELECT '{c}' AS feature, count(x) AS count, {half_up("avg(x)")} AS mean, {half_up("stddev_samp(x)")} AS std,
                {half_up("min(x)")} AS min, {half_up("max(x)")} AS max, {half_up("quantile_cont(x, 0.25)")} AS q25,
                {half_up("quantile_cont(x, 0.5)")} AS q50, {half_up("quantile_cont(x, 0.75)")} AS q75
                FROM (SELECT CAST({x} AS DOUBLE) AS x FROM x_behavior)"""
        )
    return " UNION ALL ".join(rows)


CLIP = {"total_products": 50.0}


@query("feature_describe", _describe_sql(BEHAVIOR_FEATURES, CLIP))
def feature_describe(spark, path):
    return shown(analysis.describe(Fixture.of(spark, path).features, BEHAVIOR_FEATURES, CLIP), *STATS)


PARTS["x_box_rows"] = """
SELECT lifecycle_stage, 'total_orders' AS feature, CAST(total_orders AS DOUBLE) AS x FROM x_behavior JOIN x_stages USING (user_id)
UNION ALL SELECT lifecycle_stage, 'avg_days_between_orders', avg_days_between_orders FROM x_behavior JOIN x_stages USING (user_id)
UNION ALL SELECT lifecycle_stage, 'total_products', CAST(total_products AS DOUBLE) FROM x_behavior JOIN x_stages USING (user_id)
"""
PARTS["x_box"] = """
SELECT lifecycle_stage, feature, quantile_cont(x, 0.25) AS q25, quantile_cont(x, 0.5) AS q50, quantile_cont(x, 0.75) AS q75
FROM x_box_rows GROUP BY 1, 2
"""
BOX = ("q25", "q50", "q75", "whisker_low", "whisker_high")


@query(
    "boxplot_stats",
    f"""SELECT b.lifecycle_stage, b.feature, {", ".join(f"{half_up(f'any_value({c})')} AS {c}" for c in BOX[:3])},
               {half_up("min(x)")} AS whisker_low, {half_up("max(x)")} AS whisker_high
        FROM x_box b JOIN x_box_rows r ON r.lifecycle_stage = b.lifecycle_stage AND r.feature = b.feature
        WHERE x BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) GROUP BY 1, 2""",
)
def boxplot_stats(spark, path):
    f = Fixture.of(spark, path)
    rows = f.features.join(f.stages, "user_id")
    return shown(analysis.boxplot(rows, ["total_orders", "avg_days_between_orders", "total_products"], "lifecycle_stage"), *BOX)


# ---- catalog --------------------------------------------------------------------------


@query("product_search", "SELECT * FROM x_products WHERE lower(product_name) LIKE '%ring%' AND department_id = 3")
def product_search(spark, path):
    return catalog.search(Fixture.of(spark, path).part.products(), "RING", 3)


@query("product_search_index", "SELECT * FROM x_products WHERE lower(product_name) LIKE '%ring%' AND department_id = 3")
def product_search_index(spark, path):
    """The same search, by the posting lists of the text's grams."""
    f = Fixture.of(spark, path)
    return name_index.search(f.part.products(), f.name_index, "RING").where("department_id = 3")


@query("product_search_short", "SELECT * FROM x_products WHERE lower(product_name) LIKE '%bo%'")
def product_search_short(spark, path):
    """A text shorter than a gram: the grams that begin with it."""
    f = Fixture.of(spark, path)
    return name_index.search(f.part.products(), f.name_index, "Bo")


PARTS["x_name_words"] = """
SELECT DISTINCT lower(w) AS word FROM (SELECT unnest(string_split(product_name, ' ')) AS w FROM x_products) WHERE len(w) >= 3
"""


@query(
    "product_search_many",
    """SELECT word AS text, product_id FROM x_name_words JOIN x_products ON contains(lower(product_name), word)""",
)
def product_search_many(spark, path):
    """Every word of the catalog's names searched in all names."""
    f = Fixture.of(spark, path)
    words = f.part.products().select(F.explode(F.split("product_name", " ")).alias("w"))
    words = words.select(F.lower("w").alias("text")).where(F.length("text") >= 3).distinct()
    return name_index.search_many(words, f.part.products(), f.name_index).select("text", "product_id")


@query(
    "product_page",
    """SELECT product_id, product_name, price, count(*) OVER () AS total FROM x_products
       WHERE regexp_matches(product_name, '(?i)bolt|gear') ORDER BY product_id LIMIT 20 OFFSET 20""",
)
def product_page(spark, path):
    found = catalog.search(Fixture.of(spark, path).part.products(), "bolt|gear", regex=True)
    return catalog.page(found.select("product_id", "product_name", "price"), 2, 20)


@query(
    "product_lookup",
    """SELECT k AS product_id, product_name, aisle_id, department_id, price
       FROM (SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) LEFT JOIN x_products ON product_id = k""",
)
def product_lookup(spark, path):
    """The products named by events."""
    f = Fixture.of(spark, path)
    ids = f.part.table("events").select(F.get_json_object("props", "$.k").cast("bigint").alias("product_id"))
    return catalog.lookup_many(ids, f.part.products())


@query("department_list", "SELECT department_id, department AS department_name FROM x_departments")
def department_list(spark, path):
    return catalog.departments(Fixture.of(spark, path).part.departments())


def _label_sql(column, texts):
    arms = " ".join(f"WHEN {k!r} THEN '{v}'" for k, v in texts.items())
    return f"CASE {column} {arms} ELSE 'Không xác định' END"


BEHAVIOR_SQL = _label_sql(
    "behavior_cluster",
    {
        0: "Người mua không thường xuyên",
        1: "Người mua ổn định",
        2: "Người mua nhiều",
        3: "Khách hàng tiềm năng",
        4: "Khách hàng VIP",
    },
)
PREFERENCE_SQL = _label_sql(
    "preference_cluster",
    {
        0: "Ưa chuộng hàng thiết yếu",
        1: "Ưa chuộng hàng khuyến mãi",
        2: "Ưa chuộng sản phẩm cao cấp",
        3: "Ưa chuộng hàng mới",
        4: "Ưa chuộng hàng đa dạng",
    },
)
LIFECYCLE_SQL = _label_sql(
    "lifecycle_stage",
    {"new": "Khách hàng mới", "regular": "Khách thường xuyên", "loyal": "Khách hàng trung thành", "vip": "Khách VIP"},
)

PARTS["x_recent"] = """
SELECT user_id, CAST(r AS INTEGER) AS recency, product_id, product_name FROM (
  SELECT user_id, product_id, row_number() OVER (
         PARTITION BY user_id ORDER BY order_number DESC, line_number DESC, product_id DESC) AS r FROM x_part_op)
JOIN x_products USING (product_id) WHERE r <= 5
"""


@query(
    "user_profile",
    f"""SELECT s.user_id, behavior_cluster, {BEHAVIOR_SQL} AS behavior_text, preference_cluster, {PREFERENCE_SQL} AS preference_text,
               lifecycle_stage, {LIFECYCLE_SQL} AS lifecycle_text, coalesce(p.recent, '') AS recent_purchases
        FROM x_segments s LEFT JOIN (SELECT user_id, string_agg(product_id, '|' ORDER BY recency) AS recent FROM x_recent GROUP BY 1) p
             ON p.user_id = s.user_id""",
)
def user_profile(spark, path):
    f = Fixture.of(spark, path)
    recent = catalog.recent_purchases(f.lines, f.part.products())
    out = catalog.user_profile(f.user_segments, recent)
    ids = F.array_join(F.transform("recent_purchases", lambda r: r["product_id"].cast("string")), "|")
    return out.withColumn("recent_purchases", F.coalesce(ids, F.lit("")))


@query("recent_purchases", "SELECT * FROM x_recent")
def recent_purchases(spark, path):
    f = Fixture.of(spark, path)
    return catalog.recent_purchases(f.lines, f.part.products())


@query(
    "static_fallback",
    f"""SELECT product_id AS item_id, product_name, price, department_id,
               {half_up("0.95::DOUBLE - (row_number() OVER (ORDER BY product_id) - 1) * 0.05::DOUBLE", 2)} AS score,
               'POPULAR|FALLBACK' AS source FROM x_products ORDER BY product_id LIMIT 10""",
)
def static_fallback(spark, path):
    out = recommend.static_fallback(Fixture.of(spark, path).part.products())
    return out.withColumn("source", F.array_join("source", "|"))


# ---- carts ----------------------------------------------------------------------------

PARTS["x_actions"] = """
SELECT event_id, ts, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS product_id,
       CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS step, event_type = 'signup' AS cleared
FROM events WHERE event_type IN ('click', 'error', 'signup')
"""
# Steps of +1 and -1 that never go below 0: the final quantity is the largest sum of the last steps.
PARTS["x_cart"] = """
SELECT user_id, product_id, greatest(max(tail), 0) AS qty FROM (
  SELECT user_id, product_id, sum(step) OVER (PARTITION BY user_id, product_id ORDER BY ts DESC, event_id DESC) AS tail
  FROM (SELECT *, count(*) FILTER (cleared) OVER (PARTITION BY user_id, product_id ORDER BY ts DESC, event_id DESC) AS later
        FROM x_actions) WHERE later = 0)
GROUP BY 1, 2 HAVING greatest(max(tail), 0) > 0
"""


@query("cart_state", "SELECT user_id, product_id, CAST(qty AS BIGINT) AS qty FROM x_cart")
def cart_state(spark, path):
    return cart.cart_state(Fixture.of(spark, path).part.cart_events())


@query(
    "cart_totals",
    f"""SELECT user_id, count(*) AS items, CAST(sum(qty) AS BIGINT) AS total_qty, {half_up("sum(qty * price)", 2)} AS total_amount
        FROM x_cart JOIN x_products USING (product_id) GROUP BY 1""",
)
def cart_totals(spark, path):
    f = Fixture.of(spark, path)
    return shown(cart.cart_totals(cart.cart_state(f.part.cart_events()), f.part.products()), "total_amount", digits=2)


def _adds(f, events):
    """Add-to-cart events with the brand of the part as product."""
    brands = f.part.table("part").select(F.col("p_partkey").alias("part_id"), "p_brand")
    products = f.brand_products.select("product_id", F.col("product_name").alias("p_brand"))
    adds = cart_actions(events).where(F.col("action") == "add").withColumnRenamed("product_id", "part_id")
    return adds.join(brands, "part_id").join(products, "p_brand").select("event_id", "ts", "user_id", "product_id")


@query(
    "cart_boost",
    """SELECT request_id, user_id, added_product_id, item_id AS boost_product_id FROM (
         SELECT r.request_id, r.user_id, q.basket[1] AS added_product_id, item_id,
                row_number() OVER (PARTITION BY r.request_id ORDER BY rank) AS i
         FROM x_c_recs r JOIN x_cart_requests q ON q.request_id = r.request_id WHERE item_id <> q.basket[1]) WHERE i = 1""",
)
def cart_boost(spark, path):
    f = Fixture.of(spark, path)
    return stream.boost_batch(_adds(f, f.part.table("events")), f.tables)


def _event_stream(f):
    reader = f.spark.readStream.schema(f.part.table("events").schema).option("pathGlobFilter", "events.parquet").option("maxFilesPerTrigger", 1)
    return reader.parquet(f.path)


@query("cart_boost_stream", ORACLES["cart_boost"])
def cart_boost_stream(spark, path):
    """The boosts of the same events read as a stream."""
    f = Fixture.of(spark, path)
    place = f"{stream_folder(spark)}/cartwright/boost-{spark.sparkContext.applicationId}-{_run()}"
    running = stream.boost_stream(_adds(f, _event_stream(f)), f.tables, f"{place}/out", f"{place}/checkpoint")
    running.awaitTermination()
    return spark.read.parquet(f"{place}/out").drop("batch")


@query("cart_state_stream", ORACLES["cart_state"])
def cart_state_stream(spark, path):
    """The cart quantities after the whole stream of events."""
    f = Fixture.of(spark, path)
    place = f"{stream_folder(spark)}/cartwright/cart-{spark.sparkContext.applicationId}-{_run()}"
    events = cart_actions(_event_stream(f))
    running = stream.cart_state_stream(events, f"{place}/out", f"{place}/state", f"{place}/checkpoint")
    running.awaitTermination()
    latest = spark.read.parquet(f"{place}/out").groupBy("user_id", "product_id")
    return latest.agg(F.max_by("qty", "batch").alias("qty")).where(F.col("qty") > 0)


def _run():
    import uuid

    return uuid.uuid4().hex[:12]
