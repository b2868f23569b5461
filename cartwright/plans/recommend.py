"""Hybrid recommendation for a whole table of requests.

Everything that depends only on a request's context (time bucket, weekend, lifecycle stage,
clusters) is computed once per distinct context, the *signature*: which rule contexts match,
the summed weight of each rule, the department scores of its consequents and the fallback
list. There are only as many signatures as combinations of those five values, however many
requests there are. Per request there remain one equi-join of the basket with the rules of
its signature and one aggregation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cartwright.config import (
    GLOBAL_KEY,
    HEAD_SHARE,
    LEVEL_WEIGHT,
    MAX_TOP_K,
    MIN_MATCH_RATIO,
    RANK_WEIGHTS,
    RECALL_FACTOR,
    SERVE_DEFAULTS,
    SERVING_LIST_SIZE,
    STAGE_BOOSTS,
    TIME_BUCKETS,
)
from cartwright.functions.baskets import normal_basket
from cartwright.functions.context import context_key, key_parts, level_bit, levels_of
from cartwright.functions.scoring import SCORE_UNIT, from_units, round_half_up
from cartwright.lineage import build_side, stage
from cartwright.operators import weights
from cartwright.operators.ranking import top_n

SIGNATURE = ("time_bucket", "is_weekend", "lifecycle_stage", "preference_cluster", "behavior_cluster")
CONTEXT = ["context_level", "context_key"]
# Requests of one signature that a task looks at together.
CELL = 4096
RULE, POPULAR, SIMILAR_DEPT, INSURANCE = "RULE", "POPULAR", "SIMILAR_DEPT", "INSURANCE"


@dataclass(frozen=True)
class Tables:
    """What serving reads, all small next to the purchases they were built from.

    rules: the rules index. popularity: (tier, tier_key, product_id, cnt, rank) with tiers
    time, lifecycle, behavior, global. products: product_id, department_id, department.
    behavior_scores: (cluster, department_id, score). preference_scores: (cluster,
    department, score). segments: (user_id, behavior_cluster, preference_cluster,
    lifecycle_stage).
    """

    rules: DataFrame
    popularity: DataFrame
    products: DataFrame
    behavior_scores: DataFrame
    preference_scores: DataFrame
    segments: DataFrame


@dataclass(frozen=True)
class Options:
    level_weight: Mapping[str, float] = field(default_factory=lambda: dict(LEVEL_WEIGHT))
    min_match_ratio: float = MIN_MATCH_RATIO
    rank_weights: Mapping[str, float] = field(default_factory=lambda: dict(RANK_WEIGHTS))
    recall_factor: int = RECALL_FACTOR
    time_buckets: Sequence[str] = TIME_BUCKETS
    exclude_basket: bool = False


# ---- requests -------------------------------------------------------------------------


def validate_requests(requests: DataFrame, time_buckets: Sequence[str] = TIME_BUCKETS) -> DataFrame:
    """Add ``valid`` and ``reject_reason``; nothing is dropped."""
    bucket = F.coalesce(F.col("time_bucket").isin(*time_buckets), F.lit(False))
    size = F.coalesce(F.col("top_k").between(1, MAX_TOP_K), F.lit(False))
    reason = F.when(~bucket, "time_bucket").when(~size, "top_k")
    return requests.withColumn("reject_reason", reason).withColumn("valid", F.col("reject_reason").isNull())


def request_context(requests: DataFrame, segments: DataFrame) -> DataFrame:
    """Requests with their user's segments (serving defaults for unknown users) and signature."""
    out = requests.join(segments, "user_id", "left")
    filled = {c: F.coalesce(F.col(c), F.lit(v)) for c, v in SERVE_DEFAULTS.items()}
    # Booleans read as 0/1, as they do in the rule contexts.
    out = out.withColumns(filled).withColumn("is_weekend", F.col("is_weekend").cast("int"))
    return out.withColumn("signature", context_key(SIGNATURE))


def signatures(contexts: DataFrame) -> DataFrame:
    return contexts.select("signature", *SIGNATURE).distinct()


def context_match(sigs: DataFrame, rule_contexts: DataFrame, min_ratio: float = MIN_MATCH_RATIO) -> DataFrame:
    """(signature, level, key, match_ratio) with at least ``min_ratio`` of the key's parts equal.

    An equi-join on the parts of both keys; the global key is one part that every signature has.
    """
    have = sigs.select(
        "signature", F.explode(F.concat(key_parts(F.col("signature")), F.array(F.lit(GLOBAL_KEY)))).alias("part")
    )
    parts = key_parts(F.col("context_key"))
    want = rule_contexts.select(*CONTEXT, F.size(parts).alias("parts"), F.explode(parts).alias("part"))
    hits = have.join(want, "part").groupBy("signature", *CONTEXT, "parts").agg(F.count(F.lit(1)).alias("hits"))
    ratio = F.col("hits") / F.col("parts")
    return hits.withColumn("match_ratio", ratio).where(F.col("match_ratio") >= min_ratio).drop("hits", "parts")


def weight_column(weights: Mapping[str, float], default: float = 1.0) -> Column:
    chosen = None
    for level, w in weights.items():
        test = F.col("context_level") == level
        chosen = F.when(test, F.lit(w)) if chosen is None else chosen.when(test, F.lit(w))
    return F.lit(default) if chosen is None else chosen.otherwise(F.lit(default))


def anchors(rules: DataFrame, popularity: DataFrame) -> DataFrame:
    """(antecedent, anchor): the item of each antecedent that was bought least."""
    bought = popularity.where(F.col("tier") == "global").select(F.col("product_id").alias("item"), "cnt")
    items = rules.select("antecedent").distinct().select("antecedent", F.explode("antecedent").alias("item"))
    least = F.min(F.struct(F.coalesce("cnt", F.lit(0)).alias("cnt"), "item"))
    return items.join(bought, "item", "left").groupBy("antecedent").agg(least["item"].alias("anchor"))


def antecedents(rules: DataFrame, popularity: DataFrame) -> DataFrame:
    """(antecedent, antecedent_id, anchor), written: few next to the rules, and numbers from here on."""
    return stage(anchors(rules, popularity).withColumn("antecedent_id", F.monotonically_increasing_id()), "antecedents")


def rule_entries(matches: DataFrame, rules: DataFrame, numbers: DataFrame, *columns: str | Column) -> tuple[DataFrame, DataFrame]:
    """(entries of rules, matches) in the contexts that some signature matches, which get numbers."""
    contexts = stage(matches.select(*CONTEXT).distinct().withColumn("context", F.monotonically_increasing_id()), "rule-contexts")
    named = rules.select(*CONTEXT, "antecedent", "consequent", *columns)
    entries = named.join(build_side(contexts), CONTEXT).drop(*CONTEXT)
    entries = entries.join(build_side(numbers.select("antecedent", "antecedent_id")), "antecedent").drop("antecedent")
    return stage(entries, "rule-entries"), matches.join(contexts, CONTEXT)


def signature_rules(matches: DataFrame, rules: DataFrame, numbers: DataFrame, opts: Options = Options()) -> DataFrame:
    """(signature, antecedent_id, consequent, units, level_mask): rules summed over the contexts a
    signature matches; ``units`` is the summed score in whole units."""
    weighted = F.coalesce(F.col("score") * weight_column(opts.level_weight), F.lit(0.0)).alias("weighted")
    entries, matched = rule_entries(matches, rules, numbers, weighted, level_bit(F.col("context_level")).alias("bit"))
    return weights.sums(entries, matched, SCORE_UNIT)


# ---- recall ---------------------------------------------------------------------------


def held_rules(contexts: DataFrame, sig_rules: DataFrame, numbers: DataFrame, *columns: str) -> DataFrame:
    """(request_id, top_k, signature, cell, antecedent, consequent, columns): the rules of a request's signature
    whose antecedent lies in the basket and whose consequent does not.

    Requests are dealt in cells of one signature, and the rules of a signature to each of its cells, each with its
    consequents as a list, so that neither what a basket holds nor what follows from it is shuffled before it
    adds up. They are joined on one antecedent item, the least bought one, so that a popular product does not draw everything it is part of,
    and checked for the others in place: no pairs of items are built, and an antecedent is looked at once
    per basket, however many rules and contexts have it.
    """
    sizes = contexts.groupBy("signature").agg(F.ceil(F.count(F.lit(1)) / CELL).alias("cells"))
    sizes = build_side(stage(sizes, "signature-sizes"))
    carts = contexts.select("request_id", "top_k", "signature", "basket", normal_basket(F.col("basket")).alias("_cart"))
    carts = carts.join(sizes, "signature").withColumn("cell", F.pmod(F.xxhash64("request_id"), F.col("cells"))).drop("cells")
    # An empty basket holds nothing.
    entries = carts.withColumn("anchor", F.explode("_cart"))
    lists = sig_rules.groupBy("signature", "antecedent_id").agg(F.collect_list(F.struct("consequent", *columns)).alias("_held"))
    lists = lists.join(build_side(numbers), "antecedent_id").join(sizes, "signature")
    lists = lists.withColumn("cell", F.explode(F.expr("sequence(0L, cells - 1)"))).drop("cells", "antecedent_id").hint("merge")
    inside = F.size(F.array_except("antecedent", "_cart")) == 0
    held = entries.join(lists, ["signature", "cell", "anchor"]).where(inside)
    rows = held.select("request_id", "top_k", "signature", "cell", "basket", "antecedent", F.explode("_held").alias("r"))
    rows = rows.select("request_id", "top_k", "signature", "cell", "basket", "antecedent", "r.*")
    return rows.where(~F.array_contains("basket", F.col("consequent"))).drop("basket")


def rule_matches(contexts: DataFrame, sig_rules: DataFrame, numbers: DataFrame) -> DataFrame:
    """Rules whose antecedent lies in the basket and whose consequent does not."""
    hit = held_rules(contexts, sig_rules, numbers, "units", "level_mask")
    return hit.select("request_id", "top_k", "antecedent", F.col("consequent").alias("product_id"), "units", "level_mask")


def rule_candidates(matches: DataFrame, opts: Options = Options()) -> DataFrame:
    """(request_id, product_id, rule_score, levels, position): the best 3 * top_k per request."""
    scored = matches.groupBy("request_id", "top_k", "product_id").agg(
        F.sum("units").alias("units"), F.bit_or("level_mask").alias("level_mask")
    )
    w = Window.partitionBy("request_id").orderBy(F.col("units").desc(), "product_id")
    ranked = scored.withColumn("position", F.row_number().over(w))
    cut = ranked.where(F.col("position") <= F.col("top_k") * opts.recall_factor)
    return cut.select(
        "request_id",
        "product_id",
        from_units(F.col("units")).alias("rule_score"),
        levels_of(F.col("level_mask")).alias("levels"),
        "position",
    )


def matched_contexts(
    contexts: DataFrame, matches: DataFrame, rules: DataFrame, popularity: DataFrame, opts: Options = Options()
) -> DataFrame:
    """Which rule contexts contributed to a request, with hits, level weight and match ratio."""
    # The hits of a rule are the same for every context that holds it, so a rule is joined once per
    # signature with its contexts: a bit for each place in the list of contexts that the signature matches.
    numbers = antecedents(rules, popularity)
    entries, matched = rule_entries(matches, rules, numbers)
    place = F.row_number().over(Window.partitionBy("signature").orderBy("context")) - 1
    listed = stage(matched.withColumn("place", place), "signature-contexts")
    held = stage(weights.places(entries, listed), "held-rules")
    hit = held_rules(contexts, held, numbers, "places")
    counted = weights.bit_counts(hit, "request_id", "signature", "cell").join(build_side(listed.drop("context")), ["signature", "place"])
    counted = counted.select("request_id", *CONTEXT, "match_ratio", F.col("n").alias("hits"))
    repeated = contexts.groupBy("request_id").agg(F.min("signature").alias("a"), F.max("signature").alias("b")).where("a < b")
    if not repeated.isEmpty():
        # Requests that share an id though not their context count as one.
        counted = counted.groupBy("request_id", *CONTEXT, "match_ratio").agg(F.sum("hits").alias("hits"))
    return counted.withColumn("level_weight", weight_column(opts.level_weight))


# ---- fallback -------------------------------------------------------------------------


def popularity_arrays(popularity: DataFrame) -> DataFrame:
    ranked = F.array_sort(F.collect_list(F.struct("rank", "product_id")))["product_id"]
    return popularity.groupBy("tier", "tier_key").agg(ranked.alias("items"))


def signature_fallback(sigs: DataFrame, popularity: DataFrame) -> DataFrame:
    """(signature, items, tier): the first popularity list that exists for the signature."""
    lists = popularity_arrays(popularity)
    out = sigs
    keys = {"time": "time_bucket", "lifecycle": "lifecycle_stage", "behavior": "behavior_cluster"}
    for tier, dim in keys.items():
        side = lists.where(F.col("tier") == tier).select(F.col("tier_key").alias(f"_{tier}_key"), F.col("items").alias(f"_{tier}"))
        out = out.join(side, F.col(dim).cast("string") == F.col(f"_{tier}_key"), "left")
    overall = lists.where(F.col("tier") == "global").select("items").scalar()
    out = out.withColumn("_global", overall)
    order = ["time", "lifecycle", "behavior", "global"]
    tier = F.coalesce(*[F.when(F.col(f"_{t}").isNotNull(), F.lit(t)) for t in order])
    return out.select("signature", F.coalesce(*[F.col(f"_{t}") for t in order]).alias("items"), tier.alias("tier"))


def similar_department(
    requests: DataFrame, products: DataFrame, limit: Column, longest: int = SERVING_LIST_SIZE
) -> DataFrame:
    """(request_id, product_id, position): products of the basket's departments, by id.

    The lists are merged once per distinct set of departments, of which there are few, and a request
    takes the head of its set's list. The first n products over several departments are among the
    first n of each (``longest`` must be at least the largest ``limit``).
    """
    wanted = requests.select("request_id", limit.alias("_limit"), F.explode(F.array_distinct("basket")).alias("product_id"))
    sets = (
        wanted.join(products.select("product_id", "department"), "product_id")
        .where(F.col("department").isNotNull())
        .groupBy("request_id", "_limit")
        .agg(F.array_sort(F.collect_set("department")).alias("departments"))
    )
    heads = top_n(products.select("product_id", "department"), ["department"], [F.col("product_id")], longest, "_r")
    heads = heads.groupBy("department").agg(F.collect_list("product_id").alias("ids"))
    distinct = sets.select("departments").distinct()
    merged = (
        distinct.select("departments", F.explode("departments").alias("department"))
        .join(heads, "department")
        .groupBy("departments")
        .agg(F.slice(F.array_sort(F.flatten(F.collect_list("ids"))), 1, longest).alias("ids"))
    )
    rows = sets.join(merged, "departments").select("request_id", F.posexplode(F.slice("ids", F.lit(1), F.col("_limit"))))
    return rows.select("request_id", F.col("col").alias("product_id"), (F.col("pos") + 1).alias("position"))


def rule_summary(contexts: DataFrame, candidates: DataFrame) -> DataFrame:
    """Requests with their rule candidates as one array (at most 3 * top_k long)."""
    item = F.struct("position", "product_id", "rule_score", "levels")
    lists = candidates.groupBy("request_id").agg(F.array_sort(F.collect_list(item)).alias("from_rules"))
    out = contexts.join(lists, "request_id", "left")
    empty = F.expr("cast(array() as array<struct<position:int,product_id:bigint,rule_score:double,levels:array<string>>>)")
    out = out.withColumn("from_rules", F.coalesce("from_rules", empty))
    need = F.greatest(F.col("top_k") - F.size("from_rules"), F.lit(0))
    return out.withColumn("rule_candidates", F.size("from_rules")).withColumn("need", need)


def fallback_recall(
    summary: DataFrame, fallback: DataFrame, products: DataFrame | None, opts: Options = Options()
) -> DataFrame:
    """(request_id, product_id, score, source, position) for requests short of candidates.

    The items of the signature's list (or, where no list exists, of the basket's departments)
    up to three times the gap; already recalled products are left out. ``position`` counts
    from 0 in the list. ``products`` is None when every signature has a list.
    """
    factor = opts.recall_factor
    short = summary.where(F.col("need") > 0).select("request_id", "signature", "basket", "need", "from_rules")
    listed = short.join(fallback.select("signature", "items"), "signature", "left")
    popular = listed.where(F.col("items").isNotNull()).select(
        "request_id", "from_rules", F.posexplode(F.slice("items", 1, F.col("need") * factor)).alias("position", "product_id")
    )
    popular = popular.withColumns({"base": F.lit(1.0), "source": F.lit(POPULAR)})
    rows = popular
    if products is not None:
        bare = listed.where(F.col("items").isNull())
        similar = similar_department(bare, products, F.col("need") * factor)
        similar = similar.join(bare.select("request_id", "from_rules"), "request_id").select(
            "request_id",
            "from_rules",
            (F.col("position") - 1).alias("position"),
            "product_id",
            F.lit(0.8).alias("base"),
            F.lit(SIMILAR_DEPT).alias("source"),
        )
        rows = popular.unionByName(similar)
    known = F.exists("from_rules", lambda r: r["product_id"] == F.col("product_id"))
    score = F.col("base") - F.col("position") * 0.001
    return rows.where(~known).select("request_id", "product_id", score.alias("score"), "source", "position")


# ---- scores ---------------------------------------------------------------------------


def behavior_weights(pool: DataFrame, behavior_scores: DataFrame) -> DataFrame:
    """Add ``behavior_weight``: the share of the product's department in the user's cluster.

    A department the cluster never bought weighs 1, and so does an unknown cluster.
    """
    table = behavior_scores.select(
        F.col("cluster").alias("behavior_cluster"), "department_id", F.col("score").alias("behavior_weight")
    )
    out = pool.join(table, ["behavior_cluster", "department_id"], "left")
    return out.withColumn("behavior_weight", F.coalesce("behavior_weight", F.lit(1.0)))


def preference_values(pool: DataFrame, preference_scores: DataFrame) -> DataFrame:
    """Add ``preference_score``: the cluster's mean share of the product's department, else 0."""
    table = preference_scores.select(
        F.col("cluster").alias("preference_cluster"), "department", F.col("score").alias("preference_score")
    )
    out = pool.join(table, ["preference_cluster", "department"], "left")
    return out.withColumn("preference_score", F.coalesce("preference_score", F.lit(0.0)))


def score_pool(
    summary: DataFrame,
    fallback_rows: DataFrame,
    items: DataFrame,
    tables: Tables,
) -> DataFrame:
    """One row per request and candidate with its rule, behavior and preference scores.

    ``position`` continues over the fallback rows. ``items`` holds the departments of all
    products that can be recommended.
    """
    head = summary.select("request_id", "signature", "top_k", *SIGNATURE, F.explode("from_rules").alias("r"))
    from_rules = head.select(
        "request_id",
        "top_k",
        *SIGNATURE,
        F.col("r.product_id").alias("product_id"),
        F.col("r.position").alias("position"),
        F.col("r.rule_score").alias("rule_score"),
        F.col("r.levels").alias("levels"),
        F.array(F.lit(RULE)).alias("source"),
    )
    from_fallback = fallback_rows.join(summary.select("request_id", "top_k", "rule_candidates", *SIGNATURE), "request_id")
    from_fallback = from_fallback.select(
        "request_id",
        "top_k",
        *SIGNATURE,
        "product_id",
        (F.col("rule_candidates") + F.col("position") + 1).alias("position"),
        F.lit(None).cast("double").alias("rule_score"),
        F.expr("cast(array() as array<string>)").alias("levels"),
        F.array("source").alias("source"),
    )
    pool = from_rules.unionByName(from_fallback)
    pool = pool.join(items.select("product_id", "department_id", "department"), "product_id", "left")
    pool = preference_values(behavior_weights(pool, tables.behavior_scores), tables.preference_scores)
    return pool.withColumn("behavior_score", F.col("rule_score") * F.col("behavior_weight"))


def candidate_items(tables: Tables) -> DataFrame:
    """Departments of the products in rules or popularity lists: far fewer than all products."""
    ids = tables.rules.select(F.col("consequent").alias("product_id"))
    ids = ids.unionByName(tables.popularity.select("product_id")).distinct()
    return ids.join(tables.products.select("product_id", "department_id", "department"), "product_id")


def stage_boost(stage_column: str, part: int) -> Column:
    chosen = None
    for name, boosts in STAGE_BOOSTS.items():
        test = F.col(stage_column) == name
        chosen = F.when(test, F.lit(boosts[part])) if chosen is None else chosen.when(test, F.lit(boosts[part]))
    return chosen.otherwise(F.lit(STAGE_BOOSTS["regular"][part]))


def lifecycle_scores(pool: DataFrame) -> DataFrame:
    """Add ``lifecycle_score``: the preference score, boosted for the head or the tail.

    The head is the top 30 % of a request's candidates, at least one, by preference score;
    equal scores keep the order of recall.
    """
    by_score = Window.partitionBy("request_id").orderBy(F.col("preference_score").desc(), "position")
    all_rows = Window.partitionBy("request_id")
    out = pool.withColumn("_i", F.row_number().over(by_score)).withColumn("_n", F.count(F.lit(1)).over(all_rows))
    head = F.greatest(F.lit(1), F.floor(F.col("_n") * HEAD_SHARE))
    boost = F.when(F.col("_i") <= head, stage_boost("lifecycle_stage", 0)).otherwise(stage_boost("lifecycle_stage", 1))
    return out.withColumn("lifecycle_score", F.col("preference_score") * boost).drop("_i", "_n")


def min_max(column: str, window) -> Column:
    """Scale to [0, 1] over the window; all equal gives 1 and a missing score stays null."""
    low, high = F.min(column).over(window), F.max(column).over(window)
    x = F.col(column)
    return F.when(x.isNull(), F.lit(None).cast("double")).when(low == high, F.lit(1.0)).otherwise((x - low) / (high - low))


def rank_pool(pool: DataFrame, weights: Mapping[str, float] = RANK_WEIGHTS) -> DataFrame:
    """The top_k of each request by the weighted sum of the four normalised scores."""
    total = sum(weights.values())
    if total <= 0:
        raise ValueError("sum of weights must be positive")
    w = Window.partitionBy("request_id")
    score = F.lit(0.0)
    for name, weight in weights.items():
        score = score + F.lit(weight / total) * F.coalesce(min_max(f"{name}_score", w), F.lit(0.0))
    scored = pool.withColumn("score", round_half_up(score, 9))
    order = Window.partitionBy("request_id").orderBy(F.col("score").desc(), "product_id")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= F.col("top_k"))


# ---- result ---------------------------------------------------------------------------


def insurance_fill(summary: DataFrame, ranked: DataFrame, popularity: DataFrame) -> DataFrame:
    """One row per request with its final list, filled up from the global popularity list.

    (request_id, user_id, top_k, rule_candidates, ranked, items). Lists are at most top_k long,
    so the fill is an array difference, not a join. A request without any candidate stays empty.
    """
    item = F.struct("rank", "product_id", "score", "source", "levels")
    lists = ranked.groupBy("request_id").agg(F.array_sort(F.collect_list(item)).alias("ranked"))
    out = summary.select("request_id", "user_id", "top_k", "rule_candidates").join(lists, "request_id", "left")
    overall = popularity_arrays(popularity.where(F.col("tier") == "global")).select("items").scalar()
    none = F.expr("cast(array() as array<bigint>)")
    gap = F.greatest(F.col("top_k") - F.size("ranked"), F.lit(0))
    rest = F.array_except(F.coalesce("_popular", none), F.col("ranked.product_id"))
    out = out.withColumn("_popular", overall).withColumn("_extra", F.slice(rest, F.lit(1), gap))
    filled = F.transform(
        "_extra",
        lambda p, i: F.struct(
            (F.size("ranked") + i + 1).alias("rank"),
            p.alias("product_id"),
            F.lit(0.0).alias("score"),
            F.array(F.lit(INSURANCE)).alias("source"),
            F.expr("cast(array() as array<string>)").alias("levels"),
        ),
    )
    empty = F.expr(
        "cast(array() as array<struct<rank:int,product_id:bigint,score:double,source:array<string>,levels:array<string>>>)"
    )
    items = F.when(F.col("ranked").isNull(), empty).otherwise(F.concat("ranked", filled))
    return out.withColumn("items", items).withColumn("ranked_count", F.coalesce(F.size("ranked"), F.lit(0))).drop(
        "ranked", "_popular", "_extra"
    )


def recommendation_rows(final: DataFrame) -> DataFrame:
    """(request_id, user_id, rank, item_id, score, source, context_level), arrays sorted."""
    rows = final.select("request_id", "user_id", F.explode("items").alias("i"))
    return rows.select(
        "request_id",
        "user_id",
        "i.rank",
        F.col("i.product_id").alias("item_id"),
        "i.score",
        F.array_sort("i.source").alias("source"),
        F.array_sort("i.levels").alias("context_level"),
    )


def recommendation_metadata(final: DataFrame) -> DataFrame:
    """Counts per request: candidates, fallback and insurance use, items by source."""

    def tagged(tag: str) -> Column:
        return F.size(F.filter("items", lambda i: F.array_contains(i["source"], tag)))

    some = F.size("items") > 0
    return final.select(
        "request_id",
        "user_id",
        "rule_candidates",
        (F.col("reject_reason").isNull() & (F.col("rule_candidates") < F.col("top_k"))).alias("fallback_used"),
        (some & (F.col("ranked_count") < F.col("top_k"))).alias("insurance_used"),
        F.size("items").alias("final_returned"),
        tagged(RULE).alias("rule_item_count"),
        tagged(POPULAR).alias("popular_item_count"),
        tagged(INSURANCE).alias("insurance_item_count"),
        "reject_reason",
    )


@dataclass(frozen=True)
class Stages:
    """The intermediate tables of one recommendation run."""

    contexts: DataFrame
    matches: DataFrame
    sig_rules: DataFrame
    rule_hits: DataFrame
    candidates: DataFrame
    summary: DataFrame
    fallback: DataFrame
    pool: DataFrame
    ranked: DataFrame
    final: DataFrame


def recommend(requests: DataFrame, tables: Tables, opts: Options = Options()) -> Stages:
    """All requests at once. ``recommendation_rows`` and ``recommendation_metadata`` read ``final``.

    Invalid requests come back in ``final`` with their ``reject_reason`` and an empty list. The
    popularity lists must be ``SERVING_LIST_SIZE`` long (or hold all products), so that no list
    runs out before the largest valid ``top_k``. The intermediate tables are written here.
    """
    checked = validate_requests(requests, opts.time_buckets)
    refused = checked.where(~F.col("valid"))
    requests = checked.where("valid").drop("valid", "reject_reason")
    contexts = request_context(requests, tables.segments)
    # One row per distinct context. The number given to it is fixed by writing it, and stands
    # for the long text in all later joins.
    sigs = stage(signatures(contexts).withColumn("signature_id", F.monotonically_increasing_id()), "signatures")

    def numbered(df: DataFrame) -> DataFrame:
        ids = sigs.select("signature", "signature_id")
        return df.join(ids, "signature").drop("signature").withColumnRenamed("signature_id", "signature")

    rule_contexts = tables.rules.select(*CONTEXT).distinct()
    matches = stage(numbered(context_match(sigs, rule_contexts, opts.min_match_ratio)), "context-match")
    contexts = numbered(contexts)
    sigs = sigs.drop("signature").withColumnRenamed("signature_id", "signature")
    # Its size grows with the rules and contexts, so it is measured before it is joined.
    numbers = antecedents(tables.rules, tables.popularity)
    sig_rules = stage(signature_rules(matches, tables.rules, numbers, opts), "signature-rules")
    lists = stage(signature_fallback(sigs, tables.popularity), "signature-fallback")

    hits = rule_matches(contexts, sig_rules, numbers)
    candidates = rule_candidates(hits, opts)
    # The rule recall is the costly part and three later steps read it.
    summary = stage(rule_summary(contexts, candidates), "rule-candidates")
    # A small table says whether the department branch is needed at all; only then can any
    # product be a candidate.
    bare = not lists.where(F.col("items").isNull()).isEmpty()
    items = tables.products if bare else stage(candidate_items(tables), "candidate-items")
    fallback = fallback_recall(summary, lists, tables.products if bare else None, opts)
    if opts.exclude_basket:
        baskets = summary.select("request_id", "basket")
        fallback = (
            fallback.join(baskets, "request_id")
            .where(~F.array_contains("basket", F.col("product_id")))
            .drop("basket")
        )
    pool = lifecycle_scores(score_pool(summary, fallback, items, tables))
    ranked = rank_pool(pool, opts.rank_weights)
    final = insurance_fill(summary, ranked, tables.popularity).withColumn("reject_reason", F.lit(None).cast("string"))
    final = final.unionByName(
        refused.select("request_id", "user_id", "top_k", "reject_reason", F.lit(0).alias("rule_candidates"), F.lit(0).alias("ranked_count")),
        allowMissingColumns=True,
    )
    nothing = F.expr("cast(array() as " + final.schema["items"].dataType.simpleString() + ")")
    final = final.withColumn("items", F.coalesce("items", nothing))
    return Stages(contexts, matches, sig_rules, hits, candidates, summary, fallback, pool, ranked, final)


def cart_boost(stages: Stages, requests: DataFrame) -> DataFrame:
    """For requests with one added product: the best recommended item that is not that product."""
    rows = recommendation_rows(stages.final).join(
        requests.select("request_id", F.col("basket")[0].alias("added_product_id")), "request_id"
    )
    other = rows.where(F.col("item_id") != F.col("added_product_id"))
    best = other.groupBy("request_id", "user_id", "added_product_id").agg(F.min_by("item_id", "rank").alias("boost_product_id"))
    return best


def static_fallback(products: DataFrame, n: int = 10) -> DataFrame:
    """The payload served when recommending fails: the first products by id with falling scores."""
    first = products.orderBy("product_id").limit(n)
    rows = first.agg(F.array_sort(F.collect_list(F.struct("product_id", "product_name", "price", "department_id"))).alias("l"))
    out = rows.select(F.posexplode("l").alias("i", "p"))
    return out.select(
        F.col("p.product_id").alias("item_id"),
        "p.product_name",
        "p.price",
        "p.department_id",
        round_half_up(F.lit(0.95) - F.col("i") * 0.05, 2).alias("score"),
        F.array(F.lit(POPULAR), F.lit("FALLBACK")).alias("source"),
    )

