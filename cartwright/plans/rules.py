"""Association rules for every context in one job.

The levels of the context hierarchy are nested, so transactions are laid out once per leaf context
(the most specific level), as bitmaps of orders per item, and every coarser context is counted on
the blocks of its leaves: transactions are shuffled once, and then only counts and sets are.
"""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cartwright.config import ADAPTIVE_STEPS, CONTEXT_LEVELS, MAX_TXNS_PER_CONTEXT, MIN_BASKET_ITEMS, Mining
from cartwright.functions.context import context_array
from cartwright.functions.scoring import antecedent_text, round_half_up, rule_id, rule_score
from cartwright.lineage import build_side, stage
from cartwright.operators import vertical
from cartwright.operators.ranking import first_row, top_n

LEVELS = tuple(CONTEXT_LEVELS)
LEAF = f"context_{LEVELS[0]}"
CONTEXT = ["context_level", "context_key"]
SETS_PER_LIST = 4096


def leaf_contexts(txns: DataFrame) -> DataFrame:
    """Transactions per leaf context, with the keys of all its levels."""
    keys = [f"context_{level}" for level in LEVELS]
    return txns.groupBy(*keys).agg(F.count(F.lit(1)).alias("leaf_n"))


def roll_up(leaves: DataFrame) -> DataFrame:
    """(leaf, level, key, leaf_n): each leaf context under each of its levels."""
    return leaves.select(LEAF, "leaf_n", F.explode(context_array(LEVELS)).alias("c")).select(LEAF, "leaf_n", "c.*")


def context_counts(txns: DataFrame) -> DataFrame:
    """Transactions per (level, key)."""
    return roll_up(leaf_contexts(txns)).groupBy(*CONTEXT).agg(F.sum("leaf_n").alias("n"))


def sample_keys(counts: DataFrame, n: int = 20, seed: int = 42) -> DataFrame:
    """A repeatable random sample of n distinct context keys."""
    drawn = F.md5(F.concat_ws(":", "context_level", "context_key", F.lit(str(seed))))
    return counts.select(*CONTEXT).distinct().orderBy(drawn, *CONTEXT).limit(n)


def level_gate(m: Mining):
    """Smallest number of transactions of the row's level."""
    gate = None
    for level, n in m.level_min_txns.items():
        test = F.col("context_level") == level
        gate = F.when(test, F.lit(n)) if gate is None else gate.when(test, F.lit(n))
    return gate


def passing_contexts(counts: DataFrame, m: Mining = Mining()) -> DataFrame:
    return counts.where((F.col("n") >= level_gate(m)) & (F.col("n") >= m.floor))


def mining_params(counts: DataFrame, m: Mining = Mining()) -> DataFrame:
    """Support and minimum count of each context: one support for contexts of every size, and a
    least count below which nothing is called frequent."""
    out = counts.withColumn("min_support", F.lit(float(m.min_support)))
    return out.withColumn("min_count", F.greatest(F.lit(m.least_count), F.ceil(F.col("min_support") * F.col("n"))))


def adaptive_params(
    counts: DataFrame, m: Mining = Mining(), steps: Sequence[tuple[int, float, int]] = ADAPTIVE_STEPS
) -> DataFrame:
    """A table of thresholds that rise with the size of a context. Nothing here mines by it."""
    support, length = F.lit(float(m.min_support)), F.lit(m.max_antecedent)
    for more_than, at_least, at_most in sorted(steps):
        test = F.col("n") > more_than
        support = F.when(test, F.lit(max(m.min_support, at_least))).otherwise(support)
        length = F.when(test, F.lit(min(m.max_antecedent, at_most))).otherwise(length)
    out = counts.withColumns({"min_support": support, "max_antecedent": length})
    return out.withColumn("min_count", F.ceil(F.col("min_support") * F.col("n")))


def context_transactions(txns: DataFrame, m: Mining = Mining()) -> DataFrame:
    """(order_id, level, key, items) of every context that passes its gate.

    Each transaction is exploded once, over the contexts of its leaf that pass.
    """
    leaves = leaf_contexts(txns)
    valid = passing_contexts(roll_up(leaves).groupBy(*CONTEXT).agg(F.sum("leaf_n").alias("n")), m)
    kept = (
        roll_up(leaves)
        .join(valid.select(*CONTEXT), CONTEXT, "left_semi")
        .groupBy(LEAF)
        .agg(F.collect_list(F.struct(*CONTEXT)).alias("contexts"))
    )
    kept = build_side(stage(kept, "kept-contexts"))
    items = F.array_distinct("products")
    return (
        txns.select("order_id", LEAF, items.alias("items"))
        .where(F.size("items") >= MIN_BASKET_ITEMS)
        .join(kept, LEAF)
        .select("order_id", F.explode("contexts").alias("c"), "items")
        .select("c.*", "order_id", "items")
    )


def cap_transactions(
    ctx_txns: DataFrame, cap: int = MAX_TXNS_PER_CONTEXT, seed: int = 42, bucket_digits: int = 3
) -> DataFrame:
    """A repeatable random sample of at most ``cap`` transactions per context.

    This is the sampling operator itself; mining does not use it. The order is that of a hash.
    Whole hash buckets are taken up to the cap by their counts and only the bucket the cap
    falls into is sorted, so no task sees a whole context.
    """
    digest = F.md5(F.concat_ws(":", F.col("order_id").cast("string"), F.lit(str(seed))))
    drawn = ctx_txns.withColumn("_h", digest).withColumn("_b", F.substring("_h", 1, bucket_digits))
    sizes = drawn.groupBy(*CONTEXT, "_b").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*CONTEXT).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    room = sizes.select(*CONTEXT, "_b", "_c", (F.lit(cap) - F.coalesce(F.sum("_c").over(before), F.lit(0))).alias("_room"))
    room = room.where(F.col("_room") > 0)
    joined = drawn.join(room, [*CONTEXT, "_b"])
    whole = joined.where(F.col("_c") <= F.col("_room"))
    inside = Window.partitionBy(*CONTEXT, "_b").orderBy("_h", "order_id")
    edge = (
        joined.where(F.col("_c") > F.col("_room"))
        .withColumn("_r", F.row_number().over(inside))
        .where(F.col("_r") <= F.col("_room"))
        .drop("_r")
    )
    return whole.unionByName(edge).select(*ctx_txns.columns)


def frequent_itemsets(txns: DataFrame, m: Mining = Mining(), max_size: int | None = None) -> DataFrame:
    """All frequent itemsets of every context with their counts, up to ``max_size`` items if given.

    Transactions are shuffled once, into blocks of bitmaps per leaf context (``operators.vertical``).
    Sets grow level by level for each context: a set is only counted if two of its subsets of one
    item less and the pair of its last two items are frequent there. The sets of a context meet the blocks of its leaves, and the counts
    of the blocks add up, so contexts of any size are spread over tasks. The search ends with the first level
    from which nothing grows. Building the result does the work of all levels; what is returned
    reads the written tables.
    """
    txns = txns.select(
        "order_id", *[f"context_{level}" for level in LEVELS], F.array_distinct("products").alias("items")
    ).where(F.size("items") >= MIN_BASKET_ITEMS)

    # One row per leaf context and per context, not per transaction. Both get numbers, fixed by
    # writing them, that stand for the long keys in every shuffle; measured sizes decide how
    # the tables are joined.
    leaves = stage(leaf_contexts(txns).withColumn("leaf", F.monotonically_increasing_id()), "leaf-contexts")
    rolled = leaves.select("leaf", "leaf_n", F.explode(context_array(LEVELS)).alias("c")).select("leaf", "leaf_n", "c.*")
    counts = rolled.groupBy(*CONTEXT).agg(F.sum("leaf_n").alias("n"))
    params = mining_params(passing_contexts(counts, m), m)
    contexts = stage(params.withColumn("context", F.monotonically_increasing_id()), "contexts")
    members = stage(rolled.join(contexts, CONTEXT).select("leaf", "context"), "context-members")
    limits = build_side(contexts.select("context", "n", "min_count"))
    members_side = build_side(members)
    numbered = txns.join(build_side(leaves.select(LEAF, "leaf", "leaf_n")), LEAF)
    blocks = stage(vertical.blocks(numbered, "leaf", "items", "order_id", "leaf_n"), "transaction-blocks")

    def frequent(totals: DataFrame) -> DataFrame:
        """What reaches the minimum of its context."""
        return totals.join(limits, "context").where("cnt >= min_count").drop("min_count")

    def of_contexts(leaf_counts: DataFrame) -> DataFrame:
        """Counts of leaves, added up for each context of the leaf."""
        whole = leaf_counts.groupBy("grp", "set").agg(F.sum("cnt").alias("cnt"))
        owned = whole.join(members_side.withColumnRenamed("leaf", "grp"), "grp")
        return owned.groupBy("context", "set").agg(F.sum("cnt").alias("cnt"))

    def kept(sets: DataFrame, size: int) -> DataFrame:
        """Written with a number for each set; ``head`` is the number of the set without its last item."""
        return stage(sets.withColumns({"last": F.element_at("set", -1), "id": F.monotonically_increasing_id()}), f"itemsets-{size}")

    singles = kept(frequent(of_contexts(vertical.count_singles(blocks))).withColumn("head", F.col("context")), 1)
    found, level, pairs, size = singles, singles, None, 1
    while size != max_size and not level.isEmpty():
        size += 1
        if size == 2:
            # Items that are frequent in a context of the leaf; pairs are counted where they occur.
            alive = level.join(members_side, "context").groupBy("leaf").agg(F.collect_set("last").alias("alive"))
            alive = build_side(stage(alive, "frequent-items"))
            counted = of_contexts(vertical.count_pairs(blocks.join(alive.withColumnRenamed("leaf", "grp"), "grp")))
            heads = singles.select("context", F.col("last").alias("first"), F.col("id").alias("head"))
            rows = frequent(counted).withColumn("first", F.col("set")[0]).join(heads, ["context", "first"]).drop("first")
            level = pairs = kept(rows, 2)
        else:
            grown = stage(_set_lists(_grown_sets(level, pairs)).withColumnRenamed("context", "owner"), "grown-sets")
            owners = members_side.join(grown.select(F.col("owner").alias("context")).distinct(), "context", "left_semi")
            owned = blocks.join(owners.select(F.col("leaf").alias("grp"), F.col("context").alias("owner")), "grp")
            # Counted by a job of its own: the plan of all at once is described anew after each of its exchanges.
            counted = stage(vertical.count_sets(owned, grown), "set-counts").withColumnRenamed("owner", "context")
            reached = frequent(counted)
            named = grown.select(F.col("owner").alias("context"), "piece", F.posexplode(F.arrays_zip("sets", "heads")).alias("pos", "x"))
            rows = reached.join(named, ["context", "piece", "pos"])
            level = kept(rows.select("context", F.col("x.sets").alias("set"), "cnt", "n", F.col("x.heads").alias("head")), size)
        found = found.unionByName(level)
    named = found.withColumnRenamed("set", "items").join(build_side(contexts.select("context", *CONTEXT)), "context")
    return named.select(*CONTEXT, "items", F.size("items").alias("size"), "cnt", "n")


def _grown_sets(level: DataFrame, pairs: DataFrame) -> DataFrame:
    """(context, set, head): sets of one more item, each made of two of ``level`` that share all but
    the last item, if those two items are frequent together. ``head`` is the first of the two."""
    a = level.select("context", "set", F.col("last").alias("prior"), "head", F.col("id").alias("new_head"))
    b = level.select("head", "last")
    grown = a.join(b, "head").where("last > prior")
    both = pairs.select("context", F.col("set")[0].alias("prior"), "last")
    grown = grown.join(both, ["context", "prior", "last"], "left_semi")
    return grown.select("context", F.concat("set", F.array("last")).alias("set"), F.col("new_head").alias("head"))


def _set_lists(sets: DataFrame) -> DataFrame:
    """(context, piece, sets, heads): the sets of each context as lists of about ``SETS_PER_LIST``, in order."""
    parts = sets.groupBy("context").agg(F.ceil(F.count(F.lit(1)) / SETS_PER_LIST).alias("pieces"))
    dealt = sets.join(parts, "context").withColumn("piece", F.pmod(F.col("head"), F.col("pieces")))
    lists = dealt.groupBy("context", "piece").agg(F.sort_array(F.collect_list(F.struct("set", "head"))).alias("l"))
    return lists.select("context", "piece", F.col("l.set").alias("sets"), F.col("l.head").alias("heads"))


def association_rules(itemsets: DataFrame) -> DataFrame:
    """Every single-consequent rule of the itemsets with confidence, lift and support."""
    base = itemsets.select(*CONTEXT, "items", "cnt")
    consequent = base.where(F.size("items") == 1).select(
        *CONTEXT, F.col("items")[0].alias("consequent"), F.col("cnt").alias("cons_cnt")
    )
    antecedent = base.select(*CONTEXT, F.col("items").alias("antecedent"), F.col("cnt").alias("ant_cnt"))
    split = itemsets.where(F.size("items") >= 2).withColumn("consequent", F.explode("items"))
    split = split.withColumn("antecedent", F.array_remove("items", F.col("consequent")))
    joined = split.join(antecedent, [*CONTEXT, "antecedent"]).join(consequent, [*CONTEXT, "consequent"])
    confidence = F.col("cnt") / F.col("ant_cnt")
    return joined.select(
        *CONTEXT,
        "antecedent",
        "consequent",
        confidence.alias("confidence"),
        (confidence / (F.col("cons_cnt") / F.col("n"))).alias("lift"),
        (F.col("cnt") / F.col("n")).alias("support"),
        "n",
    )


def filter_rules(rules: DataFrame, m: Mining = Mining(), per_context: int | None = None) -> DataFrame:
    """Confidence, lift and length limits; the best ``per_context`` rules of each context if given."""
    kept = rules.where(
        (F.col("confidence") >= m.min_confidence)
        & (F.col("lift") >= m.min_lift)
        & (F.size("antecedent") <= m.max_antecedent)
    )
    if per_context is None:
        return kept
    order = [F.col("lift").desc(), F.col("confidence").desc(), F.col("antecedent"), F.col("consequent")]
    return top_n(kept, CONTEXT, order, per_context, "context_rank")


def build_index(rules: DataFrame, m: Mining = Mining(), per_antecedent: int | None = None) -> DataFrame:
    """The rules table that serving reads: valid, deduplicated and scored.

    With ``per_antecedent``, only the best of each antecedent, numbered in ``antecedent_rank``.
    """
    usable = rules.where(valid_rule() & (F.col("lift") >= m.min_lift))
    score = rule_score(F.col("confidence"), F.col("lift"), F.col("support"), m)
    scored = usable.select(*CONTEXT, "antecedent", "consequent", "confidence", "lift", "support", score.alias("score"))
    scored = scored.withColumn("_worst", -F.col("score"))
    key = [*CONTEXT, "antecedent", "consequent"]
    # Of several rules with the same sides the best scored one stays.
    best = first_row(scored, key, ["_worst", "confidence", "lift", "support", "score"]).drop("_worst")
    ranked = []
    if per_antecedent is not None:
        order = [F.col("score").desc(), F.col("consequent")]
        best = top_n(best, [*CONTEXT, "antecedent"], order, per_antecedent, "antecedent_rank")
        ranked = ["antecedent_rank"]
    return best.select(
        *CONTEXT,
        rule_id(F.col("antecedent"), F.col("consequent")).alias("rule_id"),
        "antecedent",
        "consequent",
        round_half_up(F.col("confidence"), 4).alias("confidence"),
        round_half_up(F.least("lift", F.lit(m.lift_cap)), 4).alias("lift"),
        round_half_up(F.col("support"), 6).alias("support"),
        round_half_up(F.col("score"), 4).alias("score"),
        *ranked,
    )


def valid_rule():
    return (
        (F.size("antecedent") > 0)
        & F.col("consequent").isNotNull()
        & F.col("confidence").isNotNull()
        & F.col("lift").isNotNull()
    )


def build_stats(rules: DataFrame, index: DataFrame, m: Mining = Mining()) -> DataFrame:
    """Counters of one index build: rules in, dropped by reason, kept, antecedents in and out."""
    invalid = ~F.coalesce(valid_rule(), F.lit(False))
    low = ~invalid & (F.col("lift") < m.min_lift)
    per_in = rules.groupBy(*CONTEXT, "antecedent").agg(
        F.count(F.lit(1)).alias("rules_in"),
        F.count_if(invalid).alias("rules_invalid"),
        F.count_if(low).alias("rules_low_lift"),
        F.lit(0).cast("bigint").alias("rules_kept"),
    )
    per_out = index.groupBy(*CONTEXT, "antecedent").agg(
        *[F.lit(0).cast("bigint").alias(c) for c in ("rules_in", "rules_invalid", "rules_low_lift")],
        F.count(F.lit(1)).alias("rules_kept"),
    )
    both = per_in.unionByName(per_out)
    names = ["rules_in", "rules_invalid", "rules_low_lift", "rules_kept"]
    return both.agg(
        *[F.sum(c).alias(c) for c in names],
        F.count_if(F.col("rules_in") > 0).alias("antecedents_in"),
        F.count_if(F.col("rules_kept") > 0).alias("antecedents_out"),
    )


def rule_stats(index: DataFrame) -> DataFrame:
    """Contexts, antecedents and rules of each level."""
    per = index.groupBy(*CONTEXT, "antecedent").agg(F.count(F.lit(1)).alias("r"))
    per = per.groupBy(*CONTEXT).agg(F.count(F.lit(1)).alias("a"), F.sum("r").alias("r"))
    return per.groupBy("context_level").agg(
        F.count(F.lit(1)).alias("contexts"), F.sum("a").alias("antecedents"), F.sum("r").alias("rules")
    )


def mining_stats(
    itemsets: DataFrame, index: DataFrame, params: DataFrame, m: Mining = Mining(), outcome: "Outcome | None" = None
) -> DataFrame:
    """One row per mined context: size, thresholds, itemsets, rules, confidences, and the run.

    All contexts are mined by one job, so a run has one outcome: its time, and how it ended.
    """
    outcome = outcome or Outcome()
    sets = itemsets.groupBy(*CONTEXT).agg(F.count(F.lit(1)).alias("num_frequent_itemsets"))
    rules = index.groupBy(*CONTEXT).agg(
        F.count(F.lit(1)).alias("num_rules"),
        (F.sum(F.round(F.col("confidence") * 10000).cast("bigint")) / F.count(F.lit(1)) / 10000).alias("avg_confidence"),
        F.max("confidence").alias("max_confidence"),
    )
    return (
        params.join(sets, CONTEXT, "left")
        .join(rules, CONTEXT, "left")
        .select(
            *CONTEXT,
            F.col("n").alias("num_transactions"),
            "min_support",
            F.lit(m.min_confidence).alias("min_confidence"),
            *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("num_frequent_itemsets", "num_rules")],
            round_half_up(F.coalesce("avg_confidence", F.lit(0.0)), 4).alias("avg_confidence"),
            F.coalesce("max_confidence", F.lit(0.0)).alias("max_confidence"),
            F.lit(outcome.seconds).cast("double").alias("run_time"),
            F.lit(outcome.status).alias("status"),
            F.lit(outcome.error).alias("error"),
        )
    )


@dataclass
class Outcome:
    """How a mining run ended; ``seconds`` is null for a run that was not timed."""

    status: str = "success"
    error: str = ""
    seconds: float | None = None


def mine_logged(txns: DataFrame, m: Mining = Mining()) -> tuple[DataFrame | None, DataFrame]:
    """(rules, log): the written rules table and the log rows of the run.

    A run that fails has no rules table; its log rows say why, for every context it was to mine.
    """
    params = mining_params(passing_contexts(context_counts(txns), m), m)
    outcome, began = Outcome(), time.monotonic()
    itemsets = index = None
    try:
        itemsets = stage(frequent_itemsets(txns, m), "itemsets")
        index = stage(build_index(filter_rules(association_rules(itemsets), m), m), "index")
    except Exception as error:  # noqa: BLE001  the log is where a failed run is reported
        outcome.status, outcome.error = "failed", f"{type(error).__name__}: {str(error)[:500]}"
    outcome.seconds = round(time.monotonic() - began, 3)
    nothing = params.select(*CONTEXT, F.lit(0.0).alias("confidence")).where("false")
    log = mining_stats(nothing if index is None else itemsets, nothing if index is None else index, params, m, outcome)
    return index, log


def mine(
    txns: DataFrame, m: Mining = Mining(), per_context: int | None = None, per_antecedent: int | None = None
) -> DataFrame:
    """Transactions with context keys to the rules table, all contexts at once."""
    itemsets = stage(frequent_itemsets(txns, m), "itemsets")
    return build_index(filter_rules(association_rules(itemsets), m, per_context), m, per_antecedent)


def rule_sample(index: DataFrame, contexts: int = 5, per_antecedent: int = 50) -> DataFrame:
    """Flat rules of the first contexts by key, at most ``per_antecedent`` of each antecedent."""
    first = index.select(*CONTEXT).distinct().orderBy(*CONTEXT).limit(contexts)
    order = [F.col("score").desc(), F.col("consequent")]
    rows = top_n(index.join(first, CONTEXT, "left_semi"), [*CONTEXT, "antecedent"], order, per_antecedent, "rank")
    return rows.select(
        *CONTEXT,
        F.size("antecedent").alias("antecedent_size"),
        antecedent_text(F.col("antecedent")).alias("antecedent"),
        "consequent",
        "support",
        "confidence",
        "lift",
    )


def top_rules(rules: DataFrame, n: int = 10, order_by: Sequence[str] = ("context_level", "context_key", "antecedent", "consequent")) -> DataFrame:
    return rules.orderBy(F.col("lift").desc(), *order_by).limit(n)
