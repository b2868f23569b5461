"""Frequent itemsets kept up to date batch by batch, equal to mining all transactions anew.

The state holds, for every context that passes its gate, the counts of its *candidates*: frequent
sets, and their border, the sets that are not frequent though the subsets they grow from are. A batch of
transactions is laid out as blocks of its own (``operators.vertical``) and the candidates are counted in
those blocks only; the counts add up. Earlier blocks are read again just for sets that were no candidate
before: those that grow from a set which became frequent, and the sets of a context which passes its gate
for the first time. Candidates that no transaction holds are not stored; that a set was a candidate
is seen from the flags of the sets it grows from, and its count was zero then.

A set that is no longer frequent, as its context grew faster than its count, stays as border, and what
grew from it goes. Thresholds may change from one batch to the next.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwright.config import MIN_BASKET_ITEMS, Mining
from cartwright.functions.context import context_array
from cartwright.lineage import build_side, stage
from cartwright.operators import vertical
from cartwright.plans.rules import CONTEXT, LEAF, LEVELS, _set_lists, leaf_contexts, mining_params, passing_contexts

KEYS = [f"context_{level}" for level in LEVELS]
LEAVES = ", ".join(f"{key} string" for key in KEYS) + ", leaf long, leaf_n long"
ITEMS = "leaf long, item long, cnt long"
CONTEXTS = "context long, context_level string, context_key string, n long, min_count long"
SETS = "context long, set array<long>, cnt long, frequent boolean"


@dataclass(frozen=True)
class State:
    """``blocks`` of transactions, transactions of each leaf context, occurrences of items per
    leaf, passing contexts, and candidates. Leaves and contexts keep their numbers."""

    blocks: DataFrame
    leaves: DataFrame
    items: DataFrame
    contexts: DataFrame
    sets: DataFrame


def empty(spark: SparkSession) -> State:
    return State(*[spark.createDataFrame([], schema) for schema in (vertical.BLOCKS, LEAVES, ITEMS, CONTEXTS, SETS)])


def itemsets(state: State) -> DataFrame:
    """What ``rules.frequent_itemsets`` gives for all transactions so far."""
    named = state.sets.where("frequent").join(build_side(state.contexts.select("context", *CONTEXT, "n")), "context")
    return named.select(*CONTEXT, F.col("set").alias("items"), F.size("set").alias("size"), "cnt", "n")


def advance(before: State, txns: DataFrame, m: Mining = Mining(), max_size: int | None = None) -> State:
    """The state after a batch; its ``blocks`` are those of the batch alone, which come on top of the earlier ones.

    The tables of the state and all on the way to it are staged while it is built.
    """
    txns = txns.select("order_id", *KEYS, F.array_distinct("products").alias("items"))
    txns = txns.where(F.size("items") >= MIN_BASKET_ITEMS)
    added = stage(leaf_contexts(txns), "batch-leaves")
    both = added.withColumnRenamed("leaf_n", "added").join(before.leaves, KEYS, "full")
    total = F.coalesce("leaf_n", F.lit(0)) + F.coalesce("added", F.lit(0))
    leaves = stage(both.select(*KEYS, _numbered("leaf", before.leaves), total.alias("leaf_n")), "leaves")

    rolled = leaves.select("leaf", "leaf_n", F.explode(context_array(LEVELS)).alias("c")).select("leaf", "leaf_n", "c.*")
    params = mining_params(passing_contexts(rolled.groupBy(*CONTEXT).agg(F.sum("leaf_n").alias("n")), m), m)
    known = params.join(before.contexts.select(*CONTEXT, "context"), CONTEXT, "left")
    contexts = known.select(_numbered("context", before.contexts), *CONTEXT, "n", F.col("min_count").cast("long").alias("min_count"))
    contexts = stage(contexts, "contexts")
    members = stage(rolled.join(contexts, CONTEXT).select("leaf", "context"), "context-members")

    places = build_side(stage(added.join(leaves.select(LEAF, "leaf"), LEAF).select(LEAF, "leaf", "leaf_n"), "batch-places"))
    blocks = stage(vertical.blocks(txns.join(places, LEAF), "leaf", "items", "order_id", "leaf_n"), "batch-blocks")
    fresh = vertical.count_singles(blocks).select(F.col("grp").alias("leaf"), F.col("set")[0].alias("item"), "cnt")
    items = before.items.unionByName(fresh).groupBy("leaf", "item").agg(F.sum("cnt").alias("cnt"))
    items = stage(items, "leaf-items")

    levels = _Levels(before, blocks, contexts, members)
    singles = level = pairs = levels.singles(items)
    found, size = singles, 1
    while size != max_size and not level.isEmpty():
        size += 1
        if size == 2:
            rows = levels.pairs(singles)
            level = pairs = rows.where("frequent")
        else:
            rows = levels.longer(level, pairs, size)
            level = rows.where("frequent")
        found = found.unionByName(rows)
    return State(blocks, leaves, items, contexts, found.select("context", "set", "cnt", "frequent"))


def _numbered(name: str, before: DataFrame):
    """The known number, or one above all known ones; it is fixed once the table is written."""
    base = (before.agg(F.max(name)).first()[0] or 0) + 1
    return F.coalesce(F.col(name), F.lit(base) + F.monotonically_increasing_id()).alias(name)


class _Levels:
    """Candidates of one size after another: ``head`` numbers the set without its last item, ``was`` tells
    that the set was frequent before the batch."""

    def __init__(self, before: State, blocks: DataFrame, contexts: DataFrame, members: DataFrame):
        self.before, self.blocks, self.members = before, blocks, members
        self.limits = build_side(contexts.select("context", "min_count"))
        self.first_batch = before.blocks.isEmpty()

    def known(self, size: int) -> DataFrame:
        return self.before.sets.where(F.size("set") == size)

    def settled(self, counted: list[DataFrame], size: int) -> DataFrame:
        """Counts of a set from different sources added up and held against the minimum."""
        total = reduce(DataFrame.unionByName, counted).groupBy("context", "set", "head").agg(F.sum("cnt").alias("cnt"))
        was = self.known(size).select("context", "set", F.col("frequent").alias("was"))
        rows = total.join(self.limits, "context").join(was, ["context", "set"], "left")
        rows = rows.withColumns({"frequent": F.expr("cnt >= min_count"), "was": F.coalesce("was", F.lit(False))})
        return stage(rows.drop("min_count").withColumn("id", F.monotonically_increasing_id()), f"candidates-{size}")

    def of_contexts(self, leaf_counts: DataFrame, members: DataFrame) -> DataFrame:
        whole = leaf_counts.groupBy("grp", "set").agg(F.sum("cnt").alias("cnt"))
        owned = whole.join(build_side(members).withColumnRenamed("leaf", "grp"), "grp")
        return owned.groupBy("context", "set").agg(F.sum("cnt").alias("cnt"))

    def singles(self, items: DataFrame) -> DataFrame:
        """Items are counted per leaf whatever their context, so only frequent ones are kept here."""
        owned = items.join(build_side(self.members), "leaf").withColumn("set", F.array("item"))
        counted = owned.select("context", "set", F.col("context").alias("head"), "cnt")
        return self.settled([counted], 1).where("frequent")

    def pairs(self, singles: DataFrame) -> DataFrame:
        item = F.col("set")[0]
        first = singles.select("context", item.alias("first"), F.col("id").alias("head"), F.col("was").alias("was_first"))
        last = singles.select("context", item.alias("last"), F.col("was").alias("was_last"))

        def of_frequent_items(counted: DataFrame) -> DataFrame:
            ends = counted.withColumns({"first": F.col("set")[0], "last": F.col("set")[1]})
            rows = ends.join(first, ["context", "first"]).join(last, ["context", "last"])
            return rows.select("context", "set", "head", "cnt", F.expr("was_first AND was_last").alias("known"))

        def occurring(blocks: DataFrame, members: DataFrame) -> DataFrame:
            alive = singles.join(build_side(members), "context").groupBy("leaf").agg(F.collect_set(item).alias("alive"))
            alive = build_side(stage(alive.withColumnRenamed("leaf", "grp"), "frequent-items"))
            return of_frequent_items(self.of_contexts(vertical.count_pairs(blocks.join(alive, "grp")), members))

        parts = [occurring(self.blocks, self.members), of_frequent_items(self.known(2).select("context", "set", "cnt"))]
        opened = singles.where("NOT was").select("context").distinct()
        if not self.first_batch and not opened.isEmpty():
            # Contexts with items that became frequent: their earlier blocks are read for pairs with such an item.
            members = stage(self.members.join(opened, "context", "left_semi"), "opened-members")
            parts.append(occurring(self.before.blocks, members).where("NOT known"))
        return self.settled([part.drop("known") for part in parts], 2)

    def longer(self, level: DataFrame, pairs: DataFrame, size: int) -> DataFrame:
        a = level.select("context", "set", F.element_at("set", -1).alias("prior"), "head", F.col("id").alias("grown"), F.col("was").alias("was_a"))
        b = level.select("head", F.element_at("set", -1).alias("last"), F.col("was").alias("was_b"))
        both = pairs.select("context", F.col("set")[0].alias("prior"), F.col("set")[1].alias("last"), F.col("was").alias("was_pair"))
        grown = a.join(b, "head").where("last > prior").join(both, ["context", "prior", "last"])
        grown = grown.select(
            "context",
            F.concat("set", F.array("last")).alias("set"),
            F.col("grown").alias("head"),
            F.expr("was_a AND was_b AND was_pair").alias("known"),
        )
        grown = stage(grown, f"grown-sets-{size}")
        stored = self.known(size).select("context", "set", "cnt").join(grown.where("known").drop("known"), ["context", "set"])
        parts = [stored.select("context", "set", "head", "cnt"), self.counted(self.blocks, grown)]
        opened = grown.where("NOT known")
        if not self.first_batch and not opened.isEmpty():
            parts.append(self.counted(self.before.blocks, opened))
        return self.settled(parts, size)

    def counted(self, blocks: DataFrame, grown: DataFrame) -> DataFrame:
        """(context, set, head, cnt) in the given blocks."""
        lists = stage(_set_lists(grown).withColumnRenamed("context", "owner"), "set-lists")
        owners = self.members.join(lists.select(F.col("owner").alias("context")).distinct(), "context", "left_semi")
        owners = stage(owners.select(F.col("leaf").alias("grp"), F.col("context").alias("owner")), "set-owners")
        named = lists.select("owner", "piece", F.posexplode(F.arrays_zip("sets", "heads")).alias("pos", "x"))
        # Counted by a job of its own: the plan of a whole level is described anew after each of its exchanges.
        counts = stage(vertical.count_sets(blocks.join(build_side(owners), "grp"), lists), "set-counts")
        rows = counts.join(named, ["owner", "piece", "pos"])
        return rows.select(F.col("owner").alias("context"), F.col("x.sets").alias("set"), F.col("x.heads").alias("head"), "cnt")
