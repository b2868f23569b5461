"""Fixed values of the data model. Every plan takes them as overridable arguments."""

from __future__ import annotations

from dataclasses import dataclass, field

# Context hierarchy, most specific level first.
CONTEXT_LEVELS: dict[str, tuple[str, ...]] = {
    "L1": ("time_bucket", "is_weekend", "lifecycle_stage", "preference_cluster", "behavior_cluster"),
    "L2": ("time_bucket", "is_weekend", "behavior_cluster", "preference_cluster"),
    "L3": ("time_bucket", "is_weekend", "behavior_cluster"),
    "L4": ("time_bucket", "is_weekend"),
    "L5": (),
}
GLOBAL_KEY = "GLOBAL"

# Smallest number of transactions a context of each level must have.
LEVEL_MIN_TXNS = {"L1": 500, "L2": 1000, "L3": 2000, "L4": 5000, "L5": 0}
CONTEXT_FLOOR = 100

# Weight of a rule by the level it was found at.
LEVEL_WEIGHT = {"L1": 2.0, "L2": 1.8, "L3": 1.5, "L4": 1.2, "L5": 0.3}
MIN_MATCH_RATIO = 0.6

TIME_BUCKETS = ("night", "morning", "afternoon", "evening")

MIN_BASKET_ITEMS = 2
MAX_TXNS_PER_CONTEXT = 300_000

# Defaults used while training (a user without a segment) and while serving.
TRAIN_DEFAULTS = {"behavior_cluster": 0, "preference_cluster": 0, "lifecycle_stage": "new"}
SERVE_DEFAULTS = {"behavior_cluster": -1, "preference_cluster": -1, "lifecycle_stage": "unknown"}

BEHAVIOR_FEATURES = ("total_orders", "avg_days_between_orders", "total_products", "reorder_ratio")
LOG_FEATURES = ("total_orders", "total_products")

# Fixed values: (head boost, tail boost) by lifecycle stage; other stages use "regular".
STAGE_BOOSTS = {"new": (1.15, 1.00), "regular": (1.00, 1.00), "loyal": (0.95, 1.10)}
HEAD_SHARE = 0.3

# Weights of the four score sources.
RANK_WEIGHTS = {"rule": 0.5, "behavior": 0.2, "preference": 0.2, "lifecycle": 0.1}

DEFAULT_TOP_K = 20
POPULAR_LIST_SIZE = 50
MAX_TOP_K = 100
RECALL_FACTOR = 3
# The longest list a request can need: fallback reads up to RECALL_FACTOR * top_k products.
SERVING_LIST_SIZE = RECALL_FACTOR * MAX_TOP_K
DEFAULT_PRICE = 100000.0


# Fixed values: (more transactions than, support at least, antecedent at most), for a table of
# thresholds by size. Mining does not read it: it treats contexts of every size alike.
ADAPTIVE_STEPS: tuple[tuple[int, float, int], ...] = ((500_000, 0.02, 1), (200_000, 0.01, 2))

# The cuts of the top-n operators on rules. Mining cuts nothing unless asked to.
TOP_RULES_PER_CONTEXT = 3000
TOP_RULES_PER_ANTECEDENT = 10


@dataclass(frozen=True)
class Mining:
    """Thresholds of one mining run."""

    min_support: float = 0.002
    min_confidence: float = 0.10
    min_lift: float = 1.05
    max_antecedent: int = 3
    level_min_txns: dict[str, int] = field(default_factory=lambda: dict(LEVEL_MIN_TXNS))
    floor: int = CONTEXT_FLOOR
    least_count: int = 1

    # Rule score = conf * c + min(lift, cap) * l + support * (1 - c - l).
    conf_weight: float = 0.6
    lift_weight: float = 0.04
    lift_cap: float = 10.0
