"""Rule scores and ids, and order-independent sums of doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cartwright.config import Mining

# Sums of doubles depend on the order in which partitions arrive. Scores that decide a
# ranking are therefore summed as whole numbers of this unit.
SCORE_UNIT = 1e9


def to_units(x: Column) -> Column:
    return F.round(x * F.lit(SCORE_UNIT), 0).cast("bigint")


def from_units(x: Column) -> Column:
    return x.cast("double") / F.lit(SCORE_UNIT)


def round_half_up(x: Column, digits: int) -> Column:
    """Round a non-negative number; plain double arithmetic, so any engine gets the same bits."""
    scale = float(10**digits)
    return F.floor(x * scale + 0.5) / F.lit(scale)


def miner_score(confidence: Column, lift: Column, m: Mining = Mining()) -> Column:
    return confidence * m.conf_weight + F.least(lift, F.lit(m.lift_cap)) * m.lift_weight


def rule_score(confidence: Column, lift: Column, support: Column, m: Mining = Mining()) -> Column:
    support_weight = max(0.0, 1.0 - m.conf_weight - m.lift_weight)
    return miner_score(confidence, lift, m) + support * support_weight


def antecedent_text(antecedent: Column) -> Column:
    """Members as strings in string order, joined by ``|``."""
    return F.array_join(F.array_sort(F.transform(antecedent, lambda x: x.cast("string"))), "|")


def rule_id(antecedent: Column, consequent: Column) -> Column:
    return F.md5(F.concat(antecedent_text(antecedent), F.lit("->"), consequent.cast("string")))
