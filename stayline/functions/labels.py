"""Report labels and alert bands."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from stayline.reference_data import TIER_ACTIONS, TIER_ICONS, TIERS


def _choose(key: Column, options: dict[str, str], default: Column) -> Column:
    chain = reduce(lambda acc, kv: acc.when(key == kv[0], F.lit(kv[1])), options.items(), F)
    return chain.otherwise(default)


def tier_rank(tier: Column) -> Column:
    """High 1, Medium 2, everything else 3."""
    return F.when(tier == TIERS[0], 1).when(tier == TIERS[1], 2).otherwise(3)


def tier_icon(tier: Column) -> Column:
    return _choose(tier, TIER_ICONS, tier)


def recommended_action(tier: Column) -> Column:
    return _choose(tier, TIER_ACTIONS, F.lit(None).cast("string"))


def expiry_label(days: Column) -> Column:
    return F.when(days < 0, F.concat(days.cast("string"), F.lit(" (EXPIRED)"))).otherwise(days.cast("string"))


def gap_band(days: Column) -> Column:
    return F.when(days > 365, "High").when(days > 180, "Medium").otherwise("Low")


def expiry_band(days: Column) -> Column:
    return F.when(days < 0, "High").when(days < 30, "Medium").otherwise("Low")
