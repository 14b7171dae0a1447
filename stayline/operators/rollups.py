"""Aggregate expressions shared by the reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.scalar import floor_percent, percent
from stayline.reference_data import REVENUE_PER_CUSTOMER, TIERS


def tier_counts() -> list[Column]:
    """One conditional count per tier: ``high_risk``, ``medium_risk``, ``low_risk``."""
    return [F.count_if(F.col("risk_tier") == tier).alias(f"{tier.lower()}_risk") for tier in TIERS]


def revenue_at_risk(tiers: tuple[str, ...], per_customer: int = REVENUE_PER_CUSTOMER) -> Column:
    """Customers of the given tiers times the yearly spend. The reports differ in the tiers they count."""
    return F.count_if(F.col("risk_tier").isin(*tiers)) * per_customer


def tier_distribution(scores: DataFrame) -> DataFrame:
    """One row: counts and whole percents (rounded down) per tier, revenue of the high tier only."""
    total = F.count("*")
    percents = [
        floor_percent(F.count_if(F.col("risk_tier") == tier), total).alias(f"{tier.lower()}_pct") for tier in TIERS
    ]
    return scores.agg(
        total.alias("total_customers"), *tier_counts(), *percents, revenue_at_risk(("High",)).alias("revenue_at_risk_inr")
    )


def decision_stats(decisions: DataFrame) -> DataFrame:
    """One row of totals. The second label of a pair is counted only where the first does not occur at all."""

    def labelled(first: str, second: str) -> Column:
        return F.coalesce(
            F.nullif(F.count_if(F.col("decision") == first), F.lit(0)), F.count_if(F.col("decision") == second)
        )

    counts = decisions.agg(
        F.count("*").alias("total"),
        labelled("Approved", "Granted").alias("approved"),
        labelled("Refused", "Rejected").alias("refused"),
    )
    return counts.select(
        "*",
        percent(F.col("approved"), F.col("total")).alias("approval_pct"),
        percent(F.col("refused"), F.col("total")).alias("refused_pct"),
    )


def shared_keys(bridge: DataFrame, key: str, other: str) -> DataFrame:
    """Keys that map to more than one distinct ``other``."""
    return (
        bridge.groupBy(key)
        .agg(F.countDistinct(other).alias("distinct_others"))
        .where(F.col("distinct_others") > 1)
    )


#: Buckets of a selection round, and the values of one target rank that may be sorted in one task.
SELECT_BUCKETS = 1024
SELECT_TAIL = 100_000


def median_by(df: DataFrame, group: list[str], value: str, buckets: int = SELECT_BUCKETS, tail: int = SELECT_TAIL) -> DataFrame:
    """Exact median per group, also of continuous values, by distributed selection.

    The median is the mean of the values at ranks floor((n+1)/2) and floor((n+2)/2). Each rank starts with the
    group's whole range. A round counts the values in each open interval in ``buckets`` equal-width buckets (an
    aggregate of at most groups x 2 x buckets rows) and narrows the interval to the smallest and largest value of
    the bucket that holds the rank; the bucket is monotone in the value, so the counts below stay exact. An interval
    of one value is its answer; one of at most ``tail`` values is sorted in one task. Widths shrink by ``buckets`` a
    round until they reach the spacing of doubles, so few rounds are needed, and no group is ever gathered whole.
    Null values are left out; a group without values has no row.
    """
    from pyspark.sql import Window

    from stayline.session import stage

    spark = df.sparkSession
    data = stage(df.where(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v")), "median-values")
    sizes = data.groupBy(*group).agg(F.count("*").alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    ranks = F.array(F.floor((F.col("_n") + 1) / 2), F.floor((F.col("_n") + 2) / 2))
    targets = stage(
        sizes.select(*group, F.posexplode(ranks).alias("_t", "_k"), "_lo", "_hi", F.col("_n").alias("_in"), F.lit(0).cast("long").alias("_below")),
        "median-targets",
    )
    keys = [*group, "_t"]
    while True:
        open_ = targets.where((F.col("_lo") < F.col("_hi")) & (F.col("_in") > tail))
        if open_.isEmpty():
            break
        width = F.col("_hi") - F.col("_lo")
        bucket = F.least(F.floor((F.col("_v") - F.col("_lo")) / width * buckets), F.lit(buckets - 1)).cast("int")
        inside = data.join(open_, group).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
        counted = inside.groupBy(*keys, bucket.alias("_b")).agg(F.count("*").alias("_c"), F.min("_v").alias("_blo"), F.max("_v").alias("_bhi"))
        upto = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most `buckets` rows
        placed = counted.join(open_.select(*keys, "_k", "_below"), keys).withColumn("_upto", F.col("_below") + F.sum("_c").over(upto))
        chosen = placed.where((F.col("_upto") >= F.col("_k")) & (F.col("_upto") - F.col("_c") < F.col("_k"))).select(
            *keys, F.col("_blo").alias("_lo"), F.col("_bhi").alias("_hi"), F.col("_c").alias("_in"), (F.col("_upto") - F.col("_c")).alias("_below")
        )
        targets = stage(
            targets.join(chosen.select(*keys), keys, "left_anti").unionByName(chosen.join(targets.select(*keys, "_k"), keys)),
            "median-targets",
        )
    single = targets.where(F.col("_lo") == F.col("_hi")).select(*keys, F.col("_lo").alias("_x"))
    few = targets.where(F.col("_lo") < F.col("_hi"))
    within = data.join(few, group).where(F.col("_v").between(F.col("_lo"), F.col("_hi")))
    order = Window.partitionBy(*keys).orderBy("_v")  # at most `tail` rows a target
    picked = within.withColumn("_at", F.col("_below") + F.row_number().over(order)).where(F.col("_at") == F.col("_k")).select(*keys, F.col("_v").alias("_x"))
    return single.unionByName(picked).groupBy(*group).agg((F.sum("_x") / 2.0).alias(f"median_{value}"))