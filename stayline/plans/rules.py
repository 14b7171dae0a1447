"""Churn label and the four tier rules, which differ on purpose and are compared by ``tier_crosstab``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Limits of the label and of the tiers.
LAPSED_DAYS = 365
AT_RISK_DAYS = 180
EXPIRING_DAYS = 30
ENGAGED_RFM = 8
HIGH_PROBABILITY = 0.65
MEDIUM_PROBABILITY = 0.35


def _tier(high: Column, medium: Column) -> Column:
    return F.when(high, "High").when(medium, "Medium").otherwise("Low")


def churn_label(gap: Column, expiry: Column) -> Column:
    return F.when((gap > LAPSED_DAYS) & (expiry < 0), 1).otherwise(0)


def feature_tier(label: Column, rfm_total: Column) -> Column:
    return _tier(label == 1, rfm_total < ENGAGED_RFM)


def score_tier(probability: Column) -> Column:
    return _tier(probability > HIGH_PROBABILITY, probability > MEDIUM_PROBABILITY)


def baseline_tier(gap: Column, expiry: Column, visits: Column) -> Column:
    return _tier((gap > LAPSED_DAYS) & (expiry < 0), (gap > AT_RISK_DAYS) | (visits == 1))


def legend_tier(gap: Column, expiry: Column) -> Column:
    return _tier((gap > LAPSED_DAYS) & (expiry < 0), (gap > AT_RISK_DAYS) | (expiry < EXPIRING_DAYS))


def all_tiers(scored: DataFrame) -> DataFrame:
    """The tier of every customer under each rule, from rows that carry features and score."""
    gap, expiry = F.col("days_since_last_service"), F.col("days_to_policy_expiry")
    return scored.select(
        "cust_id",
        F.col("feature_tier").alias("by_features"),
        score_tier(F.col("churn_probability")).alias("by_score"),
        baseline_tier(gap, expiry, F.col("total_service_visits")).alias("by_baseline"),
        legend_tier(gap, expiry).alias("by_legend"),
    )


def tier_crosstab(scored: DataFrame) -> DataFrame:
    """How often the four rules give each combination of tiers; ``agree`` is 1 where all four are equal."""
    same = (
        (F.col("by_features") == F.col("by_score"))
        & (F.col("by_features") == F.col("by_baseline"))
        & (F.col("by_features") == F.col("by_legend"))
    )
    return (
        all_tiers(scored)
        .groupBy("by_features", "by_score", "by_baseline", "by_legend")
        .agg(F.count("*").alias("customers"))
        .withColumn("agree", F.when(same, 1).otherwise(0))
    )
