"""The published ranking of customers at risk and its summary line."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.labels import expiry_band, expiry_label, gap_band, tier_icon, tier_rank
from stayline.functions.scalar import fixed_decimals, safe_number
from stayline.operators.ranking import global_rank
from stayline.plans.catalog import scored

Tables = Mapping[str, DataFrame]


def publishable(t: Tables) -> DataFrame:
    """One row per scored customer, also without a partner elsewhere: score and features of the deciding vehicle, that vehicle's model, the masked customer."""
    vehicles = t["vehicle"].select("vehicle_id", "model", "variant").dropDuplicates(["vehicle_id"])
    people = t["customer"].select("cust_id", "name_masked", "city")
    return scored(t, "left").join(vehicles, "vehicle_id", "left").join(people, "cust_id", "left")


def ranked_results(t: Tables) -> DataFrame:
    """The published table: rank over all customers, labels and alert bands."""
    gap = safe_number(F.col("days_since_last_service")).cast("int")
    expiry = safe_number(F.col("days_to_policy_expiry")).cast("int")
    rows = publishable(t).select(
        "cust_id",
        "name_masked",
        "city",
        "model",
        "variant",
        "risk_tier",
        safe_number(F.col("churn_probability")).alias("_probability"),
        gap.alias("days_since_last_service"),
        expiry.alias("_expiry"),
        "top_driver_1",
        "top_driver_2",
        "top_driver_3",
        "recommended_action",
    )
    order = [tier_rank(F.col("risk_tier")), F.desc("_probability"), F.col("cust_id")]
    return global_rank(rows, order, "cust_id").select(
        "rank",
        "cust_id",
        "name_masked",
        "city",
        "model",
        "variant",
        fixed_decimals(F.col("_probability"), 4).alias("churn_prob"),
        "risk_tier",
        tier_icon(F.col("risk_tier")).alias("tier_label"),
        "days_since_last_service",
        gap_band(F.col("days_since_last_service")).alias("gap_band"),
        expiry_label(F.col("_expiry")).alias("policy_expiry"),
        expiry_band(F.col("_expiry")).alias("expiry_band"),
        "top_driver_1",
        "top_driver_2",
        "top_driver_3",
        "recommended_action",
    )
