"""Churn features, one row per customer and vehicle."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayline.functions.scalar import clamp, floor_div
from stayline.plans import rules
from stayline.reference_data import FREE_WORK_TYPES
from stayline.schemas import TABLES


def daily_visits(service: DataFrame, as_of: dt.date) -> DataFrame:
    """Visits up to ``as_of`` summed per vehicle and day.

    Summing first keeps a vehicle that holds a large share of all rows out of a single task: its rows are
    combined on the map side and spread over its days, and at most one row per day is left for the join.
    """
    paid = ~F.col("work_type_id").isin(FREE_WORK_TYPES)
    return (
        service.where(F.col("visit_date") <= F.lit(as_of))
        .groupBy("vin", "visit_date")
        .agg(
            F.count("smr_id").alias("visits"),
            F.count_if(paid).alias("paid"),
            F.sum(F.when(paid, F.col("bill_amount"))).alias("billed"),
            F.max(F.when(F.col("status") == "Cancelled", 1).otherwise(0)).alias("cancelled"),
        )
    )


def policies_by_vehicle(insurance: DataFrame) -> DataFrame:
    order = F.struct("policy_issue_date", "ins_id")
    return insurance.groupBy("vin").agg(
        F.count("ins_id").alias("policies"),
        F.max("policy_expiry_date").alias("last_expiry"),
        F.max(F.when(F.col("auto_membership") == "Y", 1).otherwise(0)).alias("auto_membership_flag"),
        (F.max_by("total_premium", order) - F.min_by("total_premium", order)).alias("premium_trend"),
    )


def rfm(df: DataFrame) -> DataFrame:
    return (
        df.withColumn("recency_score", F.greatest(F.lit(1), F.lit(5) - floor_div(F.col("days_since_last_service"), 140)))
        .withColumn("frequency_score", clamp(F.col("total_service_visits"), 1, 5).cast("int"))
        .withColumn("monetary_score", clamp(floor_div(F.col("avg_bill_amount"), 3000), 1, 5))
        .withColumn("rfm_total", F.col("recency_score") + F.col("frequency_score") + F.col("monetary_score"))
    )


def vehicle_facts(
    sales: DataFrame, service: DataFrame, insurance: DataFrame, vehicle: DataFrame, as_of: dt.date
) -> DataFrame:
    """The three domains on one row per sale up to ``as_of``. Every input is reduced to its key before the join, so nothing fans out.

    A sale whose vehicle has no accepted visit counts its gap from the sale date.
    """
    day = F.lit(as_of)
    sold = sales.where(F.col("sale_date") <= day).select("sales_id", "cust_id", "vin", "sale_date", "mfd_year", "finance_flag", "pucc_validity")
    visits = daily_visits(service, as_of).withColumnRenamed("vin", "visit_vin")
    served = (
        sold.join(visits, (F.col("vin") == F.col("visit_vin")) & (F.col("visit_date") >= F.col("sale_date")), "left")
        .groupBy("vin", "sales_id", "cust_id", "sale_date", "mfd_year", "finance_flag", "pucc_validity")
        .agg(
            F.min("visit_date").alias("first_visit"),
            F.max("visit_date").alias("last_visit"),
            F.coalesce(F.sum("visits"), F.lit(0)).alias("total_service_visits"),
            F.coalesce(F.sum("paid"), F.lit(0)).alias("paid_visits"),
            F.sum("billed").alias("billed"),
            F.coalesce(F.max("cancelled"), F.lit(0)).alias("cancelled_visit_flag"),
        )
    )
    return (
        served.join(policies_by_vehicle(insurance), "vin", "left")
        .join(vehicle.select("vin", "vehicle_id"), "vin", "left")
        .withColumn("vehicle_age_years", F.year(day) - F.col("mfd_year"))
        .withColumn("days_to_first_service", F.datediff("first_visit", "sale_date"))
        .withColumn("days_since_last_service", F.datediff(day, F.coalesce("last_visit", "sale_date")))
        .withColumn("avg_bill_amount", F.coalesce(F.try_divide("billed", "paid_visits"), F.lit(0.0)))
        .withColumn("pct_paid_services", F.coalesce(F.try_divide("paid_visits", "total_service_visits"), F.lit(0.0)))
        .withColumn("num_policy_renewals", F.greatest(F.coalesce("policies", F.lit(0)) - 1, F.lit(0)))
        .withColumn("days_to_policy_expiry", F.datediff("last_expiry", day))
        .withColumn("policy_expired", F.when(F.col("last_expiry") < day, 1).otherwise(0))
        .withColumn("pucc_expired", F.when(F.col("pucc_validity") < day, 1).otherwise(0))
        .withColumn("auto_membership_flag", F.coalesce("auto_membership_flag", F.lit(0)))
        .withColumn("premium_trend", F.coalesce("premium_trend", F.lit(0.0)))
    )


def churn_features(
    sales: DataFrame, service: DataFrame, insurance: DataFrame, vehicle: DataFrame, as_of: dt.date
) -> DataFrame:
    scored = rfm(vehicle_facts(sales, service, insurance, vehicle, as_of))
    labelled = scored.withColumn(
        "churn_label", rules.churn_label(F.col("days_since_last_service"), F.col("days_to_policy_expiry"))
    ).withColumn("risk_tier", rules.feature_tier(F.col("churn_label"), F.col("rfm_total")))
    return labelled.select(*TABLES["churn_features"].fieldNames())
