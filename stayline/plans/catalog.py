"""The twelve catalogued retention queries, as DataFrame plans over a table lookup ``t[name]``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.functions.labels import tier_rank
from stayline.functions.scalar import percent
from stayline.operators.rollups import revenue_at_risk, tier_counts
from stayline.reference_data import REVENUE_PER_CUSTOMER, WIN_BACK_STRATEGY

Tables = Mapping[str, DataFrame]


def _probability() -> Column:
    return F.round(F.col("churn_probability").try_cast("double"), 4).alias("churn_probability")


def scored(t: Tables, how: str = "inner") -> DataFrame:
    """Scores and the features of the deciding vehicle, one row per customer.

    A set of tables that derives both from the same rows hands them over as ``scored``; stored tables are joined.
    """
    if "scored" in t:
        return t["scored"]
    features = t["churn_features"].withColumnRenamed("risk_tier", "feature_tier")
    return t["churn_scores"].join(features, ["cust_id", "vehicle_id"], how)


def scored_customers(t: Tables) -> DataFrame:
    return scored(t).join(t["customer"].select("cust_id", "name_masked", "mobile_masked", "city"), "cust_id")


def _by_probability(df: DataFrame) -> DataFrame:
    return df.orderBy(F.desc("churn_probability"), "cust_id")


def ranked(t: Tables) -> DataFrame:
    df = scored_customers(t).select(
        tier_rank(F.col("risk_tier")).cast("string").alias("sort_order"),
        "cust_id",
        "name_masked",
        "city",
        "risk_tier",
        _probability(),
        "days_since_last_service",
        "days_to_policy_expiry",
        "churn_label",
        F.col("top_driver_1").alias("top_risk_driver"),
        "recommended_action",
    )
    return df.orderBy("sort_order", F.desc("churn_probability"), "cust_id")


def high_risk(t: Tables) -> DataFrame:
    return _by_probability(
        scored_customers(t)
        .where(F.col("risk_tier") == "High")
        .select(
            "cust_id",
            "name_masked",
            "mobile_masked",
            "city",
            _probability(),
            "days_since_last_service",
            F.col("days_to_policy_expiry").alias("days_expired_by"),
            "total_service_visits",
            "avg_bill_amount",
            "top_driver_1",
            "top_driver_2",
            "top_driver_3",
            "recommended_action",
        )
    )


def medium_risk(t: Tables) -> DataFrame:
    return _by_probability(
        scored_customers(t)
        .where(F.col("risk_tier") == "Medium")
        .select(
            "cust_id",
            "name_masked",
            "city",
            _probability(),
            "days_since_last_service",
            "days_to_policy_expiry",
            F.col("rfm_total").alias("engagement_score"),
            "num_policy_renewals",
            "top_driver_1",
            "recommended_action",
        )
    )


def low_risk(t: Tables) -> DataFrame:
    return (
        scored_customers(t)
        .where(F.col("risk_tier") == "Low")
        .select(
            "cust_id",
            "name_masked",
            "city",
            _probability(),
            "total_service_visits",
            "days_since_last_service",
            "days_to_policy_expiry",
            F.col("rfm_total").alias("engagement_score"),
            "avg_bill_amount",
            "recommended_action",
        )
        .orderBy(F.desc("engagement_score"), "cust_id")
    )


def tier_summary(t: Tables) -> DataFrame:
    """Revenue is counted for every tier here. The window runs over the three aggregated rows."""
    everyone = Window.partitionBy(F.lit(0))
    return (
        scored(t)
        .groupBy("risk_tier")
        .agg(
            F.count("*").alias("customer_count"),
            F.round(F.avg("churn_probability"), 4).alias("avg_churn_probability"),
            F.round(F.avg("days_since_last_service")).alias("avg_days_since_service"),
            F.round(F.avg("rfm_total"), 1).alias("avg_rfm_score"),
        )
        .select(
            "risk_tier",
            "customer_count",
            percent(F.col("customer_count"), F.sum("customer_count").over(everyone)).alias("pct_of_total"),
            (F.col("customer_count") * REVENUE_PER_CUSTOMER).alias("revenue_at_risk_inr"),
            "avg_churn_probability",
            "avg_days_since_service",
            "avg_rfm_score",
        )
        .orderBy(tier_rank(F.col("risk_tier")))
    )


def top_drivers(t: Tables, k: int = 10) -> DataFrame:
    """The three driver columns are unpivoted in one scan. The customer total rides along as a scalar subquery."""
    scores = t["churn_scores"]
    total = scores.agg(F.count("*").alias("n")).scalar()
    return (
        scores.select(F.explode(F.array("top_driver_1", "top_driver_2", "top_driver_3")).alias("driver"))
        .where(F.col("driver").isNotNull())
        .groupBy("driver")
        .agg(F.count("*").alias("times_cited_as_top_driver"))
        .withColumn("pct_of_customers", percent(F.col("times_cited_as_top_driver"), total))
        .orderBy(F.desc("times_cited_as_top_driver"), "driver")
        .limit(k)
    )


def lapsed(t: Tables) -> DataFrame:
    return (
        scored_customers(t)
        .where((F.col("days_since_last_service") > 365) & (F.col("days_to_policy_expiry") < 0))
        .select(
            "cust_id",
            "name_masked",
            "city",
            "days_since_last_service",
            "days_to_policy_expiry",
            "total_service_visits",
            _probability(),
            "recommended_action",
        )
        .orderBy(F.desc("days_since_last_service"), "cust_id")
    )


def never_renewed(t: Tables) -> DataFrame:
    return _by_probability(
        scored_customers(t)
        .where(F.col("num_policy_renewals") == 0)
        .select(
            "cust_id",
            "name_masked",
            "city",
            "num_policy_renewals",
            "days_to_policy_expiry",
            "days_since_last_service",
            "risk_tier",
            _probability(),
        )
    )


def by_city(t: Tables) -> DataFrame:
    return (
        t["churn_scores"]
        .select("cust_id", "risk_tier")
        .join(t["customer"].select("cust_id", "city"), "cust_id")
        .groupBy("city")
        .agg(
            F.count("*").alias("total_customers"),
            *tier_counts(),
            percent(F.count_if(F.col("risk_tier") == "High"), F.count("*")).alias("pct_high_risk"),
            revenue_at_risk(("High", "Medium")).alias("revenue_at_risk_inr"),
        )
        .orderBy(F.desc("high_risk"), F.desc("medium_risk"), "city")
    )


def by_model(t: Tables) -> DataFrame:
    """Joined to sales as they are: a customer with several sales counts once as customer, per sale in the tiers."""
    return (
        scored(t)
        .select("cust_id", "risk_tier", "churn_probability", "days_since_last_service")
        .join(t["sales"].select("cust_id", "vin"), "cust_id")
        .join(t["vehicle"].select("vin", "model"), "vin")
        .groupBy("model")
        .agg(
            F.countDistinct("cust_id").alias("customers"),
            *tier_counts(),
            F.round(F.avg("churn_probability"), 4).alias("avg_churn_prob"),
            F.round(F.avg("days_since_last_service")).alias("avg_days_since_service"),
        )
        .orderBy(F.desc("high_risk"), F.desc("avg_churn_prob"), "model")
    )


def cancellations(t: Tables) -> DataFrame:
    """Visits are counted per token first, so the joins see one row per customer."""
    visits = (
        t["service"]
        .groupBy("cust_id")
        .agg(F.count("*").alias("total_visits"), F.count_if(F.col("status") == "Cancelled").alias("cancelled"))
        .where(F.col("cancelled") > 0)
    )
    return (
        visits.join(t["customer"].select("cust_id", "name_masked", "city"), "cust_id")
        .join(t["churn_scores"].select("cust_id", "risk_tier", "churn_probability"), "cust_id")
        .select(
            "cust_id",
            "name_masked",
            "city",
            "total_visits",
            "cancelled",
            percent(F.col("cancelled"), F.col("total_visits")).alias("cancel_rate_pct"),
            "risk_tier",
            _probability(),
        )
        .orderBy(F.desc("cancel_rate_pct"), F.desc("churn_probability"), "cust_id")
    )


def recoverable(t: Tables) -> DataFrame:
    return (
        scored_customers(t)
        .where((F.col("days_since_last_service") > 180) & (F.col("days_to_policy_expiry") >= 0))
        .select(
            "cust_id",
            "name_masked",
            "city",
            "days_since_last_service",
            "days_to_policy_expiry",
            "num_policy_renewals",
            "auto_membership_flag",
            "risk_tier",
            _probability(),
            F.lit(WIN_BACK_STRATEGY).alias("strategy"),
        )
        .orderBy(F.desc("days_since_last_service"), "cust_id")
    )


CATALOG: dict[str, Callable[[Tables], DataFrame]] = {
    "Q1": ranked,
    "Q2": high_risk,
    "Q3": medium_risk,
    "Q4": low_risk,
    "Q5": tier_summary,
    "Q6": top_drivers,
    "Q7": lapsed,
    "Q8": never_renewed,
    "Q9": by_city,
    "Q10": by_model,
    "Q11": cancellations,
    "Q12": recoverable,
}


def run(query_id: str, t: Tables) -> DataFrame:
    """One catalogued query by id. An unknown id is an error, not a request for everything."""
    key = query_id.strip().upper()
    if key not in CATALOG:
        raise KeyError(f"unknown query {query_id!r}; known: {', '.join(CATALOG)}")
    return CATALOG[key](t)


def run_all(t: Tables) -> dict[str, DataFrame]:
    return {key: plan(t) for key, plan in CATALOG.items()}
