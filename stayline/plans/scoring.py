"""Scores: the documented points score, and MLlib models with additive attributions and segments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.labels import recommended_action
from stayline.functions.scalar import round_half_up
from stayline.plans import rules
from stayline.schemas import TABLES


def driver_points() -> dict[str, Column]:
    """Points per driver; the weights add to 1. A points table, not a trained model."""
    col = F.col
    return {
        "days_since_last_service": 0.25 * F.least(col("days_since_last_service") / 730.0, F.lit(1.0)),
        "days_to_policy_expiry": F.when(col("days_to_policy_expiry") < 0, 0.20).otherwise(0.0),
        "rfm_total": 0.15 * (1.0 - (col("rfm_total") - 3) / 12.0),
        "num_policy_renewals": F.when(col("num_policy_renewals") == 0, 0.10).otherwise(0.0),
        "auto_membership_flag": F.when(col("auto_membership_flag") == 0, 0.08).otherwise(0.0),
        "cancelled_visit_flag": 0.07 * col("cancelled_visit_flag"),
        "pct_paid_services": 0.05 * (1.0 - col("pct_paid_services")),
        "avg_bill_amount": 0.05 * (1.0 - F.least(col("avg_bill_amount") / 15000.0, F.lit(1.0))),
        "vehicle_age_years": 0.05 * F.least(col("vehicle_age_years") / 10.0, F.lit(1.0)),
    }


def top_names(weights: dict[str, Column], n: int = 3) -> Column:
    """Names of the ``n`` largest weights, ties by name."""
    ranked = F.sort_array(F.array(*[F.struct((0.0 - w).alias("w"), F.lit(name).alias("name")) for name, w in weights.items()]))
    return F.transform(F.slice(ranked, 1, n), lambda s: s["name"])


def with_points_score(features: DataFrame, as_of: dt.date) -> DataFrame:
    """Feature rows with the score columns added; the tier of the features is kept as ``feature_tier``."""
    points = driver_points()
    total = sum(points.values(), F.lit(0.0))
    probability = F.col("churn_probability")
    return (
        features.withColumnRenamed("risk_tier", "feature_tier")
        .withColumns({"churn_probability": round_half_up(total, 4), "_drivers": top_names(points)})
        .withColumns(
            {
                "risk_tier": rules.score_tier(probability),
                **{f"top_driver_{i + 1}": F.col("_drivers")[i] for i in range(3)},
                "recommended_action": recommended_action(rules.score_tier(probability)),
                "score_date": F.lit(as_of),
            }
        )
        .drop("_drivers")
    )


def customer_scores(features: DataFrame, as_of: dt.date) -> DataFrame:
    """One row per customer: the row of the vehicle with the highest probability, of equal ones the largest vehicle id.

    A grouped maximum of whole rows, so a customer with very many vehicles is reduced before the shuffle.
    """
    rows = with_points_score(features, as_of)
    others = [c for c in rows.columns if c != "cust_id"]
    order = F.struct("churn_probability", F.coalesce("vehicle_id", F.lit("")))
    return rows.groupBy("cust_id").agg(F.max_by(F.struct(*others), order).alias("worst")).select("cust_id", "worst.*")


def points_score(features: DataFrame, as_of: dt.date) -> DataFrame:
    return customer_scores(features, as_of).select(*TABLES["churn_scores"].fieldNames())
