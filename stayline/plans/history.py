"""Monthly relabelling and retraining: point-in-time snapshots, stored model versions, a drift gate.

Snapshots. Every sale has a row at each month end from its own month on (the month spine). Visits and policies are
summed per vehicle and month first, then carried forward by running sums over the vehicle's months, so one pass gives
the features as of every month end without a range join. A vehicle holding a large share of all visits still meets as
at most one row per month. Only what is known at a month end counts: visits up to it, policies issued up to it.

History. Labels are refreshed for each month. Version 1 is trained on the first month that has both classes; a
champion is loaded from its stored version and scores its own and all later months in one pass, and each month its AUC
on the test split is compared with the AUC it had when it became champion. If the AUC fell by more than the tolerance, a challenger is trained on that month
and replaces the champion only if it scores better there. Versions are MLlib models saved in the shared folder.
"""

from __future__ import annotations

import datetime as dt

from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stayline.plans import models, rules
from stayline.plans.features import daily_visits, rfm
from stayline.session import staged_path

#: Month ends of the history, the last being the month of ``as_of``.
MONTHS = 12

SNAPSHOT_COLUMNS = [
    "month_end", "cust_id", "vin", "vehicle_age_years", "finance_flag", "total_service_visits", "days_since_last_service",
    "avg_bill_amount", "pct_paid_services", "cancelled_visit_flag", "num_policy_renewals", "days_to_policy_expiry",
    "auto_membership_flag", "premium_trend", "recency_score", "frequency_score", "monetary_score", "churn_label",
]


def month_ends(as_of: dt.date, months: int = MONTHS) -> list[dt.date]:
    """The last days of the ``months`` months that end with the month of ``as_of``."""
    index = as_of.year * 12 + as_of.month - 1
    ends = []
    for i in range(index - months + 1, index + 1):
        y, m = divmod(i + 1, 12)
        ends.append(dt.date(y, m + 1, 1) - dt.timedelta(days=1))
    return ends


def _month_index(day: Column) -> Column:
    return F.year(day) * 12 + F.month(day) - 1


def _end_of(index: Column) -> Column:
    return F.last_day(F.make_date((index / 12).cast("int"), (index % 12 + 1).cast("int"), F.lit(1)))


def monthly_snapshots(sales: DataFrame, service: DataFrame, insurance: DataFrame, as_of: dt.date, months: int = MONTHS) -> DataFrame:
    """One row per sale and month end from the sale's month on: the model's inputs and the label as of that day."""
    ends = month_ends(as_of, months)
    first, last = _month_index(F.lit(ends[0])), _month_index(F.lit(ends[-1]))
    sold = sales.where(F.col("sale_date") <= F.lit(ends[-1])).select("vin", "cust_id", "sale_date", "mfd_year", "finance_flag")
    # known facts summed per vehicle and month; what lies before the first month end counts at the first
    visits = (
        daily_visits(service, ends[-1])
        .join(sold.select("vin", "sale_date"), "vin")
        .where(F.col("visit_date") >= F.col("sale_date"))
        .groupBy("vin", F.greatest(_month_index(F.col("visit_date")), first).alias("m"))
        .agg(
            F.sum("visits").alias("v"), F.sum("paid").alias("p"), F.sum("billed").alias("b"),
            F.max("cancelled").alias("c"), F.max("visit_date").alias("lv"),
        )
    )
    order = F.struct("policy_issue_date", "ins_id")
    policies = (
        insurance.where(F.col("policy_issue_date") <= F.lit(ends[-1]))
        .groupBy("vin", F.greatest(_month_index(F.col("policy_issue_date")), first).alias("m"))
        .agg(
            F.count("ins_id").alias("n"), F.max("policy_expiry_date").alias("e"),
            F.max(F.when(F.col("auto_membership") == "Y", 1).otherwise(0)).alias("a"),
            F.max_by("total_premium", order).alias("late"), F.min_by("total_premium", order).alias("early"),
        )
    )
    spine = sold.withColumn("m", F.explode(F.sequence(F.greatest(_month_index(F.col("sale_date")), first), last)))
    joined = spine.join(visits, ["vin", "m"], "left").join(policies, ["vin", "m"], "left")
    upto = Window.partitionBy("vin").orderBy("m").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # at most `months` rows a vehicle
    day = F.col("month_end")
    carried = joined.select(
        "vin", "cust_id", "sale_date", "mfd_year", "finance_flag", _end_of(F.col("m")).alias("month_end"),
        F.sum("v").over(upto).alias("visits"), F.sum("p").over(upto).alias("paid"), F.sum("b").over(upto).alias("billed"),
        F.max("c").over(upto).alias("cancelled"), F.max("lv").over(upto).alias("last_visit"),
        F.sum("n").over(upto).alias("policies"), F.max("e").over(upto).alias("last_expiry"), F.max("a").over(upto).alias("auto"),
        F.last("late", ignorenulls=True).over(upto).alias("late"), F.first("early", ignorenulls=True).over(upto).alias("early"),
    )
    facts = carried.select(
        "month_end", "cust_id", "vin", "finance_flag",
        (F.year(day) - F.col("mfd_year")).alias("vehicle_age_years"),
        F.coalesce("visits", F.lit(0)).alias("total_service_visits"),
        F.datediff(day, F.coalesce("last_visit", "sale_date")).alias("days_since_last_service"),
        F.coalesce(F.try_divide("billed", "paid"), F.lit(0.0)).alias("avg_bill_amount"),
        F.coalesce(F.try_divide("paid", "visits"), F.lit(0.0)).alias("pct_paid_services"),
        F.coalesce("cancelled", F.lit(0)).alias("cancelled_visit_flag"),
        F.greatest(F.coalesce("policies", F.lit(0)) - 1, F.lit(0)).alias("num_policy_renewals"),
        F.datediff("last_expiry", day).alias("days_to_policy_expiry"),
        F.coalesce("auto", F.lit(0)).alias("auto_membership_flag"),
        F.coalesce(F.col("late") - F.col("early"), F.lit(0.0)).alias("premium_trend"),
    )
    labelled = rfm(facts).withColumn("churn_label", rules.churn_label(F.col("days_since_last_service"), F.col("days_to_policy_expiry")))
    return labelled.select(*SNAPSHOT_COLUMNS)


def _test_aucs(scored: DataFrame) -> dict[dt.date, float | None]:
    """AUC of the test split per month end (counts per score value, see ``models.auc_by_period``); a row a month."""
    return {r["month_end"]: r["auc"] for r in models.auc_by_period(scored.where("NOT is_train"), "month_end").collect()}


def model_history(snapshots: DataFrame, tolerance: float = models.AUC_TOLERANCE) -> DataFrame:
    """One row per month end: label rate, champion version and its test AUC, the gate, a challenger's AUC and whether it won.

    ``snapshots`` should be staged (it is read for each version and challenger, not for each month). Months before the
    first with both classes have no model.
    """
    spark = snapshots.sparkSession
    ends = [r["month_end"] for r in snapshots.select("month_end").distinct().orderBy("month_end").collect()]  # one row a month
    rates = {r["month_end"]: r for r in snapshots.groupBy("month_end").agg(F.count("*").alias("rows"), F.sum("churn_label").alias("churned")).collect()}
    stored: dict[int, str] = {}
    champion, version, baseline = None, 0, None
    aucs: dict[dt.date, float | None] = {}  # of the champion, from its first month on
    out = []
    for end in ends:
        month = snapshots.where(F.col("month_end") == F.lit(end))
        rows, churned = int(rates[end]["rows"]), int(rates[end]["churned"] or 0)
        record = {"month_end": end, "rows": rows, "churned": churned, "label_rate": round(churned / rows, 6) if rows else None,
                  "version": None, "auc": None, "baseline_auc": None, "retrain": 0, "challenger_auc": None, "promoted": 0}
        if champion is None:
            if 0 < churned < rows:
                champion, version = models.fit(month), 1
                stored[version] = _save(spark, champion, version)
                aucs = _test_aucs(models.score(_load(champion, stored[version]), snapshots.where(F.col("month_end") >= F.lit(end))))
                baseline = aucs.get(end)
                record["promoted"] = 1
            else:
                out.append(record)
                continue
        auc = aucs.get(end)
        record.update(version=version, auc=auc, baseline_auc=baseline)
        if auc is not None and baseline is not None and auc < baseline * (1.0 - tolerance):
            record["retrain"] = 1
            challenger = models.fit(month)
            rival = _test_aucs(models.score(challenger, month)).get(end)
            record["challenger_auc"] = rival
            if rival is not None and rival > auc:
                champion, version, baseline = challenger, version + 1, rival
                stored[version] = _save(spark, challenger, version)
                aucs = _test_aucs(models.score(_load(champion, stored[version]), snapshots.where(F.col("month_end") > F.lit(end))))
                record["promoted"] = 1
        out.append(record)
    schema = (
        "month_end date, rows long, churned long, label_rate double, version int, auc double, baseline_auc double, "
        "retrain int, challenger_auc double, promoted int"
    )
    return spark.createDataFrame(out, schema)


def _save(spark, fitted: models.Fitted, version: int) -> str:
    path = staged_path(spark, f"churn-model-v{version}")
    fitted.model.write().save(path)
    return path


def _load(fitted: models.Fitted, path: str) -> models.Fitted:
    """The stored version, as scoring reads it."""
    return models.Fitted(LogisticRegressionModel.load(path), fitted.inputs, fitted.means)
