"""Ordered per-key operators: ordinals, previous values and running sums along a key's dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def day_chain(
    df: DataFrame, key: str, day: str, tie: str, previous: tuple[str, ...] = (), running: tuple[str, ...] = ()
) -> DataFrame:
    """Add ``ordinal``, ``prev_<column>`` and ``running_<column>`` along each key, ordered by ``day`` and ``tie``.

    The window is split in two levels. Rows are first summed per key and day, and only those day rows, as many
    as the calendar has days, are windowed over the key. The rows themselves are windowed within their day.
    A key that holds a large share of the table is therefore spread over its days. Rows without a key or a day
    have no place in a chain; they are kept, with NULL in the added columns.
    """
    placed = F.col(key).isNotNull() & F.col(day).isNotNull()
    unplaced, df = df.where(~placed), df.where(placed)
    last = [F.max_by(c, tie).alias(f"_last_{c}") for c in previous]
    sums = [F.sum(c).alias(f"_sum_{c}") for c in running]
    by_day = df.groupBy(key, day).agg(F.count("*").alias("_n"), *last, *sums)

    across = Window.partitionBy(key).orderBy(day)
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    days = by_day.select(
        key,
        day,
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rows_before"),
        *[F.lag(f"_last_{c}").over(across).alias(f"_prev_{c}") for c in previous],
        *[F.coalesce(F.sum(f"_sum_{c}").over(earlier), F.lit(0)).alias(f"_before_{c}") for c in running],
    )

    within = Window.partitionBy(key, day).orderBy(tie)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    in_day = df.join(days, [key, day]).withColumn("_no", F.row_number().over(within))
    chained = in_day.select(
        *df.columns,
        (F.col("_rows_before") + F.col("_no")).alias("ordinal"),
        *[
            F.when(F.col("_no") == 1, F.col(f"_prev_{c}")).otherwise(F.lag(c).over(within)).alias(f"prev_{c}")
            for c in previous
        ],
        *[(F.col(f"_before_{c}") + F.sum(c).over(upto)).alias(f"running_{c}") for c in running],
    )
    return chained.unionByName(unplaced, allowMissingColumns=True)


def policy_chain(insurance: DataFrame) -> DataFrame:
    """Every policy with its place in the vehicle's chain.

    A renewal's previous period is stated as the 365 days up to its own start (the published rule), beside the
    true gap to the policy before it. Third-party cover runs three years on the first policy and one after.
    """
    chained = day_chain(insurance, "vin", "policy_issue_date", "ins_id", previous=("policy_expiry_date",))
    first = F.col("ordinal") == 1
    issue = F.col("policy_issue_date")
    return chained.select(
        "ins_id",
        "vin",
        "ordinal",
        "policy_issue_date",
        F.date_add("policy_expiry_date", 1).alias("next_start"),
        F.when(~first, F.date_sub(issue, 365)).alias("previous_start"),
        F.when(~first, issue).alias("previous_end"),
        F.when(first, F.date_add(issue, 365 * 3)).otherwise(F.date_add(issue, 365)).alias("third_party_expiry"),
        F.datediff(issue, "prev_policy_expiry_date").alias("days_after_previous"),
    )


def _capped(values: list[str], ordinal: Column) -> Column:
    """The value at a 1-based place, the last one for every place beyond."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.least(ordinal, F.lit(len(values))).cast("int"))


def visit_chain(service: DataFrame, work_types: list[str], milestones: list[str]) -> DataFrame:
    """Every visit with its ordinal, running bill, odometer check and the work type and milestone of its place."""
    chained = day_chain(
        service, "vin", "visit_date", "smr_id", previous=("visit_date", "mileage"), running=("bill_amount",)
    )
    return chained.select(
        "smr_id",
        "vin",
        "ordinal",
        F.col("running_bill_amount").alias("running_bill"),
        F.datediff("visit_date", "prev_visit_date").alias("days_since_previous"),
        F.when(F.col("mileage") < F.col("prev_mileage"), 1).otherwise(0).alias("odometer_back"),
        _capped(work_types, F.col("ordinal")).alias("scheduled_work_type"),
        _capped(milestones, F.col("ordinal")).alias("scheduled_milestone"),
    )


def plotted_points(points: DataFrame, session: str, order: list[str], keep: int = 6) -> DataFrame:
    """The last ``keep`` points of every session after its last clear.

    ``points`` has ``is_clear`` and ``label``; a point without a label is called P1, P2, ... since the clear,
    and a repeated label, given or counted, replaces its earlier point. A point's number follows from the count of unlabelled
    points and its place from the end, so only the last few per session and label are ever kept: the limits
    are applied before the shuffle.
    """
    at = F.struct(*order)
    cleared = points.where("is_clear").groupBy(session).agg(F.max(at).alias("_clear"))
    live = (
        points.where("NOT is_clear")
        .withColumn("_at", at)
        .join(cleared, session, "left")
        .where(F.col("_clear").isNull() | (F.col("_at") > F.col("_clear")))
        .drop("_clear", "is_clear")
    )
    columns = [c for c in live.columns if c not in (session, "label", "_at")]
    newest = Window.partitionBy(session).orderBy(F.desc("_at"))
    unlabelled = live.where(F.col("label").isNull())
    counted = unlabelled.groupBy(session).agg(F.count("*").alias("_total"))
    numbered = (
        unlabelled.withColumn("_back", F.row_number().over(newest))
        .where(F.col("_back") <= keep)
        .join(counted, session)
        .withColumn("label", F.concat(F.lit("P"), (F.col("_total") - F.col("_back") + 1).cast("string")))
        .select(session, "label", "_at", *columns)
    )
    labelled = (
        live.where(F.col("label").isNotNull())
        .groupBy(session, "label")
        .agg(F.max_by(F.struct("_at", *columns), "_at").alias("_p"))
        .select(session, "label", "_p.*")
    )
    return (
        numbered.unionByName(labelled)
        .withColumn("_again", F.row_number().over(Window.partitionBy(session, "label").orderBy(F.desc("_at"))))
        .where("_again = 1")
        .drop("_again")
        .withColumn("_place", F.row_number().over(newest))
        .where(F.col("_place") <= keep)
        .drop("_at", "_place")
    )
