"""Data-quality rules: one pass marks every row with the rules it breaks, filters split it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.functions.scalar import blank_to_null
from stayline.operators.rollups import median_by
from stayline.reference_data import FREE_WORK_TYPES
from stayline.session import stage

# Formats.
VIN_FORMAT = r"^[A-Za-z0-9]{17}$"
MOBILE_FORMAT = r"^[6-9][0-9]{9}$"


@dataclass(frozen=True)
class Rule:
    """``broken`` is true for a violating row; ``action`` is reject, warn or flag."""

    name: str
    broken: Column
    action: str = "reject"


def mark(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Add ``rejects`` and ``warnings``: the names of the rules a row breaks. A rule that is NULL is not broken."""

    def broken(wanted: bool) -> Column:
        names = [F.when(r.broken, F.lit(r.name)) for r in rules if (r.action == "reject") == wanted]
        return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")

    return df.withColumns({"rejects": broken(True), "warnings": broken(False)})


def accepted(marked: DataFrame) -> DataFrame:
    return marked.where(F.size("rejects") == 0).drop("rejects", "warnings")


def rejected(marked: DataFrame) -> DataFrame:
    return marked.where(F.size("rejects") > 0)


def warned(marked: DataFrame) -> DataFrame:
    return marked.where((F.size("rejects") == 0) & (F.size("warnings") > 0))


def rule_counts(marked: DataFrame, table: str) -> DataFrame:
    """Rows per broken rule, and the accepted and rejected totals, in one pass."""
    verdict = F.when(F.size("rejects") > 0, "rows rejected").otherwise("rows accepted")
    return (
        marked.select(F.explode(F.concat("rejects", "warnings", F.array(verdict))).alias("rule"))
        .groupBy("rule")
        .agg(F.count("*").alias("rows"))
        .select(F.lit(table).alias("table_name"), "rule", "rows")
    )


def with_copies(df: DataFrame, key: str) -> DataFrame:
    """Add ``copies``, the number of rows with the same key. Only keys that occur more than once are joined back.

    A row without a key is spread by its place; it would otherwise meet all others without one. (Not by its content,
    which would carry every column through the join, also those that nobody reads.)
    """
    repeated = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_repeated"))
        .agg(F.count("*").alias("copies"))
        .where("copies > 1")
    )
    place = F.when(F.col(key).isNull(), F.monotonically_increasing_id())
    return (
        df.withColumns({"_key": F.coalesce(F.col(key).cast("string"), F.lit("")), "_place": F.coalesce(place, F.lit(-1))})
        .join(repeated.withColumn("_at", F.lit(-1).cast("long")), (F.col("_key") == F.col("_repeated").cast("string")) & (F.col("_place") == F.col("_at")), "left")
        .withColumn("copies", F.coalesce("copies", F.lit(1)))
        .drop("_key", "_place", "_repeated", "_at")
    )


def with_dimension(df: DataFrame, column: str, dimension: DataFrame, dim_key: str) -> DataFrame:
    """Add ``known_<column>``: whether the id is in a (constant, few rows) dimension."""
    known = F.broadcast(dimension.select(F.col(dim_key).alias("_id"), F.lit(True).alias(f"known_{column}")))
    return df.join(known, F.col(column) == F.col("_id"), "left").drop("_id")


def _key_rules(key: str) -> list[Rule]:
    return [
        Rule(f"{key} missing", F.col(key).isNull()),
        Rule(f"{key} not unique", F.col("copies") > 1),
        Rule("vin malformed", ~F.coalesce(F.col("vin").rlike(VIN_FORMAT), F.lit(False))),
    ]


def check_sales(feed: DataFrame, banks: DataFrame) -> DataFrame:
    """Sales with text dates: ids, VIN, dates in order, bank known where financed."""
    sale, delivery = F.col("parsed_sale_date"), F.col("parsed_delivery_date")
    ready = with_dimension(with_copies(feed, "sales_id"), "bank_id", banks, "bank_id").withColumns(
        {
            "parsed_sale_date": F.try_to_date("sale_date", "dd-MM-yyyy"),
            "parsed_delivery_date": F.try_to_date("delivery_date", "dd-MM-yyyy"),
        }
    )
    return mark(
        ready,
        _key_rules("sales_id")
        + [
            Rule("sale_date invalid", sale.isNull()),
            Rule("sale_date after delivery", sale > delivery),
            Rule("bank_id unknown", (F.col("finance_flag") == "Y") & F.col("known_bank_id").isNull()),
        ],
    )


def check_service(feed: DataFrame, work_types: DataFrame) -> DataFrame:
    amount, free = F.col("bill_amount"), F.col("work_type_id").isin(FREE_WORK_TYPES)
    ready = with_dimension(with_copies(feed, "smr_id"), "work_type_id", work_types, "work_type_id")
    return mark(
        ready,
        _key_rules("smr_id")
        + [
            Rule("work_type_id unknown", F.col("known_work_type_id").isNull()),
            Rule("bill_amount negative", amount < 0),
            Rule("bill_amount missing on free service", amount.isNull() & free, "warn"),
            Rule("bill_amount missing", amount.isNull() & ~free, "warn"),
        ],
    )


def check_insurance(feed: DataFrame, policy_types: DataFrame) -> DataFrame:
    ready = with_dimension(with_copies(feed, "ins_id"), "policy_type_id", policy_types, "policy_type_id")
    ordered = F.col("policy_expiry_date") > F.col("policy_issue_date")
    return mark(
        ready,
        _key_rules("ins_id")
        + [
            Rule("policy_type_id unknown", F.col("known_policy_type_id").isNull()),
            Rule("policy_expiry not after issue", ~F.coalesce(ordered, F.lit(False))),
        ],
    )


def check_mobiles(vault: DataFrame) -> DataFrame:
    ok = F.coalesce(F.col("mobile_1").rlike(MOBILE_FORMAT), F.lit(False))
    return mark(vault, [Rule("mobile_1 malformed", ~ok, "flag")])


def impute_bills(service: DataFrame) -> DataFrame:
    """Missing bills: 0 for free services, the median of the work type otherwise.

    The rows are read by the medians and again here, so they are computed and written once. The medians table has one
    row per work type, a fixed vocabulary, so it is broadcast.
    """
    service = stage(service, "bills")
    medians = F.broadcast(median_by(service.select("work_type_id", "bill_amount"), ["work_type_id"], "bill_amount"))
    filled = (
        F.when(F.col("bill_amount").isNotNull(), F.col("bill_amount"))
        .when(F.col("work_type_id").isin(FREE_WORK_TYPES), F.lit(0.0))
        .otherwise(F.col("median_bill_amount"))
    )
    return (
        service.join(medians, "work_type_id", "left")
        .withColumn("imputed", F.when(F.col("bill_amount").isNull(), 1).otherwise(0))
        .withColumn("bill_amount", filled)
        .drop("median_bill_amount")
    )


def vocabulary_key(text: Column) -> Column:
    """Free text reduced to lower-case letters and digits."""
    return F.regexp_replace(F.lower(text), "[^a-z0-9]", "")


def standardise(df: DataFrame, text: str, dimension: DataFrame, dim_id: str, dim_name: str) -> DataFrame:
    """Add the dimension id for free text; NULL where no entry has the same letters and digits."""
    entries = F.broadcast(
        dimension.select(vocabulary_key(F.col(dim_name)).alias("_key"), F.col(dim_id).alias(f"std_{dim_id}"))
    )
    return (
        df.withColumn("_text", vocabulary_key(blank_to_null(F.col(text))))
        .join(entries, F.col("_text") == F.col("_key"), "left")
        .drop("_text", "_key")
    )
