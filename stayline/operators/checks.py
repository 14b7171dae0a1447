"""Validation report: one row per check with the number of violations."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stayline.reference_data import DIMENSIONS, DRIVERS, FREE_WORK_TYPES, TIERS
from stayline.schemas import TABLES

Tables = Mapping[str, DataFrame]

# Foreign keys (table, column, target, target column), least row counts, label band.
FOREIGN_KEYS = [
    ("sales", "bank_id", "dim_bank", "bank_id"),
    ("sales", "dealer_id", "dim_dealer", "dealer_id"),
    ("sales", "loc_id", "dim_location", "location_id"),
    ("service", "work_type_id", "dim_work_type", "work_type_id"),
    ("service", "pay_mode_id", "dim_pay_mode", "pay_mode_id"),
    ("service", "cancel_reason_id", "dim_cancel_reason", "cancel_reason_id"),
    ("insurance", "policy_type_id", "dim_policy_type", "policy_type_id"),
    ("customer", "occ_id", "dim_occupation", "occ_id"),
    ("vehicle", "fuel_type_id", "dim_fuel_type", "fuel_type_id"),
    ("sales", "cust_id", "customer", "cust_id"),
    ("sales", "vin", "vehicle", "vin"),
    ("customer_vehicle", "vehicle_id", "vehicle", "vehicle_id"),
]
LEAST_ROWS = {
    "sales": 25,
    "service": 30,
    "insurance": 25,
    "customer": 25,
    "vehicle": 25,
    "pii_vault": 25,
    "customer_vehicle": 25,
    "churn_features": 25,
    "churn_scores": 25,
    "dim_bank": 5,
}
LABEL_BAND = (0.05, 0.70)
STRICT_LABEL_BAND = (0.20, 0.60)
MASKED_EMAIL = r"^.\*+@.\*+\..+"


def violations(df: DataFrame, table: str, asserted: dict[str, Column]) -> DataFrame:
    """Rows that break each assertion, all counted in one pass. NULL breaks an assertion."""
    names = list(asserted)
    counts = df.agg(*[F.count_if(~F.coalesce(asserted[n], F.lit(False))).alias(f"v{i}") for i, n in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"v{i}").alias("violations")) for i, n in enumerate(names)])
    return counts.select(F.lit(table).alias("table_name"), F.inline(rows))


def stack(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def _mandatory(columns: list[str]) -> dict[str, Column]:
    return {f"{c} present": F.col(c).isNotNull() for c in columns}


def range_assertions() -> dict[str, dict[str, Column]]:
    """Mandatory fields, formats, ranges and domains of facts, masters, features and scores, by table."""
    col = F.col
    flag = lambda c: col(c).isin(0, 1)
    score = lambda c: col(c).between(1, 5)
    return {
        "sales": {
            **_mandatory(["sales_id", "vin", "cust_id"]),
            "vin has 17 characters": F.length("vin") == 17,
            "vin starts with MA3": col("vin").startswith("MA3"),
            "registered in or after the year of manufacture": F.year("registration_date") >= col("mfd_year"),
            "delivered on or after the sale": col("delivery_date") >= col("sale_date"),
        },
        "service": {
            **_mandatory(["smr_id", "vin", "cust_id"]),
            "bill_amount not negative": col("bill_amount") >= 0,
        },
        "insurance": {
            **_mandatory(["ins_id", "vin", "cust_id"]),
            "expiry after issue": col("policy_expiry_date") > col("policy_issue_date"),
        },
        "churn_features": {
            "vehicle_age_years not negative": col("vehicle_age_years") >= 0,
            "days_since_last_service not negative": col("days_since_last_service") >= 0,
            "total_service_visits at least 1": col("total_service_visits") >= 1,
            "avg_bill_amount not negative": col("avg_bill_amount") >= 0,
            "pct_paid_services in [0, 1]": col("pct_paid_services").between(0, 1),
            "cancelled_visit_flag is 0 or 1": flag("cancelled_visit_flag"),
            "num_policy_renewals not negative": col("num_policy_renewals") >= 0,
            "days_to_policy_expiry present": col("days_to_policy_expiry").isNotNull(),
            "auto_membership_flag is 0 or 1": flag("auto_membership_flag"),
            "recency_score in [1, 5]": score("recency_score"),
            "frequency_score in [1, 5]": score("frequency_score"),
            "monetary_score in [1, 5]": score("monetary_score"),
            "rfm_total is the sum": col("rfm_total")
            == col("recency_score") + col("frequency_score") + col("monetary_score"),
            "rfm_total in [3, 15]": col("rfm_total").between(3, 15),
            "churn_label is 0 or 1": flag("churn_label"),
            "label 1 is tier High": (col("churn_label") != 1) | (col("risk_tier") == "High"),
            "risk_tier known": col("risk_tier").isin(TIERS),
        },
        "churn_scores": {
            "churn_probability in [0, 1]": col("churn_probability").between(0, 1),
            "probability above 0.65 is High": (col("churn_probability") <= 0.65) | (col("risk_tier") == "High"),
            "High has an action": (col("risk_tier") != "High")
            | F.coalesce(col("recommended_action") != "", F.lit(False)),
            "drivers are features": col("top_driver_1").isin(DRIVERS)
            & col("top_driver_2").isin(DRIVERS)
            & col("top_driver_3").isin(DRIVERS),
            "score_date present": col("score_date").isNotNull(),
        },
        "customer": {
            "name_masked has *": col("name_masked").contains("*"),
            "mobile_masked has X": col("mobile_masked").contains("X"),
            "email_masked has the masked form": col("email_masked").rlike(MASKED_EMAIL),
            "birth_year is a year": col("birth_year").rlike(r"^[0-9]{4}$"),
        },
    }


def range_rules(t: Tables) -> DataFrame:
    return stack([violations(t[name], name, asserted) for name, asserted in range_assertions().items()])


def edge_assertions() -> dict[str, dict[str, Column]]:
    col = F.col
    return {
        "sales": {"unfinanced has no bank": (col("finance_flag") != "N") | col("bank_id").isNull()},
        "service": {
            "free service costs 0": ~col("work_type_id").isin(FREE_WORK_TYPES) | (col("bill_amount") == 0),
            "cancelled has a reason": (col("status") != "Cancelled") | col("cancel_reason_id").isNotNull(),
            "completed has no reason": (col("status") != "Completed") | col("cancel_reason_id").isNull(),
        },
        "customer_vehicle": {"co-owner is not primary": (col("relationship_type") != "Co-Owner") | (col("is_primary_owner") == "N")},
    }


def edge_rules(t: Tables) -> DataFrame:
    return stack([violations(t[name], name, asserted) for name, asserted in edge_assertions().items()])


def orphan_keys(fact: DataFrame, column: str, target: DataFrame, target_column: str) -> DataFrame:
    """Distinct non-blank keys of a fact that the target does not have.

    Both sides meet in one aggregate per key (one shuffle), so no side is broadcast, whatever its number of keys.
    """
    keys = fact.select(F.col(column).alias("key"), F.lit(0).alias("_known")).where(F.trim("key") != "")
    known = target.select(F.col(target_column).alias("key"), F.lit(1).alias("_known")).where(F.col("key").isNotNull())
    held = keys.unionByName(known).groupBy("key").agg(F.max("_known").alias("_known"), F.min("_known").alias("_asked"))
    return held.where("_known = 0 AND _asked = 0").select("key")


def foreign_keys(t: Tables) -> DataFrame:
    parts = [
        orphan_keys(t[table], column, t[target], target_column).agg(F.count("*").alias("violations")).select(
            F.lit(table).alias("table_name"), F.lit(f"{column} in {target}").alias("check_name"), "violations"
        )
        for table, column, target, target_column in FOREIGN_KEYS
    ]
    return stack(parts)


def row_minimums(t: Tables, least: dict[str, int] | None = None) -> DataFrame:
    """Row counts against minimums; rows that are entirely null do not count."""
    parts = []
    for name, minimum in (least or LEAST_ROWS).items():
        counted = t[name].dropna(how="all").agg(F.count("*").alias("rows"))
        parts.append(
            counted.select(
                F.lit(name).alias("table_name"),
                "rows",
                F.lit(minimum).alias("least"),
                F.when(F.col("rows") >= minimum, 1).otherwise(0).alias("enough"),
            )
        )
    return stack(parts)


def label_rate(features: DataFrame, band: tuple[float, float] = LABEL_BAND) -> DataFrame:
    rate = F.coalesce(F.avg("churn_label"), F.lit(0.0))
    return features.agg(
        F.count_if(F.col("churn_label") == 0).alias("label_0"),
        F.count_if(F.col("churn_label") == 1).alias("label_1"),
        F.round(rate, 6).alias("churn_rate"),
        F.when(rate.between(*band), 1).otherwise(0).alias("in_band"),
    )


def key_sets(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys on one side only, both directions, and the row counts: equal sets have 0 and 0.

    Both sides meet in one aggregate per key (one shuffle). A null key matches nothing, so it counts on each side
    that has it.
    """
    sides = left.select(key, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(right.select(key, F.lit(0).alias("_a"), F.lit(1).alias("_b")))
    per_key = sides.groupBy(key).agg(F.sum("_a").alias("a"), F.sum("_b").alias("b"))
    unmatched = F.col(key).isNull()
    return per_key.agg(
        F.count_if((F.col("a") > 0) & ((F.col("b") == 0) | unmatched)).alias("left_only"),
        F.count_if((F.col("b") > 0) & ((F.col("a") == 0) | unmatched)).alias("right_only"),
        F.coalesce(F.sum("a"), F.lit(0)).alias("left_rows"),
        F.coalesce(F.sum("b"), F.lit(0)).alias("right_rows"),
    )


def subset_violations(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many distinct keys of ``left`` are not in ``right``; 0 means a subset."""
    return orphan_keys(left, key, right, key).agg(F.count("*").alias("violations"))


def missing_columns(df: DataFrame, expected: list[str], forbidden: tuple[str, ...] = ("cust_name",)) -> dict[str, list[str]]:
    return {
        "missing": [c for c in expected if c not in df.columns],
        "forbidden": [c for c in forbidden if c in df.columns],
    }


def missing_tables(tables: Tables, expected: list[str]) -> list[str]:
    return [name for name in expected if name not in tables]


#: Tables the report expects, forbidden columns, and the key sets that must be equal (left, right, key, equal row counts too).
EXPECTED_TABLES = [*DIMENSIONS, "sales", "service", "insurance", "customer", "vehicle", "customer_vehicle", "pii_vault",
                   "churn_features", "churn_scores"]
FORBIDDEN_COLUMNS = {"sales": ["cust_name"], "service": ["cust_name"], "insurance": ["cust_name"]}
EQUAL_KEYS = [("pii_vault", "customer", "cust_id", True), ("churn_features", "churn_scores", "cust_id", False)]


def catalogue_rows(t: Tables, expected: list[str] | None = None) -> list[tuple[str, str, int]]:
    """Existence, forbidden and missing columns, read from the tables' schemas alone (no job)."""
    rows = []
    for name in expected or EXPECTED_TABLES:
        present = name in t
        rows.append((name, "table exists", 0 if present else 1))
        if not present:
            continue
        columns = set(t[name].columns)
        for column in FORBIDDEN_COLUMNS.get(name, []):
            rows.append((name, f"no {column} column", int(column in columns)))
        if name in TABLES:
            rows.append((name, "columns present", sum(1 for c in TABLES[name].fieldNames() if c not in columns)))
    return rows


def _readable(df: DataFrame, condition: Column) -> bool:
    """Whether the table has the columns a rule reads (analysis only, no job); a rule that can't be read is left out
    and the missing column shows in the row ``columns present``."""
    from pyspark.errors import AnalysisException

    try:
        df.select(condition).schema  # noqa: B018
        return True
    except AnalysisException:
        return False


def fused_checks(df: DataFrame, name: str, least: int | None) -> DataFrame:
    """Every check of one table that needs no other table, in one aggregate: rules, keys of constant dimensions,
    the row minimum and, for the features, both label bands."""
    asserted = {**range_assertions().get(name, {}), **edge_assertions().get(name, {})}
    measures: dict[str, Column] = {n: F.count_if(~F.coalesce(c, F.lit(False))) for n, c in asserted.items() if _readable(df, c)}
    for table, column, target, target_column in FOREIGN_KEYS:
        if table == name and target in DIMENSIONS and column in df.columns:
            ddl, values = DIMENSIONS[target]
            at = [part.split()[0] for part in ddl.split(", ")].index(target_column)
            orphan = (F.trim(column) != "") & ~F.col(column).isin([row[at] for row in values])
            measures[f"{column} in {target}"] = F.count_distinct(F.when(orphan, F.col(column)))
    if least is not None:
        filled = F.greatest(*[F.col(c).isNotNull() for c in df.columns]) if df.columns else F.lit(False)
        measures["enough rows"] = F.when(F.count_if(filled) >= least, 0).otherwise(1)
    if name == "churn_features" and "churn_label" in df.columns:
        rate = F.coalesce(F.avg("churn_label"), F.lit(0.0))
        measures["churn rate in band"] = F.when(rate.between(*LABEL_BAND), 0).otherwise(1)
        measures["churn rate in strict band"] = F.when(rate.between(*STRICT_LABEL_BAND), 0).otherwise(1)
    if not measures:
        return None
    names = list(measures)
    counted = df.agg(*[measures[n].cast("bigint").alias(f"v{i}") for i, n in enumerate(names)])
    rows = F.array(*[F.struct(F.lit(n).alias("check_name"), F.col(f"v{i}").alias("violations")) for i, n in enumerate(names)])
    return counted.select(F.lit(name).alias("table_name"), F.inline(rows))


def report(t: Tables, expected: list[str] | None = None, leaks: bool = True) -> DataFrame:
    """All checks as (table, check, violations); a missing table is a row of its own and its checks are left out, as are
    rules on a missing column (counted in ``columns present``).

    Catalogue and schema rows come from the schemas. Each table is then read once for all checks that need no other
    table; only keys of non-constant tables (customer, vehicle) are joined, the key sets are compared by a full join
    of counted keys, and the raw names of the vault are looked for in the safe tables by ``privacy.leak_scan``.
    """
    from stayline.operators import privacy
    from stayline.session import stage

    spark = next(t[n] for n in (expected or EXPECTED_TABLES) if n in t).sparkSession
    # derived tables are read by several checks: each is computed and written once
    t = {n: (t[n] if n in DIMENSIONS else stage(t[n], f"report-{n}")) for n in (expected or EXPECTED_TABLES) if n in t}
    parts = [spark.createDataFrame(catalogue_rows(t, expected), "table_name string, check_name string, violations bigint")]
    for name in expected or EXPECTED_TABLES:
        if name in t and name not in DIMENSIONS:
            fused = fused_checks(t[name], name, LEAST_ROWS.get(name))
            if fused is not None:
                parts.append(fused)
    for name, least in LEAST_ROWS.items():
        if name in DIMENSIONS and name in t:
            parts.append(fused_checks(t[name], name, least))
    for table, column, target, target_column in FOREIGN_KEYS:
        if target not in DIMENSIONS and table in t and target in t:
            parts.append(orphan_keys(t[table], column, t[target], target_column).agg(F.count("*").cast("bigint").alias("violations")).select(
                F.lit(table).alias("table_name"), F.lit(f"{column} in {target}").alias("check_name"), "violations"))
    for left, right, key, rows_too in EQUAL_KEYS:
        if left in t and right in t:
            sets = key_sets(t[left].select(key), t[right].select(key), key)
            checks_of = [F.struct(F.lit(f"{key} set equals {right}").alias("check_name"), (F.col("left_only") + F.col("right_only")).cast("bigint").alias("violations"))]
            if rows_too:
                checks_of.append(F.struct(F.lit(f"rows equal {right}").alias("check_name"), F.abs(F.col("left_rows") - F.col("right_rows")).cast("bigint").alias("violations")))
            parts.append(sets.select(F.lit(left).alias("table_name"), F.inline(F.array(*checks_of))))
    if leaks and "pii_vault" in t:
        scanned = [n for n in privacy.SAFE_TABLES if n in t]
        found = privacy.leak_scan(t["pii_vault"], {n: t[n] for n in scanned}).groupBy("table_name").agg(F.count_distinct("name").alias("n"))
        listed = spark.createDataFrame([(n,) for n in scanned], "table_name string")
        parts.append(listed.join(found, "table_name", "left").select(
            "table_name", F.lit("no raw names").alias("check_name"), F.coalesce("n", F.lit(0)).cast("bigint").alias("violations")))
    return stack(parts)


def verdict(checks: DataFrame) -> DataFrame:
    """One row: every check counts for the overall result."""
    return checks.agg(
        F.count("*").alias("checks"),
        F.count_if(F.col("violations") > 0).alias("failed"),
        F.bool_and(F.col("violations") == 0).alias("passed"),
    )


def table_hash(df: DataFrame, name: str) -> DataFrame:
    """Row count and an order-free content hash of a table: the sum of 60-bit digests of its rows, so equal rows add up.

    A row's digest is over its values as text, floating-point numbers with six decimals, and can be had in any engine.
    """
    text = [F.col(f.name).cast("decimal(38,6)" if f.dataType.typeName() == "double" else "string").cast("string") for f in df.schema.fields]
    row = F.concat_ws("|", *[F.coalesce(c, F.lit("~")) for c in text])
    digest = F.conv(F.substring(F.md5(row), 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(F.count("*").alias("rows"), F.coalesce(F.sum(digest), F.lit(0)).cast("string").alias("content_hash")).select(
        F.lit(name).alias("table_name"), "rows", "content_hash"
    )
