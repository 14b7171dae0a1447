"""Master data of the after-sales star schema and the fixed texts of its reports."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------------
# Dimension rows, the model catalogue, staff names and report texts. They are data,
# stated in full, because results are compared by value.
# ---------------------------------------------------------------------------------------------

DIMENSIONS: dict[str, tuple[str, list[tuple]]] = {
    "dim_bank": (
        "bank_id string, bank_name string, bank_type string, regulated_by string, is_active string",
        [
            ("BNK001", "HDFC Bank", "Private", "RBI", "Y"),
            ("BNK002", "ICICI Bank", "Private", "RBI", "Y"),
            ("BNK003", "State Bank of India", "Public", "RBI", "Y"),
            ("BNK004", "Axis Bank", "Private", "RBI", "Y"),
            ("BNK005", "Bajaj Finserv", "NBFC", "RBI", "Y"),
            ("BNK006", "Kotak Mahindra", "Private", "RBI", "Y"),
            ("BNK007", "Bank of Baroda", "Public", "RBI", "Y"),
            ("BNK008", "Tata Capital", "NBFC", "RBI", "Y"),
        ],
    ),
    "dim_dealer": (
        "dealer_id string, dealer_name string, city string, state string, zone string, dealer_type string",
        [
            ("DLR001", "Sunrise Motors", "Mumbai", "Maharashtra", "West", "3S"),
            ("DLR002", "Deccan AutoHub", "Pune", "Maharashtra", "West", "3S"),
            ("DLR003", "Garden City Cars", "Bangalore", "Karnataka", "South", "3S"),
            ("DLR004", "Marina Auto World", "Chennai", "Tamil Nadu", "South", "2S"),
            ("DLR005", "Golconda Drives", "Hyderabad", "Telangana", "South", "3S"),
        ],
    ),
    "dim_location": (
        "location_id string, city string, state string, zone string, tier string",
        [
            ("LOC_MUM_01", "Mumbai", "Maharashtra", "West", "Metro"),
            ("LOC_PUN_01", "Pune", "Maharashtra", "West", "Tier-1"),
            ("LOC_BLR_01", "Bangalore", "Karnataka", "South", "Metro"),
            ("LOC_CHN_01", "Chennai", "Tamil Nadu", "South", "Metro"),
            ("LOC_HYD_01", "Hyderabad", "Telangana", "South", "Metro"),
        ],
    ),
    "dim_work_type": (
        "work_type_id string, work_type_name string, is_billable string, category string, sla_hours int",
        [
            ("WT001", "Free Service", "N", "Scheduled", 4),
            ("WT002", "Paid Service", "Y", "Scheduled", 6),
            ("WT003", "Body Repair", "Y", "Unscheduled", 24),
            ("WT004", "Accidental Repair", "Y", "Unscheduled", 48),
            ("WT005", "AMC (Annual Maintenance)", "Y", "Contract", 8),
        ],
    ),
    "dim_policy_type": (
        "policy_type_id string, policy_type_name string, coverage_type string, is_mandatory string, "
        "description string",
        [
            ("PT001", "Comprehensive", "OD + Third Party", "N", "Covers own damage + third-party liability"),
            ("PT002", "Third Party", "Third Party Only", "Y", "Mandatory by law; covers third-party only"),
            ("PT003", "Zero Dep", "OD + TP + Zero Dep", "N", "No depreciation deducted on claim"),
            ("PT004", "Standalone OD", "Own Damage Only", "N", "OD cover for vehicles with existing TP"),
        ],
    ),
    "dim_pay_mode": (
        "pay_mode_id string, pay_mode_name string, is_digital string, platform string",
        [
            ("PM001", "Cash", "N", "In-Store"),
            ("PM002", "Debit/Credit Card", "Y", "POS Terminal"),
            ("PM003", "UPI", "Y", "NPCI"),
            ("PM004", "Net Banking", "Y", "Bank Portal"),
            ("PM005", "Cheque", "N", "In-Store"),
        ],
    ),
    "dim_cancel_reason": (
        "cancel_reason_id string, description string, category string, is_customer_fault string",
        [
            ("CR001", "Customer Request", "Customer-Initiated", "Y"),
            ("CR002", "Parts Unavailable", "Operational", "N"),
            ("CR003", "No Show", "Customer-Initiated", "Y"),
            ("CR004", "Vehicle Breakdown", "Operational", "N"),
            ("CR005", "Appointment Conflict", "Customer-Initiated", "Y"),
        ],
    ),
    "dim_occupation": (
        "occ_id string, occupation_name string, income_bracket string, segment string",
        [
            ("OCC001", "Salaried", "Middle", "Employee"),
            ("OCC002", "Business Owner", "High", "Entrepreneur"),
            ("OCC003", "Self-Employed", "Middle", "Professional"),
            ("OCC004", "Government Employee", "Middle", "Employee"),
            ("OCC005", "Student", "Low", "Other"),
            ("OCC006", "Retired", "Low-Middle", "Other"),
        ],
    ),
    "dim_fuel_type": (
        "fuel_type_id string, fuel_type_name string, emission_standard string, ev_flag string, green_score int",
        [
            ("FT001", "Petrol", "BS6", "N", 3),
            ("FT002", "Diesel", "BS6", "N", 2),
            ("FT003", "CNG", "Low Emission", "N", 4),
            ("FT004", "Electric", "Zero Emission", "Y", 5),
            ("FT005", "Hybrid", "Low Emission", "N", 4),
        ],
    ),
    "dim_milestone": (
        "milestone_id string, milestone_name string, interval_km int, interval_months int",
        [
            ("MS001", "1st Free Service", 1000, 1),
            ("MS002", "2nd Free Service", 5000, 3),
            ("MS003", "3rd Free Service", 10000, 6),
            ("MS004", "Annual Paid Service", 20000, 12),
            ("MS005", "AMC Service", 0, 1),
        ],
    ),
}

MODEL_CATALOGUE_SCHEMA = (
    "model_no int, model string, variants array<string>, cc int, engine_prefix string, fuel_type_id string, "
    "transmission string, body_type string, seating_capacity int"
)
MODEL_CATALOGUE = [
    (0, "Swift", ["VXI", "ZXI", "LXI", "ZXI+"], 1197, "K12N", "FT001", "Manual", "Hatchback", 5),
    (1, "Baleno", ["Delta", "Sigma", "Alpha", "Zeta"], 1197, "K12N", "FT001", "AMT", "Hatchback", 5),
    (2, "Creta", ["E", "S", "SX", "SX(O)"], 1497, "G4LC", "FT002", "Automatic", "SUV", 5),
    (3, "i20", ["Magna", "Sportz", "Asta", "Era"], 1197, "G4LC", "FT001", "Manual", "Hatchback", 5),
    (4, "Nexon", ["XE", "XM", "XZ", "XZ+"], 1199, "REVT", "FT001", "AMT", "SUV", 5),
    (5, "City", ["V", "VX", "ZX", "S"], 1498, "L15Z", "FT001", "CVT", "Sedan", 5),
    (6, "Punch", ["Pure", "Adventure", "Accomplished"], 1199, "REVT", "FT001", "AMT", "SUV", 5),
    (7, "WagonR", ["LXI", "VXI", "ZXI"], 998, "K10C", "FT003", "Manual", "Hatchback", 5),
    (8, "Venue", ["S", "SX", "N Line"], 1197, "G3LC", "FT001", "Manual", "SUV", 5),
    (9, "Thar", ["AX", "LX", "LX Hard Top"], 2184, "mHwk", "FT002", "Manual", "SUV", 4),
]

COLORS = [
    "Chalk", "Harbour", "Brick", "Slate",
    "Coal", "Copper", "Cherry", "Nickel",
]
SALES_STAFF = ["Desk One", "Desk Two", "Desk Three", "Desk Four", "Desk Five"]
SERVICE_STAFF = ["Bay One", "Bay Two", "Bay Three", "Bay Four", "Bay Five"]

TIERS = ["High", "Medium", "Low"]
TIER_ICONS = {"High": "🔴 HIGH", "Medium": "🟡 MEDIUM", "Low": "🟢 LOW"}
TIER_ACTIONS = {
    "High": "Urgent outreach: Call + service reminder + policy renewal offer",
    "Medium": "Send WhatsApp reminder for upcoming service / insurance renewal",
    "Low": "Monthly newsletter — loyalty points update",
}
WIN_BACK_STRATEGY = "Service discount offer — policy still active, easy win-back"
DRIVERS = [
    "days_since_last_service", "days_to_policy_expiry", "avg_bill_amount", "pct_paid_services",
    "num_policy_renewals", "auto_membership_flag", "cancelled_visit_flag", "rfm_total", "vehicle_age_years",
]
REVENUE_PER_CUSTOMER = 15000
SEGMENT_NAMES = ["Champions", "Loyal", "At-Risk", "Lost"]

# End of fixed values ---------------------------------------------------------------------------

FREE_WORK_TYPES = [row[0] for row in DIMENSIONS["dim_work_type"][1] if row[2] == "N"]
VARIANT_COUNT = sum(len(row[2]) for row in MODEL_CATALOGUE)

_ARROW = {
    "string": pa.string(),
    "int": pa.int32(),
    "bigint": pa.int64(),
    "double": pa.float64(),
    "array<string>": pa.list_(pa.string()),
}


def constant_table(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    """A few constant rows as a local relation, which the optimizer can fold and broadcast without a job."""
    fields = [part.split() for part in ddl.split(", ")]
    columns = [pa.array([row[i] for row in rows], type=_ARROW[kind]) for i, (_, kind) in enumerate(fields)]
    return spark.createDataFrame(pa.table(columns, names=[name for name, _ in fields]))


def dimension(spark: SparkSession, name: str) -> DataFrame:
    schema, rows = DIMENSIONS[name]
    return constant_table(spark, rows, schema)


def model_variants(spark: SparkSession) -> DataFrame:
    """One row per model and variant, numbered in catalogue order by ``variant_no`` from 0."""
    rows, first = [], 0
    for row in MODEL_CATALOGUE:
        rows.append((*row, first))
        first += len(row[2])
    return (
        constant_table(spark, rows, MODEL_CATALOGUE_SCHEMA + ", first_no int")
        .select("*", F.posexplode("variants").alias("pos", "variant"))
        .withColumn("variant_no", F.col("first_no") + F.col("pos"))
        .drop("pos", "first_no", "variants")
    )
