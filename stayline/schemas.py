"""Table schemas of the star schema, in column order."""

from __future__ import annotations

from pyspark.sql import types as T

from stayline.reference_data import DIMENSIONS

_DDL = {
    "sales": "sales_id string, cust_id string, dealer_id string, vin string, mfd_year int, "
    "registration_date date, tax_validity date, pucc_validity date, finance_flag string, bank_id string, "
    "sale_date date, delivery_date date, sales_poc string, loc_id string",
    "service": "smr_id string, cust_id string, dealer_id string, vin string, work_type_id string, "
    "milestone_id string, visit_date date, bill_date date, status string, cancel_reason_id string, "
    "bill_amount double, mileage int, service_advisor string, pay_mode_id string",
    "insurance": "ins_id string, cust_id string, dealer_id string, vin string, policy_type_id string, "
    "policy_no string, policy_issue_date date, policy_inception_date date, policy_expiry_date date, "
    "tp_policy_issue_date date, tp_policy_expiry_date date, previous_policy_start_date date, "
    "previous_policy_end_date date, auto_membership string, total_premium double",
    "customer": "cust_id string, name_masked string, mobile_masked string, email_masked string, "
    "birth_year string, gender string, occ_id string, city string, state string, pincode string, "
    "preferred_dealer_id string, created_at date, updated_at date",
    "vehicle": "vehicle_id string, vin string, reg_no string, engine_no string, model string, variant string, "
    "color string, cc int, mfd_year int, registration_date date, fuel_type_id string, transmission string, "
    "body_type string, seating_capacity int, created_at date",
    "customer_vehicle": "cv_id string, cust_id string, vehicle_id string, relationship_type string, "
    "purchase_date date, is_primary_owner string, active_flag string",
    "pii_vault": "cust_id string, cust_name string, mobile_1 string, mobile_2 string, email string, dob string, "
    "address string, city string, state string, pincode string, gender string, occ_id string",
    "churn_features": "cust_id string, vehicle_id string, vehicle_age_years int, finance_flag string, "
    "total_service_visits bigint, days_since_last_service int, avg_bill_amount double, "
    "pct_paid_services double, cancelled_visit_flag int, num_policy_renewals bigint, "
    "days_to_policy_expiry int, auto_membership_flag int, premium_trend double, recency_score int, "
    "frequency_score int, monetary_score int, rfm_total int, churn_label int, risk_tier string",
    "churn_scores": "cust_id string, vehicle_id string, churn_probability double, risk_tier string, top_driver_1 string, "
    "top_driver_2 string, top_driver_3 string, recommended_action string, score_date date",
    "decisions": "application_number string, decision string",
}

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "date": T.DateType(),
}


def _struct(ddl: str) -> T.StructType:
    """A StructType from ``name type, ...`` without a running session (``StructType.fromDDL`` needs one)."""
    pairs = [part.split() for part in ddl.split(", ")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


TABLES: dict[str, T.StructType] = {name: _struct(ddl) for name, ddl in _DDL.items()}
TABLES.update({name: _struct(ddl) for name, (ddl, _) in DIMENSIONS.items()})

FACTS = ["sales", "service", "insurance"]
COLUMN_NOTES = {
    "cust_id": "customer token; the only key to the vault",
    "policy_expiry_date": "churn signal",
    "auto_membership": "Y = roadside membership, churn signal",
    "total_premium": "premium in INR, used for the trend",
    "churn_label": "1 = churned, 0 = active",
}


def with_notes(schema: T.StructType) -> T.StructType:
    """The same schema with the column notes kept as comments."""
    return T.StructType(
        [
            T.StructField(f.name, f.dataType, f.nullable, {"comment": COLUMN_NOTES[f.name]})
            if f.name in COLUMN_NOTES
            else f
            for f in schema.fields
        ]
    )
