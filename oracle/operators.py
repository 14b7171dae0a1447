"""Check SQL of the quality, privacy, chain, identity and lookup operators."""

from __future__ import annotations

from oracle.base import TABLES, statement, text, wide, words
from stayline.reference_data import DIMENSIONS, DRIVERS
from stayline.schemas import TABLES as SCHEMAS

_SALES_FEED = f"""
SELECT CASE WHEN k % 211 <> 0 THEN {wide('SL', 'k')} END AS sales_id,
  CASE WHEN k % 101 = 1 THEN v[1:16] WHEN k % 103 = 2 THEN v[1:16] || '-' ELSE v END AS vin,
  CASE WHEN k % 107 <> 3 THEN sale_date END AS sale_date,
  CASE WHEN k % 109 = 4 THEN sale_date - 1 ELSE sale_date + CAST(1 + k % 14 AS INTEGER) END AS delivery_date,
  k % 3 < 2 AS financed,
  CASE WHEN k % 113 = 5 THEN 'BNK099' WHEN k % 127 = 6 THEN NULL WHEN k % 3 < 2 THEN 'BNK00' || (1 + k % 8) END
    AS bank_id
FROM (SELECT *, {wide('MA3', 'k', 14)} AS v,
        unnest(CASE WHEN k % 97 = 0 THEN [1, 2] ELSE [1] END) AS copy FROM sold)"""
_SERVICE_FEED = """
SELECT smr_id, vin, CASE WHEN p % 50 = 3 THEN 'WT009' ELSE work_type_id END AS work_type_id,
  CASE WHEN p % 20 = 1 THEN NULL WHEN p % 40 = 2 AND work_type_id <> 'WT001' THEN -bill_amount ELSE bill_amount END
    AS bill_amount
FROM (SELECT *, CAST(split_part(smr_id, '-', 3) AS BIGINT) AS p FROM service_feed),
  LATERAL (SELECT unnest(CASE WHEN p % 89 = 0 THEN [1, 2] ELSE [1] END) AS copy)"""
_INSURANCE_FEED = """
SELECT ins_id, vin, policy_issue_date, CASE WHEN k % 83 = 1 THEN policy_issue_date - 1 ELSE policy_expiry_date END
    AS policy_expiry_date, CASE WHEN k % 79 = 2 THEN 'PT009' ELSE policy_type_id END AS policy_type_id
FROM (SELECT *, CAST(cust_id[5:] AS BIGINT) AS k FROM insurance),
  LATERAL (SELECT unnest(CASE WHEN k % 71 = 0 THEN [1, 2] ELSE [1] END) AS copy)"""
_VAULT_FEED = """
SELECT CASE WHEN k % 53 = 0 THEN mobile_1[1:9] WHEN k % 59 = 1 THEN '5' || mobile_1[2:] ELSE mobile_1 END AS mobile_1
FROM (SELECT *, CAST(cust_id[5:] AS BIGINT) AS k FROM pii_vault)"""


def _ids(dimension: str) -> str:
    return "(" + ", ".join(text(row[0]) for row in DIMENSIONS[dimension][1]) + ")"


def _key_rules(key: str) -> str:
    return (
        f"CASE WHEN {key} IS NULL THEN '{key} missing' END, "
        f"CASE WHEN {key} IS NOT NULL AND count(*) OVER (PARTITION BY {key}) > 1 THEN '{key} not unique' END, "
        "CASE WHEN NOT regexp_full_match(vin, '[A-Za-z0-9]{17}') THEN 'vin malformed' END"
    )


_BANK_KNOWN = f"bank_id IS NOT NULL AND bank_id IN {_ids('dim_bank')}"
_MARKED = {
    "dirty_sales": _SALES_FEED,
    "dirty_service": _SERVICE_FEED,
    "dirty_insurance": _INSURANCE_FEED,
    "dirty_vault": _VAULT_FEED,
    "marked_sales": f"""
SELECT sales_id AS row_id, list_filter([{_key_rules('sales_id')},
    CASE WHEN sale_date IS NULL THEN 'sale_date invalid' END,
    CASE WHEN sale_date > delivery_date THEN 'sale_date after delivery' END,
    CASE WHEN financed AND NOT coalesce({_BANK_KNOWN}, false) THEN 'bank_id unknown' END], lambda x: x IS NOT NULL)
  AS rejects, CAST([] AS VARCHAR[]) AS warnings FROM dirty_sales""",
    "marked_service": f"""
SELECT smr_id AS row_id, vin, work_type_id, bill_amount, list_filter([{_key_rules('smr_id')},
    CASE WHEN work_type_id NOT IN {_ids('dim_work_type')} THEN 'work_type_id unknown' END,
    CASE WHEN bill_amount < 0 THEN 'bill_amount negative' END], lambda x: x IS NOT NULL) AS rejects,
  CASE WHEN bill_amount IS NOT NULL THEN CAST([] AS VARCHAR[])
    WHEN work_type_id = 'WT001' THEN ['bill_amount missing on free service'] ELSE ['bill_amount missing'] END AS warnings
FROM dirty_service""",
    "marked_insurance": f"""
SELECT ins_id AS row_id, list_filter([{_key_rules('ins_id')},
    CASE WHEN policy_type_id NOT IN {_ids('dim_policy_type')} THEN 'policy_type_id unknown' END,
    CASE WHEN policy_expiry_date <= policy_issue_date THEN 'policy_expiry not after issue' END],
    lambda x: x IS NOT NULL) AS rejects, CAST([] AS VARCHAR[]) AS warnings FROM dirty_insurance""",
    "marked_vault": """
SELECT CAST([] AS VARCHAR[]) AS rejects, CASE WHEN regexp_full_match(mobile_1, '[6-9][0-9]{9}')
    THEN CAST([] AS VARCHAR[]) ELSE ['mobile_1 malformed'] END AS warnings FROM dirty_vault""",
}


def _dq(select: str) -> str:
    return statement(select, _MARKED)


def _summary(table: str, name: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, unnest(rejects || warnings || [CASE WHEN len(rejects) > 0 THEN 'rows rejected' "
        f"ELSE 'rows accepted' END]) AS rule FROM {table}"
    )


_MARKED_OF = {"marked_sales": "sales", "marked_service": "service", "marked_insurance": "insurance"}


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _violations(table: str, name: str, rules: dict[str, str]) -> list[str]:
    return [
        f"SELECT '{name}' AS table_name, {text(check)} AS check_name, "
        f"count(*) FILTER (NOT coalesce({rule}, false)) AS violations FROM {table}"
        for check, rule in rules.items()
    ]


def _present(*columns: str) -> dict[str, str]:
    return {f"{c} present": f"{c} IS NOT NULL" for c in columns}


_DRIVER_LIST = "(" + ", ".join(text(d) for d in DRIVERS) + ")"
_RANGES = _union(
    _violations("sales", "sales", {
        **_present("sales_id", "vin", "cust_id"),
        "vin has 17 characters": "len(vin) = 17",
        "vin starts with MA3": "vin LIKE 'MA3%'",
        "registered in or after the year of manufacture": "year(registration_date) >= mfd_year",
        "delivered on or after the sale": "delivery_date >= sale_date",
    })
    + _violations("service", "service", {
        **_present("smr_id", "vin", "cust_id"), "bill_amount not negative": "bill_amount >= 0"})
    + _violations("insurance", "insurance", {
        **_present("ins_id", "vin", "cust_id"), "expiry after issue": "policy_expiry_date > policy_issue_date"})
    + _violations("features", "churn_features", {
        "vehicle_age_years not negative": "vehicle_age_years >= 0",
        "days_since_last_service not negative": "days_since_last_service >= 0",
        "total_service_visits at least 1": "total_service_visits >= 1",
        "avg_bill_amount not negative": "avg_bill_amount >= 0",
        "pct_paid_services in [0, 1]": "pct_paid_services BETWEEN 0 AND 1",
        "cancelled_visit_flag is 0 or 1": "cancelled_visit_flag IN (0, 1)",
        "num_policy_renewals not negative": "num_policy_renewals >= 0",
        "days_to_policy_expiry present": "days_to_policy_expiry IS NOT NULL",
        "auto_membership_flag is 0 or 1": "auto_membership_flag IN (0, 1)",
        "recency_score in [1, 5]": "recency_score BETWEEN 1 AND 5",
        "frequency_score in [1, 5]": "frequency_score BETWEEN 1 AND 5",
        "monetary_score in [1, 5]": "monetary_score BETWEEN 1 AND 5",
        "rfm_total is the sum": "rfm_total = recency_score + frequency_score + monetary_score",
        "rfm_total in [3, 15]": "rfm_total BETWEEN 3 AND 15",
        "churn_label is 0 or 1": "churn_label IN (0, 1)",
        "label 1 is tier High": "churn_label <> 1 OR risk_tier = 'High'",
        "risk_tier known": "risk_tier IN ('High', 'Medium', 'Low')",
    })
    + _violations("scores", "churn_scores", {
        "churn_probability in [0, 1]": "churn_probability BETWEEN 0 AND 1",
        "probability above 0.65 is High": "churn_probability <= 0.65e0 OR risk_tier = 'High'",
        "High has an action": "risk_tier <> 'High' OR recommended_action <> ''",
        "drivers are features": f"top_driver_1 IN {_DRIVER_LIST} AND top_driver_2 IN {_DRIVER_LIST} "
                                f"AND top_driver_3 IN {_DRIVER_LIST}",
        "score_date present": "score_date IS NOT NULL",
    })
    + _violations("master", "customer", {
        "name_masked has *": "name_masked LIKE '%*%'",
        "mobile_masked has X": "mobile_masked LIKE '%X%'",
        "email_masked has the masked form": r"regexp_matches(email_masked, '^.\*+@.\*+\..+')",
        "birth_year is a year": "regexp_full_match(birth_year, '[0-9]{4}')",
    })
)
_EDGES = _union(
    _violations("sales", "sales", {"unfinanced has no bank": "finance_flag <> 'N' OR bank_id IS NULL"})
    + _violations("service", "service", {
        "free service costs 0": "work_type_id <> 'WT001' OR bill_amount = 0",
        "cancelled has a reason": "status <> 'Cancelled' OR cancel_reason_id IS NOT NULL",
        "completed has no reason": "status <> 'Completed' OR cancel_reason_id IS NULL",
    })
    + _violations("customer_vehicle", "customer_vehicle", {
        "co-owner is not primary": "relationship_type <> 'Co-Owner' OR is_primary_owner = 'N'"})
)
_FOREIGN = [
    ("sales", "sales", "bank_id", "dim_bank", "bank_id", "dim_bank"),
    ("sales", "sales", "dealer_id", "dim_dealer", "dealer_id", "dim_dealer"),
    ("sales", "sales", "loc_id", "dim_location", "location_id", "dim_location"),
    ("service", "service", "work_type_id", "dim_work_type", "work_type_id", "dim_work_type"),
    ("service", "service", "pay_mode_id", "dim_pay_mode", "pay_mode_id", "dim_pay_mode"),
    ("service", "service", "cancel_reason_id", "dim_cancel_reason", "cancel_reason_id", "dim_cancel_reason"),
    ("insurance", "insurance", "policy_type_id", "dim_policy_type", "policy_type_id", "dim_policy_type"),
    ("master", "customer", "occ_id", "dim_occupation", "occ_id", "dim_occupation"),
    ("vehicle", "vehicle", "fuel_type_id", "dim_fuel_type", "fuel_type_id", "dim_fuel_type"),
    ("sales", "sales", "cust_id", "master", "cust_id", "customer"),
    ("sales", "sales", "vin", "vehicle", "vin", "vehicle"),
    ("customer_vehicle", "customer_vehicle", "vehicle_id", "vehicle", "vehicle_id", "vehicle"),
]
_FK = _union([
    f"SELECT '{shown}' AS table_name, '{column} in {target_shown}' AS check_name, count(DISTINCT {column}) AS violations "
    f"FROM {table} WHERE {column} IS NOT NULL AND {column} NOT IN (SELECT {key} FROM {target})"
    for table, shown, column, target, key, target_shown in _FOREIGN
])
_LEAST = [("sales", "sales", 25), ("service", "service", 30), ("insurance", "insurance", 25), ("master", "customer", 25),
          ("vehicle", "vehicle", 25), ("pii_vault", "pii_vault", 25), ("customer_vehicle", "customer_vehicle", 25),
          ("features", "churn_features", 25), ("scores", "churn_scores", 25), ("dim_bank", "dim_bank", 5)]
_MINIMUMS = _union([
    f"SELECT '{shown}' AS table_name, count(*) AS rows, {n} AS least, CASE WHEN count(*) >= {n} THEN 1 ELSE 0 END AS enough "
    f"FROM {table}" for table, shown, n in _LEAST
])
_RATE = """
SELECT count(*) FILTER (churn_label = 0) AS label_0, count(*) FILTER (churn_label = 1) AS label_1,
  round(avg(churn_label), 6) AS churn_rate, CASE WHEN avg(churn_label) BETWEEN 0.05 AND 0.7 THEN 1 ELSE 0 END AS in_band
FROM features"""
_PERSON = "sha256(lower(cust_name) || '|' || mobile_1 || '|stayline')"

_NUMBERS = {
    "checked": r"""
SELECT search_id, raw, code IS NULL AS ok, code AS error_code,
  CASE code WHEN 'not_alphanumeric' THEN 'no spaces or special characters allowed'
    WHEN 'letters_after_prefix' THEN 'after IRL only digits are allowed'
    WHEN 'letters_at_end' THEN 'letters at end: ' || letters WHEN 'other_letters' THEN 'unexpected letters: ' || letters
    WHEN 'too_short' THEN 'too short: ' || len(digits) || ' digits'
    WHEN 'too_long' THEN 'too long: ' || len(digits) || ' digits' ELSE '' END AS error_msg,
  CASE WHEN code IS NULL THEN digits ELSE '' END AS number
FROM (SELECT *, array_to_string(list_sort(list_distinct(regexp_extract_all(upper(t), '[A-Z]'))), '') AS letters,
        CASE WHEN t = '' THEN 'empty' WHEN NOT regexp_full_match(t, '[A-Za-z0-9]+') THEN 'not_alphanumeric'
          WHEN regexp_full_match(digits, '[0-9]+') THEN
            CASE WHEN len(digits) < 8 THEN 'too_short' WHEN len(digits) > 8 THEN 'too_long' END
          WHEN upper(t) LIKE 'IRL%' THEN 'letters_after_prefix'
          WHEN regexp_matches(t, '[A-Za-z]$') THEN 'letters_at_end' ELSE 'other_letters' END AS code
      FROM (SELECT *, CASE WHEN upper(t) LIKE 'IRL%' THEN t[4:] ELSE t END AS digits
            FROM (SELECT *, trim(raw) AS t FROM searches)))""",
    "decided": """
SELECT digits, CAST(digits AS BIGINT) AS number, arg_min(application_number, row_idx) AS application_number,
  arg_min(decision, row_idx) AS decision FROM decisions GROUP BY digits""",
}



def _hash(name: str, source: str) -> str:
    columns = [f"CAST({f.name} AS DECIMAL(38, 6))" if f.dataType.typeName() == "double" else f.name for f in SCHEMAS[name].fields]
    row = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in columns)
    return (f"SELECT '{name}' AS table_name, count(*) AS rows, "
            f"CAST(sum(CAST('0x' || md5(concat_ws('|', {row}))[1:15] AS BIGINT)) AS VARCHAR) AS content_hash FROM {source}")


_LEAK_TEXTS = {
    "leaky": """
SELECT s.* REPLACE (CASE WHEN CAST(s.cust_id[5:] AS BIGINT) % 97 = 0 THEN 'c/o ' || p.cust_name || ', desk'
    WHEN CAST(s.cust_id[5:] AS BIGINT) % 89 = 0 THEN 'x_' || p.cust_name || 's'
    ELSE s.sales_poc END AS sales_poc) FROM sales s JOIN pii_vault p USING (cust_id)""",
    "texts": "SELECT table_name, column_name, txt, count(*) AS n FROM (" + _union([
        f"SELECT '{shown}' AS table_name, unnest({words(cols)}) AS column_name, unnest([{', '.join(cols)}]) AS txt "
        f"FROM {table}"
        for table, shown, cols in [
            ("leaky", "sales", ["sales_id", "cust_id", "dealer_id", "vin", "finance_flag", "bank_id", "sales_poc",
                                "loc_id"]),
            ("service", "service", ["smr_id", "cust_id", "dealer_id", "vin", "work_type_id", "milestone_id",
                                    "status", "cancel_reason_id", "service_advisor", "pay_mode_id"]),
            ("insurance", "insurance", ["ins_id", "cust_id", "dealer_id", "vin", "policy_type_id", "policy_no",
                                        "auto_membership"]),
            ("features", "churn_features", ["cust_id", "vehicle_id", "finance_flag", "risk_tier"]),
            ("scores", "churn_scores", ["cust_id", "vehicle_id", "risk_tier", "top_driver_1", "top_driver_2", "top_driver_3",
                                        "recommended_action"]),
        ]
    ]) + ") GROUP BY ALL",
}


_EXPECTED = [*DIMENSIONS, "sales", "service", "insurance", "customer", "vehicle", "customer_vehicle", "pii_vault", "churn_features",
             "churn_scores"]
_SAFE = ["sales", "service", "insurance", "churn_features", "churn_scores"]
# the report scans the tables as they are, so the planted leak of ``leaky`` is left out
_REPORT_TEXTS = {"report_texts": _LEAK_TEXTS["texts"].replace("FROM leaky", "FROM sales")}
_REPORT = _union([
    f"SELECT table_name, check_name, CAST(violations AS BIGINT) AS violations FROM ({_RANGES})",
    f"SELECT table_name, check_name, CAST(violations AS BIGINT) AS violations FROM ({_EDGES})",
    f"SELECT table_name, check_name, CAST(violations AS BIGINT) AS violations FROM ({_FK})",
    f"SELECT table_name, 'enough rows' AS check_name, CAST(1 - enough AS BIGINT) AS violations FROM ({_MINIMUMS})",
    f"SELECT 'churn_features' AS table_name, 'churn rate in band' AS check_name, CAST(1 - in_band AS BIGINT) AS violations FROM ({_RATE})",
    """SELECT 'churn_features' AS table_name, 'churn rate in strict band' AS check_name,
  CAST(CASE WHEN coalesce(avg(churn_label), 0) BETWEEN 0.2 AND 0.6 THEN 0 ELSE 1 END AS BIGINT) AS violations FROM features""",
    "SELECT name AS table_name, check_name, CAST(0 AS BIGINT) AS violations FROM (SELECT unnest("
    + words(_EXPECTED) + ") AS name) CROSS JOIN (SELECT unnest(['table exists', 'columns present']) AS check_name)",
    "SELECT unnest(['sales', 'service', 'insurance']) AS table_name, 'no cust_name column' AS check_name, CAST(0 AS BIGINT) AS violations",
    """SELECT 'pii_vault' AS table_name, 'cust_id set equals customer' AS check_name, count(*) FILTER (a IS NULL OR b IS NULL) AS violations
FROM (SELECT cust_id, count(*) AS a FROM pii_vault GROUP BY cust_id) FULL JOIN (SELECT cust_id, count(*) AS b FROM master GROUP BY cust_id) USING (cust_id)""",
    """SELECT 'pii_vault' AS table_name, 'rows equal customer' AS check_name,
  CAST(abs((SELECT count(*) FROM pii_vault) - (SELECT count(*) FROM master)) AS BIGINT) AS violations""",
    """SELECT 'churn_features' AS table_name, 'cust_id set equals churn_scores' AS check_name, count(*) FILTER (a IS NULL OR b IS NULL) AS violations
FROM (SELECT cust_id, count(*) AS a FROM features GROUP BY cust_id) FULL JOIN (SELECT cust_id, count(*) AS b FROM scores GROUP BY cust_id) USING (cust_id)""",
    "SELECT s.table_name, 'no raw names' AS check_name, count(DISTINCT l.name) AS violations FROM (SELECT unnest(" + words(_SAFE)
    + """) AS table_name) s
LEFT JOIN (SELECT table_name, name FROM report_texts JOIN (SELECT DISTINCT cust_name AS name FROM pii_vault WHERE len(cust_name) > 3) p
           ON contains(txt, name)) l ON l.table_name = s.table_name GROUP BY s.table_name""",
])


SQL = {
    "masked_customer": statement("SELECT * FROM master"),
    "masked_address": statement("SELECT cust_id, '**, MG Road, ' || city AS address_masked FROM pii_vault"),
    "vault_leak_scan": statement(
        """
SELECT table_name, column_name, name, CAST(sum(n) AS BIGINT) AS leaked_rows
FROM texts JOIN (SELECT DISTINCT cust_name AS name FROM pii_vault WHERE len(cust_name) > 3) p ON contains(txt, name)
GROUP BY ALL""",
        _LEAK_TEXTS,
    ),
    "vault_erasure": statement("""
SELECT cust_id, email FROM pii_vault WHERE cust_id NOT IN (SELECT cust_id FROM scores WHERE risk_tier = 'High')"""),
    "revealed_customers": statement("""
SELECT m.cust_id, m.name_masked, p.cust_name, p.dob FROM master m JOIN pii_vault p ON p.cust_id = m.cust_id"""),
    "dq_summary": _dq("SELECT table_name, rule, count(*) AS rows FROM (" + _union([
        _summary("marked_sales", "sales"), _summary("marked_service", "service"),
        _summary("marked_insurance", "insurance"), _summary("marked_vault", "pii_vault")]) + ") GROUP BY ALL"),
    "dq_rejects": _dq(_union([
        f"SELECT '{name}' AS table_name, row_id, array_to_string(rejects, '; ') AS rules FROM {table} WHERE len(rejects) > 0"
        for table, name in _MARKED_OF.items()])),
    "dq_accepted_service": _dq(
        "SELECT row_id AS smr_id, vin, work_type_id, bill_amount FROM marked_service WHERE len(rejects) = 0"),
    "dq_imputed_bills": _dq("""
SELECT row_id AS smr_id, work_type_id, CASE WHEN bill_amount IS NOT NULL THEN bill_amount
    WHEN work_type_id = 'WT001' THEN 0e0 ELSE m END AS bill_amount, CASE WHEN bill_amount IS NULL THEN 1 ELSE 0 END AS imputed
FROM marked_service JOIN (SELECT work_type_id, median(bill_amount) AS m FROM marked_service WHERE len(rejects) = 0
                          GROUP BY work_type_id) USING (work_type_id) WHERE len(rejects) = 0"""),
    "dq_vocabulary": statement("""
SELECT work_text, CASE WHEN style <> 2 THEN work_type_id END AS std_work_type_id, count(*) AS rows
FROM (SELECT work_type_id, mileage % 4 AS style, CASE mileage % 4 WHEN 0 THEN upper(work_type_name)
        WHEN 1 THEN ' ' || replace(work_type_name, ' ', '-') WHEN 2 THEN work_type_name || ' job' ELSE work_type_name END
        AS work_text FROM service_feed JOIN dim_work_type USING (work_type_id)) GROUP BY ALL"""),
    "bill_median": statement("""
SELECT work_type_id, median(bill_amount) AS median_bill_amount FROM service_feed GROUP BY work_type_id"""),
    "fk_orphans": statement(_FK),
    "fk_orphan_vins": statement(
        """SELECT DISTINCT vin FROM (SELECT CASE WHEN CAST(split_part(smr_id, '-', 3) AS BIGINT) % 61 = 5 THEN 'MA9' || vin[4:]
  ELSE vin END AS vin FROM service_feed) WHERE vin NOT IN (SELECT vin FROM sales)"""),
    "row_minimums": statement(_MINIMUMS),
    "label_rate": statement(_RATE),
    "range_rules": statement(_RANGES),
    "edge_rules": statement(_EDGES),
    "key_sets": statement("""
SELECT count(*) FILTER (b IS NULL) AS left_only, count(*) FILTER (a IS NULL) AS right_only,
  CAST(sum(a) AS BIGINT) AS left_rows, CAST(sum(b) AS BIGINT) AS right_rows
FROM (SELECT cust_id, count(*) AS a FROM service_feed GROUP BY cust_id)
FULL JOIN (SELECT cust_id, count(*) AS b FROM master GROUP BY cust_id) USING (cust_id)"""),
    "validation_report": statement(_REPORT, _REPORT_TEXTS),
    "validation_verdict": statement(
        f"""
SELECT count(*) AS checks, count(*) FILTER (violations > 0) AS failed, bool_and(violations = 0) AS passed FROM ({_REPORT})""",
        _REPORT_TEXTS),
    "audit_hashes": statement(" UNION ALL ".join(_hash(*pair) for pair in [
        ("sales", "sales"), ("service", "service"), ("insurance", "insurance"), ("customer", "master"), ("vehicle", "vehicle"),
        ("churn_features", "features")])),
    "policy_chain": statement("""
SELECT ins_id, vin, n AS ordinal, policy_issue_date, policy_expiry_date + 1 AS next_start,
  CASE WHEN n > 1 THEN policy_issue_date - 365 END AS previous_start, CASE WHEN n > 1 THEN policy_issue_date END AS previous_end,
  policy_issue_date + CASE WHEN n = 1 THEN 1095 ELSE 365 END AS third_party_expiry,
  CAST(policy_issue_date - before AS INTEGER) AS days_after_previous
FROM (SELECT *, row_number() OVER w AS n, lag(policy_expiry_date) OVER w AS before FROM insurance
      WINDOW w AS (PARTITION BY vin ORDER BY policy_issue_date, ins_id))"""),
    "visit_chain": statement("""
SELECT smr_id, vin, n AS ordinal, bill AS running_bill, CAST(visit_date - before AS INTEGER) AS days_since_previous,
  CASE WHEN mileage < km THEN 1 ELSE 0 END AS odometer_back, 'WT00' || least(n, 5) AS scheduled_work_type,
  'MS00' || least(n, 5) AS scheduled_milestone
FROM (SELECT *, row_number() OVER w AS n, lag(visit_date) OVER w AS before, lag(mileage) OVER w AS km,
        sum(bill_amount) OVER (w ROWS UNBOUNDED PRECEDING) AS bill FROM service
      WINDOW w AS (PARTITION BY vin ORDER BY visit_date, smr_id))"""),
    "surrogate_keys": statement("""
SELECT vin, first_seen, 'VEH' || lpad(CAST(row_number() OVER (ORDER BY first_seen, vin) AS VARCHAR), 12, '0') AS vehicle_no
FROM (SELECT vin, min(visit_date) AS first_seen FROM service_feed GROUP BY vin)"""),
    "sequence_keys": statement("""
SELECT ins_id, 'INS' || lpad(CAST(row_number() OVER (ORDER BY policy_issue_date, ins_id) AS VARCHAR), 12, '0')
  AS sequence_id FROM insurance"""),
    "bridge_pairs": statement("SELECT * FROM customer_vehicle"),
    "bridge_shared": statement("""
SELECT 'cust_id' AS side, cust_id AS key, count(DISTINCT vehicle_id) AS distinct_others FROM customer_vehicle
GROUP BY cust_id HAVING count(DISTINCT vehicle_id) > 1
UNION ALL
SELECT 'vehicle_id', vehicle_id, count(DISTINCT cust_id) FROM customer_vehicle
GROUP BY vehicle_id HAVING count(DISTINCT cust_id) > 1"""),
    "unique_vehicles": statement("""
SELECT vin, smr_id, dealer_id, mileage FROM (SELECT *, row_number() OVER (PARTITION BY vin ORDER BY visit_date, smr_id) AS n
FROM service_feed) WHERE n = 1"""),
    "identity_dedup": statement(f"""
SELECT {_PERSON} AS person_token, count(*) AS registrations, min(cust_id) AS first_cust_id FROM registrations
GROUP BY cust_name, mobile_1"""),
    "tokenised_sales": statement(f"""
SELECT sales_id, vin, {_PERSON} AS person_token FROM sales JOIN pii_vault USING (cust_id)"""),
    "vin_fallback_join": statement("""
SELECT f.smr_id, coalesce(v.vehicle_id, e.vehicle_id) AS vehicle_id,
  CASE WHEN v.vin IS NOT NULL THEN 'vin' WHEN e.vin IS NOT NULL THEN 'engine_reg' ELSE 'none' END AS match_kind
FROM (SELECT smr_id, CASE WHEN s % 3 = 0 THEN NULL WHEN s % 7 = 1 THEN 'XX9' || vin[4:] ELSE vin END AS vin,
        engine_prefix || lpad(CAST(k AS VARCHAR), 12, '0') AS engine_no,
        CASE WHEN s % 5 <> 2 THEN 'MH' || lpad(CAST(k % 50 AS VARCHAR), 2, '0') || 'AB' || k END AS reg_no
      FROM (SELECT smr_id, vin, CAST(vin[4:] AS BIGINT) AS k, CAST(split_part(smr_id, '-', 4) AS BIGINT) AS s
            FROM service_feed) JOIN variants ON variant_no = k % 36) f
LEFT JOIN vehicle v ON v.vin = f.vin
LEFT JOIN vehicle e ON v.vin IS NULL AND e.engine_no = f.engine_no AND e.reg_no = f.reg_no"""),
    "fuzzy_names": statement(
        """
SELECT a.name, count(*) AS similar_names, min(b.name) AS first_similar
FROM names a JOIN names b ON levenshtein(a.name, b.name) = 1 GROUP BY a.name""",
        {"names": "SELECT DISTINCT lower(cust_name) AS name FROM pii_vault"},
    ),
    "decision_stats": statement("""
SELECT count(*) AS total, count(*) FILTER (decision = 'Approved') AS approved, count(*) FILTER (decision = 'Refused') AS refused,
  round(100e0 * count(*) FILTER (decision = 'Approved') / count(*), 1) AS approval_pct,
  round(100e0 * count(*) FILTER (decision = 'Refused') / count(*), 1) AS refused_pct FROM decisions"""),
    "decision_classes": statement("""
SELECT decision, CASE decision WHEN 'Approved' THEN 'approved' WHEN 'Refused' THEN 'refused' ELSE 'other' END
  AS decision_class, count(*) AS decisions FROM decisions GROUP BY decision"""),
    "number_validation": statement("SELECT * FROM checked", _NUMBERS),
    "decision_lookup": statement(
        """
SELECT c.search_id, c.raw, CASE WHEN NOT ok THEN 'invalid' WHEN d.digits IS NULL THEN 'not_found' ELSE 'found' END AS status,
  error_code, d.application_number, d.decision, CASE d.decision WHEN 'Approved' THEN 'approved' WHEN 'Refused' THEN 'refused'
    WHEN 'Pending' THEN 'other' END AS decision_class
FROM checked c LEFT JOIN decided d ON d.digits = c.number""",
        _NUMBERS,
    ),
    "decision_nearest": statement(
        """
SELECT search_id, q.number, 'Before' AS nearest_application, d.application_number, d.decision, q.n - d.number AS difference
FROM missed q ASOF JOIN decided d ON q.n > d.number
UNION ALL
SELECT search_id, q.number, 'After', d.application_number, d.decision, d.number - q.n
FROM missed q ASOF JOIN decided d ON q.n < d.number""",
        {**_NUMBERS, "missed": """
SELECT search_id, number, CAST(number AS BIGINT) AS n FROM checked
WHERE ok AND number NOT IN (SELECT digits FROM decided)"""},
    ),
    "grid_clean": """
SELECT 'F' || o_custkey AS file_id, o_orderkey * 2 + 100 AS row_idx,
  lpad(CAST(o_orderkey * 3 % 100000000 AS VARCHAR), 8, '0') AS application_number,
  CASE WHEN o_orderkey % 11 <> 0 THEN CASE o_orderstatus WHEN 'F' THEN 'Approved' WHEN 'O' THEN 'Refused' ELSE 'Pending' END
  END AS decision FROM orders""",
    "grid_headers": """
SELECT DISTINCT 'F' || o_custkey AS file_id, 2 + o_custkey % 5 AS header_row FROM orders""",
    "page_links": """
SELECT page_id, url, CAST(pos - 1 AS INTEGER) AS pos, href, text, regexp_extract(url, '^[a-z]+://[^/?#]*') || href AS link
FROM (SELECT page_id, url, generate_subscripts(a, 1) AS pos, unnest(h) AS href, unnest(a) AS text
      FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1) AS h,
              regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) AS a FROM pages))""",
    "page_first_link": """
SELECT page_id, regexp_extract(url, '^[a-z]+://[^/?#]*') || arg_min(href, pos) AS link, arg_min(text, pos) AS period_label
FROM (SELECT page_id, url, generate_subscripts(a, 1) AS pos, unnest(h) AS href, unnest(a) AS text
      FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)">[^<]*</a>', 1) AS h,
              regexp_extract_all(html, '<a href="[^"]*">([^<]*)</a>', 1) AS a FROM pages))
WHERE contains(text, 'e') AND contains(text, 'n') GROUP BY page_id, url""",
}
assert set(_MARKED) & set(TABLES) == set()

SQL["load_report"] = statement("""
SELECT 'sales' AS table_name, 'mfd_year' AS item, 'cast column' AS finding, 'string to int' AS detail
UNION ALL SELECT 'sales', 'sales', 'rows', CAST(count(*) AS VARCHAR) FROM sales
UNION ALL SELECT 'service', 'part-99999-broken.parquet', 'unreadable file', 'left out'
UNION ALL SELECT 'service', 'service', 'rows', CAST(count(*) AS VARCHAR) FROM service
UNION ALL SELECT 'insurance', 'insurance', 'rows', CAST(count(*) AS VARCHAR) FROM insurance
UNION ALL SELECT 'customer', 'customer', 'rows', CAST(count(*) AS VARCHAR) FROM master
UNION ALL SELECT 'vehicle', 'vehicle', 'missing table', 'vehicle.parquet'""")
