"""Check SQL of the twelve catalogued queries, the features, scores and rules."""

from __future__ import annotations

from oracle.base import statement
from stayline.reference_data import WIN_BACK_STRATEGY

# One row per customer with everything the lists show.
_EVERYONE = """
SELECT s.*, m.name_masked, m.mobile_masked, m.city, f.days_since_last_service AS gap, f.days_to_policy_expiry AS expiry,
  f.total_service_visits, f.avg_bill_amount, f.rfm_total, f.num_policy_renewals, f.auto_membership_flag, f.churn_label
FROM scores s JOIN master m ON m.cust_id = s.cust_id JOIN features f ON f.vehicle_id = s.vehicle_id"""
_GAPS = "gap AS days_since_last_service, expiry AS days_to_policy_expiry"


def _list(columns: str, where: str = "true") -> str:
    return statement(f"SELECT cust_id, {columns} FROM everyone WHERE {where}", {"everyone": _EVERYONE})


SQL = {
    "q01_ranked": _list(
        "CASE risk_tier WHEN 'High' THEN '1' WHEN 'Medium' THEN '2' ELSE '3' END AS sort_order, name_masked, city, "
        f"risk_tier, churn_probability, {_GAPS}, churn_label, top_driver_1 AS top_risk_driver, recommended_action"
    ),
    "q02_high_risk": _list(
        "name_masked, mobile_masked, city, churn_probability, gap AS days_since_last_service, expiry AS days_expired_by, "
        "total_service_visits, avg_bill_amount, top_driver_1, top_driver_2, top_driver_3, recommended_action",
        "risk_tier = 'High'",
    ),
    "q03_medium_risk": _list(
        f"name_masked, city, churn_probability, {_GAPS}, rfm_total AS engagement_score, num_policy_renewals, "
        "top_driver_1, recommended_action",
        "risk_tier = 'Medium'",
    ),
    "q04_low_risk": _list(
        f"name_masked, city, churn_probability, total_service_visits, {_GAPS}, rfm_total AS engagement_score, "
        "avg_bill_amount, recommended_action",
        "risk_tier = 'Low'",
    ),
    "q05_tier_summary": statement("""
SELECT risk_tier, n AS customer_count, round(100e0 * n / sum(n) OVER (), 1) AS pct_of_total,
  n * 15000 AS revenue_at_risk_inr, round(p, 4) AS avg_churn_probability, round(g) AS avg_days_since_service,
  round(r, 1) AS avg_rfm_score
FROM (SELECT s.risk_tier, count(*) AS n, avg(churn_probability) AS p, avg(days_since_last_service) AS g,
        avg(rfm_total) AS r FROM scores s JOIN features f ON f.vehicle_id = s.vehicle_id GROUP BY s.risk_tier)"""),
    "q06_top_drivers": statement("""
SELECT driver, count(*) AS times_cited_as_top_driver,
  round(100e0 * count(*) / (SELECT count(*) FROM scores), 1) AS pct_of_customers
FROM (SELECT unnest([top_driver_1, top_driver_2, top_driver_3]) AS driver FROM scores)
GROUP BY driver ORDER BY 2 DESC, 1 LIMIT 10"""),
    "q07_lapsed": _list(
        f"name_masked, city, {_GAPS}, total_service_visits, churn_probability, recommended_action",
        "gap > 365 AND expiry < 0",
    ),
    "q08_never_renewed": _list(
        f"name_masked, city, num_policy_renewals, {_GAPS}, risk_tier, churn_probability", "num_policy_renewals = 0"
    ),
    "q09_by_city": statement("""
SELECT city, count(*) AS total_customers, count(*) FILTER (risk_tier = 'High') AS high_risk,
  count(*) FILTER (risk_tier = 'Medium') AS medium_risk, count(*) FILTER (risk_tier = 'Low') AS low_risk,
  round(100e0 * count(*) FILTER (risk_tier = 'High') / count(*), 1) AS pct_high_risk,
  15000 * count(*) FILTER (risk_tier <> 'Low') AS revenue_at_risk_inr
FROM scores JOIN master USING (cust_id) GROUP BY city"""),
    "q10_by_model": statement("""
SELECT model, count(DISTINCT s.cust_id) AS customers, count(*) FILTER (s.risk_tier = 'High') AS high_risk,
  count(*) FILTER (s.risk_tier = 'Medium') AS medium_risk, count(*) FILTER (s.risk_tier = 'Low') AS low_risk,
  round(avg(s.churn_probability), 4) AS avg_churn_prob,
  round(avg(f.days_since_last_service)) AS avg_days_since_service
FROM scores s JOIN features f ON f.vehicle_id = s.vehicle_id JOIN sales x ON x.cust_id = s.cust_id
JOIN vehicle v ON v.vin = x.vin GROUP BY model"""),
    "q11_cancellations": statement("""
SELECT v.cust_id, m.name_masked, m.city, count(*) AS total_visits,
  count(*) FILTER (v.status = 'Cancelled') AS cancelled,
  round(100e0 * count(*) FILTER (v.status = 'Cancelled') / count(*), 1) AS cancel_rate_pct, s.risk_tier,
  s.churn_probability
FROM service v JOIN master m ON m.cust_id = v.cust_id JOIN scores s ON s.cust_id = v.cust_id
GROUP BY ALL HAVING count(*) FILTER (v.status = 'Cancelled') > 0"""),
    "q12_recoverable": _list(
        f"name_masked, city, {_GAPS}, num_policy_renewals, auto_membership_flag, risk_tier, churn_probability, "
        f"'{WIN_BACK_STRATEGY}' AS strategy",
        "gap > 180 AND expiry >= 0",
    ),
    "features": statement("SELECT * FROM features"),
    "scores": statement("SELECT * FROM scores"),
    "feature_details": statement("""
SELECT cust_id, vin, days_to_first_service, policy_expired, pucc_expired FROM facts"""),
    "rfm_scores": statement("""
SELECT recency_score, frequency_score, monetary_score, rfm_total, count(*) AS customers
FROM features GROUP BY ALL"""),
    "tier_crosstab": statement("""
SELECT a AS by_features, b AS by_score, c AS by_baseline, d AS by_legend, count(*) AS customers,
  CASE WHEN a = b AND b = c AND c = d THEN 1 ELSE 0 END AS agree
FROM (SELECT f.risk_tier AS a, s.risk_tier AS b,
        CASE WHEN gap > 365 AND exp < 0 THEN 'High' WHEN gap > 180 OR vis = 1 THEN 'Medium' ELSE 'Low' END AS c,
        CASE WHEN gap > 365 AND exp < 0 THEN 'High' WHEN gap > 180 OR exp < 30 THEN 'Medium' ELSE 'Low' END AS d
      FROM (SELECT *, days_since_last_service AS gap, days_to_policy_expiry AS exp, total_service_visits AS vis
            FROM features) f JOIN scores s USING (vehicle_id))
GROUP BY a, b, c, d"""),
}
