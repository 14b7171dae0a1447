"""Check SQL of publication, customer view and moist air."""

from __future__ import annotations

from oracle.base import TABLES, half_up, statement
from stayline.plans.view360 import SUMMARY_FIELDS

from stayline.reference_data import TIER_ICONS

_ICON = "CASE s.risk_tier " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in TIER_ICONS.items()) + " END"
_BAND = "CASE WHEN {0} THEN 'High' WHEN {1} THEN 'Medium' ELSE 'Low' END"

# -- moist air: formulas as DuckDB macros in text form ---------------------------------------------


def p_sat(t: str) -> str:
    k = f"({t} + 273.15e0)"
    water = (f"-5800.2206e0 / {k} + 1.3914993e0 - 0.048640239e0 * {k} + 4.1764768e-5 * {k} ** 2 "
             f"- 1.4452093e-8 * {k} ** 3 + 6.5459673e0 * ln({k})")
    ice = (f"-5674.5359e0 / {k} + 6.3925247e0 - 0.009677843e0 * {k} + 6.2215701e-7 * {k} ** 2 "
           f"+ 2.0747825e-9 * {k} ** 3 - 9.484024e-13 * {k} ** 4 + 4.1635019e0 * ln({k})")
    return f"exp(CASE WHEN {t} >= 0 THEN {water} ELSE {ice} END)"


def w_rh(t: str, phi: str) -> str:
    pv = f"({p_sat(t)} * {phi})"
    return f"greatest(1e-7, 0.621945e0 * {pv} / (101325e0 - {pv}))"


def w_wb(t: str, wb: str) -> str:
    return (f"greatest(1e-7, ((2501e0 - 2.381e0 * {wb}) * {w_rh(wb, '1e0')} - 1.006e0 * ({t} - {wb})) "
            f"/ (2501e0 + 1.86e0 * {t} - 4.186e0 * {wb}))")


def w_v(t: str, v: str) -> str:
    return f"greatest(1e-7, ({v} * 101325e0 / (287.042e0 * ({t} + 273.15e0)) - 1e0) / 1.6078e0)"


def h_of(t: str, w: str) -> str:
    return f"(1.006e0 * {t} + {w} * (2501e0 + 1.86e0 * {t}))"


def v_of(t: str, w: str) -> str:
    return f"(287.042e0 * ({t} + 273.15e0) * (1e0 + 1.6078e0 * {w}) / 101325e0)"


def pv_of(w: str) -> str:
    return f"({w} * 101325e0 / (0.621945e0 + {w}) / 1000e0)"


_SOLVED = {
    "ratio": f"""
SELECT *, CASE kind WHEN 'WBT' THEN {w_wb('dbt', 'value')} WHEN 'DPT' THEN {w_rh('value', '1e0')}
    WHEN 'RH' THEN {w_rh('dbt', '(value / 100e0)')} WHEN 'W' THEN greatest(1e-7, value) ELSE {w_v('dbt', 'value')} END AS w
FROM readings""",
}


def bisected(steps: str, source: str, t: str, w: str) -> dict[str, str]:
    """Sixty halvings of both brackets for every row of ``source``, as a recursive table ``steps``."""
    wm, dm = "(wl + wh) / 2", "(dl + dh) / 2"
    return {
        steps: f"""
SELECT reading_id, 0 AS i, {t} AS t, {w} AS w, greatest(-50e0, {t} - 60e0) AS wl, {t} AS wh, -60e0 AS dl, 90e0 AS dh
FROM {source}
UNION ALL
SELECT reading_id, i + 1, t, w, CASE WHEN wet > w THEN wl ELSE wm END, CASE WHEN wet > w THEN wm ELSE wh END,
  CASE WHEN dew < w THEN dm ELSE dl END, CASE WHEN dew < w THEN dh ELSE dm END
FROM (SELECT *, {w_wb('t', 'wm')} AS wet, {w_rh('dm', '1e0')} AS dew
      FROM (SELECT *, {wm} AS wm, {dm} AS dm FROM {steps} WHERE i < 60))""",
        f"{steps}_state": f"""
SELECT reading_id, {half_up('t', 2)} AS dbt, {half_up('(wl + wh) / 2', 2)} AS wbt, {half_up('(dl + dh) / 2', 2)} AS dpt,
  {half_up('greatest(0e0, least(1e0, w / ws)) * 100e0', 1)} AS rh, {half_up('w', 6)} AS w, {half_up(h_of('t', 'w'), 3)} AS h,
  {half_up(v_of('t', 'w'), 4)} AS v, {half_up(pv_of('w'), 4)} AS pv, {half_up('w / ws', 4)} AS mu
FROM (SELECT *, {w_rh('t', '1e0')} AS ws FROM {steps} WHERE i = 60)""",
    }


_FIRST = {**_SOLVED, **bisected("halving", "ratio", "dbt", "w")}
_MIXED_W = "(m1 * w + ow) / (m1 + 1e0)"
_MIXED_H = "(m1 * h + oh) / (m1 + 1e0)"
_RUNS = {
    **_FIRST,
    "runs": f"""
SELECT *, reading_id % 8 AS kind, reading_id % 16 < 8 AS use_w, CASE WHEN reading_id % 16 < 8 THEN 2e0 ELSE 1e0 END AS m1,
  0.012e0 AS ow, {half_up(h_of('30e0', '0.012e0'), 3)} AS oh FROM halving_state""",
    "aimed": f"""
SELECT *, {_MIXED_W} AS wm, {_MIXED_H} AS hm,
  CASE kind WHEN 0 THEN dbt + 10e0 WHEN 1 THEN dbt - 5e0 WHEN 4 THEN dbt - 8e0 WHEN 5 THEN dbt + 8e0
    WHEN 6 THEN (dbt + wbt) / 2e0 END AS p1 FROM runs""",
    "target": f"""
SELECT *, CASE WHEN kind IN (2, 3) THEN dbt WHEN kind = 7 THEN (hm - 2501e0 * wm) / (1.006e0 + 1.86e0 * wm) ELSE p1 END AS t2,
  greatest(1e-7, CASE WHEN kind IN (0, 1) THEN w WHEN kind IN (2, 3) AND use_w THEN w + 0.001e0
    WHEN kind IN (2, 3) THEN {w_rh('dbt', '0.6e0')} WHEN kind IN (4, 5) AND use_w THEN 0.004e0
    WHEN kind IN (4, 5) THEN {w_rh('p1', '0.5e0')} WHEN kind = 6 THEN {w_wb('p1', 'wbt')} ELSE wm END) AS w2
FROM aimed""",
    **bisected("second", "target", "t2", "w2"),
}
_TYPE = ("['SENSIBLE_HEATING', 'SENSIBLE_COOLING', 'HUMIDIFICATION', 'DEHUMIDIFICATION', 'COOLING_DEHUMIDIFICATION', "
         "'HEATING_HUMIDIFICATION', 'EVAPORATIVE_COOLING', 'ADIABATIC_MIXING'][1 + reading_id % 8]")


def _metric(kind: int, name: str, value: str) -> str:
    return f"SELECT reading_id, '{name}' AS metric, {value} AS value FROM both_states WHERE kind = {kind}"


_METRICS = " UNION ALL ".join([
    _metric(0, "heat_added", "bh - h"), _metric(0, "delta_t", "p1 - dbt"), _metric(0, "w_constant", "w"),
    _metric(1, "heat_removed", "h - bh"), _metric(1, "delta_t", "dbt - p1"), _metric(1, "w_constant", "w"),
    _metric(2, "moisture_added", "bw - w"), _metric(2, "enthalpy_change", "bh - h"), _metric(2, "dbt_constant", "dbt"),
    _metric(3, "moisture_removed", "w - bw"), _metric(3, "enthalpy_change", "bh - h"), _metric(3, "dbt_constant", "dbt"),
    _metric(4, "total_heat_removed", "h - bh"), _metric(4, "sensible_heat_removed", "1.006e0 * (dbt - bt)"),
    _metric(4, "latent_heat_removed", "2501e0 * (w - bw)"), _metric(4, "moisture_removed", "w - bw"),
    _metric(5, "total_heat_added", "bh - h"), _metric(5, "moisture_added", "bw - w"), _metric(5, "delta_t", "bt - dbt"),
    _metric(6, "temperature_drop", "dbt - bt"), _metric(6, "moisture_added", "bw - w"), _metric(6, "wbt_constant", "wbt"),
    _metric(6, "enthalpy_change", "bh - h"),
    _metric(7, "mixed_dbt", "t2"), _metric(7, "mixed_w", "wm"), _metric(7, "mixed_h", "hm"), _metric(7, "mass_1", "m1"),
    _metric(7, "mass_2", "1e0"),
])

# Ties are rounded half up on the decimal digits of the number, not on its binary value.
_PRINTED = """CASE WHEN metric IN ('mass_1', 'mass_2') THEN CAST(value AS VARCHAR)
  WHEN metric IN ('delta_t', 'dbt_constant', 'wbt_constant', 'temperature_drop', 'mixed_dbt') THEN CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(18, 2)) AS VARCHAR)
  WHEN metric IN ('w_constant', 'moisture_added', 'moisture_removed', 'mixed_w') THEN CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(18, 6)) AS VARCHAR)
  ELSE CAST(CAST(CAST(value AS VARCHAR) AS DECIMAL(18, 3)) AS VARCHAR) END"""

_CURVE_ROWS = "SELECT 'saturation' AS family, 1e0 AS param, 300 AS steps" + "".join(
    f" UNION ALL SELECT '{family}', {value}, 200"
    for family, value in [("rh", f"{p / 100}e0") for p in range(10, 100, 10)]
    + [("wbt", f"{p}e0") for p in range(-5, 31, 5)]
    + [("h", f"{p}e0") for p in range(-10, 121, 10)]
    + [("v", f"{p}e0") for p in (0.8, 0.84, 0.88, 0.92)]
)

_SECTIONS = """
SELECT cust_id, 1 AS section_no, 'customer' AS section, CAST(NULL AS DATE) AS item_date, cust_id AS item_id FROM master
UNION ALL SELECT s.cust_id, 2, 'vehicle', NULL, v.vehicle_id FROM sales s JOIN vehicle v ON v.vin = s.vin
UNION ALL SELECT cust_id, 3, 'sales', sale_date, sales_id FROM sales
UNION ALL SELECT cust_id, 4, 'service', visit_date, smr_id FROM service
UNION ALL SELECT cust_id, 5, 'insurance', policy_issue_date, ins_id FROM insurance
UNION ALL SELECT cust_id, 6, 'churn_features', NULL, vehicle_id FROM features
UNION ALL SELECT cust_id, 7, 'churn_scores', NULL, cust_id FROM scores"""

SQL = {
    "publish_ranked": statement(f"""
SELECT row_number() OVER (ORDER BY CASE s.risk_tier WHEN 'High' THEN 1 WHEN 'Medium' THEN 2 ELSE 3 END,
    s.churn_probability DESC, s.cust_id) AS rank, s.cust_id, m.name_masked, m.city, v.model, v.variant,
  printf('%.4f', s.churn_probability) AS churn_prob, s.risk_tier, {_ICON} AS tier_label, f.days_since_last_service,
  {_BAND.format('f.days_since_last_service > 365', 'f.days_since_last_service > 180')} AS gap_band,
  f.days_to_policy_expiry || CASE WHEN f.days_to_policy_expiry < 0 THEN ' (EXPIRED)' ELSE '' END AS policy_expiry,
  {_BAND.format('f.days_to_policy_expiry < 0', 'f.days_to_policy_expiry < 30')} AS expiry_band,
  s.top_driver_1, s.top_driver_2, s.top_driver_3, s.recommended_action
FROM scores s LEFT JOIN master m ON m.cust_id = s.cust_id LEFT JOIN features f ON f.vehicle_id = s.vehicle_id
LEFT JOIN vehicle v ON v.vehicle_id = s.vehicle_id"""),
    "publish_summary": statement("""
SELECT n AS total_customers, a AS high_risk, b AS medium_risk, c AS low_risk, a * 100 // n AS high_pct,
  b * 100 // n AS medium_pct, c * 100 // n AS low_pct, a * 15000 AS revenue_at_risk_inr
FROM (SELECT count(*) AS n, count(*) FILTER (risk_tier = 'High') AS a, count(*) FILTER (risk_tier = 'Medium') AS b,
        count(*) FILTER (risk_tier = 'Low') AS c FROM scores)"""),
    "customer_360": statement("""
SELECT m.cust_id, m.name_masked, m.city, coalesce(o.n, 0) AS vehicle_rows, coalesce(s.n, 0) AS sales_rows,
  coalesce(v.n, 0) AS service_rows, coalesce(i.n, 0) AS insurance_rows, s.d AS last_sales, v.d AS last_service,
  i.d AS last_insurance
FROM master m
LEFT JOIN (SELECT cust_id, count(*) AS n FROM sales JOIN vehicle USING (vin) GROUP BY cust_id) o ON o.cust_id = m.cust_id
LEFT JOIN (SELECT cust_id, count(*) AS n, max(sale_date) AS d FROM sales GROUP BY cust_id) s ON s.cust_id = m.cust_id
LEFT JOIN (SELECT cust_id, count(*) AS n, max(visit_date) AS d FROM service GROUP BY cust_id) v ON v.cust_id = m.cust_id
LEFT JOIN (SELECT cust_id, count(*) AS n, max(policy_expiry_date) AS d FROM insurance GROUP BY cust_id) i
  ON i.cust_id = m.cust_id"""),
    "customer_sections": statement(_SECTIONS),
    "customer_summary": statement(
        "SELECT cust_id, unnest([" + ", ".join(f"'{field}'" for field in SUMMARY_FIELDS) + "]) AS field, unnest(["
        + ", ".join(f"coalesce(CAST({c} AS VARCHAR), '')" for c in SUMMARY_FIELDS.values()) + "]) AS value FROM wide_row",
        {"wide_row": """
SELECT m.cust_id, m.name_masked, m.city, m.state, s.* EXCLUDE (cust_id), f.* EXCLUDE (cust_id, vehicle_id, risk_tier)
FROM master m LEFT JOIN scores s ON s.cust_id = m.cust_id LEFT JOIN features f ON f.vehicle_id = s.vehicle_id"""},
    ),
    "dimension_lookup": statement("""
SELECT work_type_name, pay_mode_name, description, milestone_name, dealer_name, count(*) AS visits, sum(bill_amount) AS billed
FROM service_feed LEFT JOIN dim_work_type USING (work_type_id) LEFT JOIN dim_pay_mode USING (pay_mode_id)
LEFT JOIN dim_cancel_reason USING (cancel_reason_id) LEFT JOIN dim_milestone USING (milestone_id)
LEFT JOIN dim_dealer USING (dealer_id) GROUP BY ALL"""),
    "sql_on_views": statement("""
SELECT dealer_name, city, count(DISTINCT cust_id) AS customers, sum(total_premium) AS premium
FROM insurance JOIN dim_dealer USING (dealer_id) WHERE cust_id IN (SELECT cust_id FROM scores WHERE risk_tier = 'High')
GROUP BY dealer_name, city"""),
    "grid_without_notes": """
SELECT 'F' || o_custkey AS file_id, count(*) + 2 AS lines, count(*) FILTER (o_orderkey % 11 <> 0) + 2 AS with_decision
FROM orders GROUP BY o_custkey""",
    "model_variants": statement("""
SELECT model, variant, cc, transmission, body_type, count(*) AS vehicles FROM vehicle GROUP BY ALL"""),
    "customer_vehicles": statement("""
SELECT vehicle_id, vin, model, variant FROM vehicle WHERE vin IN (
  SELECT vin FROM sales WHERE cust_id IN (SELECT cust_id FROM scores WHERE risk_tier = 'High'))"""),
    "air_closed_forms": statement(
        f"""
SELECT reading_id, kind, {half_up('w', 9)} AS w, {half_up('p', 5)} AS p_sat,
  {half_up('greatest(0e0, least(1e0, w / ws))', 8)} AS rh, {half_up('w / ws', 8)} AS mu, {half_up(h_of('dbt', 'w'), 6)} AS h,
  {half_up(v_of('dbt', 'w'), 8)} AS v, {half_up(pv_of('w'), 8)} AS pv
FROM (SELECT *, {p_sat('dbt')} AS p, {w_rh('dbt', '1e0')} AS ws FROM ratio)""",
        _SOLVED,
    ),
    "air_state": statement("SELECT *, CAST(NULL AS VARCHAR) AS error FROM halving_state", _FIRST, recursive=True),
    "air_processes": statement(
        f"SELECT *, {_TYPE} AS process_type, CAST(NULL AS VARCHAR) AS error FROM second_state", _RUNS, recursive=True
    ),
    "air_process_metrics": statement(
        f"SELECT reading_id, {_TYPE} AS process_type, metric, {half_up('value', 6)} AS value, {_PRINTED} AS printed "
        f"FROM ({_METRICS})",
        {**_RUNS, "both_states": """
SELECT a.*, b.dbt AS bt, b.w AS bw, b.h AS bh FROM target a JOIN second_state b USING (reading_id)"""},
        recursive=True,
    ),
    "air_mixing": statement(
        f"""
SELECT user_id, m AS mass, {half_up('(hm - 2501e0 * wm) / (1.006e0 + 1.86e0 * wm)', 2)} AS dbt_mix,
  {half_up('wm', 6)} AS w_mix, {half_up('hm', 3)} AS h_mix
FROM (SELECT user_id, sum(m) AS m, sum(m * w) / sum(m) AS wm, sum(m * h) / sum(m) AS hm
      FROM (SELECT user_id, 1e0 + reading_id % 3 AS m, {half_up('w', 6)} AS w, {half_up(h_of('dbt', 'w'), 3)} AS h FROM ratio)
      GROUP BY user_id)""",
        _SOLVED,
    ),
    "air_curves": statement(
        f"""
SELECT user_id, family, param, count(*) AS points, {half_up('min(t)', 6)} AS first_dbt, {half_up('max(t)', 6)} AS last_dbt,
  {half_up('min(w)', 8)} AS least_w, {half_up('max(w)', 8)} AS most_w
FROM (SELECT *, CASE WHEN family IN ('saturation', 'rh') THEN {w_rh('t', 'param')} WHEN family = 'wbt' THEN {w_wb('t', 'param')}
        WHEN family = 'v' THEN {w_v('t', 'param')}
        WHEN 2501e0 + 1.86e0 * t > 0 THEN (param - 1.006e0 * t) / (2501e0 + 1.86e0 * t) END AS w
      FROM (SELECT *, low + i * (hi - low) / steps AS t
            FROM (SELECT *, CASE WHEN family = 'wbt' THEN greatest(param, lo) ELSE lo END AS low,
                    unnest(range(0, steps + 1)) AS i FROM charts CROSS JOIN curve_rows))
      WHERE family <> 'wbt' OR t >= param)
WHERE w BETWEEN 0 AND 0.031e0 GROUP BY ALL""",
        {"charts": "SELECT user_id, min(dbt) AS lo, max(dbt) AS hi FROM readings GROUP BY user_id",
         "curve_rows": _CURVE_ROWS},
    ),
    "air_history": statement(
        """
SELECT user_id, label, reading_id, dbt FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, reading_id DESC) AS place FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, label ORDER BY ts DESC, reading_id DESC) AS again FROM (
      SELECT user_id, ts, reading_id, dbt, coalesce(given, 'P' || count(*) FILTER (given IS NULL) OVER (
          PARTITION BY user_id ORDER BY ts, reading_id ROWS UNBOUNDED PRECEDING)) AS label
      FROM actions WHERE clears_left = 0))
  WHERE again = 1) WHERE place <= 6""",
        {"actions": """
SELECT * FROM (SELECT user_id, ts, reading_id, dbt, event_type, CASE WHEN event_type = 'purchase' THEN
    CASE WHEN reading_id % 2 = 0 THEN 'State 1' ELSE 'State 2' END END AS given,
  count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id ORDER BY ts, reading_id
    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS clears_left FROM readings) WHERE event_type <> 'error'"""},
    ),
    "point_labels": statement("""
SELECT user_id, reading_id, 'P' || row_number() OVER (PARTITION BY user_id ORDER BY CAST(ts AS DATE), reading_id) AS label
FROM readings WHERE event_type NOT IN ('error', 'purchase')"""),
}
assert not set(_RUNS) & set(TABLES)

SQL["sink_published"] = SQL["publish_ranked"]  # the newest checked version holds exactly what was ranked
SQL["sink_documents"] = SQL["customer_sections"]
SQL["sink_csv"] = statement("SELECT ins_id, vin, policy_issue_date, policy_expiry_date, total_premium FROM insurance")
SQL["sink_tables"] = statement("""
SELECT 'sales' AS table_name, count(*) AS rows FROM sales UNION ALL SELECT 'insurance', count(*) FROM insurance
UNION ALL SELECT 'customer', count(*) FROM master""")
SQL["customer_pages"] = statement(
    "SELECT *, (item_no - 1) // 50 + 1 AS page FROM (SELECT *, row_number() OVER (PARTITION BY cust_id ORDER BY section_no, "
    "item_date DESC NULLS LAST, item_id) AS item_no FROM items)",
    {"items": _SECTIONS},
)
