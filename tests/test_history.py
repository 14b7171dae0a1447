"""Monthly snapshots and the model history: month ends, carried facts, the drift gate and stored versions."""

import datetime as dt
import random

from pyspark.sql import functions as F

from stayline.plans import history, models


def test_month_ends():
    assert history.month_ends(dt.date(1999, 12, 31), 3) == [dt.date(1999, 10, 31), dt.date(1999, 11, 30), dt.date(1999, 12, 31)]
    assert history.month_ends(dt.date(2000, 3, 5), 2) == [dt.date(2000, 2, 29), dt.date(2000, 3, 31)]


def test_snapshots_carry_facts_forward(spark):
    day = dt.date
    sales = spark.createDataFrame(
        [("V1", "C1", day(1999, 10, 15), 1995, "Y"), ("V2", "C2", day(1999, 12, 1), 1999, "N")],
        "vin string, cust_id string, sale_date date, mfd_year int, finance_flag string",
    )
    service = spark.createDataFrame(
        [("S1", "V1", day(1999, 10, 20), "WT002", "Completed", 300.0), ("S2", "V1", day(1999, 10, 20), "WT001", "Cancelled", 0.0),
         ("S3", "V1", day(1999, 12, 5), "WT003", "Completed", 900.0), ("S4", "V1", day(1999, 9, 1), "WT002", "Completed", 50.0),
         ("S5", "V1", day(2000, 1, 5), "WT002", "Completed", 70.0)],
        "smr_id string, vin string, visit_date date, work_type_id string, status string, bill_amount double",
    )
    insurance = spark.createDataFrame(
        [("I1", "V1", day(1999, 10, 15), day(1999, 11, 14), "Y", 8000.0), ("I2", "V1", day(1999, 11, 15), day(2000, 11, 14), "N", 9500.0),
         ("I3", "V2", day(2000, 1, 2), day(2001, 1, 1), "N", 7000.0)],
        "ins_id string, vin string, policy_issue_date date, policy_expiry_date date, auto_membership string, total_premium double",
    )
    got = {(r.vin, r.month_end): r for r in history.monthly_snapshots(sales, service, insurance, day(1999, 12, 31), 3).collect()}
    assert sorted(got) == [("V1", day(1999, 10, 31)), ("V1", day(1999, 11, 30)), ("V1", day(1999, 12, 31)), ("V2", day(1999, 12, 31))]
    october, november, december = (got[("V1", day(1999, m, d))] for m, d in ((10, 31), (11, 30), (12, 31)))
    assert (october.total_service_visits, october.avg_bill_amount, october.cancelled_visit_flag) == (2, 300.0, 1)
    assert (october.num_policy_renewals, october.days_to_policy_expiry, october.auto_membership_flag, october.premium_trend) == (0, 14, 1, 0.0)
    assert (november.total_service_visits, november.num_policy_renewals, november.premium_trend) == (2, 1, 1500.0)
    assert (december.total_service_visits, december.avg_bill_amount, december.days_since_last_service) == (3, 600.0, 26)
    v2 = got[("V2", day(1999, 12, 31))]
    assert (v2.total_service_visits, v2.days_since_last_service, v2.days_to_policy_expiry, v2.churn_label) == (0, 30, None, 0)


def _month(end, n, flipped, seed):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        visits = rng.randrange(0, 8)
        churn = (visits < 3) != flipped if rng.random() < 0.9 else rng.random() < 0.5
        rows.append((end, f"C{i:05d}", f"V{i:05d}", 3, "Y" if i % 2 else "N", visits, 100, 2000.0 + 10 * visits, 0.5, 0, 1, -5, 0, 0.0, 2, min(5, max(1, visits)), 1, int(churn)))
    return rows


def auc(pairs):
    pos = [p for p, y in pairs if y == 1]
    neg = [p for p, y in pairs if y == 0]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


def test_history_retrains_only_on_drift(spark):
    schema = ", ".join(f"{c} {t}" for c, t in zip(history.SNAPSHOT_COLUMNS, [
        "date", "string", "string", "int", "string", "long", "int", "double", "double", "int", "int", "int", "int", "double", "int", "int", "int", "int"]))
    ends = [dt.date(1999, m, 28) for m in (1, 2, 3, 4, 5)]
    rows = [(ends[0], f"C{i:05d}", f"V{i:05d}", 3, "Y", 1, 100, 2000.0, 0.5, 0, 1, -5, 0, 0.0, 2, 1, 1, 0) for i in range(300)]  # one class only
    rows += _month(ends[1], 600, False, 1) + _month(ends[2], 600, False, 2) + _month(ends[3], 600, True, 3) + _month(ends[4], 600, True, 4)
    snapshots = spark.createDataFrame(rows, schema)
    got = {r.month_end: r for r in history.model_history(snapshots).collect()}
    assert got[ends[0]].version is None and got[ends[0]].label_rate == 0.0
    assert (got[ends[1]].version, got[ends[1]].promoted, got[ends[1]].retrain) == (1, 1, 0)
    assert (got[ends[2]].version, got[ends[2]].retrain) == (1, 0)
    flipped = got[ends[3]]
    assert flipped.retrain == 1 and flipped.auc < 0.5 < flipped.challenger_auc and flipped.promoted == 1
    assert (got[ends[4]].version, got[ends[4]].retrain, got[ends[4]].baseline_auc) == (2, 0, flipped.challenger_auc)
    # the reported AUC is that of version 1 on the month's test split, recomputed plainly
    first = models.fit(snapshots.where(F.col("month_end") == ends[1]))
    scored = models.score(first, snapshots.where(F.col("month_end") == ends[2])).where("NOT is_train").collect()
    assert abs(auc([(r.churn_probability, r.churn_label) for r in scored]) - got[ends[2]].auc) < 1e-6


def test_a_version_scores_its_months_in_one_pass(spark, monkeypatch):
    schema = ", ".join(f"{c} {t}" for c, t in zip(history.SNAPSHOT_COLUMNS, [
        "date", "string", "string", "int", "string", "long", "int", "double", "double", "int", "int", "int", "int", "double", "int", "int", "int", "int"]))
    ends = [dt.date(1999, m, 28) for m in (1, 2, 3)]
    snapshots = spark.createDataFrame([r for n, end in enumerate(ends) for r in _month(end, 300, False, n)], schema)
    scored, plain = [], models.score
    monkeypatch.setattr(models, "score", lambda fitted, rows: scored.append(1) or plain(fitted, rows))
    got = history.model_history(snapshots).collect()
    assert [r.version for r in got] == [1, 1, 1] and all(r.auc is not None for r in got)
    assert len(scored) == 1 + sum(r.retrain for r in got) + sum(r.promoted for r in got[1:])
