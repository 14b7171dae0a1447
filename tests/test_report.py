"""The validation report: every check is a row, on a set of tables that passes and on one that fails in each new way."""

import pytest
from pyspark.sql import functions as F

from stayline.operators import checks


@pytest.fixture(scope="module")
def clean(star):
    tables = {name: star[name] for name in checks.EXPECTED_TABLES}
    features = tables["churn_features"].where("total_service_visits >= 1")
    tables["churn_features"] = features
    tables["churn_scores"] = tables["churn_scores"].join(features.select("cust_id").distinct(), "cust_id", "left_semi")
    return tables


def failing(rows):
    return {(r.table_name, r.check_name): r.violations for r in rows if r.violations}


def test_clean_tables_pass(clean):
    rows = checks.report(clean).collect()
    assert failing(rows) == {}
    assert len(rows) > 100
    assert checks.verdict(checks.report(clean)).first().passed


def test_each_new_check_fails_alone(spark, clean):
    broken = dict(clean)
    del broken["dim_milestone"]
    one = clean["pii_vault"].first().cust_id
    names = clean["pii_vault"].where((F.col("cust_id") != one) & (F.length("cust_name") > 3)).select("cust_name").limit(2).collect()
    broken["sales"] = clean["sales"].withColumn("cust_name", F.lit("x"))
    leaked = F.when(F.col("smr_id") == clean["service"].first().smr_id, F.lit(f"called {names[0].cust_name} today")).otherwise(F.col("service_advisor"))
    broken["service"] = clean["service"].withColumn("service_advisor", leaked)
    broken["pii_vault"] = clean["pii_vault"].where(F.col("cust_id") != one)
    broken["churn_features"] = clean["churn_features"].withColumn("churn_label", F.lit(1))
    broken["churn_scores"] = clean["churn_scores"].drop("score_date")
    got = failing(checks.report(broken).collect())
    assert got.pop(("dim_milestone", "table exists")) == 1
    assert got.pop(("sales", "no cust_name column")) == 1
    assert got.pop(("service", "no raw names")) == 1
    assert got.pop(("pii_vault", "cust_id set equals customer")) == 1
    assert got.pop(("pii_vault", "rows equal customer")) == 1
    assert got.pop(("churn_features", "churn rate in band")) == 1
    assert got.pop(("churn_features", "churn rate in strict band")) == 1
    assert got.pop(("churn_features", "label 1 is tier High")) > 0  # all labels 1: not all of them are tier High
    assert got.pop(("churn_scores", "columns present")) == 1
    assert got.pop(("churn_scores", "score_date present"), None) is None  # the column is gone: its rule can't be read
    assert got == {}


def test_a_missing_table_is_a_row_not_an_error(clean):
    partial = {name: df for name, df in clean.items() if name not in ("churn_scores", "customer")}
    got = failing(checks.report(partial).collect())
    assert got == {("churn_scores", "table exists"): 1, ("customer", "table exists"): 1}
