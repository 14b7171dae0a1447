"""Plans, sinks, loading and the whole chain."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from stayline.operators import checks
from stayline.plans import catalog, features, models, publish, view360
from stayline.plans.pipeline import Pipeline
from stayline.schemas import FACTS, TABLES
from stayline.session import staged_path
from stayline.sinks import writers
from stayline.sources import tables as loading
from tests.conftest import AS_OF


@pytest.fixture(scope="module")
def built(spark, star):
    folder = staged_path(spark, "pipeline")
    pipeline = Pipeline(spark, folder, AS_OF)
    verdict = pipeline.run(star).first()
    return pipeline, verdict


def test_projection_has_the_declared_schemas(star):
    for name in ["sales", "service", "insurance", "customer", "vehicle", "customer_vehicle", "pii_vault", "churn_features", "churn_scores"]:
        assert [(f.name, f.dataType) for f in star[name].schema] == [(f.name, f.dataType) for f in TABLES[name]], name
    for name in FACTS:
        assert checks.missing_columns(star[name], TABLES[name].fieldNames()) == {"missing": [], "forbidden": []}


def test_unknown_query_raises(star):
    with pytest.raises(KeyError):
        catalog.run("Q99", star)
    assert len(catalog.CATALOG) == 12


def test_pipeline_end_to_end(spark, built):
    pipeline, verdict = built
    assert verdict.checks > 60
    failed = {(r.table_name, r.check_name) for r in pipeline["validation"].where("violations > 0").collect()}
    # The derived data has vehicles without an accepted visit; nothing else may fail.
    assert failed <= {("churn_features", "total_service_visits at least 1")}
    steps = {r.step for r in spark.read.parquet(pipeline.path("audit")).collect()}
    assert steps == {"ingest", "check", "star", "features", "scores", "publish", "validate"}
    results = writers.read_current(spark, pipeline.path("churn_results"))
    n = results.count()
    assert n == pipeline["churn_scores"].count()
    assert results.agg(F.min("rank"), F.max("rank"), F.countDistinct("rank")).first()[:] == (1, n, n)


def test_stored_and_derived_tables_give_the_same_reports(built, star, rows):
    pipeline, _ = built
    loaded, missing = loading.load_all(pipeline.spark, pipeline.folder)
    assert set(missing) == {"decisions"}
    accepted = {**loaded}
    for query_id in ("Q5", "Q9"):
        assert catalog.run(query_id, accepted).count() == catalog.run(query_id, star).count()
    again = features.churn_features(loaded["sales"], loaded["service"], loaded["insurance"], loaded["vehicle"], AS_OF)
    assert rows(again) == rows(loaded["churn_features"])
    assert "churn_scores" in loading.register(loaded)
    assert pipeline.spark.sql("SELECT count(*) AS n FROM churn_scores WHERE risk_tier = 'High'").first().n > 0


def test_csv_round_trip_types_the_text(spark, star, rows):
    folder = staged_path(spark, "csv")
    part = star.insurance.limit(50)
    writers.write_csv(part, f"{folder}/insurance.csv")
    back = loading.load_table(spark, folder, "insurance", "csv")
    assert back.schema["policy_issue_date"].dataType.simpleString() == "date"
    assert rows(back, "ins_id", "policy_expiry_date", "total_premium") == rows(part, "ins_id", "policy_expiry_date", "total_premium")
    odd = spark.createDataFrame([(1,)], ["  Days Since\nLast Service "])
    assert loading.clean_names(odd).columns == ["days_since_last_service"]


def test_customer_document(star):
    key = star.sales.select("cust_id").first().cust_id
    doc = view360.document(star, f"  {key.lower()} ").collect()
    assert [r.section_no for r in doc] == sorted(r.section_no for r in doc)
    assert {"customer", "vehicle", "sales", "insurance", "churn_features", "churn_scores"} <= {r.section for r in doc}
    assert "pii_vault" not in {r.section for r in doc}
    dates = [r.item_date for r in doc if r.section == "insurance"]
    assert dates == sorted(dates, reverse=True)
    assert "cust_name" in json.loads([r.item for r in view360.document(star, key, show_pii=True).collect() if r.section == "pii_vault"][0])
    assert [r.section for r in view360.document(star, "nobody").collect()] == ["not_found"]
    assert view360.summary(star, key).count() == 14


def test_document_files(spark, star):
    path = staged_path(spark, "documents")
    everything = view360.sections(star)
    writers.write_documents(everything, path)
    assert writers.read_current(spark, path, "json").count() == everything.count()


def test_publish_keeps_scores_without_partner(spark, star):
    stranger = star.churn_scores.limit(1).withColumns({"cust_id": F.lit("CUSTX"), "vehicle_id": F.lit("VEHX")})
    t = {n: star[n] for n in ("customer", "churn_features", "sales", "vehicle")} | {"churn_scores": star.churn_scores.unionByName(stranger)}
    row = publish.ranked_results(t).where("cust_id = 'CUSTX'").first()
    assert row.days_since_last_service == 0 and row.model is None


def test_features_of_a_hand_made_vehicle(spark):
    day = lambda y, m, d: dt.date(y, m, d)
    sales = spark.createDataFrame([("S", "C", "D", "V", 2015, None, None, day(2016, 2, 1), "Y", "B", day(2015, 5, 1), None, None, None)], TABLES["sales"])
    visit = lambda i, w, d, s, a: (i, "C", "D", "V", w, None, d, None, s, None, a, 1, None, None)
    service = spark.createDataFrame(
        [visit("1", "WT001", day(2015, 6, 1), "Completed", 0.0), visit("2", "WT002", day(2016, 6, 1), "Cancelled", 3000.0),
         visit("3", "WT003", day(2017, 6, 1), "Completed", 9001.0), visit("4", "WT002", day(2015, 4, 1), "Completed", 99.0),
         visit("5", "WT002", day(2019, 4, 1), "Completed", 99.0)], TABLES["service"])
    policy = lambda i, d, m, p: (i, "C", "D", "V", "PT001", None, d, d, d + dt.timedelta(365), d, d, None, None, m, p)
    insurance = spark.createDataFrame([policy("a", day(2015, 5, 1), "N", 10000.0), policy("b", day(2016, 5, 2), "Y", 9000.0)], TABLES["insurance"])
    vehicle = spark.createDataFrame([("VEH1", "V", *[None] * 13)], TABLES["vehicle"])
    r = features.churn_features(sales, service, insurance, vehicle, day(2018, 12, 31)).first()
    assert (r.vehicle_id, r.vehicle_age_years, r.total_service_visits, r.days_since_last_service) == ("VEH1", 3, 3, 578)
    assert (r.avg_bill_amount, round(r.pct_paid_services, 4), r.cancelled_visit_flag) == (6000.5, 0.6667, 1)
    assert (r.num_policy_renewals, r.auto_membership_flag, r.premium_trend, r.days_to_policy_expiry) == (1, 1, -1000.0, -608)
    assert (r.recency_score, r.frequency_score, r.monetary_score, r.rfm_total, r.churn_label, r.risk_tier) == (1, 3, 2, 6, 1, "High")


def test_models(star, spark):
    rows = star.churn_features.cache()
    fitted = models.fit(rows)
    scored = models.score(fitted, rows)
    metrics = models.evaluate(scored)
    assert 0.5 < metrics["auc"] <= 1.0 and 0 <= metrics["f1"] <= 1
    assert not {"days_since_last_service", "days_to_policy_expiry"} & set(fitted.inputs)
    named = models.with_drivers(fitted, scored).first()
    assert {named.top_driver_1, named.top_driver_2, named.top_driver_3} <= set(fitted.inputs)
    pruned = models.prune(fitted, rows)
    assert set(pruned.inputs) <= set(fitted.inputs)
    trees = models.fit(rows, ["total_service_visits", "avg_bill_amount"], kind="trees")
    assert not trees.is_linear
    with pytest.raises(ValueError):
        models.attributions(trees)
    assert {r.segment for r in models.segments(rows).select("segment").distinct().collect()} == {"Champions", "Loyal", "At-Risk", "Lost"}


def test_stability_of_equal_samples_is_zero(spark):
    data = [(p, y, i % 2) for y in (1, 2) for i, p in enumerate([0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0])]
    df = spark.createDataFrame(data, "churn_probability double, y int, churn_label int")
    assert {r.psi for r in models.stability_index(df, "y").collect()} == {0.0}
    auc = {r.y: r.auc for r in models.auc_by_period(df, "y").collect()}
    assert auc[1] == auc[2] == pytest.approx(15 / 25)


def test_command_line(built, star, capsys):
    from stayline.__main__ import main

    pipeline, _ = built
    key = star.sales.select("cust_id").first().cust_id
    main(["query", "--data", pipeline.folder, "q5"])
    main(["sql", "--data", pipeline.folder, "SELECT count(*) AS customers_in_all FROM customer"])
    main(["customer", "--data", pipeline.folder, key, "--out", pipeline.folder + "/out"])
    shown = capsys.readouterr().out
    assert "avg_churn_probability" in shown and "customers_in_all" in shown and "Name (masked)" in shown
    with pytest.raises(KeyError):
        main(["query", "--data", pipeline.folder, "Q77"])


def test_a_customer_with_three_vehicles(built):
    """One row in every report that is per customer, whatever the number of vehicles; stored and derived tables agree."""
    pipeline, _ = built
    many = pipeline["churn_features"].groupBy("cust_id").count().where("count >= 3")
    ids = [r.cust_id for r in many.limit(5).collect()]
    assert len(ids) == 5
    mine = F.col("cust_id").isin(ids)
    stored = {name: pipeline[name] for name in ("churn_features", "churn_scores", "customer", "sales", "vehicle", "service")}
    assert pipeline["churn_scores"].where(mine).count() == 5
    assert catalog.run("Q1", stored).where(mine).count() == 5
    assert view360.summary(stored).where(mine).count() == 14 * 5
    ranks = writers.read_current(pipeline.spark, pipeline.path("churn_results")).where(mine).select("rank").collect()
    assert len({r.rank for r in ranks}) == len(ranks) == 5
    assert sum(r.customer_count for r in catalog.run("Q5", stored).collect()) == stored["churn_scores"].count()
    worst = pipeline["churn_scores"].where(mine).collect()
    for r in worst:
        assert pipeline["churn_features"].where((F.col("cust_id") == r.cust_id) & (F.col("vehicle_id") == r.vehicle_id)).count() == 1


def test_every_query_but_the_dated_ones_reads_all_orders(spark, star):
    assert star.sales.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
    assert star.churn_features.count() == star.sales.where(F.col("sale_date") <= F.lit(AS_OF)).count()


def test_metrics_table_and_stable_segments(spark, star):
    rows = star.churn_features.cache()
    scored = models.score(models.fit(rows), rows)
    found, want = models.metrics(scored).first(), models.evaluate(scored)
    assert all(abs(found[k] - want[k]) < 2e-3 for k in ("auc", "precision", "recall", "f1"))
    one = {r.vehicle_id: r.segment for r in models.segments(rows).collect()}
    two = {r.vehicle_id: r.segment for r in models.segments(rows.repartition(13, "vehicle_id")).collect()}
    assert one == two and len(one) == rows.count() and 2 <= len(set(one.values())) <= 4
    rows.unpersist()


def test_safe_write_publishes_only_whole_versions(spark, rows):
    import pytest

    path = staged_path(spark, "safe")
    first = spark.createDataFrame([(1, "x"), (2, "y")], "n int, s string")
    second = spark.createDataFrame([(3, "z")], "n int, s string")
    writers.safe_write(first, path)
    writers.safe_write(second, path)
    assert rows(writers.read_current(spark, path)) == [(3, "z")]
    with pytest.raises(writers.WriteCheckFailed):  # written, but it doesn't read back as the rows: not published
        writers.safe_write(first, path, "csv", schema="n int, s int", header=True)
    assert rows(writers.read_current(spark, path)) == [(3, "z")]
    for _ in range(3):
        writers.safe_write(first, path)
    assert writers.published_versions(spark, path) == [5, 6]
    assert rows(writers.read_current(spark, path)) == [(1, "x"), (2, "y")]


def test_document_pages_number_items_in_reading_order(spark):
    day = dt.date(2020, 1, 1)
    items = [("C1", 4, "service", day + dt.timedelta(days=i), f"S{i:04d}") for i in range(130)]  # a long history
    items += [("C1", 1, "customer", None, "C1"), ("C2", 3, "sales", day, "A"), ("C2", 3, "sales", None, "B"), ("C2", 3, "sales", day, "C")]
    frame = spark.createDataFrame(items, "cust_id string, section_no int, section string, item_date date, item_id string")
    got = {(r.cust_id, r.item_id): (r.item_no, r.page) for r in view360.pages(frame, page_items=50).collect()}
    assert got[("C1", "C1")] == (1, 1)
    assert got[("C1", "S0129")] == (2, 1) and got[("C1", "S0000")] == (131, 3)
    assert sorted(n for (c, _), (n, _) in got.items() if c == "C1") == list(range(1, 132))
    assert [got[("C2", k)] for k in ("A", "C", "B")] == [(1, 1), (2, 1), (3, 1)]  # newest first, ties by id, undated last


def test_safe_write_computes_the_rows_once(spark, rows):
    path, seen = staged_path(spark, "once"), spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    counted = spark.range(50).selectExpr("cast(id as int) n", "cast(id % 3 as string) s").mapInArrow(count, "n int, s string")
    writers.safe_write(counted, path)
    assert seen.value == 50 and writers.read_current(spark, path).count() == 50
    writers.safe_write(counted.where("n < 0"), path, "json", schema=counted.schema)  # no rows are a set too
    assert writers.published_versions(spark, path) == [1, 2]


def test_service_deals_visits_by_order_key_once(star):
    plan = star.service._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join " in line]
    assert len(joins) == 2 and not any("vin" in line for line in joins)
    sold = star.sales.select("vin", "sale_date")
    feed = star.service_feed
    want = feed.join(sold, "vin").where("visit_date >= sale_date").select(*feed.columns)
    assert star.service.count() == want.count() and star.service.exceptAll(want).isEmpty()
