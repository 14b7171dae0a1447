"""All named queries: name -> callable(spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import reference_data as ref
from stayline.functions import application, masks
from stayline.functions.scalar import round_half_up
from stayline.operators import chains, checks, identity, lookup, privacy, quality, ranking, rollups
from stayline.plans import air, catalog, features, history, models, publish, rules, view360
from stayline.session import stage, staged_path, tune
from stayline.sources import grid, links
from stayline.sources.projection import AS_OF, AfterSales, _vin
from stayline.sinks import writers
from stayline.sources.tables import load_table, register
from stayline.streaming import compaction, outreach, refresh, service_feed

Plan = Callable[[AfterSales], DataFrame]
PLANS: dict[str, Plan] = {}


def named(name: str) -> Callable[[Plan], Plan]:
    def keep(plan: Plan) -> Plan:
        PLANS[name] = plan
        return plan

    return keep


def _runner(plan: Plan) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, folder: plan(AfterSales(tune(spark), folder, AS_OF))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _runner(plan) for name, plan in PLANS.items()}


# -- catalogue, features, rules -------------------------------------------------------------------

for _name, _plan in {
    "q01_ranked": catalog.ranked,
    "q02_high_risk": catalog.high_risk,
    "q03_medium_risk": catalog.medium_risk,
    "q04_low_risk": catalog.low_risk,
    "q05_tier_summary": catalog.tier_summary,
    "q06_top_drivers": catalog.top_drivers,
    "q07_lapsed": catalog.lapsed,
    "q08_never_renewed": catalog.never_renewed,
    "q09_by_city": catalog.by_city,
    "q10_by_model": catalog.by_model,
    "q11_cancellations": catalog.cancellations,
    "q12_recoverable": catalog.recoverable,
    "features": lambda t: t.churn_features,
    "scores": lambda t: t.churn_scores,
    "tier_crosstab": lambda t: rules.tier_crosstab(t.scored),
}.items():
    PLANS[_name] = _plan


@named("feature_details")
def _feature_details(t: AfterSales) -> DataFrame:
    facts = features.vehicle_facts(t.sales, t.service_feed, t.insurance, t.vehicle, t.as_of)
    return facts.select("cust_id", "vin", "days_to_first_service", "policy_expired", "pucc_expired")


@named("rfm_scores")
def _rfm_scores(t: AfterSales) -> DataFrame:
    scores = ["recency_score", "frequency_score", "monetary_score", "rfm_total"]
    return t.churn_features.groupBy(*scores).agg(F.count("*").alias("customers"))


# -- privacy ---------------------------------------------------------------------------------------


@named("masked_customer")
def _masked_customer(t: AfterSales) -> DataFrame:
    return t.customer


@named("masked_address")
def _masked_address(t: AfterSales) -> DataFrame:
    return t.pii_vault.select("cust_id", masks.mask_address(F.col("address")).alias("address_masked"))


@named("vault_leak_scan")
def _leaks(t: AfterSales) -> DataFrame:
    scanned = {name: t.leaky_sales if name == "sales" else t[name] for name in privacy.SAFE_TABLES}
    return privacy.leak_scan(t.pii_vault, scanned)


@named("vault_erasure")
def _erasure(t: AfterSales) -> DataFrame:
    requests = t.churn_scores.where(F.col("risk_tier") == "High")
    return privacy.erase(t.pii_vault, requests).select("cust_id", "email")


@named("revealed_customers")
def _revealed(t: AfterSales) -> DataFrame:
    return privacy.reveal(t.customer, t.pii_vault, show_pii=True).select("cust_id", "name_masked", "cust_name", "dob")


# -- quality and validation ------------------------------------------------------------------------


def _marked(t: AfterSales) -> dict[str, DataFrame]:
    return {
        "sales": quality.check_sales(t.sales_feed, t["dim_bank"]),
        "service": quality.check_service(t.service_defects, t["dim_work_type"]),
        "insurance": quality.check_insurance(t.insurance_defects, t["dim_policy_type"]),
        "pii_vault": quality.check_mobiles(t.vault_defects),
    }


@named("dq_summary")
def _dq_summary(t: AfterSales) -> DataFrame:
    return checks.stack([quality.rule_counts(marked, name) for name, marked in _marked(t).items()])


@named("dq_rejects")
def _dq_rejects(t: AfterSales) -> DataFrame:
    marked = _marked(t)
    rows = [
        quality.rejected(marked[name]).select(
            F.lit(name).alias("table_name"), F.col(key).alias("row_id"), F.array_join("rejects", "; ").alias("rules")
        )
        for name, key in (("sales", "sales_id"), ("service", "smr_id"), ("insurance", "ins_id"))
    ]
    return checks.stack(rows)


@named("dq_accepted_service")
def _dq_accepted(t: AfterSales) -> DataFrame:
    ok = quality.accepted(quality.check_service(t.service_defects, t["dim_work_type"]))
    return ok.select("smr_id", "vin", "work_type_id", "bill_amount")


@named("dq_imputed_bills")
def _dq_imputed(t: AfterSales) -> DataFrame:
    ok = quality.accepted(quality.check_service(t.service_defects, t["dim_work_type"]))
    bills = quality.impute_bills(ok.select("smr_id", "work_type_id", "bill_amount"))
    return bills.select("smr_id", "work_type_id", "bill_amount", "imputed")


@named("dq_vocabulary")
def _dq_vocabulary(t: AfterSales) -> DataFrame:
    names = t["dim_work_type"].select("work_type_id", "work_type_name")
    spelt = t.service_feed.join(F.broadcast(names), "work_type_id").select(
        F.when(F.col("mileage") % 4 == 0, F.upper("work_type_name"))
        .when(F.col("mileage") % 4 == 1, F.concat(F.lit(" "), F.replace("work_type_name", F.lit(" "), F.lit("-"))))
        .when(F.col("mileage") % 4 == 2, F.concat("work_type_name", F.lit(" job")))
        .otherwise(F.col("work_type_name"))
        .alias("work_text")
    )
    standard = quality.standardise(spelt, "work_text", t["dim_work_type"], "work_type_id", "work_type_name")
    return standard.groupBy("work_text", "std_work_type_id").agg(F.count("*").alias("rows"))


@named("bill_median")
def _bill_median(t: AfterSales) -> DataFrame:
    return rollups.median_by(t.service_feed, ["work_type_id"], "bill_amount")


@named("fk_orphans")
def _fk_orphans(t: AfterSales) -> DataFrame:
    return checks.foreign_keys(t)


@named("fk_orphan_vins")
def _fk_orphan_vins(t: AfterSales) -> DataFrame:
    part = F.element_at(F.split("smr_id", "-"), 3).cast("bigint")
    unsold = F.concat(F.lit("MA9"), F.substring("vin", 4, 14))
    feed = t.service_feed.withColumn("vin", F.when(part % 61 == 5, unsold).otherwise(F.col("vin")))
    return checks.orphan_keys(feed, "vin", t.sales, "vin").withColumnRenamed("key", "vin")


@named("row_minimums")
def _row_minimums(t: AfterSales) -> DataFrame:
    return checks.row_minimums(t)


@named("label_rate")
def _label_rate(t: AfterSales) -> DataFrame:
    return checks.label_rate(t.churn_features)


@named("range_rules")
def _range_rules(t: AfterSales) -> DataFrame:
    return checks.range_rules(t)


@named("edge_rules")
def _edge_rules(t: AfterSales) -> DataFrame:
    return checks.edge_rules(t)


@named("key_sets")
def _key_sets(t: AfterSales) -> DataFrame:
    return checks.key_sets(t.service_feed.select("cust_id"), t.customer.select("cust_id"), "cust_id")


@named("validation_report")
def _report(t: AfterSales) -> DataFrame:
    return checks.report(t)


@named("validation_verdict")
def _verdict(t: AfterSales) -> DataFrame:
    return checks.verdict(checks.report(t))


@named("audit_hashes")
def _audit_hashes(t: AfterSales) -> DataFrame:
    names = ["sales", "service", "insurance", "customer", "vehicle", "churn_features"]
    return checks.stack([checks.table_hash(t[name], name) for name in names])


# -- chains, ids, bridge ---------------------------------------------------------------------------


@named("policy_chain")
def _policy_chain(t: AfterSales) -> DataFrame:
    return chains.policy_chain(t.insurance)


@named("visit_chain")
def _visit_chain(t: AfterSales) -> DataFrame:
    work_types, milestones = (
        [row[0] for row in ref.DIMENSIONS[name][1]] for name in ("dim_work_type", "dim_milestone")
    )
    return chains.visit_chain(t.service, work_types, milestones)


@named("surrogate_keys")
def _surrogate_keys(t: AfterSales) -> DataFrame:
    return ranking.surrogate_ids(t.service_feed, "vin", "visit_date", "VEH", "vehicle_no")


@named("sequence_keys")
def _sequence_keys(t: AfterSales) -> DataFrame:
    numbered = ranking.sequence_ids(t.insurance, [F.col("policy_issue_date")], "ins_id", "INS", "sequence_id")
    return numbered.select("ins_id", "sequence_id")


@named("bridge_pairs")
def _bridge_pairs(t: AfterSales) -> DataFrame:
    return t.customer_vehicle.dropDuplicates(["cust_id", "vehicle_id"])


@named("bridge_shared")
def _bridge_shared(t: AfterSales) -> DataFrame:
    sides = [
        rollups.shared_keys(t.customer_vehicle, key, other).select(
            F.lit(key).alias("side"), F.col(key).alias("key"), "distinct_others"
        )
        for key, other in (("cust_id", "vehicle_id"), ("vehicle_id", "cust_id"))
    ]
    return checks.stack(sides)


@named("unique_vehicles")
def _unique_vehicles(t: AfterSales) -> DataFrame:
    """One visit row per VIN: the earliest, chosen by id among equals, not whichever row comes first."""
    first = F.min_by(F.struct("smr_id", "dealer_id", "mileage"), F.struct("visit_date", "smr_id"))
    return t.service_feed.groupBy("vin").agg(first.alias("v")).select("vin", "v.*")


# -- identity --------------------------------------------------------------------------------------

SALT = "stayline"


@named("identity_dedup")
def _identity_dedup(t: AfterSales) -> DataFrame:
    return identity.persons(t.registrations, SALT)


@named("tokenised_sales")
def _tokenised_sales(t: AfterSales) -> DataFrame:
    return identity.tokenise(t.sales.select("sales_id", "cust_id", "vin"), t.pii_vault, SALT)


@named("vin_fallback_join")
def _vin_fallback(t: AfterSales) -> DataFrame:
    matched = identity.match_vehicles(t.workshop_feed, t.vehicle, "smr_id")
    return matched.select("smr_id", "vehicle_id", "match_kind")


@named("fuzzy_names")
def _fuzzy_names(t: AfterSales) -> DataFrame:
    return identity.name_neighbours(t.pii_vault)


# -- decision lookup -------------------------------------------------------------------------------


@named("decision_stats")
def _decision_stats(t: AfterSales) -> DataFrame:
    return rollups.decision_stats(t.decisions)


@named("decision_classes")
def _decision_classes(t: AfterSales) -> DataFrame:
    kind = application.decision_class(F.col("decision"))
    return t.decisions.groupBy("decision", kind.alias("decision_class")).agg(F.count("*").alias("decisions"))


@named("number_validation")
def _number_validation(t: AfterSales) -> DataFrame:
    return application.with_number_check(t.searches, "raw")


@named("decision_lookup")
def _decision_lookup(t: AfterSales) -> DataFrame:
    return lookup.exact_matches(t.searches, t.decisions).drop("number")


@named("decision_nearest")
def _decision_nearest(t: AfterSales) -> DataFrame:
    return lookup.nearest_matches(t.searches, t.decisions)


@named("grid_clean")
def _grid_clean(t: AfterSales) -> DataFrame:
    return grid.clean_grid(t.decision_grid)


@named("grid_without_notes")
def _grid_without_notes(t: AfterSales) -> DataFrame:
    """Lines below the notes line that follows a title, per file, entirely empty lines left out."""
    lines = grid.sheet_table(t.decision_grid, ["mark", "no", "number", "decision"])
    return lines.groupBy("file_id").agg(F.count("*").alias("lines"), F.count("decision").alias("with_decision"))


@named("grid_headers")
def _grid_headers(t: AfterSales) -> DataFrame:
    return grid.header_rows(t.decision_grid)


@named("page_links")
def _page_links(t: AfterSales) -> DataFrame:
    return links.links(t.raw("pages"))


@named("page_first_link")
def _page_first_link(t: AfterSales) -> DataFrame:
    return links.first_link(t.raw("pages"), ("e", "n"))


# -- publication and customer view -----------------------------------------------------------------


@named("publish_ranked")
def _publish_ranked(t: AfterSales) -> DataFrame:
    return publish.ranked_results(t)


@named("publish_summary")
def _publish_summary(t: AfterSales) -> DataFrame:
    return rollups.tier_distribution(t.churn_scores)


@named("customer_360")
def _customer_360(t: AfterSales) -> DataFrame:
    return view360.overview(t)


@named("customer_sections")
def _customer_sections(t: AfterSales) -> DataFrame:
    return view360.sections(t).select("cust_id", "section_no", "section", "item_date", "item_id")


@named("sink_published")
def _sink_published(t: AfterSales) -> DataFrame:
    """Published results written as a checked version, twice, and read back from the newest."""
    path = staged_path(t.spark, "published")
    ranked = publish.ranked_results(t)
    writers.write_published(ranked, path)
    writers.write_published(ranked, path)
    return writers.read_current(t.spark, path).select(*ranked.columns)


@named("sink_documents")
def _sink_documents(t: AfterSales) -> DataFrame:
    """Every customer's sections written as checked JSON lines and read back."""
    path = staged_path(t.spark, "documents")
    sections = view360.sections(t)
    writers.write_documents(sections, path)
    return writers.read_current(t.spark, path, "json", schema=sections.schema).select("cust_id", "section_no", "section", "item_date", "item_id")


@named("sink_csv")
def _sink_csv(t: AfterSales) -> DataFrame:
    """Insurance written as checked CSV, loaded back by name and typed as declared."""
    folder = staged_path(t.spark, "csv")
    writers.write_csv(t.insurance, f"{folder}/insurance.csv")
    return load_table(t.spark, folder, "insurance", "csv").select("ins_id", "vin", "policy_issue_date", "policy_expiry_date", "total_premium")


@named("sink_tables")
def _sink_tables(t: AfterSales) -> DataFrame:
    """A data set written table by table as checked versions, then its row counts as read back."""
    folder = staged_path(t.spark, "dataset")
    names = writers.write_tables({name: t[name] for name in ("sales", "insurance", "customer")}, folder)
    counts = [load_table(t.spark, folder, name).agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows") for name in names]
    return checks.stack(counts)


@named("customer_pages")
def _customer_pages(t: AfterSales) -> DataFrame:
    """The place of every item in its customer's document; an item's text takes no part in it and isn't carried along."""
    items = view360.sections(t).select("cust_id", "section_no", "section", "item_date", "item_id")
    return view360.pages(items).select(*items.columns, "item_no", "page")


@named("customer_summary")
def _customer_summary(t: AfterSales) -> DataFrame:
    return view360.summary(t)


@named("dimension_lookup")
def _dimension_lookup(t: AfterSales) -> DataFrame:
    """Service rows with the names behind their ids; the dimensions are constants of a few rows."""
    named_rows = t.service_feed
    for dim, key, name in (
        ("dim_work_type", "work_type_id", "work_type_name"),
        ("dim_pay_mode", "pay_mode_id", "pay_mode_name"),
        ("dim_cancel_reason", "cancel_reason_id", "description"),
        ("dim_milestone", "milestone_id", "milestone_name"),
        ("dim_dealer", "dealer_id", "dealer_name"),
    ):
        named_rows = named_rows.join(F.broadcast(t[dim].select(key, name)), key, "left")
    return named_rows.groupBy("work_type_name", "pay_mode_name", "description", "milestone_name", "dealer_name").agg(
        F.count("*").alias("visits"), F.sum("bill_amount").alias("billed")
    )


@named("model_variants")
def _model_variants(t: AfterSales) -> DataFrame:
    return t.vehicle.groupBy("model", "variant", "cc", "transmission", "body_type").agg(F.count("*").alias("vehicles"))


@named("customer_vehicles")
def _customer_vehicles(t: AfterSales) -> DataFrame:
    """Vehicles sold to high-risk customers (semi join), with the mapped people of each."""
    risky = t.sales.join(t.churn_scores.where(F.col("risk_tier") == "High"), "cust_id", "left_semi")
    return t.vehicle.join(risky, "vin", "left_semi").select("vehicle_id", "vin", "model", "variant")


# -- moist air -------------------------------------------------------------------------------------


@named("air_closed_forms")
def _air_closed_forms(t: AfterSales) -> DataFrame:
    digits = {"w": 9, "p_sat": 5, "rh": 8, "mu": 8, "h": 6, "v": 8, "pv": 8}
    solved = air.closed_forms(t.readings)
    return solved.select("reading_id", "kind", *[round_half_up(F.col(c), d).alias(c) for c, d in digits.items()])


@named("air_state")
def _air_state(t: AfterSales) -> DataFrame:
    return air.states(t.readings).select("reading_id", "error", "state.*")


@named("air_processes")
def _air_processes(t: AfterSales) -> DataFrame:
    return air.processes(t.process_runs).select("reading_id", "process_type", "error", "state2.*")


@named("air_process_metrics")
def _air_process_metrics(t: AfterSales) -> DataFrame:
    done = air.processes(t.process_runs).select("reading_id", "process_type", F.explode("metrics").alias("metric", "value"))
    printed = air.metric_text(F.col("metric"), F.col("value"))
    return done.withColumns({"printed": printed, "value": round_half_up(F.col("value"), 6)})


@named("air_mixing")
def _air_mixing(t: AfterSales) -> DataFrame:
    ratio = air.closed_forms(t.readings).select(
        "user_id",
        round_half_up(F.col("w"), 6).alias("w"),
        round_half_up(F.col("h"), 3).alias("h"),
        (1.0 + F.col("reading_id") % 3).alias("mass"),
    )
    mixed = air.mix(ratio, ["user_id"])
    return mixed.select(
        "user_id",
        "mass",
        round_half_up(F.col("dbt_mix"), 2).alias("dbt_mix"),
        round_half_up(F.col("w_mix"), 6).alias("w_mix"),
        round_half_up(F.col("h_mix"), 3).alias("h_mix"),
    )


@named("air_curves")
def _air_curves(t: AfterSales) -> DataFrame:
    """All curve families inside the dry-bulb range of each user's readings, one row per curve."""
    charts = t.readings.groupBy("user_id").agg(F.min("dbt").alias("dbt_min"), F.max("dbt").alias("dbt_max"))
    return (
        air.curve_points(charts)
        .groupBy("user_id", "family", "param")
        .agg(
            F.count("*").alias("points"),
            round_half_up(F.min("dbt"), 6).alias("first_dbt"),
            round_half_up(F.max("dbt"), 6).alias("last_dbt"),
            round_half_up(F.min("w"), 8).alias("least_w"),
            round_half_up(F.max("w"), 8).alias("most_w"),
        )
    )


@named("air_history")
def _air_history(t: AfterSales) -> DataFrame:
    return chains.plotted_points(t.plotted, "user_id", ["ts", "reading_id"]).select(
        "user_id", "label", "reading_id", "dbt"
    )


@named("point_labels")
def _point_labels(t: AfterSales) -> DataFrame:
    """The running label of every plotted point per user, whatever is cleared later."""
    days = t.plotted.where("NOT is_clear AND label IS NULL").withColumn("day", F.col("ts").cast("date"))
    numbered = chains.day_chain(days, "user_id", "day", "reading_id")
    return numbered.select("user_id", "reading_id", F.concat(F.lit("P"), F.col("ordinal").cast("string")).alias("label"))


@named("load_report")
def _load_report(t: AfterSales) -> DataFrame:
    """The star tables written by Spark to a folder with a broken file, a column of another type and a missing table, then loaded."""
    from stayline.sources import tables as loading

    folder = staged_path(t.spark, "loaded")
    for name in ("sales", "service", "insurance", "customer"):
        df = t[name]
        if name == "sales":
            df = df.withColumn("mfd_year", F.col("mfd_year").cast("string"))  # another type than declared
        df.write.parquet(f"{folder}/{name}.parquet")
    broken = f"{folder}/service.parquet/part-99999-broken.parquet"
    t.spark.createDataFrame([("not a parquet file",)], "value string").coalesce(1).write.text(f"{folder}/broken-text")
    source = loading.data_files(t.spark, f"{folder}/broken-text")[0]
    jvm = t.spark.sparkContext._jvm
    fs = jvm.org.apache.hadoop.fs.Path(source).getFileSystem(t.spark.sparkContext._jsc.hadoopConfiguration())
    fs.rename(jvm.org.apache.hadoop.fs.Path(source), jvm.org.apache.hadoop.fs.Path(broken))
    _, report = loading.load_checked(t.spark, folder, ["sales", "service", "insurance", "customer", "vehicle"])
    return report


@named("sql_on_views")
def _sql_on_views(t: AfterSales) -> DataFrame:
    """Any SQL text over the registered tables; here dealers by premium of their high-risk customers."""
    register({name: t[name] for name in ("insurance", "churn_scores", "dim_dealer")})
    return t.spark.sql(
        """
        SELECT d.dealer_name, d.city, count(DISTINCT i.cust_id) AS customers, sum(i.total_premium) AS premium
        FROM insurance i JOIN churn_scores s ON s.cust_id = i.cust_id JOIN dim_dealer d ON d.dealer_id = i.dealer_id
        WHERE s.risk_tier = 'High' GROUP BY d.dealer_name, d.city
        """
    )


# -- models and monitoring -------------------------------------------------------------------------


@named("ml_scores")
def _ml_scores(t: AfterSales) -> DataFrame:
    rows = stage(t.churn_features, "features")
    return models.score(models.fit(rows), rows).select("cust_id", "vehicle_id", "churn_probability", "score_tier", "is_train")


@named("ml_metrics")
def _ml_metrics(t: AfterSales) -> DataFrame:
    rows = stage(t.churn_features, "features")
    return models.metrics(models.score(models.fit(rows), rows))


@named("ml_drivers")
def _ml_drivers(t: AfterSales) -> DataFrame:
    rows = stage(t.churn_features, "features")
    fitted = models.prune(models.fit(rows), rows)
    return models.with_drivers(fitted, models.score(fitted, rows)).select(
        "cust_id", "vehicle_id", "churn_probability", "top_driver_1", "top_driver_2", "top_driver_3"
    )


@named("segments")
def _segments(t: AfterSales) -> DataFrame:
    return models.segments(stage(t.churn_features, "features")).select("cust_id", "vehicle_id", "rfm_total", "segment")


def _scored_by_year(t: AfterSales) -> DataFrame:
    years = t.sales.groupBy("cust_id").agg(F.year(F.min("sale_date")).alias("sale_year"))
    return t.scored.select("cust_id", "churn_label", "churn_probability").join(years, "cust_id")


@named("auc_by_year")
def _auc_by_year(t: AfterSales) -> DataFrame:
    return models.auc_by_period(_scored_by_year(t), "sale_year")


@named("drift_gate")
def _drift_gate(t: AfterSales) -> DataFrame:
    return models.drift_gate(_scored_by_year(t), "sale_year")


@named("stability_index")
def _stability_index(t: AfterSales) -> DataFrame:
    return models.stability_index(_scored_by_year(t), "sale_year")


@named("monthly_snapshots")
def _monthly_snapshots(t: AfterSales) -> DataFrame:
    return history.monthly_snapshots(t.sales, t.service_feed, t.insurance, t.as_of)


@named("model_history")
def _model_history(t: AfterSales) -> DataFrame:
    return history.model_history(stage(history.monthly_snapshots(t.sales, t.service_feed, t.insurance, t.as_of), "snapshots"))


# -- streams ---------------------------------------------------------------------------------------


@named("stream_refresh")
def _stream_refresh(t: AfterSales) -> DataFrame:
    table, checkpoint = staged_path(t.spark, "versions"), staged_path(t.spark, "versions-checkpoint")
    refresh.refresh(t.decision_versions(t.stream("orders")), table, checkpoint).awaitTermination()
    return refresh.latest(t.spark.read.parquet(table)).select("application_number", "decision", "row_idx")


@named("stream_compacted")
def _stream_compacted(t: AfterSales) -> DataFrame:
    folder, checkpoint = staged_path(t.spark, "decisions"), staged_path(t.spark, "decisions-checkpoint")
    compaction.compact(t.decision_versions(t.stream("orders")), folder, checkpoint).awaitTermination()
    schema = "application_number string, decision string, published_at timestamp, row_idx bigint"
    return compaction.current(t.spark, folder, schema).select("application_number", "decision", "row_idx")


def _visit_events(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.concat_ws("-", F.concat(F.lit("SMR"), F.col("l_orderkey").cast("string")), "l_linenumber", "l_partkey", "l_suppkey",
                    F.col("l_shipdate").cast("date").cast("string"), "l_returnflag").alias("smr_id"),
        _vin(F.col("l_orderkey")).alias("vin"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        (F.col("l_returnflag") == "R").alias("cancelled"),
    )


@named("stream_outreach")
def _stream_outreach(t: AfterSales) -> DataFrame:
    table, checkpoint = staged_path(t.spark, "outreach"), staged_path(t.spark, "outreach-checkpoint")
    outreach.run(_visit_events(t.stream("lineitem")), table, checkpoint).awaitTermination()
    delivered = t.spark.read.schema(outreach.OUTPUT).parquet(table)
    return delivered.unionByName(outreach.undecided(_visit_events(t.raw("lineitem")), delivered))


@named("stream_service_windows")
def _stream_windows(t: AfterSales) -> DataFrame:
    table, checkpoint = staged_path(t.spark, "visits"), staged_path(t.spark, "visits-checkpoint")
    service_feed.run(t.live_visits(t.stream("lineitem")), table, checkpoint).awaitTermination()
    closed = t.spark.read.parquet(table)
    return closed.unionByName(service_feed.open_windows(t.live_visits(t.raw("lineitem")), closed))
