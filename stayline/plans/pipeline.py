"""The whole chain as separate steps, each reading the tables the step before wrote."""

from __future__ import annotations

import datetime as dt
import getpass
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline import reference_data as ref
from stayline.operators import checks, privacy, quality, rollups
from stayline.plans import features, publish, scoring
from stayline.schemas import TABLES
from stayline.sinks.writers import write_published

Tables = Mapping[str, DataFrame]


@dataclass
class Pipeline:
    """Steps over one output folder. Any step can be run again on its own; its tables are overwritten."""

    spark: SparkSession
    folder: str
    as_of: dt.date
    audit: list[tuple] = field(default_factory=list)

    def path(self, name: str) -> str:
        return f"{self.folder.rstrip('/')}/{name}.parquet"

    def __getitem__(self, name: str) -> DataFrame:
        return ref.dimension(self.spark, name) if name in ref.DIMENSIONS else self.spark.read.parquet(self.path(name))

    def __contains__(self, name: str) -> bool:
        return name in TABLES

    def write(self, step: str, name: str, df: DataFrame) -> None:
        """Write a table and note who wrote how many rows with which content.

        The figures are read from the written files, so they describe what later steps will see. (An
        ``Observation`` would count during the write, but leaves the session unable to run MLlib afterwards.)
        """
        df.write.mode("overwrite").parquet(self.path(name))
        written = checks.table_hash(self.spark.read.schema(df.schema).parquet(self.path(name)), name).first()
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        self.audit.append((step, name, getpass.getuser(), now, written["rows"], written["content_hash"]))

    def ingest(self, source: Tables) -> None:
        """The three domains, the registrations, the vehicles and the bridge, as delivered."""
        for name in ("sales", "service", "insurance", "pii_vault", "vehicle", "customer_vehicle"):
            self.write("ingest", f"raw_{name}", source[name])

    def check(self) -> None:
        """Split facts into accepted and rejected rows; missing bills are imputed."""
        sales = self["raw_sales"].withColumns(
            {c: F.date_format(c, "dd-MM-yyyy") for c in ("sale_date", "delivery_date")}
        )
        marked = {
            "sales": quality.check_sales(sales, self["dim_bank"]),
            "service": quality.check_service(self["raw_service"], self["dim_work_type"]),
            "insurance": quality.check_insurance(self["raw_insurance"], self["dim_policy_type"]),
        }
        for name, rows in marked.items():
            accepted = quality.accepted(rows)
            if name == "sales":
                accepted = accepted.withColumns(
                    {c: F.col(f"parsed_{c}") for c in ("sale_date", "delivery_date")}
                )
            if name == "service":
                accepted = quality.impute_bills(accepted)
            self.write("check", name, accepted.select(*TABLES[name].fieldNames()))
            key = {"sales": "sales_id", "service": "smr_id", "insurance": "ins_id"}[name]
            self.write("check", f"rejected_{name}", quality.rejected(rows).select(key, "vin", "rejects"))

    def star(self) -> None:
        """Vault and masked master; visits outside their vehicle's sale and ``as_of`` are kept out of the star."""
        vault, masked = privacy.split(self["raw_pii_vault"])
        dealers = self["sales"].groupBy("cust_id").agg(
            F.min_by("dealer_id", "sale_date").alias("preferred_dealer_id"),
            F.min("sale_date").alias("created_at"),
            F.max("sale_date").alias("updated_at"),
        )
        customer = masked.join(dealers, "cust_id", "left")
        self.write("star", "pii_vault", vault)
        self.write("star", "customer", customer.select(*TABLES["customer"].fieldNames()))
        for name in ("vehicle", "customer_vehicle"):
            self.write("star", name, self[f"raw_{name}"])

    def features(self) -> None:
        rows = features.churn_features(self["sales"], self["service"], self["insurance"], self["vehicle"], self.as_of)
        self.write("features", "churn_features", rows)

    def scores(self) -> None:
        self.write("scores", "churn_scores", scoring.points_score(self["churn_features"], self.as_of))

    def publish(self) -> None:
        write_published(publish.ranked_results(self), self.path("churn_results"))
        self.write("publish", "tier_distribution", rollups.tier_distribution(self["churn_scores"]))

    def validate(self) -> DataFrame:
        """The report, written first so that the verdict reads it instead of checking again."""
        self.write("validate", "validation", checks.report(self))
        return checks.verdict(self["validation"])

    def write_audit(self) -> None:
        schema = "step string, table_name string, operator string, finished_at timestamp_ntz, rows long, content_hash string"
        self.spark.createDataFrame(self.audit, schema).write.mode("append").parquet(self.path("audit"))

    def run(self, source: Tables) -> DataFrame:
        self.ingest(source)
        self.check()
        self.star()
        self.features()
        self.scores()
        self.publish()
        result = self.validate()
        self.write_audit()
        return result
