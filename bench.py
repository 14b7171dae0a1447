"""Time headline queries cold and warm on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "q01_ranked",
    "q05_tier_summary",
    "q10_by_model",
    "q11_cancellations",
    "features",
    "dq_imputed_bills",
    "vault_leak_scan",
    "visit_chain",
    "identity_dedup",
    "vin_fallback_join",
    "decision_lookup",
    "decision_nearest",
    "grid_clean",
    "publish_ranked",
    "customer_360",
    "air_state",
    "air_processes",
    "q06_top_drivers",
    "q09_by_city",
    "q12_recoverable",
    "scores",
    "dq_summary",
    "fk_orphans",
    "policy_chain",
    "page_links",
    "air_mixing",
    "validation_verdict",
    "customer_summary",
    "fuzzy_names",
    "ml_scores",
    "stability_index",
    "monthly_snapshots",
    "validation_report",
    "bill_median",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from stayline.plans.registry import queries
    from stayline.session import build_session

    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "12g"},
    )
    spark.sparkContext.setLogLevel("OFF")
    named = queries()
    wanted = sys.argv[1:] or HEADLINE

    def timed(name: str) -> float:
        start = time.perf_counter()
        named[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    cold = {name: timed(name) for name in wanted}
    warm = {name: timed(name) for name in wanted}
    rows_in = {name: spark.read.parquet(f"{folder}/{name}.parquet").count() for name in ("orders", "lineitem", "events")}
    print(
        json.dumps(
            {
                "metric": "headline_queries_warm_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "rows_in": rows_in,
                "sf": os.path.basename(folder).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
