"""Time the headline queries, each from the input tables with nothing staged before.

One untimed run warms the JVM up; it shares no staged table with the timed ones.

Prints one JSON line. BENCH_SF_DIR names the data folder, BENCH_CPUS the cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from linkledger.plans import catalog
from linkledger.plans.fixture_run import SETTINGS, fresh_workspace

HEADLINE = (
    "lk_linked_count", "account_revenue", "last_transaction", "sales_decile_share", "sales_decile_ntile",
    "account_sales_history", "contact_enriched", "contact_linkage", "active_linked", "dq_completeness",
    "dq_field_quality", "dq_parity", "dq_staleness", "dq_match_readiness", "dq_snapshot", "issue_map",
    "crm_xref_agreement", "duplicate_entity_list", "path_b_extract", "reconcile_matches", "duplicate_candidates",
    "upload_batches", "quality_index", "snapshot_verification",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    found = catalog.all_queries(SETTINGS)
    chosen = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(HEADLINE)

    def run(name: str) -> float:
        ws = fresh_workspace(spark, folder)
        begin = time.perf_counter()
        found[name](ws).write.format("noop").mode("overwrite").save()
        taken = time.perf_counter() - begin
        ws.release()
        return taken

    run("dq_snapshot")  # session start-up and cold code are not part of any query
    seconds = {name: round(run(name), 3) for name in chosen}
    print(json.dumps({
        "metric": "headline queries, total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": folder.rstrip("/").rsplit("sf", 1)[-1], "cores": cores, "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
