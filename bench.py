"""Time the headline queries; prints one JSON line.

The inventory tables are derived first and timed on their own; each query then runs twice
over the stored tables, writing all rows to nowhere, and the better time counts. A whole
``analysis.run``, in which views share their inputs, is timed once. The total is that of the
queries alone.
"""

import json
import os
import time

from checks import mart
from checks.queries import all_queries
from stockrecon.plans import analysis
from stockrecon.schemas import TABLES
from stockrecon.session import build_session, new_folder
from stockrecon.sources.tables import load_tables

QUERIES = [
    "V1_daily_sales",
    "V2_daily_movements",
    "V3_duplicate_movements",
    "V4_inventory_reconciliation",
    "V5_reconciliation_issues",
    "V6_phantom_inventory",
    "V7_stockout_days",
    "V8_stockout_periods",
    "V9_lost_sales_estimate",
    "V10_supplier_performance",
    "V11_branch_inventory_health",
    "V12_data_quality_issues",
    "R1_issue_mix",
    "R6_validation_summary",
    "R11_executive_kpis",
    "Q7_model_rules",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def scale_of(folder: str) -> float | str:
    name = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    return float(name) if name.replace(".", "", 1).isdigit() else name


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g")},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {"derive_tables": timed(lambda: mart.inventory(spark, folder))}
    for name in QUERIES:
        run = all_queries()[name]
        seconds[name] = min(
            timed(lambda: run(spark, folder).write.format("noop").mode("overwrite").save()) for _ in range(2)
        )
    source = new_folder(spark, "bench-source")
    load_tables({name: df for name, df in mart.inventory(spark, folder).items() if name in TABLES}, source)
    seconds["analysis_run"] = timed(
        lambda: analysis.run(spark, source, new_folder(spark, "bench-run"), "parquet", "parquet").collect()
    )
    queries = {name: round(value, 3) for name, value in seconds.items()}
    total = round(sum(seconds[name] for name in QUERIES), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": queries,
                "sf": scale_of(folder),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
