"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local cores (default 8).
Every query runs once cold and WARM_RUNS times warm, in rounds over all queries, so that a slow spell
of the machine does not hit all runs of one. `queries` holds the warm medians, `cold` the first runs. A
run includes building the plan and computing every column of every row; the rows go to Spark's noop sink.
"""

from __future__ import annotations

import json
import os
import time
from statistics import median

from pyspark.sql import SparkSession

from ledgerline.workload.queries import QUERIES

WARM_RUNS = 3
HEADLINE = [
    "stg_customers",
    "stg_subscriptions",
    "stg_invoices",
    "issues_customers",
    "issues_subscriptions",
    "issues_invoices",
    "usable_subscriptions",
    "paid_invoices_eur",
    "mrr_by_month_plan",
    "customer_ltv",
    "subscription_churn",
    "dq_unique",
    "dq_relationships",
    "dq_accepted_values",
    "dq_suite_report",
    "raw_reconciliation",
    "multi_count_distinct",
    "broadcast_fx",
]


def run(spark: SparkSession, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ledgerline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    cold = {name: run(spark, name, sf_dir) for name in HEADLINE}
    rounds = [{name: run(spark, name, sf_dir) for name in HEADLINE} for _ in range(WARM_RUNS)]
    warm = {name: median(r[name] for r in rounds) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_warm_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "sf": sf_dir.rsplit("sf", 1)[-1],
                "cpus": cpus,
            }
        )
    )


if __name__ == "__main__":
    main()
