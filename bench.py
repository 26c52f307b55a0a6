"""Time the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS]; print one line of JSON.

Each query runs whole: every row and column of its result is computed, nothing is collected.
"""

from __future__ import annotations

import json
import os
import sys
import time

from recurra.plans.catalog import queries
from recurra.session import build_session

HEADLINE = (
    "customer_remap", "clean_customers", "clean_subscriptions", "clean_invoices", "clean_usage", "clean_tickets",
    "cleaning_log", "fk_orphans", "domain_violations", "reconcile", "subscription_mrr", "customer_month_mrr",
    "fact_mrr_waterfall", "mrr_waterfall", "fact_monthly_subscription", "pivot_source", "net_revenue_retention",
    "monthly_churn", "fact_churn_by_month", "cohort_retention", "cohort_retention_matrix", "fact_customer_clv",
    "clv_by_channel", "trailing_usage", "revenue_at_risk", "tenure_summary", "arpu_summary", "arpu_histogram",
    "usage_before_churn", "invoice_price_check", "invoice_sample", "monthly_summary", "business_review",
)


def run(names: list[str], folder: str, cpus: str) -> dict[str, float]:
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            # The bench tables are a few megabytes; at the default of 1 MB most cores would idle.
            "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64k",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    # Start-up and the first code generation are not a query's time.
    registered["mrr_waterfall"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        begun = time.perf_counter()
        registered[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - begun, 3)
    spark.stop()
    return seconds


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    seconds = run(sys.argv[1:] or list(HEADLINE), folder, cpus)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
