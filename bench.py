"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Arguments, if any, name the queries to run instead. Each result is produced in full and discarded.
"""

import json
import os
import sys
import time

from harness.queries import registry
from smeltworks.session import local_session

HEADLINE = (
    "daily_revenue",
    "monthly_revenue",
    "customer_ltv",
    "product_performance",
    "order_summary",
    "category_revenue",
    "customer_ranks",
    "running_revenue",
    "month_growth",
    "order_history",
    "order_history_hot_customers",
    "top_products_per_category",
    "best_month",
    "silver_customers",
    "silver_products",
    "silver_orders",
    "silver_order_items",
    "upsert_orders",
    "replace_table",
    "replace_partition",
    "backfill_range",
    "daily_revenue_backfill",
    "incremental_load",
    "stream_upsert",
    "medallion_daily_revenue",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench", **{"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    queries, seconds = registry(), {}
    # One small run first, so that session start-up is not charged to the first query.
    queries["completed_by_day"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    line = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }
    print(json.dumps(line))


if __name__ == "__main__":
    main()
