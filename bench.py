"""Times the headline queries and prints one JSON line.

Stages are rebuilt first: "build" is the whole run from the driver's tables to
segments, as separate steps; the queries after it read the stage tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from tallyloom.plans.build import rebuild  # noqa: E402
from tallyloom.plans.queries import all_queries  # noqa: E402

STAGES = (
    "raw_orders", "raw_items", "raw_customers", "raw_products", "inventory", "orders_cleaned", "items_cleaned", "orders", "items", "customers",
    "products", "catalogue", "priced", "order_totals", "baskets", "curated", "lines", "customer_rfm", "segments",
    "dim_customers", "customer_months", "retention", "new_returning", "economics",
)
HEADLINE = (
    "d2_raw_audit", "d12_clean_audit", "d10_cleaning_log", "e1_order_value_distribution",
    "e7_pareto_concentration", "f1_sales_curated", "f3_rfm_customer_segments", "f5_product_analytics",
    "f6_segment_summary", "f7_items_for_bi", "m2_monthly_revenue", "m3_product_performance",
    "m4_brand_profitability", "m6_category_monthly_trend", "m9_cohort_retention", "b1_revenue_profit_orders",
    "b14_customer_decile", "t4_rolling_12m_month", "q13_profitability_matrix", "v8_figures", "h1_kpi_primitives",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors

    times: dict[str, float] = {}
    shop = rebuild(spark, folder)
    for name in STAGES:
        start = time.perf_counter()
        getattr(shop, name)
        times[f"build_{name}"] = round(time.perf_counter() - start, 3)
    queries = all_queries()
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline queries, build included",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
