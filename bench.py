"""Time the headline jobs and queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and cores.
`etl_pipeline`, `rfm_job` and `forecast_job` are whole jobs as the published timings count them:
reading, computing and writing the result tables.
"""

from __future__ import annotations

import json
import os
import time
from datetime import date, datetime

from tillwise.catalog.queries import AS_OF, QUERIES
from tillwise.functions.scale import clear_scratch, scratch_path
from tillwise.operators import forecast, reports, segments
from tillwise.plans.pipeline import build_marts, run_pipeline, validate
from tillwise.session import local_session
from tillwise.sources.adapters import Inputs
from tillwise.sources.writers import write_processed

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

NAMES = [
    "q1_daily_revenue", "q2_store_mtd", "q3_top_products", "q4_segment_distribution", "q5_stockout_risk",
    "q6_channel_attribution", "q7_new_vs_returning", "int_sales_enriched", "int_customer_orders", "mart_customer_rfm",
    "mart_executive_kpis", "mart_store_performance", "mart_product_performance", "mart_inventory_status",
    "mart_marketing_attribution", "dq_validate_orders", "dq_validate_lines", "fact_sales", "attr_data_driven",
]


def jobs(spark, warehouse: str):
    raw = Inputs(spark, FOLDER)

    def rfm_job():
        rfm = segments.calculate_rfm(raw.order_lines, raw.orders, raw.customers, AS_OF)
        folder = scratch_path(spark, "bench-rfm")
        write_processed({"rfm": rfm}, folder)
        write_processed({"summary": segments.segment_summary(spark.read.parquet(f"{folder}/rfm"))}, folder)

    def forecast_job():
        weekly = forecast.weekly_category_sales(raw.order_lines, raw.orders, raw.products)
        folder = scratch_path(spark, "bench-forecast")
        write_processed({"weekly": weekly}, folder)
        write_processed({"forecast": forecast.forecast_all(spark.read.parquet(f"{folder}/weekly"))}, folder)

    yield "etl_pipeline", lambda: run_pipeline(raw, scratch_path(spark, "bench-warehouse"))
    yield "rfm_job", rfm_job
    yield "forecast_job", forecast_job
    # Dashboards read the marts that the daily run stored.
    mart = lambda name: spark.read.parquet(f"{warehouse}/{name}")
    write = lambda df: df.write.format("noop").mode("overwrite").save()
    yield "stored_kpi_cards", lambda: write(reports.kpi_cards(mart("mart_executive_kpis"), date(2001, 7, 1), date(2001, 7, 28)))
    yield "stored_top_customers", lambda: write(reports.top_customers(mart("mart_customer_rfm")))
    yield "stored_stock_status", lambda: write(reports.status_by_category(mart("mart_inventory_status")))
    yield "stored_segments", lambda: write(segments.segment_counts(mart("mart_customer_rfm")))
    for name in NAMES:
        yield name, lambda n=name: QUERIES[n](spark, FOLDER).write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(CPUS, partitions=int(CPUS))
    # Not timed: starts the engine, lets the JVM compile the common paths, and stores the marts. Lines
    # repeat keys in the test tables, so the gate of the marts is not asked here.
    warehouse, raw = scratch_path(spark, "bench-warm-up"), Inputs(spark, FOLDER)
    orders, lines = validate(raw)
    run_pipeline(raw, warehouse)
    write_processed(build_marts(raw, orders, lines, warehouse, AS_OF, date(1995, 1, 1), datetime(2001, 8, 2)), warehouse)
    times = {}
    for name, job in jobs(spark, warehouse):
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
    }), flush=True)
    clear_scratch(spark)


if __name__ == "__main__":
    main()
