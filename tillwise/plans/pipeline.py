"""The daily run: validate, transform, merge and load, build marts behind a gate, write scores back, audit.

A run can be repeated under its id: facts, rejects and the log row of a run lie in folders of the run and
are replaced, a merged dimension takes a second merge of the same day without change, marts are replaced.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import date, datetime, time, timezone
from types import SimpleNamespace

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.columns import date_key, surrogate_key
from tillwise.functions.scale import scratch_scope, stage
from tillwise.operators import data_tests, dims, facts, inventory, marts, quality, segments
from tillwise.operators.intermediate import Star, int_customer_orders
from tillwise.sources import writers

# Attributes whose changes make a new version (our choice where the requirements name none).
TRACKED = {
    "dim_customer": ("customer_id", ["region", "city", "loyalty_tier", "postcode_district"]),
    "dim_product": ("product_id", ["category", "subcategory", "cost_price_pence", "rrp_pence", "is_active"]),
}
# What a mart must hold to be published.
MART_TESTS = {
    "int_customer_orders": [data_tests.not_null("customer_id"), data_tests.unique("customer_id")],
    "mart_customer_rfm": [data_tests.not_null("customer_id"), data_tests.unique("customer_id"), data_tests.not_null("rfm_segment")],
    "mart_executive_kpis": [data_tests.not_null("order_date"), data_tests.unique("order_date")],
    "mart_store_performance": [data_tests.unique("store_id", "order_year", "order_month")],
    "mart_product_performance": [data_tests.unique("product_id", "order_year", "order_iso_year", "order_week")],
    "mart_inventory_status": [data_tests.not_null("product_id"), data_tests.unique("product_id", "store_id")],
    "mart_marketing_attribution": [data_tests.not_null("campaign_id")],
}


def _utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


@dataclass
class RunSummary:
    run_id: str
    reports: dict[str, dict] = field(default_factory=dict)
    loaded: dict[str, int] = field(default_factory=dict)
    published: dict[str, str] = field(default_factory=dict)
    alerts: int = 0
    status: str = "SUCCESS"


def validate(raw) -> tuple[DataFrame, DataFrame]:
    """Checked orders and lines, written once: clean rows, rejects and report are readings of one decision."""
    orders = stage(quality.check_orders(raw.orders, raw.customers), "checked-orders")
    lines = stage(quality.check_order_lines(raw.order_lines, quality.clean(orders), raw.products), "checked-lines")
    return orders, lines


def build_facts(
    raw, orders: DataFrame, lines: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame, run_id: str, load_time: datetime
) -> dict[str, DataFrame]:
    """The fact tables over the stored dimensions; rows name the versions of customer and product valid on their day."""
    stock = raw.inventory
    if "stock_status" not in stock.columns:
        stock = inventory.with_stock_status(stock, by_product=True)
    return {
        "fact_sales": facts.build_fact_sales(quality.clean_orders(orders), quality.clean(lines), customers, products, stores, run_id, load_time),
        "fact_inventory": facts.build_fact_inventory(stock, products, stores, run_id, load_time),
        "fact_marketing_spend": facts.build_fact_marketing(raw.marketing, run_id, load_time),
    }


def _merged(spark, name: str, new: DataFrame, path: str, day: date) -> DataFrame:
    """The stored dimension with the new snapshot merged in; scores written back earlier stay."""
    key, tracked = TRACKED[name]
    if writers.current_version(spark, path) is None:
        return new.withColumns({"valid_from": F.lit(day).cast("date"), "version": F.lit(1).cast("bigint")})
    stored = writers.read_published(spark, path)
    kept = {"created_at", *dims.VERSION_COLUMNS, *(dims.RFM_COLUMNS if name == "dim_customer" else ())}
    snapshot = new.drop(*kept)
    merged = dims.scd2_merge(stored, snapshot, key, tracked, day)
    return merged.withColumns({
        "created_at": F.coalesce("created_at", "updated_at"), name.removeprefix("dim_") + "_key": dims.version_key(key)
    })


def _load_dimension(spark, df: DataFrame, name: str, warehouse: str, day: date) -> int:
    path = f"{warehouse}/{name}"
    return writers.publish_version(_merged(spark, name, df, path, day) if name in TRACKED else df, path)


def _load_fact(df: DataFrame, name: str, warehouse: str, run_id: str) -> int:
    yearly = df.withColumn("year", F.expr("date_key div 10000").cast("int")).hint("rebalance", "year")
    return writers.replace_run(yearly, f"{warehouse}/{name}", run_id, partition_by="year")


def load_warehouse(raw, orders: DataFrame, lines: DataFrame, warehouse: str, summary: RunSummary, started: datetime, day: date) -> DataFrame:
    """Load all tables and rejects; returns the quality reports."""
    spark = raw.spark
    snapshots = {
        "dim_customer": dims.transform_customers(raw.customers, started), "dim_product": dims.transform_products(raw.products, started),
        "dim_store": dims.transform_stores(raw.stores, started),
    }
    # Dimensions do not depend on each other, nor do facts: their jobs share the cluster.
    with ThreadPoolExecutor(max_workers=3) as pool:
        jobs = {name: pool.submit(_load_dimension, spark, df, name, warehouse, day) for name, df in snapshots.items()}
        summary.loaded = {name: job.result() for name, job in jobs.items()}
        stored = [writers.read_published(spark, f"{warehouse}/{name}") for name in snapshots]
        tables = build_facts(raw, orders, lines, *stored, summary.run_id, started)
        jobs = {name: pool.submit(_load_fact, df, name, warehouse, summary.run_id) for name, df in tables.items()}
        summary.loaded |= {name: job.result() for name, job in jobs.items()}
    rejected = quality.quarantine(quality.failed(orders), summary.run_id, "POS").unionByName(
        quality.quarantine(quality.failed(lines), summary.run_id, "POS")
    )
    writers.append_quarantine(rejected, f"{warehouse}/data_quality_quarantine", summary.run_id)
    reports = stage(quality.dq_report(orders, "orders").unionByName(quality.dq_report(lines, "order_lines")), "reports")
    summary.reports = {r["source"]: r.asDict() for r in reports.collect()}  # two rows
    return reports


def build_marts(raw, orders: DataFrame, lines: DataFrame, warehouse: str, as_of: date, start: date, load_time: datetime) -> dict[str, DataFrame]:
    """The marts over the accepted rows and the stored dimensions."""
    spark = raw.spark
    accepted = SimpleNamespace(spark=spark, orders=quality.clean_orders(orders), order_lines=quality.clean(lines))
    days = accepted.orders.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b"))
    star = Star(accepted, load_time=load_time)
    star.customers, star.products, star.stores = (
        writers.read_published(spark, f"{warehouse}/{n}").filter("is_current") for n in ("dim_customer", "dim_product", "dim_store")
    )
    star.dates = dims.describe_dates(dims.spine_between(days, "a", "b"))
    customers = stage(int_customer_orders(star, as_of), "customer-orders")
    stock = raw.inventory if "stock_status" in raw.inventory.columns else inventory.with_stock_status(raw.inventory)
    stock = stock.withColumns({"date_key": date_key("snapshot_date"), "inventory_key": surrogate_key(facts.INVENTORY_ID)})
    return {
        "int_customer_orders": customers,
        "mart_customer_rfm": segments.mart_customer_rfm(customers),
        "mart_executive_kpis": marts.mart_executive_kpis(star, start),
        "mart_store_performance": marts.mart_store_performance(star),
        "mart_product_performance": marts.mart_product_performance(star),
        "mart_inventory_status": marts.mart_inventory_status(stock, star.products, star.stores),
        "mart_marketing_attribution": marts.mart_marketing_attribution(raw.marketing, dims.build_dim_campaign(raw.marketing, load_time)),
    }


def publish_marts(tables: dict[str, DataFrame], reports: DataFrame, warehouse: str, max_reject_pct: float = 5.0, prefix: str = "tillwise_") -> dict[str, str]:
    """Outcome per mart: PUBLISHED, or KEEP_PREVIOUS with the reason; what was stored before then stays.

    Nothing is published where a source rejected more than `max_reject_pct` per cent of its rows.
    """
    if data_tests.reject_rate_gate(reports, max_reject_pct).filter("action = 'KEEP_PREVIOUS'").count():
        return {name: "KEEP_PREVIOUS: reject rate" for name in tables}
    out = {}
    for name, df in tables.items():
        publish = lambda staged, n=name: writers.publish_table(staged, prefix + n, f"{warehouse}/{n}")
        try:
            data_tests.gate(df, name, MART_TESTS[name], publish)
            out[name] = "PUBLISHED"
        except data_tests.GateClosed as e:
            out[name] = f"KEEP_PREVIOUS: {e}"
    return out


def write_scores_back(spark, warehouse: str) -> None:
    """Scores, segment and lifetime value of the published RFM mart into the current customers."""
    path = f"{warehouse}/dim_customer"
    stored = writers.read_published(spark, path)
    scored = segments.update_customers(stored.filter("is_current"), writers.read_published(spark, f"{warehouse}/mart_customer_rfm"))
    writers.publish_version(scored.unionByName(stored.filter("NOT is_current")), path)


def run_pipeline(
    raw, warehouse: str, run_id: str | None = None, day: date | None = None, with_marts: bool = False,
    as_of: date | None = None, start: date = date(1990, 1, 1), max_reject_pct: float = 5.0,
) -> RunSummary:
    """One run on `day` into `warehouse`. With marts, also the marts as of `as_of` (default: `day`) and the scores.

    Customers and products keep their history; stores are replaced; facts and rejects are kept per run. What the
    run stages is deleted at its end.
    """
    with scratch_scope(raw.spark):
        return _run(raw, warehouse, run_id, day, with_marts, as_of, start, max_reject_pct)


def _run(
    raw, warehouse: str, run_id: str | None, day: date | None, with_marts: bool, as_of: date | None, start: date, max_reject_pct: float
) -> RunSummary:
    started = _utc_now()
    day = day or started.date()
    summary = RunSummary(run_id or str(uuid.uuid4()))
    spark, error = raw.spark, None
    try:
        alerts = freshness_and_volume(raw, datetime.combine(day, time()))
        summary.alerts = writers.replace_run(alerts, f"{warehouse}/pipeline_alerts", summary.run_id, "run_id")
        orders, lines = validate(raw)
        reports = load_warehouse(raw, orders, lines, warehouse, summary, started, day)
        if with_marts:
            tables = build_marts(raw, orders, lines, warehouse, as_of or day, start, started)
            summary.published = publish_marts(tables, reports, warehouse, max_reject_pct)
            if summary.published["mart_customer_rfm"] == "PUBLISHED":
                write_scores_back(spark, warehouse)
                scores = writers.read_published(spark, f"{warehouse}/mart_customer_rfm")
                segments.append_history(scores.select("customer_id", "rfm_segment"), day, f"{warehouse}/segment_history")
    except Exception as e:
        summary.status, error = "FAILED", str(e)[:500]
        raise
    finally:
        totals = [sum(r[c] for r in summary.reports.values()) for c in ("records_input", "records_clean", "records_quarantined")]
        log = writers.run_log_row(spark, summary.run_id, "ALL", *totals, summary.status, started, _utc_now(), error)
        writers.replace_run(log, f"{warehouse}/pipeline_run_log", summary.run_id, "run_id")
    return summary


def freshness_and_volume(raw, as_of: datetime, hours: int = 26, tolerance_pct: int = 20) -> DataFrame:
    """Warnings that do not stop a run: (check, source, day, value, expected).

    `freshness`: the newest order or stock row is older than `hours` (value: its age in seconds, null for none).
    `volume`: a channel's orders of the newest day are not within `tolerance_pct` of the mean of the seven days before.
    """
    orders, stock = (df.select(quality.as_date(c).alias("day")) for df, c in ((raw.orders, "order_date"), (raw.inventory, "snapshot_date")))
    ages = quality.freshness_check(orders, "day", "orders", as_of, hours).unionByName(
        quality.freshness_check(stock, "day", "inventory", as_of, hours)
    )
    stale = ages.filter("is_stale").select(
        F.lit("freshness").alias("check"), "source", F.lit(as_of.date()).alias("day"), F.col("age_seconds").alias("value"),
        F.lit(hours * 3600).cast("bigint").alias("expected"),
    )
    # The newest week and the day itself are all that a warning needs.
    dated = raw.orders.select("channel", quality.as_date("order_date").alias("order_date")).filter(
        F.col("order_date").between(F.date_sub(F.lit(as_of.date()), 8), F.lit(as_of.date()))
    )
    daily = dated.groupBy("channel", "order_date").agg(F.count(F.lit(1)).alias("records"))
    newest = F.max("order_date").over(Window.partitionBy("channel"))
    checked = quality.volume_check(daily, ["channel"], "order_date", "records", tolerance_pct).withColumn("newest", newest)
    odd = checked.filter("is_outside AND order_date = newest").select(
        F.lit("volume").alias("check"), F.concat(F.lit("orders of "), F.coalesce("channel", F.lit("no channel"))).alias("source"),
        F.col("order_date").alias("day"), F.col("records").alias("value"), F.expr("prior_total div prior_days").alias("expected"),
    )
    return stale.unionByName(odd)
