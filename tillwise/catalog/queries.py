"""Every operator as a query over the test tables."""

from __future__ import annotations

import functools
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise import model
from tillwise.functions import columns as C
from tillwise.functions.scale import bytes_in, scratch_path, stage
from tillwise.operators import (
    attribution, customer_state, data_tests, dims, facts, forecast, intermediate, inventory, marts, quality, reports, segments,
    staging,
)
from tillwise.plans.pipeline import MART_TESTS
from tillwise.session import partition_for, tune
from tillwise.sources import adapters, readers, writers
from tillwise.sources.adapters import Inputs
from tillwise.streaming import hourly, landing, store_sales

AS_OF = date(2001, 8, 2)  # the day after the last order
EVENTS_AS_OF = date(2024, 1, 31)  # the day after the last event
LOAD_TIME = datetime(2001, 8, 2)
START = date(1995, 1, 1)
CALENDAR = (date(1990, 1, 1), date(2030, 12, 31))
RUN = "run-1"
AUDIT = ("created_at", "updated_at", "rfm_updated_at")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


_inputs: dict[tuple[str, str], Inputs] = {}


def inputs(spark: SparkSession, folder: str) -> Inputs:
    """The plans over a folder's tables, shared by the queries of one application. No rows are kept."""
    key = (spark.sparkContext.applicationId, folder)
    if key not in _inputs:
        _inputs[key] = Inputs(spark, folder)
    return _inputs[key]


def query(name: str):
    def register(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tables = sum(bytes_in(spark, f"{folder}/{t}.parquet") for t in adapters.TABLES)
            return fn(inputs(partition_for(tune(spark), tables), folder))

        QUERIES[name] = run
        return fn

    return register


def star(raw: Inputs) -> intermediate.Star:
    if "planned_star" not in vars(raw):
        raw.planned_star = intermediate.Star(raw, *CALENDAR, load_time=LOAD_TIME, run_id=RUN)
    return raw.planned_star


def calendar(raw: Inputs) -> DataFrame:
    return dims.build_dim_date(raw.spark, *CALENDAR)


def no_audit(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in AUDIT if c in df.columns])


# --- sources and sinks ----------------------------------------------------------------------

@query("src_read_raw")
def _(raw):
    """CSV written from the tables, read back through the given schemas; counts per file."""
    folder = scratch_path(raw.spark, "csv")
    inputs = {
        "customers": dims.transform_customers(raw.customers, LOAD_TIME), "products": raw.products, "stores": raw.stores,
        "orders": raw.orders.withColumn("store_id", F.lit(None).cast("string")), "order_lines": raw.order_lines,
        "marketing": raw.marketing,
    }
    for name, df in inputs.items():
        fields = [f for f in model.RAW[name].fieldNames()]
        df.select(*fields).write.option("header", True).csv(f"{folder}/{model.RAW_FILES[name]}")
    out = None
    for name, df in readers.read_raw(raw.spark, folder).items():
        row = df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n"))
        out = row if out is None else out.unionByName(row)
    return out


@query("src_sql_query")
def _(raw):
    sql = """SELECT channel, count(*) AS orders, cast(sum(order_total_pence) AS double) / 100 AS total_gbp
             FROM {orders} WHERE order_total_pence > 0 GROUP BY channel"""
    return readers.run_query(raw.spark, sql, orders=raw.orders)


@query("src_read_columns")
def _(raw):
    return readers.read_columns(raw.products, ["product_id", "category"])


@query("src_lower_columns")
def _(raw):
    upper = raw.stores.toDF(*[c.upper() for c in raw.stores.columns])
    return readers.lower_columns(upper)


@query("src_landing_stream")
def _(raw):
    """Landed files taken in as a stream, twice: the second run finds nothing new."""
    path = scratch_path(raw.spark, "landing")
    text = raw.orders.select(F.to_json(F.struct("order_id", "customer_id", "order_total_pence", "channel")).alias("value"))
    broken = F.when(F.length("value") % 7 == 0, F.concat(F.lit("{"), F.col("value"))).otherwise(F.col("value"))
    text.select(broken.alias("value")).write.text(f"{path}/in")
    feed = landing.Landing(raw.spark, f"{path}/in", f"{path}/out", model.schema(order_id=model.S, customer_id=model.S, order_total_pence=model.L))
    feed.take()
    feed.take()
    accepted = feed.accepted.read().groupBy(F.col("extra")["channel"].alias("channel")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_total_pence").alias("total_pence")
    )
    bad = feed.quarantined.read().agg(F.lit("quarantined").alias("channel"), F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("total_pence"))
    return accepted.unionByName(bad)


@query("src_json_landing")
def _(raw):
    path = scratch_path(raw.spark, "landing")
    text = raw.orders.select(F.to_json(F.struct("order_id", "customer_id", "order_total_pence")).alias("value"))
    broken = F.when(F.length("value") % 7 == 0, F.concat(F.lit("{"), F.col("value"))).otherwise(F.col("value"))
    text.select(broken.alias("value")).write.text(path)
    schema = model.schema(order_id=model.S, customer_id=model.S, order_total_pence=model.L)
    df = readers.read_json_landing(raw.spark, path, schema)
    return df.groupBy(F.col(readers.CORRUPT).isNotNull().alias("is_corrupt")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("order_total_pence").alias("total_pence")
    )


def sales_fact(raw: Inputs) -> DataFrame:
    s = star(raw)
    return facts.build_fact_sales(raw.orders, raw.order_lines, s.customers, s.products, s.stores, RUN, LOAD_TIME)


@query("sink_load_roundtrip")
def _(raw):
    """Truncate, append twice, read back."""
    path = scratch_path(raw.spark, "roundtrip")
    lines = raw.order_lines.select("order_line_id", "units_sold", "net_revenue_pence")
    counts = [writers.load_table(lines, path, m) for m in ("overwrite", "append")]
    return raw.spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("stored"), F.lit(sum(counts)).cast("bigint").alias("reported"), F.sum("units_sold").alias("units")
    )


@query("sink_write_processed")
def _(raw):
    """All six warehouse tables as files; what is read back is counted."""
    folder, built = scratch_path(raw.spark, "processed"), star(raw)
    tables = {
        "dim_customer": built.customers, "dim_product": built.products, "dim_store": built.stores, "fact_sales": sales_fact(raw),
        "fact_inventory": facts.build_fact_inventory(stock(raw, by_product=True), built.products, built.stores, RUN, LOAD_TIME),
        "fact_marketing_spend": facts.build_fact_marketing(raw.marketing, RUN, LOAD_TIME),
    }
    writers.write_processed(tables, folder)
    counts = [raw.spark.read.parquet(f"{folder}/{n}").agg(F.lit(n).alias("table_name"), F.count(F.lit(1)).alias("n")) for n in tables]
    return functools.reduce(DataFrame.unionByName, counts)


@query("sink_quarantine")
def _(raw):
    """Rejected orders appended to the quarantine table and read back by reason."""
    path = scratch_path(raw.spark, "quarantine")
    _, rejected, _ = quality.validate_orders(bad_orders(raw), RUN)
    appended = writers.append_quarantine(rejected, path, RUN)
    return raw.spark.read.parquet(path).groupBy("run_id", "source_system", "failure_reason", "failed_check").agg(
        F.count(F.lit(1)).alias("n"), F.lit(appended).cast("bigint").alias("appended")
    )


@query("sink_partition_prune")
def _(raw):
    """Yearly partitions; only the folder of one year is read back."""
    path = scratch_path(raw.spark, "yearly")
    fact = sales_fact(raw).select("date_key", "store_key", "product_key", "units_sold", "net_revenue_pence")
    writers.write_yearly_partitioned(fact, path, ("store_key", "product_key"))
    one = raw.spark.read.parquet(path).filter("year = 1998")
    return one.groupBy("store_key").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("units_sold").alias("units"), C.gbp(F.sum("net_revenue_pence")).alias("revenue_gbp")
    )


@query("sink_publish")
def _(raw):
    writers.publish_view(raw.stores, "tillwise_stores")
    exists = readers.table_exists(raw.spark, "tillwise_stores")
    return readers.read_table(raw.spark, "tillwise_stores").groupBy("store_type").agg(
        F.count(F.lit(1)).alias("stores"), F.lit(exists).alias("view_exists")
    )


# --- validation -----------------------------------------------------------------------------

def bad_orders(raw: Inputs) -> DataFrame:
    return adapters.faulty_orders(raw.spark, raw.folder)


def bad_lines(raw: Inputs) -> DataFrame:
    return adapters.faulty_order_lines(raw.spark, raw.folder)


def tally(checked: DataFrame, *keys: str) -> DataFrame:
    return checked.groupBy(quality.FAILED, *keys).agg(F.count(F.lit(1)).alias("n"))


@query("dq_null_check")
def _(raw):
    return tally(quality.null_check(bad_orders(raw), quality.ORDER_KEYS), "channel")


@query("dq_duplicates")
def _(raw):
    return tally(quality.duplicate_check(bad_orders(raw).filter(F.col("order_id").isNotNull()), "order_id"), "channel")


@query("dq_range_check")
def _(raw):
    return tally(quality.range_check(bad_orders(raw), "order_total_pence", 0, open_low=True), "channel")


@query("dq_date_check")
def _(raw):
    return tally(quality.date_check(bad_orders(raw), "order_date"), "channel")


@query("dq_orphan_orders")
def _(raw):
    checked = quality.ref_integrity(bad_lines(raw), "order_id", raw.orders)
    return quality.failed(checked).groupBy("order_id").agg(F.count(F.lit(1)).alias("n"), F.sum("units_sold").alias("units"))


@query("dq_unknown_products")
def _(raw):
    checked = quality.ref_integrity(bad_lines(raw), "product_id", raw.products)
    return quality.failed(checked).groupBy("product_id").agg(F.count(F.lit(1)).alias("n"), F.sum("units_sold").alias("units"))


@query("dq_quarantine")
def _(raw):
    _, rejected, _ = quality.validate_orders(bad_orders(raw), RUN)
    return rejected.select("run_id", "source_system", "failure_reason", "failed_check",
                           F.get_json_object("record_raw", "$.order_id").alias("order_id"),
                           F.get_json_object("record_raw", "$.order_total_pence").alias("order_total_pence"))


@query("dq_validate_orders")
def _(raw):
    return quality.check_orders(bad_orders(raw))


@query("dq_validate_lines")
def _(raw):
    orders = quality.clean(quality.check_orders(bad_orders(raw)))
    checked = quality.check_order_lines(bad_lines(raw), orders, raw.products)
    return checked.select("order_line_id", "order_id", "product_id", "units_sold", quality.FAILED)


def validation_report(raw: Inputs) -> DataFrame:
    """Reports of orders and lines; the orders are checked once, for their report and for the lines."""
    orders = stage(quality.check_orders(bad_orders(raw)), "checked-orders")
    lines = quality.check_order_lines(bad_lines(raw), quality.clean(orders), raw.products)
    return quality.dq_report(orders, "orders").unionByName(quality.dq_report(lines, "order_lines"))


@query("dq_report")
def _(raw):
    return validation_report(raw)


@query("dq_dedupe_latest")
def _(raw):
    """Events reported more than once per user and type: the newest stays."""
    events = adapters.table(raw.spark, raw.folder, "events")
    return quality.dedupe_latest(events, ["event_type", "user_id"], ["ts", "event_id"]).select("event_type", "user_id", "event_id", "value")


@query("dq_fill_missing")
def _(raw):
    df = bad_orders(raw).withColumn("amount", F.col("order_total_pence")).withColumn("day", quality.as_date("order_date"))
    filled = quality.fill_missing(df, zero=["order_total_pence"], mean=["amount"], text=["customer_id", "campaign_id"], dates=["day"])
    return filled.groupBy("channel", "date_missing").agg(
        F.sum("order_total_pence").alias("total_pence"), F.count_if(F.col("customer_id") == "UNKNOWN").alias("unknown_customers"),
        F.count_if(F.col("campaign_id") == "UNKNOWN").alias("unknown_campaigns"), F.count("amount").alias("amounts"),
        F.round(F.max("amount"), 0).alias("max_amount"),
    )


@query("dq_value_ceiling")
def _(raw):
    return quality.order_value_ceiling(raw.orders).groupBy("needs_review").agg(
        F.count(F.lit(1)).alias("n"), F.max("order_total_pence").alias("largest")
    )


@query("dq_unknown_customers")
def _(raw):
    return quality.unknown_customers(bad_orders(raw).filter(F.col("customer_id").isNotNull())
                                     .withColumn("customer_id", F.when(F.length("order_id") % 3 == 0, F.concat("customer_id", F.lit("X"))).otherwise(F.col("customer_id"))),
                                     raw.customers).select("customer_id", "order_id")


@query("dq_freshness")
def _(raw):
    orders = adapters.table(raw.spark, raw.folder, "orders")
    events = adapters.table(raw.spark, raw.folder, "events")
    return quality.freshness_check(orders, "o_orderdate", "orders", datetime(2001, 8, 2, 12)).unionByName(
        quality.freshness_check(events, "ts", "events", datetime(2024, 1, 31))
    )


@query("dq_volume")
def _(raw):
    daily = raw.orders.groupBy("channel", "order_date").agg(F.count(F.lit(1)).alias("records"))
    return quality.volume_check(daily, ["channel"], "order_date", "records")


def run_log(raw: Inputs) -> DataFrame:
    """One run per order day and channel, with the outcome of validating that day's orders."""
    orders = bad_orders(raw).withColumn("run_date", quality.as_date("order_date")).filter(F.col("run_date").isNotNull())
    bad = quality.range_bad("order_total_pence", 0, open_low=True) | F.col("order_id").isNull()
    n, rejected = F.count(F.lit(1)), F.count_if(bad)
    return orders.groupBy("run_date", F.col("channel").alias("source_system")).agg(
        n.alias("records_extracted"), (n - rejected).alias("records_loaded"), rejected.alias("records_quarantined"),
        F.when(rejected == 0, "SUCCESS").when(rejected < n, "PARTIAL").otherwise("FAILED").alias("status"),
        F.lit(None).cast("string").alias("error_message"), (n * 2).alias("duration_seconds"),
    )


@query("q8_pipeline_health")
def _(raw):
    return reports.pipeline_health(run_log(raw), AS_OF)


@query("audit_run_log")
def _(raw):
    """The audit row of a run over orders and lines, from the reports of their validation."""
    return writers.run_log_of(validation_report(raw), RUN, "ALL", "SUCCESS", LOAD_TIME, LOAD_TIME)


TABLE_TESTS = {
    "customers": ["customer_id", "region"], "products": ["product_id", "category"], "stores": ["store_id", "region"],
    "order_lines": ["order_line_id", "order_id", "product_id"], "marketing": ["campaign_id", "channel"],
}


@query("dq_dashboard")
def _(raw):
    """Runs, tests of all inputs, and the age of the newest row of each table that has a time."""
    tests = data_tests.run_tests(bad_orders(raw), "orders", [data_tests.not_null(c) for c in quality.ORDER_KEYS])
    for name, columns in TABLE_TESTS.items():
        tests = tests.unionByName(data_tests.run_tests(getattr(raw, name), name, [data_tests.not_null(c) for c in columns]))
    tables = {
        "orders": (adapters.table(raw.spark, raw.folder, "orders"), "o_orderdate"),
        "lineitem": (adapters.table(raw.spark, raw.folder, "lineitem"), "l_shipdate"),
        "events": (adapters.table(raw.spark, raw.folder, "events"), "ts"),
    }
    return quality.quality_dashboard(run_log(raw), tests, tables, LOAD_TIME)


# --- dimensions and facts -------------------------------------------------------------------

@query("key_surrogate")
def _(raw):
    return raw.products.select("product_id", C.surrogate_key("product_id").alias("product_key"))


@query("key_date")
def _(raw):
    return raw.orders.groupBy(C.date_key("order_date").alias("date_key")).agg(F.count(F.lit(1)).alias("orders"))


@query("dim_customer")
def _(raw):
    return no_audit(star(raw).customers)


@query("dim_product")
def _(raw):
    return no_audit(star(raw).products)


@query("dim_store")
def _(raw):
    return no_audit(star(raw).stores)


@query("dim_date")
def _(raw):
    bounds = raw.orders.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b"))
    return dims.describe_dates(dims.spine_between(bounds, "a", "b"))


@query("dim_channel")
def _(raw):
    """Channels with the orders that came through each; unlisted ones share key 99."""
    channels = dims.build_dim_channel(raw.spark)
    keyed = raw.orders.groupBy(facts.channel_key(F.col("channel")).alias("channel_key")).agg(F.count(F.lit(1)).alias("orders"))
    return keyed.join(F.broadcast(channels), "channel_key", "left")


@query("dim_campaign")
def _(raw):
    return no_audit(dims.build_dim_campaign(raw.marketing, LOAD_TIME))


@query("dim_holiday_effects")
def _(raw):
    """Orders and stream events on days under a holiday's influence, per holiday and year."""
    orders = raw.orders.groupBy(F.col("order_date").alias("day")).agg(F.count(F.lit(1)).alias("orders"), F.lit(0).cast("bigint").alias("events"))
    stream = adapters.table(raw.spark, raw.folder, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.lit(0).cast("bigint").alias("orders"), F.count(F.lit(1)).alias("events"))
    days = orders.unionByName(stream)
    effects = dims.effect_days(dims.bank_holidays(days.select(F.year("day").alias("year"))))
    # The calendar's days are few whatever the number of orders.
    return days.join(effects, F.col("day") == F.col("effect_date")).groupBy(
        "holiday_name", F.year("day").cast("bigint").alias("effect_year")
    ).agg(F.sum("orders").alias("orders"), F.sum("events").alias("events"))


@query("fact_sales")
def _(raw):
    return no_audit(sales_fact(raw))


def stock(raw: Inputs, by_product: bool = False) -> DataFrame:
    return inventory.with_stock_status(raw.inventory, by_product=by_product)


@query("fact_inventory")
def _(raw):
    s = star(raw)
    return no_audit(facts.build_fact_inventory(stock(raw, by_product=True), s.products, s.stores, RUN, LOAD_TIME))


@query("fact_marketing_spend")
def _(raw):
    return no_audit(facts.build_fact_marketing(raw.marketing, RUN, LOAD_TIME))


@query("scd2_history")
def _(raw):
    return dims.scd2_history(customer_snapshots(raw), "customer_id", ["loyalty_tier", "city"], "snapshot_date")


def dated_versions(raw: Inputs, dim: DataFrame, natural: str, attribute: str, every: int, key: str) -> DataFrame:
    """Versions from three yearly snapshots; every so manyth member changes its attribute in the second and back in the third."""
    k = F.regexp_extract(natural, r"(\d+)$", 1).cast("bigint")
    days = F.array(*[F.lit(d).cast("date") for d in ("1993-01-01", "1996-03-01", "1998-09-01")])
    dated = dim.select(natural, attribute, F.explode(days).alias("snapshot_date"))
    moved = F.when((k % every == 0) & (F.year("snapshot_date") == 1996), "Moved").otherwise(F.col(attribute))
    versions = dims.scd2_history(dated.withColumn(attribute, moved), natural, [attribute], "snapshot_date")
    return versions.withColumn(key, dims.version_key(natural))


@query("fact_sales_asof")
def _(raw):
    """Order lines with the keys of the customer's and product's versions on the order's day."""
    s = star(raw)
    people = dated_versions(raw, s.customers, "customer_id", "loyalty_tier", 7, "customer_key")
    goods = dated_versions(raw, s.products, "product_id", "category", 3, "product_key")
    fact = facts.build_fact_sales(raw.orders, raw.order_lines, people, goods, s.stores, RUN, LOAD_TIME)
    return fact.select("order_line_id", "date_key", "customer_key", "product_key", "store_key", "net_revenue_pence")


def customer_snapshots(raw: Inputs) -> DataFrame:
    """Three dated snapshots; some customers change tier in the second."""
    base = star(raw).customers.select("customer_id", "loyalty_tier", "city")
    k = F.regexp_extract("customer_id", r"(\d+)$", 1).cast("bigint")
    changed = F.when(k % 7 == 0, "Platinum").otherwise(F.col("loyalty_tier"))
    days = F.array(*[F.lit(d).cast("date") for d in ("2001-06-01", "2001-07-01", "2001-08-01")])
    dated = base.select("*", F.explode(days).alias("snapshot_date"))
    return dated.withColumn("loyalty_tier", F.when(F.col("snapshot_date") == "2001-07-01", changed).otherwise(F.col("loyalty_tier")))


@query("scd2_merge")
def _(raw):
    base = star(raw).customers.select("customer_id", "loyalty_tier", "city")
    k = F.regexp_extract("customer_id", r"(\d+)$", 1).cast("bigint")
    dim = base.withColumns(
        {"customer_id": F.when(k % 11 == 0, F.concat("customer_id", F.lit("-old"))).otherwise(F.col("customer_id")),
         "valid_from": F.lit("2001-06-01").cast("date"), "valid_to": F.lit(None).cast("date"), "is_current": F.lit(True),
         "version": F.lit(1).cast("bigint")}
    )
    snapshot = base.withColumn("loyalty_tier", F.when(k % 7 == 0, "Platinum").otherwise(F.col("loyalty_tier")))
    return dims.scd2_merge(dim, snapshot, "customer_id", ["loyalty_tier", "city"], AS_OF)


# --- staging and intermediate ---------------------------------------------------------------

@query("stg_sales")
def _(raw):
    return no_audit(staging.stg_sales(sales_fact(raw)))


@query("stg_customers")
def _(raw):
    return no_audit(staging.stg_customers(star(raw).customers))


@query("stg_products")
def _(raw):
    return no_audit(staging.stg_products(star(raw).products))


@query("stg_stores")
def _(raw):
    return no_audit(staging.stg_stores(star(raw).stores))


@query("stg_inventory")
def _(raw):
    s = star(raw)
    return no_audit(staging.stg_inventory(facts.build_fact_inventory(stock(raw, by_product=True), s.products, s.stores, RUN, LOAD_TIME)))


@query("stg_marketing_spend")
def _(raw):
    return no_audit(staging.stg_marketing_spend(facts.build_fact_marketing(raw.marketing, RUN, LOAD_TIME)))


@query("int_sales_enriched")
def _(raw):
    return intermediate.enriched_columns(intermediate.int_sales_enriched(star(raw), numbered=True), RUN)


def customer_orders(raw: Inputs, as_of: date = AS_OF, until: date | None = None) -> DataFrame:
    return intermediate.int_customer_orders(star(raw), as_of, until=until)


@query("int_customer_orders")
def _(raw):
    return customer_orders(raw).drop("total_revenue_pence", "total_profit_pence")


@query("customer_state")
def _(raw):
    """The same from a stored state: the history up to July, then week by week merged into it; a week given twice counts once."""
    s = star(raw)
    sales = stage(intermediate.not_returned(intermediate.int_sales_enriched(s)).select(
        "customer_id", "order_id", "order_date", "category", "units_sold", "net_revenue_pence", "gross_profit_pence", "is_weekend", "is_promotional_period", "store_type"
    ), "state-sales")
    store = customer_state.HabitStore(raw.spark, scratch_path(raw.spark, "customer-state"))
    for day in (date(2001, 7, 1), date(2001, 7, 8), date(2001, 7, 8), date(2001, 7, 20), AS_OF):
        store.advance(sales, day)
    return customer_state.customer_orders_of(store.state(), s.customers, AS_OF).drop("total_revenue_pence", "total_profit_pence")


@query("int_customer_orders_12m")
def _(raw):
    """The same over the last 12 months, as the requirements ask."""
    out = intermediate.int_customer_orders(star(raw), AS_OF, window_months=12)
    return out.select("customer_id", "days_since_last_purchase", "purchase_frequency", "total_orders", "total_revenue_gbp")


@query("customer_top_category")
def _(raw):
    sales = intermediate.not_returned(intermediate.int_sales_enriched(star(raw), ("customer", "product")))
    return intermediate.customer_top_category(sales)


# --- marts ----------------------------------------------------------------------------------

def rfm(raw: Inputs, as_of: date = AS_OF, until: date | None = None) -> DataFrame:
    return segments.mart_customer_rfm(customer_orders(raw, as_of, until))


@query("mart_customer_rfm")
def _(raw):
    return rfm(raw).drop("total_revenue_pence")


@query("mart_customer_rfm_literal")
def _(raw):
    return segments.mart_customer_rfm(customer_orders(raw), recency="literal").select("customer_id", "r_score", "rfm_segment")


@query("daily_sales_kpis")
def _(raw):
    return marts.daily_sales_kpis(star(raw), START)


@query("mart_executive_kpis")
def _(raw):
    return marts.mart_executive_kpis(star(raw), START)


@query("mart_store_performance")
def _(raw):
    return marts.mart_store_performance(star(raw))


@query("mart_product_performance")
def _(raw):
    return marts.mart_product_performance(star(raw))


def inventory_status(raw: Inputs) -> DataFrame:
    s = star(raw)
    keyed = stock(raw).withColumns(
        {"date_key": C.date_key("snapshot_date"), "inventory_key": C.surrogate_key(facts.INVENTORY_ID)}
    )
    return marts.mart_inventory_status(keyed, s.products, s.stores)


@query("mart_inventory_status")
def _(raw):
    return inventory_status(raw)


def marketing_attribution(raw: Inputs) -> DataFrame:
    return marts.mart_marketing_attribution(raw.marketing, dims.build_dim_campaign(raw.marketing, LOAD_TIME))


@query("mart_marketing_attribution")
def _(raw):
    return marketing_attribution(raw)


# --- analytical queries ---------------------------------------------------------------------

@query("q1_daily_revenue")
def _(raw):
    return reports.daily_revenue(star(raw), AS_OF)


@query("q2_store_mtd")
def _(raw):
    return reports.store_mtd_vs_prior(star(raw), AS_OF)


@query("q3_top_products")
def _(raw):
    return reports.top_products(star(raw), AS_OF)


@query("q4_segment_distribution")
def _(raw):
    return segments.segment_distribution(segments.update_customers(star(raw).customers, rfm(raw)))


def weekly(raw: Inputs) -> DataFrame:
    return forecast.weekly_category_sales(raw.order_lines, raw.orders, raw.products)


def product_daily(raw: Inputs, first: date | None = None, last: date | None = None) -> DataFrame:
    # A few rows per week, read by every branch of the forecast.
    fc = stage(forecast.moving_average_forecast(stage(weekly(raw), "weekly")), "forecast")
    return forecast.product_daily_forecast(fc, raw.order_lines, raw.orders, raw.products, first_day=first, last_day=last)


def next_week_demand(raw: Inputs) -> DataFrame:
    return product_daily(raw, AS_OF, date(2001, 8, 9))


@query("q5_stockout_risk")
def _(raw):
    s = star(raw)
    return inventory.stockout_risk(stock(raw), s.products, s.stores, next_week_demand(raw), AS_OF)


@query("q6_channel_attribution")
def _(raw):
    return reports.channel_attribution(raw.marketing, dims.build_dim_campaign(raw.marketing, LOAD_TIME), EVENTS_AS_OF)


@query("q7_new_vs_returning")
def _(raw):
    return reports.new_vs_returning(star(raw), AS_OF)


# --- segmentation job -----------------------------------------------------------------------

def metrics(raw: Inputs) -> DataFrame:
    return segments.rfm_metrics(segments.load_sales(raw.order_lines, raw.orders), AS_OF)


def scored(raw: Inputs) -> DataFrame:
    return segments.score(metrics(raw), "qcut")


@query("rfm_metrics")
def _(raw):
    return metrics(raw).drop("total_revenue_pence")


@query("rfm_qcut_scores")
def _(raw):
    return scored(raw).select("customer_id", "r_score", "f_score", "m_score", "rfm_total_score")


@query("rfm_segments")
def _(raw):
    return segments.calculate_rfm(raw.order_lines, raw.orders, raw.customers, AS_OF).drop("total_revenue_pence")


@query("rfm_segment_summary")
def _(raw):
    return segments.segment_summary(scored(raw))


@query("rfm_heatmap")
def _(raw):
    return segments.rfm_heatmap(scored(raw))


@query("rfm_segment_counts")
def _(raw):
    return segments.segment_counts(scored(raw))


@query("rfm_migration")
def _(raw):
    before = date(2001, 7, 2)
    return segments.segment_migration(rfm(raw, before, before), rfm(raw))


@query("rfm_moved_at_risk")
def _(raw):
    before = date(2001, 7, 2)
    return segments.moved_to(rfm(raw, before, before), rfm(raw), "At Risk")


@query("rfm_acquisition_crosstab")
def _(raw):
    return segments.segment_by_acquisition(rfm(raw))


@query("rfm_history")
def _(raw):
    path = scratch_path(raw.spark, "rfm-history")
    for day in (date(2001, 7, 2), AS_OF):
        segments.append_history(rfm(raw, day, day).select("customer_id", "rfm_segment"), day, path)
    return raw.spark.read.parquet(path).groupBy("run_date", "rfm_segment").agg(F.count(F.lit(1)).alias("customers"))


@query("rfm_channel_crosstab")
def _(raw):
    return segments.segment_by_channel(rfm(raw), raw.orders)


@query("customer_clv")
def _(raw):
    return segments.customer_clv(metrics(raw))


@query("customer_churn_risk")
def _(raw):
    return segments.churn_risk(metrics(raw))


@query("export_segment_members")
def _(raw):
    path = scratch_path(raw.spark, "export")
    writers.write_export(segments.export_segment(rfm(raw), star(raw).customers, "At Risk"), path)
    schema = "customer_id string, email_masked string, segment string, last_purchase_date date, ltv_gbp double"
    return raw.spark.read.schema(schema).option("header", True).csv(path)


# --- forecasting ----------------------------------------------------------------------------

@query("fc_weekly_sales")
def _(raw):
    return weekly(raw)


@query("fc_moving_average")
def _(raw):
    return forecast.moving_average_forecast(weekly(raw))


@query("fc_backtest_split")
def _(raw):
    return forecast.backtest_split(weekly(raw))


@query("fc_mape")
def _(raw):
    w = weekly(raw)
    return forecast.mape(forecast.backtest_moving_average(w), forecast.held_out(w))


@query("fc_seasonal")
def _(raw):
    return forecast.seasonal_forecast(weekly(raw))


@query("fc_all")
def _(raw):
    return forecast.forecast_all(stage(weekly(raw), "weekly"))


@query("fc_accuracy")
def _(raw):
    w = weekly(raw)
    return forecast.forecast_accuracy(forecast.mape(forecast.backtest_moving_average(w), forecast.held_out(w)))


@query("fc_product_daily")
def _(raw):
    return product_daily(raw).drop("forecast_milli_units")


@query("fc_product_units")
def _(raw):
    fc = stage(forecast.moving_average_forecast(stage(weekly(raw), "weekly")), "forecast")
    return forecast.product_daily_units(fc, raw.order_lines, raw.orders, raw.products)


@query("fc_fallback")
def _(raw):
    w = stage(weekly(raw), "weekly")
    errors = forecast.mape(forecast.backtest_seasonal(w), forecast.held_out(w))
    return forecast.forecast_with_fallback(forecast.seasonal_forecast(w), errors, forecast.moving_average_forecast(w))


# --- data tests and macros ------------------------------------------------------------------

def staged_sales(raw: Inputs) -> DataFrame:
    return staging.stg_sales(sales_fact(raw))


@query("test_not_null")
def _(raw):
    tests = [data_tests.not_null(c) for c in ("sale_key", "order_id", "net_revenue_gbp", "units_sold", "is_returned", "campaign_key")]
    return data_tests.run_tests(staged_sales(raw), "stg_sales", tests)


@query("test_unique")
def _(raw):
    by_line = data_tests.run_tests(staged_sales(raw), "stg_sales", [data_tests.unique("order_line_id")])
    return by_line.unionByName(data_tests.run_tests(star(raw).customers, "stg_customers", [data_tests.unique("customer_id")]))


@query("test_accepted_values")
def _(raw):
    s = star(raw)
    out = data_tests.run_tests(s.customers, "stg_customers", [data_tests.accepted_values("loyalty_tier", model.LOYALTY_TIERS)])
    out = out.unionByName(data_tests.run_tests(s.stores, "stg_stores", [data_tests.accepted_values("store_type", ("Physical", "App"))]))
    return out.unionByName(data_tests.run_tests(stock(raw), "stg_inventory", [data_tests.accepted_values("stock_status", model.STOCK_STATUSES)]))


@query("test_revenue_positive")
def _(raw):
    """Lines with their revenue reduced by a fixed amount, so that some break the rule."""
    lowered = staged_sales(raw).withColumn("net_revenue_gbp", F.round(F.col("net_revenue_gbp") - 2000, 2))
    return data_tests.assert_revenue_positive(lowered)


@query("test_rfm_coverage")
def _(raw):
    orders = customer_orders(raw)
    gold = F.col("loyalty_tier") == "Gold"
    return data_tests.assert_rfm_covers(orders, orders.filter(~gold))


@query("fn_safe_divide")
def _(raw):
    return raw.marketing.select("campaign_id", "channel", "date", C.safe_divide("attributed_revenue_pence", "spend_pence").alias("roas"))


@query("fn_date_spine")
def _(raw):
    bounds = raw.orders.agg(F.min("order_date").alias("a"), F.max("order_date").alias("b"))
    return dims.spine_between(bounds, "a", "b")


@query("fn_utc")
def _(raw):
    return raw.touches.select("touch_id", C.to_utc("ts", "America/New_York").alias("utc"))


@query("pii_mask")
def _(raw):
    k = F.regexp_extract("customer_id", r"(\d+)$", 1)
    code = F.concat(F.lit("SW"), F.substring(k, 1, 1), F.lit(" 4AB"))
    return raw.customers.select("customer_id", C.mask_email("email").alias("email_masked"), C.postcode_district(code).alias("postcode_district"))


@query("gate_publish")
def _(raw):
    """A table that passes its tests is published, one that does not is kept back."""
    path = scratch_path(raw.spark, "published")
    rules = [data_tests.not_null("order_id"), data_tests.accepted_values("channel", (*model.CHANNEL_KEYS, "Kiosk"))]
    outcomes = []
    for name, df in (("orders", raw.orders), ("faulty_orders", bad_orders(raw))):
        try:
            data_tests.gate(df, name, rules, lambda ok, n=name: writers.write_processed({n: ok}, path))
            outcomes.append((name, True))
        except data_tests.GateClosed:
            outcomes.append((name, False))
    done = raw.spark.createDataFrame(outcomes, "table_name string, is_published boolean")
    stored = raw.spark.read.parquet(f"{path}/orders").agg(F.count(F.lit(1)).alias("stored"))
    return done.crossJoin(F.broadcast(stored))  # one row


@query("gate_reject_rate")
def _(raw):
    orders = quality.dq_report(quality.check_orders(bad_orders(raw)), "faulty_orders")
    clean = quality.dq_report(quality.range_check(raw.orders, "order_total_pence", 0, open_low=True), "orders")
    return data_tests.reject_rate_gate(orders.unionByName(clean))


# --- dashboards -----------------------------------------------------------------------------

_published: dict[tuple[str, str, str], str] = {}


def published(raw: Inputs, name: str, build: Callable[[Inputs], DataFrame]) -> DataFrame:
    """A stored mart: built, tested and published when a dashboard first asks for it, then read from its files."""
    key = (raw.spark.sparkContext.applicationId, raw.folder, name)
    if key not in _published:
        folder = scratch_path(raw.spark, "marts")
        table = f"tillwise_{folder.rsplit('-', 1)[1]}_{name}"
        data_tests.gate(build(raw), name, MART_TESTS[name], lambda staged: writers.publish_table(staged, table, f"{folder}/{name}"))
        _published[key] = folder
    return writers.read_published(raw.spark, f"{_published[key]}/{name}")


def stored_stock(raw: Inputs) -> DataFrame:
    return published(raw, "mart_inventory_status", inventory_status)


@query("dash_kpi_cards")
def _(raw):
    kpis = published(raw, "mart_executive_kpis", lambda r: marts.mart_executive_kpis(star(r), START))
    return reports.kpi_cards(kpis, date(2001, 7, 1), date(2001, 7, 28))


@query("dash_revenue_region")
def _(raw):
    return reports.revenue_by_region(star(raw))


@query("dash_store_table")
def _(raw):
    return reports.store_table(star(raw), AS_OF)


@query("dash_top_bottom")
def _(raw):
    return reports.top_bottom_products(star(raw))


@query("dash_top_customers")
def _(raw):
    return reports.top_customers(published(raw, "mart_customer_rfm", rfm))


@query("dash_stock_status")
def _(raw):
    return reports.status_by_category(stored_stock(raw))


@query("dash_days_hist")
def _(raw):
    return reports.days_of_stock_histogram(stored_stock(raw))


@query("dash_critical_stock")
def _(raw):
    return reports.critical_stock(stored_stock(raw))


@query("dash_lost_revenue")
def _(raw):
    return reports.lost_revenue(stored_stock(raw))


@query("dash_campaign_scatter")
def _(raw):
    return reports.spend_vs_revenue(published(raw, "mart_marketing_attribution", marketing_attribution))


@query("dash_filtered_kpis")
def _(raw):
    sales = intermediate.int_sales_enriched(star(raw), ("date", "product", "store"))
    view = reports.filter_view(sales, AS_OF, date(2001, 1, 1), date(2001, 7, 31), categories=["Large", "Small"], channels=["Online", "In-Store"])
    return reports.filtered_kpis(view)


@query("dash_default_kpis")
def _(raw):
    return reports.filtered_kpis(reports.filter_view(intermediate.int_sales_enriched(star(raw), ("date", "store")), AS_OF))


@query("dash_store_scope")
def _(raw):
    sales = intermediate.int_sales_enriched(star(raw), ("date", "store"))
    return reports.restrict_to_store(sales, "STR-14").groupBy("order_date").agg(
        F.sum("units_sold").alias("units"), C.gbp(F.sum("net_revenue_pence")).alias("revenue_gbp")
    )


@query("dash_entitled_sales")
def _(raw):
    """Sales as each of three users sees them: one with a third of the stores, one with two, one without an entry."""
    k = F.regexp_extract("store_id", r"(\d+)$", 1).cast("bigint")
    entries = raw.stores.filter(k % 3 == 0).select(F.lit("north").alias("user_name"), "store_id").unionByName(
        raw.stores.filter(F.col("store_id").isin("STR-1", "STR-2")).select(F.lit("kiosk").alias("user_name"), "store_id")
    )
    sales = raw.order_lines.groupBy("store_id").agg(F.sum("net_revenue_pence").alias("pence"))
    views = [reports.secured(sales, entries, F.lit(u)).select(F.lit(u).alias("user_name"), "store_id", C.gbp("pence").alias("revenue_gbp")) for u in ("north", "kiosk", "nobody")]
    return views[0].unionByName(views[1]).unionByName(views[2])


@query("dash_blend")
def _(raw):
    """Customer segments next to lifetime habits, blended on the customer."""
    left = rfm(raw).select("customer_id", "rfm_segment")
    return reports.blend(left, segments.churn_risk(metrics(raw)), ["customer_id"])


@query("store_wtd_mtd")
def _(raw):
    return reports.store_wtd_mtd(star(raw))


# --- inventory extras -----------------------------------------------------------------------

@query("inv_rag_status")
def _(raw):
    zero = inventory.rag_status(F.col("stock_on_hand"), F.col("reorder_point"), "zero_stock")
    return stock(raw).select("snapshot_date", "product_id", "store_id", "stock_status", zero.alias("zero_stock_status"), "days_of_stock_remaining")


@query("inv_stock_alerts")
def _(raw):
    return inventory.stock_alerts(inventory_status(raw), next_week_demand(raw), AS_OF)


@query("inv_turnover")
def _(raw):
    return inventory.inventory_turnover(raw.inventory)


# --- attribution and streaming --------------------------------------------------------------

@query("attr_paths")
def _(raw):
    return attribution.touches_before_purchase(raw.touches, raw.conversions)


for _model in ("last_click", "first_click", "linear", "time_decay", "data_driven"):
    query(f"attr_{_model}")(
        lambda raw, m=_model: attribution.attribute(raw.touches, raw.conversions, raw.marketing, m)
    )


@query("attr_compare")
def _(raw):
    return attribution.compare_models(raw.touches, raw.conversions, raw.marketing)


@query("stream_hourly_sales")
def _(raw):
    return hourly.stream_sales(raw.spark, f"{raw.folder}/event[s].parquet")


ORDER_TS = "CAST(o_orderdate AS TIMESTAMP) + make_interval(0, 0, 0, 0, CAST(o_orderkey % 24 AS INT))"
LINE_TS = "CAST(l_shipdate AS TIMESTAMP)"
STREAMED = {
    "lineitem": (LINE_TS, ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_shipdate")),
    "orders": (ORDER_TS, ("o_orderkey", "o_orderdate")),
}


def stream_source(raw: Inputs) -> Callable[..., DataFrame]:
    """Streams over the order and line files; a backlog of many times a batch's bytes is replayed in order of time."""
    spark, files = raw.spark, {n: f"{raw.folder}/{n}.parquet" for n in STREAMED}
    tables = {n: (adapters.table(spark, raw.folder, n).select(*columns), ts) for n, (ts, columns) in STREAMED.items()}
    slices = -(-sum(bytes_in(spark, f) for f in files.values()) // store_sales.SLICE_BYTES)
    backlog = scratch_path(spark, "backlog")
    in_order = slices > 1 and store_sales.in_time_order(tables, backlog, slices)

    def stream(name: str, *columns: str) -> DataFrame:
        schema = tables[name][0].schema
        if in_order:
            return store_sales.read_files(spark, f"{backlog}/{name}", schema, 1).selectExpr(*columns)
        return store_sales.read_files(spark, f"{raw.folder}/{name[:-1]}[{name[-1]}].parquet", schema).selectExpr(*columns)

    return stream


@query("stream_store_sales")
def _(raw):
    """Orders and shipped lines joined as streams, by hour of the order, store and stock status."""
    gross = "CAST(round(l_extendedprice * 100) AS BIGINT)"
    ids = ("concat('SKU-', l_partkey) AS product_id", "concat('STR-', l_suppkey) AS store_id")
    stream = stream_source(raw)
    orders = stream("orders", "concat('ORD-', o_orderkey) AS order_id", f"{ORDER_TS} AS order_ts")
    lines = stream("lineitem", "concat('ORD-', l_orderkey, '-', l_linenumber) AS order_line_id", "concat('ORD-', l_orderkey) AS order_id",
                   f"{LINE_TS} AS line_ts", *ids, "CAST(l_quantity AS BIGINT) AS units_sold", f"{gross} AS net_revenue_pence")
    stock = stream("lineitem", *ids, f"{LINE_TS} AS snapshot_ts",
                   "CAST((l_partkey * 7 + l_suppkey * 13 + l_linenumber * 29) % 201 AS BIGINT) AS stock_on_hand", "CAST(10 + l_partkey % 31 AS BIGINT) AS reorder_point")
    tables = store_sales.StoreSales(raw.spark, scratch_path(raw.spark, "store-sales"))
    tables.take_stock(stock)
    # The lines of the test tables repeat ids, so all columns tell them apart.
    each = ["order_line_id", "order_id", "line_ts", "product_id", "store_id", "units_sold", "net_revenue_pence"]
    tables.take_sales(store_sales.lines_with_orders(orders, lines, "1 day", "130 days", each))
    return tables.hourly()
