"""Reading, writing, the daily run and the stream."""

from datetime import date
from types import SimpleNamespace

from conftest import SF
from pyspark.sql import functions as F

from tillwise.model import RAW, RAW_FILES
from tillwise.plans.pipeline import run_pipeline
from tillwise.sources import adapters, readers, writers
from tillwise.sources.adapters import Inputs
from tillwise.streaming import hourly


def test_missing_files_give_empty_frames(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("store_id,store_name,store_type,city,region,postcode,opening_date,is_active\nS1,One,Online,,,,2020-01-02,True\n")
    raw = readers.read_raw(spark, str(tmp_path))
    assert set(raw) == set(RAW_FILES)
    assert raw["stores"].first().is_active is True and raw["stores"].first().city is None
    assert raw["orders"].count() == 0 and raw["orders"].schema == RAW["orders"]


def test_pipeline_loads_what_passes(spark, tmp_path):
    good = Inputs(spark, SF)
    raw = SimpleNamespace(
        spark=spark, customers=good.customers, products=good.products, stores=good.stores, inventory=good.inventory,
        marketing=good.marketing, orders=adapters.faulty_orders(spark, SF), order_lines=adapters.faulty_order_lines(spark, SF),
    )
    summary = run_pipeline(raw, str(tmp_path), "run-7")
    orders, lines = summary.reports["orders"], summary.reports["order_lines"]
    assert orders["records_input"] == orders["records_clean"] + orders["records_quarantined"]
    assert 0 < orders["records_clean"] < orders["records_input"]
    fact = spark.read.parquet(f"{tmp_path}/fact_sales")
    assert fact.count() == lines["records_clean"] == summary.loaded["fact_sales"]
    assert fact.filter("customer_key IS NULL OR product_key IS NULL OR date_key IS NULL").count() == 0
    rejected = spark.read.parquet(f"{tmp_path}/data_quality_quarantine")
    assert rejected.count() == orders["records_quarantined"] + lines["records_quarantined"]
    assert rejected.filter("failure_reason IS NULL").count() == 0
    log = spark.read.parquet(f"{tmp_path}/pipeline_run_log").first()
    assert (log.run_id, log.status, log.records_quarantined) == ("run-7", "SUCCESS", rejected.count())
    run_pipeline(raw, str(tmp_path), "run-8")  # another run adds its facts, a repeated one replaces its own
    run_pipeline(raw, str(tmp_path), "run-8")
    assert spark.read.parquet(f"{tmp_path}/fact_sales").count() == 2 * lines["records_clean"]
    assert spark.read.parquet(f"{tmp_path}/data_quality_quarantine").count() == 2 * rejected.count()
    assert spark.read.parquet(f"{tmp_path}/pipeline_run_log").count() == 2
    assert writers.read_published(spark, f"{tmp_path}/dim_store").count() == good.stores.count()
    assert writers.read_published(spark, f"{tmp_path}/dim_customer").count() == good.customers.count()


def test_daily_run_keeps_history_and_gates_marts(spark, tmp_path):
    good, house = Inputs(spark, SF), str(tmp_path)
    raw = SimpleNamespace(
        spark=spark, customers=good.customers, products=good.products, stores=good.stores, inventory=good.inventory,
        marketing=good.marketing, orders=good.orders.withColumn("store_id", F.lit("STR-1")), order_lines=good.order_lines,
    )
    lines = spark.createDataFrame(good.order_lines.dropDuplicates(["order_line_id"]).collect(), good.order_lines.schema)
    raw.order_lines = lines
    first = run_pipeline(raw, house, "d1", date(2001, 8, 2), with_marts=True)
    assert set(first.published.values()) == {"PUBLISHED"}, first.published
    people = writers.read_published(spark, f"{house}/dim_customer")
    scored = people.filter("rfm_segment IS NOT NULL").count()
    assert scored == writers.read_published(spark, f"{house}/mart_customer_rfm").count() > 0
    assert spark.table("tillwise_mart_store_performance").count() > 0
    before = writers.read_published(spark, f"{house}/mart_executive_kpis").count()

    # The next day some customers move, and too many orders are rejected: history grows, marts stay.
    moved = good.customers.filter("customer_id LIKE '%7'").count()
    raw.customers = good.customers.withColumn("city", F.when(F.col("customer_id").like("%7"), "Elsewhere").otherwise(F.col("city")))
    raw.orders = raw.orders.withColumn("order_total_pence", F.when(F.col("order_id").like("%1"), -1).otherwise(F.col("order_total_pence")))
    second = run_pipeline(raw, house, "d2", date(2001, 8, 3), with_marts=True)
    assert set(second.published.values()) == {"KEEP_PREVIOUS: reject rate"}
    assert writers.read_published(spark, f"{house}/mart_executive_kpis").count() == before
    people = writers.read_published(spark, f"{house}/dim_customer")
    assert people.filter("NOT is_current").count() == moved and people.filter("version = 2").count() == moved > 0
    assert people.filter("is_current AND rfm_segment IS NOT NULL").count() == scored
    versions = people.count()
    run_pipeline(raw, house, "d2", date(2001, 8, 3))
    assert writers.read_published(spark, f"{house}/dim_customer").count() == versions


def test_unknown_customers_are_rejected(spark):
    from tillwise.operators import quality

    good = Inputs(spark, SF)
    orders = good.orders.withColumn("store_id", F.lit("S")).withColumn("customer_id", F.when(F.col("order_id") == "ORD-1", "CUS-X").otherwise(F.col("customer_id")))
    checked = quality.check_orders(orders, good.customers)
    rejected = quality.quarantine(quality.failed(checked), "r", "POS").collect()
    assert [r.failure_reason for r in rejected] == ["UNKNOWN_CUSTOMER"] * orders.filter("customer_id = 'CUS-X'").count()


def test_scratch_is_cleared(spark):
    import os

    from tillwise.functions import scale

    path = scale.scratch_path(spark, "x")
    spark.range(3).write.parquet(path)
    folder = os.path.dirname(path.removeprefix("file:"))
    assert os.path.isdir(folder)
    scale.clear_scratch(spark)
    assert not os.path.exists(folder)


def test_yearly_partitions_are_pruned(spark, tmp_path):
    df = spark.range(4000).selectExpr("20200101 + (id % 3) * 10000 AS date_key", "id % 17 AS store_key", "id AS v")
    writers.write_yearly_partitioned(df, str(tmp_path / "t"), ("store_key",))
    back = spark.read.parquet(str(tmp_path / "t")).filter("year = 2021")
    assert back.count() == df.filter("date_key div 10000 = 2021").count()
    assert "PartitionFilters: [isnotnull(year" in back._jdf.queryExecution().toString()


def test_load_table_counts_and_skips_empty(spark, tmp_path):
    path = str(tmp_path / "t")
    assert writers.load_table(spark.range(5), path, "overwrite") == 5
    assert writers.load_table(spark.range(0), path, "overwrite") == 0
    assert writers.load_table(spark.range(3), path, "append") == 3
    assert spark.read.parquet(path).count() == 8


def test_stream_drops_repeats_and_equals_batch(spark, tmp_path):
    events = adapters.table(spark, SF, "events")
    path = str(tmp_path / "in")
    events.unionByName(events).coalesce(1).write.parquet(path)  # every event twice
    out = hourly.stream_sales(spark, path)
    want = events.filter("event_type = 'purchase'").groupBy(F.date_trunc("hour", "ts").alias("h")).count()
    assert {(r.hour_start, r.orders) for r in out.collect()} == {(r.h.strftime("%Y-%m-%d %H:%M:%S"), r["count"]) for r in want.collect()}


def test_stream_counts_late_rows(spark, tmp_path):
    path, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "cp"))
    row = lambda i, ts: f"SELECT {i}L AS event_id, TIMESTAMP_NTZ'{ts}' AS ts, 1L AS user_id, 'purchase' AS event_type, 2.5D AS value, '' AS props"
    late = []
    for sql in (row(1, "2024-01-01 00:10:00") + " UNION ALL " + row(2, "2024-01-02 00:10:00"), row(3, "2024-01-02 00:20:00"),
                row(4, "2024-01-01 00:30:00")):
        spark.sql(sql).coalesce(1).write.mode("append").parquet(path)
        # A restart goes on from the checkpoint; batch numbers keep growing.
        late.append(hourly.run_available(hourly.hourly_sales(hourly.read_events(spark, path)), out, checkpoint))
    hours = {r.hour_start: (r.orders, r.revenue_gbp) for r in hourly.latest_hours(spark, out).collect()}
    assert hours == {"2024-01-01 00:00:00": (1, 2.5), "2024-01-02 00:00:00": (2, 5.0)}
    assert late[:2] == [0, 0] and late[2] >= 1
