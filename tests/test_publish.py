"""Versions of published tables, and facts that name the version of their customer and product."""

from datetime import date, datetime
from types import SimpleNamespace

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tillwise.operators import dims
from tillwise.plans import pipeline
from tillwise.sources import writers
from tillwise.sources.adapters import Inputs


def values(df):
    return sorted(r[0] for r in df.collect())


def test_readers_see_one_version_or_the_other(spark, tmp_path):
    path = str(tmp_path / "t")
    with pytest.raises(FileNotFoundError):
        writers.read_published(spark, path)
    assert writers.publish_version(spark.range(3), path) == 3
    old = writers.read_published(spark, path)
    assert writers.publish_version(spark.range(10, 12), path) == 2
    # A frame goes on reading the version it began with; a new one reads the new version.
    assert values(old) == [0, 1, 2] and values(writers.read_published(spark, path)) == [10, 11]
    # The next version may be made of the present one.
    writers.publish_version(writers.read_published(spark, path).selectExpr("id + 1 AS id"), path)
    assert values(writers.read_published(spark, path)) == [11, 12]
    assert writers.publish_version(spark.range(0), path) == 0 and values(writers.read_published(spark, path)) == []


def test_a_run_that_ends_before_the_switch_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.publish_version(spark.range(3), path)

    def killed(*_):
        raise KeyboardInterrupt

    monkeypatch.setattr(writers, "_switch", killed)
    with pytest.raises(KeyboardInterrupt):
        writers.publish_version(spark.range(50), path)
    monkeypatch.undo()
    assert values(writers.read_published(spark, path)) == [0, 1, 2]
    # Also where the rows are only half written.
    failing = spark.range(50).select(F.when(F.col("id") == 40, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        writers.publish_version(failing, path)
    assert values(writers.read_published(spark, path)) == [0, 1, 2]
    writers.publish_version(spark.range(1), path)
    assert values(writers.read_published(spark, path)) == [0]


def test_two_runs_cannot_take_the_same_number(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    writers.publish_version(spark.range(1), path)
    stale = writers.current_version(spark, path)
    writers.publish_version(spark.range(2), path)
    real = writers.current_version
    calls = iter([stale])
    monkeypatch.setattr(writers, "current_version", lambda s, p: next(calls, None) or real(s, p))
    with pytest.raises(RuntimeError, match="another run"):
        writers.publish_version(spark.range(7), path)
    monkeypatch.undo()
    assert writers.read_published(spark, path).count() == 2


def test_old_versions_are_kept_by_count(spark, tmp_path):
    path = tmp_path / "t"
    for k in range(6):
        writers.publish_version(spark.range(k), str(path), keep=2)
    assert sum(p.name.startswith("v-") for p in path.iterdir()) == 2
    assert writers.current_version(spark, str(path))[0] == 6 and writers.read_published(spark, str(path)).count() == 5


def test_catalog_table_follows(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.publish_table(spark.range(3), "tillwise_published_test", path)
    writers.publish_table(spark.range(5), "tillwise_published_test", path)
    assert spark.table("tillwise_published_test").count() == 5
    writers.publish_table(spark.range(2).selectExpr("id", "'x' AS more"), "tillwise_published_test", path)  # other columns
    assert spark.table("tillwise_published_test").columns == ["id", "more"]
    spark.sql("DROP TABLE tillwise_published_test")


VERSIONS = [("A", date(2024, 1, 10), 1), ("A", date(2024, 2, 1), 2), ("A", date(2024, 2, 2), 3), ("A", date(2024, 6, 1), 4), ("B", date(2024, 3, 1), 1)]


def test_version_on_a_day_equals_a_scan(spark):
    versions = spark.createDataFrame(VERSIONS, "id string, valid_from date, version bigint").withColumn("k", F.concat("id", F.lit("v"), "version"))
    days = [date(2024, m, d) for m in (1, 2, 3, 5, 6, 7) for d in (1, 2, 9, 10, 11)]
    rows = [(i, d) for i in ("A", "B", "C", None) for d in [*days, None]]
    got = {(r.who, r.day): r.k for r in dims.versions_on(spark.createDataFrame(rows, "who string, day date"), versions.withColumnRenamed("id", "who"), "who", "day", "k").collect()}
    for who, day in rows:
        mine = [(f, v) for i, f, v in VERSIONS if i == who]
        begun = [x for x in mine if day is None or x[0] <= day]
        want = max(begun or mine[:1], default=None)
        assert got[(who, day)] == (None if want is None else f"{who}v{want[1]}"), (who, day)


def test_first_version_keeps_the_key_of_the_id(spark):
    df = spark.createDataFrame([("A", 1), ("A", 2), ("B", 1)], "id string, version bigint")
    keys = df.select("id", "version", dims.version_key("id").alias("v"), dims.surrogate_key("id").alias("k")).collect()
    assert all((r.v == r.k) == (r.version == 1) for r in keys) and len({r.v for r in keys}) == 3


def test_facts_name_the_version_of_their_day(spark, tmp_path):
    """A customer moves in mid-history: earlier orders keep the old version's key, later ones get the new one's."""
    good, house = Inputs(spark, SF), str(tmp_path)
    raw = SimpleNamespace(
        spark=spark, customers=good.customers, products=good.products, stores=good.stores, inventory=good.inventory, marketing=good.marketing,
        orders=good.orders.withColumn("store_id", F.lit("STR-1")),
        order_lines=spark.createDataFrame(good.order_lines.dropDuplicates(["order_line_id"]).collect(), good.order_lines.schema),
    )
    first = pipeline.run_pipeline(raw, house, "d1", date(1995, 1, 1))
    raw.customers = good.customers.withColumn("city", F.when(F.col("customer_id").like("%7"), "Elsewhere").otherwise(F.col("city")))
    pipeline.run_pipeline(raw, house, "d2", date(1998, 1, 1))
    people = writers.read_published(spark, f"{house}/dim_customer")
    assert people.select("customer_key").distinct().count() == people.count()  # each version has its own key
    fact = spark.read.parquet(f"{house}/fact_sales").filter("pipeline_run_id = 'd2'")
    assert fact.count() == first.loaded["fact_sales"] and fact.filter("customer_key IS NULL").count() == 0
    named = fact.join(people.select("customer_key", "customer_id", "version"), "customer_key")
    assert named.count() == fact.count()
    moved = named.filter("customer_id LIKE '%7'")
    assert moved.filter("(version = 2) <> (date_key >= 19980101)").count() == 0
    assert {r.version for r in moved.select("version").distinct().collect()} == {1, 2}
    assert named.filter("customer_id NOT LIKE '%7' AND version <> 1").count() == 0


def test_alerts_and_segment_history_of_a_run(spark, tmp_path):
    good, house = Inputs(spark, SF), str(tmp_path)
    raw = SimpleNamespace(
        spark=spark, customers=good.customers, products=good.products, stores=good.stores, inventory=good.inventory, marketing=good.marketing,
        orders=good.orders.withColumn("store_id", F.lit("STR-1")),
        order_lines=spark.createDataFrame(good.order_lines.dropDuplicates(["order_line_id"]).collect(), good.order_lines.schema),
    )
    summary = pipeline.run_pipeline(raw, house, "late", date(2003, 1, 1), with_marts=True)
    alerts = spark.read.parquet(f"{house}/pipeline_alerts").collect()
    assert {(a["check"], a.source) for a in alerts} == {("freshness", "orders"), ("freshness", "inventory")} and summary.alerts == 2
    history = spark.read.parquet(f"{house}/segment_history")
    assert history.count() == writers.read_published(spark, f"{house}/mart_customer_rfm").count() > 0
    assert [r.run_date for r in history.select("run_date").distinct().collect()] == [date(2003, 1, 1)]


def test_volume_alert_names_the_channel(spark):
    day = lambda k: f"2024-03-{k:02d}"
    rows = [("Online", day(k)) for k in range(1, 8) for _ in range(10)] + [("Online", day(8))] * 20 + [("App", day(k)) for k in range(1, 9) for _ in range(5)]
    raw = SimpleNamespace(orders=spark.createDataFrame(rows, "channel string, order_date string"),
                          inventory=spark.createDataFrame([(datetime(2024, 3, 8),)], "snapshot_date timestamp_ntz"))
    got = [tuple(r) for r in pipeline.freshness_and_volume(raw, datetime(2024, 3, 9)).collect()]
    assert got == [("volume", "orders of Online", date(2024, 3, 8), 20, 10)]
