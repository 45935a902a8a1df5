"""The paths for large and skewed data, forced with low limits and compared with brute force."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tillwise.functions import ranking, scale


def test_mark_first_with_a_hot_key_in_one_partition(spark):
    random.seed(1)
    rows = [("hot", i % 7) for i in range(400)] + [(f"k{i}", j) for i in range(50) for j in range(i % 3 + 1)]
    rows += [("twin", 1)] * 30 + [(None, 5), (None, None), ("none", None), ("none", 3)]
    df = spark.createDataFrame(rows, "k string, v int").coalesce(1)
    out = scale.mark_first(df, ["k"], ["v"], "first")
    assert out.columns == ["k", "v", "first"]
    assert sorted(map(str, ((r["k"], r["v"]) for r in out.collect()))) == sorted(map(str, rows))
    firsts = [(r["k"], r["v"]) for r in out.filter("first").collect()]
    assert len(firsts) == len(set(firsts)) == 54
    assert {("hot", 0), ("twin", 1), ("none", 3), (None, 5)} <= set(firsts)  # missing values come last
    assert all((f"k{i}", 0) in firsts for i in range(50))


def test_mark_first_reads_no_group_in_one_window(spark):
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    plan = scale.mark_first(df, ["k"], ["v"], "first")._jdf.queryExecution().toString()
    assert "Window" not in plan


@pytest.mark.parametrize("n", [1, 3, 5, 7, 99, 500])
@pytest.mark.parametrize("missing", [0, 2, 40])
def test_scores_equal_pandas(spark, n, missing):
    random.seed(n)
    values = [None if i < min(missing, n - 1) else random.choice([1, 1, 1, 2, 9, -4, random.randint(0, 10**6)]) for i in range(n)]
    rows = [(f"id{i:04d}", v) for i, v in enumerate(values)]
    random.shuffle(rows)
    df = spark.createDataFrame(rows, "id string, m bigint").repartition(7)
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]))
    rank = {r[0]: i + 1 for i, r in enumerate(order)}
    bins = pd.qcut(pd.Series(range(1, n + 1)), 5, labels=False).add(1).tolist() if n > 1 else [1]
    tiles = [t + 1 for t, part in enumerate(np.array_split(np.arange(n), 5)) for _ in part]
    metrics = {"a": F.col("m"), "b": -F.col("m")}
    for method, want in (("ntile", tiles), ("qcut", bins)):
        got = ranking.with_scores(df, "id", metrics, method).collect()
        assert {r["id"]: r["a"] for r in got} == {i: want[k - 1] for i, k in rank.items()}
        assert all(r["b"] is not None for r in got)


def test_one_value_is_split_by_id(spark):
    """A metric that all rows share is spread over partitions and still ranked exactly."""
    df = spark.range(1000).select(F.format_string("c%05d", "id").alias("id"), F.lit(1).cast("bigint").alias("m"))
    ranks = ranking.exact_ranks(df, "id", {"m": F.col("m")})
    assert {r["id"]: r["rank"] for r in ranks.collect()} == {f"c{i:05d}": i + 1 for i in range(1000)}


def test_stage_round_trip(spark):
    df = spark.range(10).withColumn("x", F.col("id") * 2)
    assert sorted(scale.stage(df, "t").collect()) == df.collect()


def test_scope_deletes_what_it_staged(spark):
    before = scale.stage(spark.range(2), "outside")
    with scale.scratch_scope(spark):
        path = scale.stage(spark.range(3), "inside").inputFiles()[0].rpartition("/")[0]
        assert scale.folder_exists(spark, path)
    assert not scale.folder_exists(spark, path) and before.count() == 2
    try:
        with scale.scratch_scope(spark):
            path = scale.scratch_path(spark, "failed")
            spark.range(1).write.parquet(path)
            raise ValueError
    except ValueError:
        assert not scale.folder_exists(spark, path)


def test_shuffles_of_large_inputs_start_with_more_partitions(spark):
    """A task's share of a large input does not grow with it; small inputs keep the session's partitions."""
    from tillwise import session

    first, advisory = "spark.sql.adaptive.coalescePartitions.initialPartitionNum", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    try:
        session.partition_for(spark, 5000 * session.INPUT_BYTES_PER_PARTITION)
        assert spark.conf.get(first) == "5000" and spark.conf.get(advisory) == "16MB"
    finally:
        session.partition_for(spark, 0)
    assert spark.conf.get(first, None) is None and spark.conf.get(advisory) == before


def test_scans_of_large_inputs_are_cut_finer(spark, tmp_path):
    """A scan's task holds what it shuffles, so a split of a large input is bounded below Spark's 128 MB."""
    from tillwise import session

    key = "spark.sql.files.maxPartitionBytes"
    before, cores = spark.conf.get(key), spark.conf.get("spark.sql.files.minPartitionNum", None)
    blob = F.concat(*[F.sha2(F.concat(F.col("id").cast("string"), F.lit(f"-{i}")), 512) for i in range(8)])
    spark.range(120_000).coalesce(1).select(blob.alias("blob")).write.option("parquet.block.size", 4 << 20).parquet(str(tmp_path / "t"))
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        session.partition_for(spark, 0)
        assert spark.conf.get(key) == before and spark.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions() == 1
        session.partition_for(spark, 5000 * session.INPUT_BYTES_PER_PARTITION)
        assert spark.conf.get(key) == "16MB" and spark.read.parquet(str(tmp_path / "t")).rdd.getNumPartitions() > 1
    finally:
        session.partition_for(spark, 0)
        spark.conf.unset("spark.sql.files.minPartitionNum") if cores is None else spark.conf.set("spark.sql.files.minPartitionNum", cores)
    assert spark.conf.get(key) == before


def test_lines_meet_their_orders_last(spark):
    """No shuffle of lines carries the attributes of their orders, customers and days."""
    from tillwise.operators.intermediate import int_sales_enriched
    from tillwise.catalog.queries import inputs, star

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = int_sales_enriched(star(inputs(spark, "/root/testdata/sf0.001")))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    at = [plan.index(f"hashpartitioning({key}#") for key in ("order_id", "_product", "_store")]
    assert at == sorted(at)


def _shop(spark, days=40):
    """A star of a few rows: ids unknown, missing and given twice, attributes missing."""
    from datetime import date, timedelta
    from types import SimpleNamespace

    from tillwise.operators.intermediate import Star

    n = lambda k, m: None if k % 11 == 0 else k % m
    day = lambda k: date(2001, 1, 1) + timedelta(k % days)
    text = lambda prefix, v: None if v is None else f"{prefix}{v}"
    customers = [(text("C", k), f"u{k}@x.com", text("a", n(k, 3)), text("g", n(k, 2)), text("t", n(k, 5)), text("r", n(k, 4)), "web", day(k), text("l", n(k, 3))) for k in range(30)]
    products = [(text("P", k), f"name {k % 7}", text("c", n(k, 3)), text("s", n(k, 4)), text("b", n(k, 2)), text("S", n(k, 5)), 40 + k, 100 + k, True, day(k)) for k in range(25)]
    stores = [(f"S{k}", f"store {k}", "Online" if k % 2 else "Physical", "x", "y", None, day(k), True) for k in range(6)]
    orders = [(text("O", k), text("C", n(k, 35)), None if k % 17 == 0 else day(k), "Online", 5 * k, "POS", text("CAM-", n(k, 3))) for k in range(80)]
    lines = [(text("L", n(k, 999)), text("O", n(k, 90)), text("P", n(k, 28)), text("S", n(k, 7)), k % 4, 1000 + k, k % 50, 950 + k, 400, 500 + k, k % 9 == 0, day(k) if k % 9 == 0 else None) for k in range(400)]
    made = lambda rows, schema: spark.createDataFrame(rows + rows[:3], schema)
    raw = SimpleNamespace(
        spark=spark,
        customers=made(customers, "customer_id string, email string, age_band string, gender string, city string, region string, acquisition_channel string, acquisition_date date, loyalty_tier string"),
        products=made(products, "product_id string, product_name string, category string, subcategory string, brand string, supplier_id string, cost_price_pence bigint, rrp_pence bigint, is_active boolean, launch_date date"),
        stores=made(stores, "store_id string, store_name string, store_type string, city string, region string, postcode string, opening_date date, is_active boolean"),
        orders=made(orders, "order_id string, customer_id string, order_date date, channel string, order_total_pence bigint, source_system string, campaign_id string"),
        order_lines=made(lines, "order_line_id string, order_id string, product_id string, store_id string, units_sold bigint, gross_revenue_pence bigint, discount_pence bigint, net_revenue_pence bigint, cost_of_goods_pence bigint, gross_profit_pence bigint, is_returned boolean, return_date date"),
    )
    return Star(raw, date(2001, 1, 1), date(2001, 2, 1))


def test_small_dimensions_are_broadcast_and_shared_attributes_numbered(spark, monkeypatch):
    """Neither a shuffle for small dimensions nor one with attributes that members share, and the same rows on every path."""
    from tillwise.operators.intermediate import int_sales_enriched

    def of(limit, numbered):
        monkeypatch.setattr(scale, "BROADCAST_BYTES", limit)
        df = int_sales_enriched(_shop(spark), numbered=numbered)
        return df.columns, sorted(map(str, df.collect())), df._jdf.queryExecution().executedPlan().toString()

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        columns, rows, plan = of(0, False)
        for limit, numbered in ((0, True), (1700, True), (3300, True), (1 << 20, True), (1 << 20, False)):
            found = of(limit, numbered)
            assert found[:2] == (columns, rows), limit
            if limit == 3300:  # the stores are small, the products are not; their combinations are
                assert "hashpartitioning(_store" not in found[2] and "hashpartitioning(_product" in found[2] and "_product_set" in found[2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert len(rows) > 400 and "hashpartitioning(_store" in plan and "hashpartitioning(_product" in plan


def test_small_is_measured(spark):
    df = spark.createDataFrame([("x" * 1000, None, 1)] * 20, "a string, b string, c int")
    assert scale.is_small(df) and scale.is_small(df.limit(0))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert not scale.is_small(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    big = spark.range(70_000).select(F.repeat(F.lit("y"), 1000).alias("a"))
    assert not scale.is_small(big)


def test_facts_shuffle_lines_and_stock_as_little_as_they_can(spark, monkeypatch):
    """Stores of any measured small size need no shuffle, lines meet the orders last, and stock is shuffled once by product."""
    from datetime import date, datetime, timedelta

    from tillwise.operators import facts, inventory

    shop, at = _shop(spark), datetime(2001, 2, 1)
    raw = shop.raw
    snapshots = [(date(2001, 1, 1) + timedelta(k % 9), None if k % 13 == 0 else f"P{k % 28}", f"S{k % 7}", k, k % 5, k % 3) for k in range(300)]
    stock = spark.createDataFrame(snapshots + snapshots[:2], "snapshot_date date, product_id string, store_id string, stock_on_hand bigint, units_sold bigint, reorder_point bigint")

    def of(limit, by_product):
        monkeypatch.setattr(scale, "BROADCAST_BYTES", limit)
        sales = facts.build_fact_sales(raw.orders, raw.order_lines, shop.customers, shop.products, shop.stores, "r", at)
        held = facts.build_fact_inventory(inventory.with_stock_status(stock, by_product=by_product), shop.products, shop.stores, "r", at)
        plans = [df._jdf.queryExecution().executedPlan().toString() for df in (sales, held)]
        return [(sorted(df.columns), sorted(str(sorted(r.asDict().items(), key=str)) for r in df.collect())) for df in (sales, held)], plans

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1b")
    try:
        rows, (plan, stock_before) = of(0, False)
        orders_last = [plan.index(f"hashpartitioning({key}#") for key in ("order_id", "product_id", "store_id")]
        assert orders_last == sorted(orders_last)
        found, (sales_plan, stock_plan) = of(500, True)
        assert found == rows and of(1 << 20, True)[0] == rows
        # Given in 9 rows the stores are small, the products are not. What is left by store puts one row per id together.
        shuffles = lambda text, key: text.count(f"Exchange hashpartitioning({key}#")
        assert [shuffles(p, "store_id") for p in (plan, stock_before, sales_plan, stock_plan)] == [2, 2, 1, 1]
        assert shuffles(sales_plan, "product_id") == 2
        # By product and store and by product and once for the products; then by product only.
        assert shuffles(stock_before, "product_id") == 3 and shuffles(stock_plan, "product_id") == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert any("product_key', None" not in r for r in rows[0][1]) and len(rows[0][1]) > 400
