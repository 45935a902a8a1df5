"""Orders and lines joined as streams: late, repeated and unmatched rows, restarts, stock, compaction."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tillwise.streaming import store_sales as S

ORDERS = "order_id string, order_ts timestamp"
LINES = "order_line_id string, order_id string, line_ts timestamp, product_id string, store_id string, units_sold bigint, net_revenue_pence bigint"
STOCK = "product_id string, store_id string, snapshot_ts timestamp, stock_on_hand bigint, reorder_point bigint"


def at(day, hour, minute=0):
    return datetime(2024, 1, day, hour, minute)


def line(n, order, when, units=1, product="P1", store="S1"):
    return (f"L{n}", order, when, product, store, units, 100 * units)


@pytest.fixture
def shop(spark, tmp_path):
    class Shop:
        tables = S.StoreSales(spark, str(tmp_path / "out"))

        def arrive(self, orders=(), lines=(), stock=()):
            for name, rows, schema in (("orders", orders, ORDERS), ("lines", lines, LINES), ("stock", stock, STOCK)):
                spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(str(tmp_path / name))
            read = lambda name, schema: S.read_files(spark, str(tmp_path / name), spark.createDataFrame([], schema).schema)
            late = self.tables.take_stock(read("stock", STOCK))
            return late, self.tables.take_sales(S.lines_with_orders(read("orders", ORDERS), read("lines", LINES)))

        def sold(self):
            return {(r.hour_start[8:13], r.store_id, r.stock_status): (r.lines, r.units) for r in self.tables.hourly().collect()}

        def unmatched(self):
            return sorted(r.order_line_id for r in self.tables.unmatched.read().collect())

    return Shop()


def test_streams_meet_over_batches(shop):
    shop.arrive(
        orders=[("O1", at(1, 9)), ("O1", at(1, 9)), ("O2", at(1, 10))],
        lines=[line(1, "O1", at(1, 9, 5), 2), line(1, "O1", at(1, 9, 5), 2), line(2, "O2", at(1, 10, 30)), line(3, "O3", at(1, 10, 40)), line(4, "O9", at(1, 10))],
        stock=[("P1", "S1", at(1, 8), 5, 10), ("P1", "S1", at(1, 9), 50, 10)],
    )
    # Repeated rows count once; O3 has not come yet.
    assert shop.sold() == {("01 09", "S1", "GREEN"): (1, 2), ("01 10", "S1", "GREEN"): (1, 1)} and shop.unmatched() == []
    # O3 comes in a later batch than its line; another line of O1 is within two hours, one is not. Stock has run out since.
    shop.arrive(
        orders=[("O3", at(1, 10, 20))], lines=[line(5, "O1", at(1, 10, 59)), line(6, "O1", at(1, 11, 1)), line(7, "O3", at(1, 10, 50), 3, "P2", "S2")],
        stock=[("P1", "S1", at(1, 10, 30), 0, 10)],
    )
    assert shop.sold() == {("01 09", "S1", "GREEN"): (1, 2), ("01 09", "S1", "RED"): (1, 1), ("01 10", "S1", "GREEN"): (1, 1),
                           ("01 10", "S1", "RED"): (1, 1), ("01 10", "S2", "UNKNOWN"): (1, 3)}
    # A day later the watermarks have passed: what found no order is given out, and older rows are late.
    shop.arrive(orders=[("O5", at(2, 9))], lines=[line(8, "O5", at(2, 9, 1))])
    shop.arrive(orders=[("O6", at(2, 10))], lines=[line(9, "O6", at(2, 10, 1))])
    assert shop.unmatched() == ["L4", "L6"]
    late = shop.arrive(orders=[("O7", at(1, 9))], lines=[line(10, "O7", at(1, 9, 1))], stock=[("P1", "S1", at(1, 1), 99, 1)])[1]
    assert late >= 1 and ("02 09", "S1", "RED") in shop.sold() and sum(n for n, _ in shop.sold().values()) == 7
    shop.arrive()
    assert sum(n for n, _ in shop.sold().values()) == 7


def test_batches_are_put_together(spark, tmp_path):
    table = S.BatchTable(spark, str(tmp_path / "t"), S.SALES, S._summed)
    rows = lambda n: spark.createDataFrame([(at(1, 9), "S1", "RED", 1, n, 10 * n)], S.SALES)
    assert table.read().count() == 0 and not table.compact(0)
    for k in range(5):
        table.add(rows(k), k)
    table.add(rows(4), 4)  # a batch that runs again replaces itself
    one = lambda: tuple(table.read().first())[3:]
    assert one() == (5, 10, 100) and not table.compact(5)
    assert table.compact(4) and table._batches() == [] and one() == (5, 10, 100)
    table.add(rows(4), 4)  # also after it was put together
    table.add(rows(7), 5)
    assert one() == (6, 17, 170)
    assert table.compact(0) and one() == (6, 17, 170) and table._through() == 5


def test_folders_left_by_a_lost_run_do_not_count(spark, tmp_path, monkeypatch):
    table = S.BatchTable(spark, str(tmp_path / "t"), S.STOCK, S._newest)
    rows = lambda n: spark.createDataFrame([("P", "S", at(1, n), n, 1)], S.STOCK)
    for k in range(3):
        table.add(rows(k), k)
    monkeypatch.setattr(S.scale, "delete_path", lambda *_: (_ for _ in ()).throw(KeyboardInterrupt))
    with pytest.raises(KeyboardInterrupt):
        table.compact(0)
    monkeypatch.undo()
    assert table._batches() == [0, 1, 2] and [tuple(r) for r in table.read().collect()] == [("P", "S", at(1, 2), 2, 1)]
    empty = S.BatchTable(spark, str(tmp_path / "e"), S.STOCK, S._newest)
    empty.add(rows(0).limit(0), 0)
    assert empty.compact(0) and empty._through() == 0 and empty.read().count() == 0


def test_a_batch_is_computed_once(spark, tmp_path):
    """Sales and lines without an order come from one run of the stream's join."""
    seen = spark.sparkContext.accumulator(0)

    @F.udf("timestamp")
    def passed(value):
        seen.add(1)
        return value

    rows = [line(1, "O1", at(1, 9, 5)), line(2, "O1", at(1, 9, 6))]
    spark.createDataFrame([("O1", at(1, 9))], ORDERS).write.parquet(str(tmp_path / "orders"))
    spark.createDataFrame(rows, LINES).coalesce(1).write.parquet(str(tmp_path / "lines"))
    read = lambda name, schema: S.read_files(spark, str(tmp_path / name), spark.createDataFrame([], schema).schema)
    sold = S.lines_with_orders(read("orders", ORDERS), read("lines", LINES)).withColumn("order_ts", passed.asNondeterministic()("order_ts"))
    tables = S.StoreSales(spark, str(tmp_path / "out"))
    tables.take_sales(sold)
    assert seen.value == 2 and tables.hourly().first().lines == 2


def test_a_backlog_is_replayed_in_order_of_time(spark, tmp_path):
    """The same sales come out whether a backlog is one batch or several, and the state holds only a part of it."""
    random.seed(3)
    orders = [(f"O{i}", at(1 + i % 28, i % 24)) for i in range(300)] + [(None, at(3, 1)), ("O305", None)]
    lines = [line(i, f"O{i % 310}", at(1 + i % 310 % 28, i % 310 % 24, i % 60)) for i in range(900)]
    lines += [line(1, "O1", at(2, 1, 1)), line(2000, "O5", at(6, 23)), line(2001, None, at(9, 1)), line(2002, "O3", None)]
    random.shuffle(lines)
    stock = [("P1", "S1", at(1, 8), 5, 10)]
    tables = {"lines": (spark.createDataFrame(lines, LINES), "line_ts"), "orders": (spark.createDataFrame(orders, ORDERS), "order_ts")}
    assert S.in_time_order(tables, str(tmp_path / "backlog"), 6)
    for name, (rows, _) in tables.items():
        rows.coalesce(1).write.parquet(str(tmp_path / name))
        assert len(list((tmp_path / "backlog" / name).glob("slice=*/part-*.parquet"))) == 6
    found, kept = {}, {}
    for kind, folder, files in (("once", tmp_path, None), ("replayed", tmp_path / "backlog", 1)):
        read = lambda name: S.read_files(spark, str(folder / name), tables[name][0].schema, files)  # noqa: B023, E731
        shop = S.StoreSales(spark, str(tmp_path / "out" / kind))
        shop.stock.add(spark.createDataFrame(stock, STOCK), 0)
        assert shop.take_sales(S.lines_with_orders(read("orders"), read("lines"), "1 hour", "2 hours")) == 0
        found[kind] = sorted(map(tuple, shop.hourly().collect())), sorted(r.order_line_id for r in shop.unmatched.read().collect())
        kept[kind] = [r.n for r in spark.read.parquet(f"{shop.unmatched.path}/batches").groupBy("batch").agg(F.count("*").alias("n")).collect()]
    assert found["once"] == found["replayed"] and found["once"][0] and found["once"][1]
    # Lines without an order leave the state while the backlog is read, and not all at its end.
    assert len(kept["once"]) == 1 and len(kept["replayed"]) > 3


def test_cuts_by_hour_are_about_equal(spark):
    rows = spark.range(10_000).selectExpr("CASE WHEN id % 100 <> 0 THEN CAST(id * 977 % 1000003 AS BIGINT) END AS s")
    cuts = S._hours_that_cut(rows, 5)
    assert len(cuts) == 4 and cuts == sorted(set(cuts)) and all(c % 3600 == 0 for c in cuts)
    parts = [rows.filter((F.col("s") >= a) & (F.col("s") < b)).count() for a, b in zip([0, *cuts], [*cuts, 10**7], strict=True)]
    assert sum(parts) == 9900 and max(parts) < 2100
    assert S._hours_that_cut(rows, 1) == [] and S._hours_that_cut(rows.limit(0), 5) == []
    assert S._hours_that_cut(spark.range(50).selectExpr("7200L AS s"), 5) == []
