from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillwise.operators import data_tests as D
from tillwise.operators import quality as Q

ORDERS = "order_id string, customer_id string, store_id string, order_date string, order_total_pence bigint"


def orders(spark):
    return spark.createDataFrame(
        [
            ("O1", "C1", "S1", "2024-01-01", 100),
            ("O1", "C1", "S1", "2024-01-01", 100),  # exact copy
            ("O1", "C1", "S1", "2024-01-01", 100),
            (None, "C1", "S1", "2024-01-01", 100),
            (None, None, "S1", "2024-01-01", 100),  # first failed check wins
            ("O2", None, "S1", "2024-01-01", 100),
            ("O3", "C1", None, "2024-01-01", 100),
            ("O4", "C1", "S1", None, 100),
            ("O5", "C1", "S1", "2024-01-01", -500),
            ("O6", "C1", "S1", "2024-01-01", 0),
            ("O7", "C1", "S1", "2024-01-01", None),
            ("O8", "C1", "S1", "not-a-date", 100),
            ("O9", "C1", "S1", "2024-02-30", 100),
            ("OK", "C1", "S1", "2024-02-29", 1),
        ],
        ORDERS,
    )


def test_check_orders(spark):
    got = Q.check_orders(orders(spark)).groupBy(Q.FAILED).count().collect()
    assert {r[0]: r[1] for r in got} == {
        None: 2, "duplicate_check:order_id": 2, "null_check:order_id": 2, "null_check:customer_id": 1, "null_check:store_id": 1,
        "null_check:order_date": 1, "range_check:order_total_pence": 3, "date_check:order_date": 2,
    }


def test_validate_orders_parts(spark):
    clean, rejected, report = Q.validate_orders(orders(spark), "r1")
    assert {(r.order_id, str(r.order_date)) for r in clean.collect()} == {("O1", "2024-01-01"), ("OK", "2024-02-29")}
    rows = rejected.collect()
    assert len({r.quarantine_id for r in rows}) == 12
    raw = next(r for r in rows if r.failed_check == "null_check:customer_id").record_raw
    assert '"customer_id":null' in raw and '"order_id":"O2"' in raw
    assert report.first().asDict() == {
        "source": "orders", "records_input": 14, "records_clean": 2, "records_quarantined": 12, "quarantine_rate_pct": 85.71,
    }


def test_empty_input(spark):
    clean, rejected, report = Q.validate_orders(spark.createDataFrame([], ORDERS), "r1")
    assert clean.count() == 0 and rejected.count() == 0
    assert report.first().quarantine_rate_pct == 0.0


def test_check_lines_order_of_reasons(spark):
    lines = spark.createDataFrame(
        [("L1", "O1", "P1", 1), (None, "O1", "P1", 1), ("L3", None, "P1", 1), ("L4", "O1", None, 1), ("L5", "OX", "PX", 1),
         ("L6", "O1", "PX", 0), ("L7", "O1", "P1", 0), ("L8", "O1", "P1", None)],
        "order_line_id string, order_id string, product_id string, units_sold bigint",
    )
    known = spark.createDataFrame([("O1", "P1"), ("O1", "P1")], "order_id string, product_id string")
    got = {r[0]: r[-1] for r in Q.check_order_lines(lines, known, known).filter("order_line_id IS NOT NULL").collect()}
    assert got == {"L1": None, "L3": "null_check:order_id", "L4": "null_check:product_id", "L5": "ref_integrity:order_id",
                   "L6": "ref_integrity:product_id", "L7": "range_check:units_sold", "L8": "range_check:units_sold"}


def test_freshness_of_an_empty_source_is_stale(spark):
    df = spark.createDataFrame([], "ts timestamp_ntz")
    assert Q.freshness_check(df, "ts", "x", datetime(2024, 1, 1)).first().is_stale


def test_volume_check(spark):
    rows = [("a", i, 100) for i in range(7)] + [("a", 7, 121), ("a", 8, 90)]
    out = {r.d: r.is_outside for r in Q.volume_check(spark.createDataFrame(rows, "s string, d int, n bigint"), ["s"], "d", "n").collect()}
    assert out[0] is False and out[7] is True and out[8] is False


def test_volume_check_looks_back_seven_days_not_rows(spark):
    days = [(date(2024, 1, 1) + timedelta(days=k), n) for k, n in ((0, 1000), (1, 1000), (8, 100), (9, 100), (12, 300), (30, 5))]
    daily = spark.createDataFrame([("a", d, n) for d, n in days] + [("b", days[0][0], 7)], "s string, d date, n bigint")
    out = {(r.s, r.d): (r.prior_total, r.prior_days, r.is_outside) for r in Q.volume_check(daily, ["s"], "d", "n").collect()}
    assert out[("a", days[2][0])] == (1000, 1, True)  # the second day is seven days before, the first eight
    assert out[("a", days[3][0])] == (100, 1, False)
    assert out[("a", days[4][0])] == (200, 2, True)
    assert out[("a", days[5][0])] == (None, 0, False) and out[("b", days[0][0])] == (None, 0, False)


def test_gate_keeps_a_failing_table_back(spark):
    published = []
    good = spark.createDataFrame([(1, "a"), (2, None)], "id int, v string")
    D.gate(good, "t", [D.not_null("id"), D.unique("id"), D.accepted_values("v", ["a"])], published.append)
    with pytest.raises(D.GateClosed):
        D.gate(good.union(good), "t", [D.unique("id")], published.append)
    assert len(published) == 1 and published[0].count() == 2


def test_fill_missing(spark):
    df = spark.createDataFrame([(1, None, None), (None, 4, "x"), (3, 8, "y")], "a bigint, b bigint, c string").withColumn("d", F.lit(None).cast("date"))
    out = Q.fill_missing(df, zero=["a"], mean=["b"], text=["c"], dates=["d"]).collect()
    assert [tuple(r) for r in out] == [(1, 6.0, "UNKNOWN", None, True), (0, 4.0, "x", None, True), (3, 8.0, "y", None, True)]
