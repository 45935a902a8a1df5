"""Landed feeds, entitlements, and whole units that add up."""

import json
from collections import defaultdict
from datetime import date, timedelta

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.operators import forecast, reports
from tillwise.streaming.landing import Landing

SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("pence", T.LongType())])


def test_each_line_is_taken_in_once(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    feed = Landing(spark, str(source), str(tmp_path / "out"), SCHEMA)
    (source / "a.json").write_text('{"id":"1","pence":5}\n{"id":"2","pence":"x"}\n\nnot json\n[1]\n{"pence":7,"shop":"S1"}\n')
    feed.take()
    rows = lambda: sorted((str(r.id), r.pence, dict(r.extra)) for r in feed.accepted.read().collect())
    bad = lambda: sorted((r.line, r.file) for r in feed.quarantined.read().collect())
    assert rows() == [("1", 5, {}), ("None", 7, {"shop": "S1"})]
    assert bad() == [("[1]", "a.json"), ("not json", "a.json"), ('{"id":"2","pence":"x"}', "a.json")]
    feed.take()  # nothing new
    assert len(rows()) == 2 and len(bad()) == 3
    # Another object over the same folders goes on from the checkpoint; several files become several batches.
    for k in range(3):
        (source / f"b{k}.json").write_text(json.dumps({"id": f"b{k}", "pence": k, "coupon": None}) + "\n")
    again = Landing(spark, str(source), str(tmp_path / "out"), SCHEMA)
    again.take(files_per_batch=1)
    assert [r[0] for r in rows()] == ["1", "None", "b0", "b1", "b2"] and len(bad()) == 3
    again.accepted.compact(0)
    again.take()
    assert len(rows()) == 5 and again.accepted._batches() == []


def test_users_see_their_entries_only(spark):
    sales = spark.createDataFrame([("S1", 1), ("S2", 2), ("S2", 3), ("S3", 4), (None, 5)], "store_id string, pence bigint")
    entries = spark.createDataFrame([("ana", "S1"), ("ana", "S2"), ("ana", "S2"), ("bo", "S3"), ("bo", None), (None, "S1")], "user_name string, store_id string")
    see = lambda user: sorted(r.pence for r in reports.secured(sales, entries, user).collect())
    assert see(F.lit("ana")) == [1, 2, 3] and see(F.lit("bo")) == [4]
    assert see(F.lit("eve")) == [] and see(F.lit(None).cast("string")) == []
    assert see(None) == []  # the session's user has no entry
    me = spark.range(1).select(F.session_user().alias("user_name"), F.lit("S3").alias("store_id"))
    assert sorted(r.pence for r in reports.secured(sales, me).collect()) == [4]


def test_products_add_up_to_the_category_and_days_to_the_week(spark):
    monday = date(2024, 1, 1)
    products = spark.createDataFrame([(f"P{k}", "a" if k < 7 else "b") for k in range(9)], "product_id string, category string")
    orders = spark.createDataFrame([(f"O{k}", monday + timedelta(days=k % 28)) for k in range(90)], "order_id string, order_date date")
    lines = spark.createDataFrame([(f"O{k}", f"P{k % 9}", 1 + k % 5, False) for k in range(90)], "order_id string, product_id string, units_sold bigint, is_returned boolean")
    weeks = [(monday + timedelta(weeks=w), c, y, w >= 4) for w in range(6) for c, y in (("a", 100 + w), ("b", 3 * (w % 2)))]
    fc = spark.createDataFrame(weeks, "ds date, category string, yhat bigint, is_forecast boolean")
    out = forecast.product_daily_units(fc, lines, orders, products).collect()
    sums, day = defaultdict(int), defaultdict(int)
    for r in out:
        assert r.forecast_units >= 0
        sums[(r.category, r.forecast_date - timedelta(days=r.forecast_date.weekday()))] += r.forecast_units
        day[(r.category, r.forecast_date)] += r.forecast_units
    assert dict(sums) == {(c, d): y for d, c, y, ahead in weeks if ahead}
    assert {n for (c, _), n in day.items() if c == "a"} <= {14, 15} and len(out) == 9 * 14
