"""Daily merges into the customer state equal one computation over all days."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from tillwise.operators import customer_state as C

SALES = ("customer_id string, order_id string, order_date date, category string, units_sold bigint, net_revenue_pence bigint, "
         "gross_profit_pence bigint, is_weekend boolean, is_promotional_period boolean, store_type string")
FIRST = date(2024, 1, 1)


def sales_of(spark, days):
    r, rows = random.Random(7), []
    for day in range(days):
        for k in range(r.randrange(0, 5)):
            who = r.choice(["hot", "hot", "c1", "c2", "c3", None])
            for _ in range(r.randrange(1, 4)):
                rows.append((who, f"O{day}-{k}", FIRST + timedelta(days=day), r.choice(["a", "b", None]), r.randrange(1, 4), r.randrange(-50, 500),
                             r.randrange(100), day % 7 > 4, day % 5 == 0, r.choice(["Online", "Physical", None])))
    return spark.createDataFrame(rows, SALES)


def test_daily_merges_equal_one_computation(spark, tmp_path):
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    sales = sales_of(spark, 30).coalesce(1).cache()
    store = C.HabitStore(spark, str(tmp_path / "state"))
    assert store.through() is None
    for day in range(30):
        assert store.advance(sales, FIRST + timedelta(days=day))
        if day % 10 == 0:
            assert not store.advance(sales, FIRST + timedelta(days=day))  # given twice, merged once
    key = lambda df: sorted(map(repr, df.collect()))
    whole = C.habits_of(sales)
    assert key(store.state()) == key(whole) and store.through() == FIRST + timedelta(days=29)
    assert {r.customer_id for r in whole.collect()} == {"hot", "c1", "c2", "c3"}
    hot = store.state().filter("customer_id = 'hot'").first()
    want = sales.filter("customer_id = 'hot'").agg(F.countDistinct("order_id"), F.countDistinct("order_date"), F.sum("net_revenue_pence")).first()
    assert (hot.orders, hot.days, hot.revenue) == tuple(want) and sum(c.revenue for c in hot.categories) == hot.revenue
    sales.unpersist()
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_state_without_sales(spark, tmp_path):
    store = C.HabitStore(spark, str(tmp_path / "state"))
    assert store.advance(sales_of(spark, 0), FIRST) and store.state().count() == 0 and store.through() == FIRST
    assert store.advance(sales_of(spark, 9), FIRST + timedelta(days=9)) and store.state().count() > 0
