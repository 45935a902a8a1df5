"""Customer habits kept as a stored state of sums, to which a day's sales are merged.

What a customer's row of `int_customer_orders` says follows from sums, the first and the last day: an order has one
day, so orders and purchase days of different days are different ones and add up. A daily run thus reads one day of
sales and the state, not the whole history.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.columns import gbp, ratio
from tillwise.operators.intermediate import CUSTOMER_GROUP
from tillwise.sources import writers

HABITS = ("weekend_orders", "promo_orders", "online_orders", "instore_orders")
SUMS = ("units", "revenue", "profit", "lines", *HABITS, "orders", "days")
CATEGORIES = "array<struct<category: string, revenue: bigint>>"


def habits_of(sales: DataFrame) -> DataFrame:
    """The state of sales (enriched, not returned): per customer the sums, first and last day, revenue by category.

    Orders and days are counted in layers, each of which adds up what the one before has put together, so a hot
    customer's lines shrink before they meet. Lines without a customer are left out.
    """
    own = sales.filter("customer_id IS NOT NULL")
    lines = ("units", "revenue", "profit", "lines", *HABITS)
    per_order = own.groupBy("customer_id", "order_date", "order_id").agg(
        F.sum("units_sold").alias("units"), F.sum("net_revenue_pence").alias("revenue"), F.sum("gross_profit_pence").alias("profit"),
        F.count(F.lit(1)).alias("lines"), F.count_if("is_weekend").alias("weekend_orders"),
        F.count_if("is_promotional_period").alias("promo_orders"), F.count_if(F.col("store_type") == "Online").alias("online_orders"),
        F.count_if(F.col("store_type") == "Physical").alias("instore_orders"),
    )
    again = [F.sum(c).alias(c) for c in lines]
    per_day = per_order.groupBy("customer_id", "order_date").agg(*again, F.count("order_id").alias("orders"))
    per_customer = per_day.groupBy("customer_id").agg(
        *again, F.sum("orders").alias("orders"), F.count("order_date").alias("days"), F.min("order_date").alias("first_day"), F.max("order_date").alias("last_day")
    )
    per_category = own.groupBy("customer_id", "category").agg(F.sum("net_revenue_pence").alias("revenue"))
    bought = per_category.groupBy(F.col("customer_id").alias("_id")).agg(
        F.sort_array(F.collect_list(F.struct("category", F.col("revenue").cast("bigint").alias("revenue")))).alias("categories")  # at most all categories
    )
    joined = per_customer.join(bought, F.col("customer_id") == F.col("_id"))
    return joined.select("customer_id", *[F.col(c).cast("bigint").alias(c) for c in SUMS], "first_day", "last_day", F.col("categories").cast(CATEGORIES).alias("categories"))


def _added(a: Column, b: Column) -> Column:
    """Two arrays of revenue by category as one."""
    names = F.sort_array(F.array_union(F.transform(a, lambda x: x["category"]), F.transform(b, lambda x: x["category"])))
    of = lambda array, name: F.aggregate(
        F.filter(array, lambda x: x["category"].eqNullSafe(name)), F.lit(0).cast("bigint"), lambda s, x: s + x["revenue"]
    )
    return F.transform(names, lambda n: F.struct(n.alias("category"), (of(a, n) + of(b, n)).alias("revenue"))).cast(CATEGORIES)


def merge_habits(state: DataFrame, delta: DataFrame) -> DataFrame:
    """The state of both inputs, which cover different days. Customers are unique on both sides of the one join."""
    new = delta.select(F.col("customer_id").alias("_id"), *[F.col(c).alias(f"_{c}") for c in delta.columns if c != "customer_id"])
    none = F.array().cast(CATEGORIES)
    return state.join(new, F.col("customer_id") == F.col("_id"), "full_outer").select(
        F.coalesce("customer_id", "_id").alias("customer_id"),
        *[(F.coalesce(c, F.lit(0)) + F.coalesce(f"_{c}", F.lit(0))).cast("bigint").alias(c) for c in SUMS],
        F.least("first_day", "_first_day").alias("first_day"), F.greatest("last_day", "_last_day").alias("last_day"),
        F.when(F.col("_id").isNull(), F.col("categories")).otherwise(
            _added(F.coalesce("categories", none), F.coalesce("_categories", none))
        ).alias("categories"),
    )


def customer_orders_of(state: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """`int_customer_orders` from the state, with the customers' present attributes."""
    day = F.lit(as_of).cast("date")
    who = customers.select(F.col("customer_id").alias("_id"), F.col("region").alias("customer_region"), "loyalty_tier", "acquisition_channel")
    best = F.array_min(F.transform("categories", lambda x: F.struct((-x["revenue"]).alias("r"), x["category"].alias("category"))))
    return state.join(who, F.col("customer_id") == F.col("_id"), "left").select(
        "customer_id", *CUSTOMER_GROUP,
        F.datediff(day, "last_day").cast("bigint").alias("days_since_last_purchase"),
        F.col("last_day").alias("last_purchase_date"), F.col("first_day").alias("first_purchase_date"),
        F.col("days").alias("purchase_frequency"), F.col("orders").alias("total_orders"), F.col("units").alias("total_units_purchased"),
        gbp("revenue").alias("total_revenue_gbp"), ratio("revenue", "lines * 100", 2).alias("avg_order_value_gbp"), gbp("profit").alias("total_profit_gbp"),
        *HABITS, best["category"].alias("top_category"), F.datediff(day, "first_day").cast("bigint").alias("customer_age_days"),
        F.col("revenue").alias("total_revenue_pence"), F.col("profit").alias("total_profit_pence"),
    )


class HabitStore:
    """The stored state, published version by version; each knows the last day it holds (`through`)."""

    def __init__(self, spark, path: str):
        self.spark, self.path = spark, path

    def _stored(self) -> DataFrame | None:
        return None if writers.current_version(self.spark, self.path) is None else writers.read_published(self.spark, self.path)

    def state(self) -> DataFrame:
        return self._stored().filter("customer_id IS NOT NULL").drop("through")

    def through(self) -> date | None:
        stored = self._stored()
        return None if stored is None else stored.agg(F.max("through")).first()[0]

    def advance(self, sales: DataFrame, through: date) -> bool:
        """Merge the days after the stored ones up to `through`; False, and no change, if they are in the state already.

        Only the new days' partitions of `sales` are read. A day must be complete when it is merged.
        """
        done = self.through()
        if done is not None and done >= through:
            return False
        days = sales.filter(F.col("order_date") <= F.lit(through))
        if done is not None:
            days = days.filter(F.col("order_date") > F.lit(done))
        delta = habits_of(days)
        merged = delta if done is None else merge_habits(self.state(), delta)
        # One row without a customer carries the day also where nothing was ever sold.
        mark = self.spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in merged.schema])
        writers.publish_version(merged.unionByName(mark).withColumn("through", F.lit(through)), self.path)
        return True
