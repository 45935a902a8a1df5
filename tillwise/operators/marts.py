"""Mart tables: daily KPIs, stores by month, products by week, stock and marketing."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.columns import gbp, percent, ratio
from tillwise.operators.intermediate import Star, count_layers, int_sales_enriched, not_returned


def _when_type(kind: str, value: str) -> Column:
    return F.when(F.col("store_type") == kind, F.col(value)).otherwise(0)


def _big(name: str) -> Column:
    return F.col(name).cast("bigint")


def daily_sales_kpis(star: Star, start_date: date) -> DataFrame:
    """One row per day from `start_date`: revenue, volume, margin, returns, channel split, new customers.

    Returned lines stay in revenue here. A line counts as new when it is dated on its customer's
    first purchase day. Sums are taken per order, then per customer and day, then per day, so
    even the busiest day reaches its last aggregation as a few partial rows.
    """
    sales = int_sales_enriched(star, parts=("date", "customer", "store")).filter(F.col("order_date").isNotNull())
    sums = {
        "revenue": F.col("net_revenue_pence"),
        "profit": F.col("gross_profit_pence"),
        "discount": F.col("discount_pence"),
        "units": F.col("units_sold"),
        "returned_lines": F.col("is_returned").cast("int"),
        "returned_revenue": F.when(F.col("is_returned"), F.col("net_revenue_pence")).otherwise(0),
        "online": _when_type("Online", "net_revenue_pence"),
        "instore": _when_type("Physical", "net_revenue_pence"),
        "acquired_lines": F.col("acquisition_channel").isNotNull().cast("int"),
    }
    again = [F.sum(n).alias(n) for n in sums]
    per_order = sales.groupBy("order_date", "customer_id", "order_id").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    per_customer = per_order.groupBy("order_date", "customer_id").agg(*again, F.count("order_id").alias("orders"))
    # One row per customer and day: a customer's window holds at most the days of the calendar.
    first_day = F.min("order_date").over(Window.partitionBy("customer_id"))
    marked = per_customer.withColumn(
        "new_lines", F.when(F.col("order_date") == first_day, F.col("acquired_lines")).otherwise(0)
    )
    daily = marked.filter(F.col("order_date") >= F.lit(start_date)).groupBy("order_date").agg(
        *again, F.sum("orders").alias("orders"), F.count("customer_id").alias("customers"), F.sum("new_lines").alias("new_lines")
    )
    days = star.dates.select(
        F.col("full_date").alias("_day"), F.col("year").alias("order_year"), F.col("month_num").alias("order_month"),
        F.col("month_name").alias("order_month_name"), F.col("quarter").alias("order_quarter"),
        F.col("week_number").alias("order_week"), "is_weekend", F.col("is_promotional").alias("is_promotional_period"), "season",
    )
    return daily.join(F.broadcast(days), F.col("order_date") == F.col("_day"), "inner").select(
        "order_date", "order_year", "order_month", "order_month_name", "order_quarter", "order_week", "is_weekend",
        "is_promotional_period", "season",
        gbp("revenue").alias("revenue_gbp"),
        gbp("profit").alias("gross_profit_gbp"),
        gbp("discount").alias("discount_gbp"),
        _big("orders").alias("total_orders"),
        _big("units").alias("total_units"),
        _big("customers").alias("unique_customers"),
        ratio("revenue", "orders * 100", 2).alias("avg_order_value_gbp"),
        percent("profit", "revenue", 2).alias("gross_margin_pct"),
        _big("returned_lines").alias("returned_lines"),
        gbp("returned_revenue").alias("returned_revenue_gbp"),
        gbp("online").alias("online_revenue_gbp"),
        gbp("instore").alias("instore_revenue_gbp"),
        _big("new_lines").alias("new_customer_orders"),
    )


def with_comparisons(daily: DataFrame) -> DataFrame:
    """Add the values of 7 and 364 days before, and growth in percent.

    Both distances are whole weeks, so a day only ever looks at the same weekday: the windows
    run per weekday over the daily rows, without joining the daily table to itself.
    """
    number = F.datediff("order_date", F.lit("1970-01-01").cast("date"))
    numbered = daily.withColumns({"_n": number, "_weekday": F.weekday("order_date")})

    def at(days: int, column: str) -> Column:
        same_day = Window.partitionBy("_weekday").orderBy("_n").rangeBetween(-days, -days)
        return F.max(column).over(same_day)

    out = numbered.select(
        "*",
        at(7, "revenue_gbp").alias("revenue_gbp_wow"), at(7, "total_orders").alias("orders_wow"),
        at(7, "avg_order_value_gbp").alias("aov_wow"),
        at(364, "revenue_gbp").alias("revenue_gbp_yoy"), at(364, "total_orders").alias("orders_yoy"),
    ).drop("_n", "_weekday")
    whole = lambda c: F.round(F.col(c) * 100).cast("bigint")  # noqa: E731  pounds back to whole pence
    now, week, year = whole("revenue_gbp"), whole("revenue_gbp_wow"), whole("revenue_gbp_yoy")
    return out.withColumns(
        {
            "revenue_growth_wow_pct": percent(now - week, week, 1),
            "revenue_growth_yoy_pct": percent(now - year, year, 1),
            "orders_growth_wow_pct": percent("total_orders - orders_wow", "orders_wow", 1),
        }
    )


def mart_executive_kpis(star: Star, start_date: date) -> DataFrame:
    return with_comparisons(daily_sales_kpis(star, start_date))


def store_months(star: Star) -> DataFrame:
    """Store by month, not yet ranked. Returned lines stay in revenue."""
    sales = int_sales_enriched(star, parts=("date", "customer", "store"))
    keys = ["store_id", "order_year", "order_month"]
    agg = count_layers(
        sales, keys,
        {"revenue": F.col("net_revenue_pence"), "profit": F.col("gross_profit_pence"), "discount": F.col("discount_pence"),
         "units": F.col("units_sold"), "lines": F.lit(1), "returned": F.col("is_returned").cast("int")},
    )
    stores = star.stores.filter("is_current").select(
        F.col("store_id").alias("_id"), "store_name", "store_type", F.col("region").alias("store_region"),
        F.col("city").alias("store_city"),
    )
    month_name = F.date_format(F.make_date("order_year", "order_month", F.lit(1)), "MMMM")
    return agg.join(stores, F.col("store_id") == F.col("_id"), "left").select(
        "store_id", "store_name", "store_type", "store_region", "store_city", "order_year", "order_month",
        month_name.alias("order_month_name"),
        gbp("revenue").alias("revenue_gbp"),
        gbp("profit").alias("gross_profit_gbp"),
        gbp("discount").alias("discount_gbp"),
        percent("profit", "revenue", 2).alias("gross_margin_pct"),
        _big("orders").alias("total_orders"),
        _big("units").alias("total_units"),
        _big("customers").alias("unique_customers"),
        ratio("revenue", "orders * 100", 2).alias("avg_order_value_gbp"),
        percent("returned", "lines", 2).alias("return_rate_pct"),
        _big("revenue").alias("revenue_pence"),
    )


def mart_store_performance(star: Star) -> DataFrame:
    """Store by month, ranked by revenue within the month."""
    # A month has one row per store, so a window group is bounded by the store dimension.
    place = F.rank().over(Window.partitionBy("order_year", "order_month").orderBy(F.desc("revenue_pence")))
    return store_months(star).withColumn("revenue_rank_in_month", place.cast("bigint")).drop("revenue_pence")


def product_weeks(star: Star) -> DataFrame:
    """Product by week over lines that were not returned, not yet ranked."""
    sales = not_returned(int_sales_enriched(star))
    agg = count_layers(
        sales, ["product_id", "order_year", "order_iso_year", "order_week"],
        {"revenue": F.col("net_revenue_pence"), "profit": F.col("gross_profit_pence"), "units": F.col("units_sold"),
         "online": _when_type("Online", "net_revenue_pence"), "instore": _when_type("Physical", "net_revenue_pence")},
    )
    products = star.products.filter("is_current").select(
        F.col("product_id").alias("_id"), "product_name", "category", "subcategory", "brand", "rrp_pence"
    )
    list_price = F.col("rrp_pence").cast("decimal(19,0)") * F.col("units")
    return agg.join(products, F.col("product_id") == F.col("_id"), "left").select(
        "product_id", "product_name", "category", "subcategory", "brand", gbp("rrp_pence").alias("rrp_gbp"),
        "order_year", "order_iso_year", "order_week",
        gbp("revenue").alias("revenue_gbp"),
        gbp("profit").alias("gross_profit_gbp"),
        percent("profit", "revenue", 2).alias("gross_margin_pct"),
        _big("units").alias("units_sold"),
        _big("orders").alias("orders_containing_product"),
        _big("customers").alias("unique_buyers"),
        ratio("revenue", "units * 100", 2).alias("avg_selling_price_gbp"),
        percent(list_price - F.col("revenue"), list_price, 1).alias("avg_discount_vs_rrp_pct"),
        gbp("online").alias("online_revenue_gbp"),
        gbp("instore").alias("instore_revenue_gbp"),
        _big("revenue").alias("revenue_pence"),
    )


def mart_product_performance(star: Star) -> DataFrame:
    """Product by week, ranked by revenue within week and category.

    The week number is the ISO one; the ISO year is part of the key, so the last days of
    December are not merged with the first week of the same calendar year.
    """
    # A week has one row per product, so a window group is bounded by the product dimension.
    group = Window.partitionBy("order_year", "order_iso_year", "order_week", "category")
    place = F.rank().over(group.orderBy(F.desc("revenue_pence")))
    return product_weeks(star).withColumn("rank_in_category", place.cast("bigint")).drop("revenue_pence")


def mart_inventory_status(inventory: DataFrame, products: DataFrame, stores: DataFrame) -> DataFrame:
    """The latest snapshot per product and store with reorder flags and revenue at risk.

    Takes the maximum by date while aggregating, so no task sorts the snapshots of a pair.
    """
    fields = [c for c in ("inventory_key", "date_key", "stock_on_hand", "units_received", "units_sold", "reorder_point",
                          "reorder_quantity", "stock_status", "days_of_stock_remaining")]
    latest = inventory.groupBy("product_id", "store_id").agg(
        F.max_by(F.struct(*fields), F.struct("date_key", "inventory_key")).alias("s")
    ).select("product_id", "store_id", "s.*")
    item = products.filter("is_current").select(
        F.col("product_id").alias("_product"), "product_name", "category", "subcategory", "supplier_id", "rrp_pence"
    )
    shop = stores.filter("is_current").select(
        F.col("store_id").alias("_store"), "store_name", "store_type", F.col("region").alias("store_region")
    )
    joined = latest.join(item, F.col("product_id") == F.col("_product")).join(shop, F.col("store_id") == F.col("_store"))
    short = F.greatest(F.col("reorder_point") - F.col("stock_on_hand"), F.lit(0))
    return joined.select(
        "inventory_key", "date_key", "product_id", "product_name", "category", "subcategory", "supplier_id",
        "store_id", "store_name", "store_type", "store_region", "stock_on_hand", "units_received", "units_sold",
        "reorder_point", "reorder_quantity", "stock_status", "days_of_stock_remaining",
        (F.col("stock_on_hand") <= 0).alias("is_out_of_stock"),
        (F.col("stock_on_hand") <= F.col("reorder_point")).alias("needs_reorder"),
        (F.col("stock_on_hand") - F.col("reorder_point")).alias("stock_above_reorder"),
        gbp(short * F.coalesce(F.col("rrp_pence"), F.lit(0))).alias("potential_lost_revenue_gbp"),
    )


def mart_marketing_attribution(marketing: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Campaign by month: spend, clicks, attributed revenue, rates, and the share of the month's revenue."""
    monthly = marketing.groupBy(
        F.year("date").cast("bigint").alias("year"), F.month("date").cast("bigint").alias("month_num"), "campaign_id"
    ).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("spend_pence", "impressions", "clicks", "attributed_revenue_pence", "attributed_orders")]
    )
    known = monthly.join(
        campaigns.select(F.col("campaign_id").alias("_id"), "campaign_name", F.col("channel").alias("marketing_channel"), "objective"),
        F.col("campaign_id") == F.col("_id"),
    )
    months = known.groupBy(F.col("year").alias("_year"), F.col("month_num").alias("_month")).agg(
        F.sum("attributed_revenue_pence").alias("_total")
    )
    both = known.join(months, (F.col("year") == F.col("_year")) & (F.col("month_num") == F.col("_month")))
    spend, revenue, orders = F.col("spend_pence"), F.col("attributed_revenue_pence"), F.col("attributed_orders")
    return both.select(
        "year", "month_num", F.date_format(F.make_date("year", "month_num", F.lit(1)), "MMMM").alias("month_name"),
        "campaign_id", "campaign_name", "marketing_channel", "objective",
        gbp(spend).alias("total_spend_gbp"),
        F.col("impressions").alias("total_impressions"),
        F.col("clicks").alias("total_clicks"),
        percent("clicks", "impressions", 3).alias("ctr_pct"),
        ratio(spend, F.col("clicks") * 100, 4).alias("avg_cpc_gbp"),
        gbp(revenue).alias("attributed_revenue_gbp"),
        orders.alias("attributed_orders"),
        ratio(revenue, spend, 2).alias("roas"),
        ratio(spend, orders * 100, 2).alias("cost_per_order_gbp"),
        percent(revenue, F.col("_total"), 2).alias("revenue_share_pct"),
    )
