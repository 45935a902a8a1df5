"""Analytical queries and the data sets behind the dashboard tiles."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.columns import gbp, percent, ratio
from tillwise.operators.intermediate import Star, count_layers, int_sales_enriched, not_returned


def _since(as_of: date, days: int) -> Column:
    return F.lit(as_of - timedelta(days=days))


def daily_revenue(star: Star, as_of: date, days: int = 30) -> DataFrame:
    """Orders, units, revenue and margin per day over the last days, newest first."""
    sales = not_returned(int_sales_enriched(star, parts=("date",))).filter(F.col("order_date") >= _since(as_of, days))
    keys = ["order_date", "order_day_of_week", "is_weekend"]
    sums = {"units": "units_sold", "revenue": "net_revenue_pence", "profit": "gross_profit_pence"}
    per_order = sales.groupBy(*keys, "order_id").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    return per_order.groupBy(*keys).agg(*[F.sum(n).alias(n) for n in sums], F.count("order_id").alias("orders")).select(
        F.col("order_date").alias("full_date"), F.col("order_day_of_week").alias("day_of_week"), "is_weekend",
        F.col("orders").alias("total_orders"), F.col("units").cast("bigint").alias("total_units"),
        gbp("revenue").alias("net_revenue_gbp"), gbp("profit").alias("gross_profit_gbp"),
        percent("profit", "revenue", 1).alias("gross_margin_pct"),
        ratio("revenue", "orders * 100", 2).alias("avg_order_value_gbp"),
    ).orderBy(F.desc("full_date"))


def store_mtd_vs_prior(star: Star, as_of: date) -> DataFrame:
    """Month-to-date revenue per store against the whole month before; one pass over both months."""
    this_month = F.trunc(F.lit(as_of), "month")
    day = F.col("order_date")
    sales = not_returned(int_sales_enriched(star, parts=("date", "customer", "store"))).filter(
        (day >= F.add_months(this_month, -1)) & (day <= F.last_day(F.lit(as_of))) & F.col("store_id").isNotNull()
    )
    periods = count_layers(
        sales.withColumn("is_current", day >= this_month), ["store_id", "is_current"], {"revenue": F.col("net_revenue_pence")}
    )
    pick = lambda c, current: F.max(F.when(F.col("is_current") == F.lit(current), F.col(c)))
    both = periods.groupBy("store_id").agg(
        pick("revenue", True).alias("now"), pick("orders", True).alias("orders"), pick("customers", True).alias("customers"),
        pick("revenue", False).alias("before"),
    ).filter(F.col("orders").isNotNull())
    stores = star.stores.filter("is_current").select(F.col("store_id").alias("_id"), "store_name", "region", "city")
    return both.join(stores, F.col("store_id") == F.col("_id")).select(
        "store_id", "store_name", "region", "city", gbp("now").alias("revenue_gbp"), "orders",
        F.col("customers").alias("unique_customers"), gbp("before").alias("revenue_gbp_prior"),
        percent("now - before", "before", 1).alias("mom_growth_pct"),
    ).orderBy(F.desc("revenue_gbp"), "store_id")


def product_totals(star: Star, first_day: Column | None = None) -> DataFrame:
    """Units, revenue and profit per known product over lines not returned."""
    sales = not_returned(int_sales_enriched(star, parts=("date",)))
    if first_day is not None:
        sales = sales.filter(F.col("order_date") >= first_day)
    per_product = sales.groupBy("product_id").agg(
        F.sum("units_sold").cast("bigint").alias("units_sold"), F.sum("net_revenue_pence").alias("revenue"),
        F.sum("gross_profit_pence").alias("profit"),
    )
    products = star.products.filter("is_current").select(
        F.col("product_id").alias("_id"), "product_name", "category", "subcategory"
    )
    return per_product.join(products, F.col("product_id") == F.col("_id")).drop("_id")


def top_products(star: Star, as_of: date, days: int = 28, n: int = 10) -> DataFrame:
    totals = product_totals(star, _since(as_of, days))
    return totals.orderBy(F.desc("revenue"), "product_id").limit(n).select(
        "product_id", "product_name", "category", "subcategory", "units_sold", gbp("revenue").alias("revenue_gbp"),
        gbp("profit").alias("profit_gbp"), percent("profit", "revenue", 1).alias("margin_pct"),
    )


def channel_attribution(marketing: DataFrame, campaigns: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """Spend and attributed revenue per marketing channel over the last days."""
    per_campaign = marketing.filter(F.col("date") >= _since(as_of, days)).groupBy("campaign_id").agg(
        *[F.sum(c).alias(c) for c in ("impressions", "clicks", "spend_pence", "attributed_revenue_pence", "attributed_orders")]
    )
    owner = campaigns.select(F.col("campaign_id").alias("_id"), F.col("channel").alias("marketing_channel"))
    totals = per_campaign.join(owner, F.col("campaign_id") == F.col("_id")).groupBy("marketing_channel").agg(
        F.count("campaign_id").alias("active_campaigns"),
        *[F.sum(c).cast("bigint").alias(c) for c in ("impressions", "clicks", "spend_pence", "attributed_revenue_pence", "attributed_orders")],
    )
    return totals.select(
        "marketing_channel", "active_campaigns", "impressions", "clicks",
        percent("clicks", "impressions", 2).alias("ctr_pct"), gbp("spend_pence").alias("spend_gbp"),
        gbp("attributed_revenue_pence").alias("attributed_revenue_gbp"), "attributed_orders",
        ratio("attributed_revenue_pence", "spend_pence", 2).alias("roas"),
        ratio("spend_pence", "attributed_orders * 100", 2).alias("cost_per_order_gbp"),
    ).orderBy(F.desc("attributed_revenue_gbp"))


def new_vs_returning(star: Star, as_of: date, months: int = 12) -> DataFrame:
    """Customers per month by whether they were acquired in that month or before it.

    The two flags depend on customer and month only, so one distinct step serves all three counts.
    """
    day = F.col("order_date")
    sales = not_returned(int_sales_enriched(star, parts=("date", "customer"))).filter(
        (day >= F.add_months(F.lit(as_of), -months)) & F.col("customer_id").isNotNull()
    )
    month = F.trunc("order_date", "month")
    buyers = sales.groupBy(month.alias("month"), "customer_id").agg(F.max("acquisition_date").alias("acquired"))
    return buyers.groupBy("month").agg(
        F.count_if((F.col("acquired") >= F.col("month")) & (F.col("acquired") < F.add_months("month", 1))).alias("new_customers"),
        F.count_if(F.col("acquired") < F.col("month")).alias("returning_customers"),
        F.count(F.lit(1)).alias("total_customers"),
    ).select(
        F.year("month").cast("bigint").alias("year"), F.month("month").cast("bigint").alias("month_num"),
        F.date_format("month", "MMMM").alias("month_name"), "new_customers", "returning_customers", "total_customers",
    ).orderBy("year", "month_num")


def pipeline_health(run_log: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Runs of the last days with the share of quarantined records."""
    return run_log.filter(F.col("run_date") >= _since(as_of, days)).select(
        "run_date", "source_system", "status", "records_extracted", "records_loaded", "records_quarantined",
        percent("records_quarantined", "records_extracted", 2).alias("quarantine_rate_pct"),
        "duration_seconds", "error_message",
    ).orderBy(F.desc("run_date"), "source_system")


# --- dashboard tiles ------------------------------------------------------------------------

def _pence(c: str) -> Column:
    return F.round(F.col(c) * 100).cast("bigint")


def kpi_cards(kpis: DataFrame, first: date, last: date) -> DataFrame:
    """Totals of a date range with growth against the week and the 364 days before it."""
    rows = kpis.select("order_date", _pence("revenue_gbp").alias("revenue"), _pence("gross_profit_gbp").alias("profit"), "total_orders")

    def between(shift: int) -> Column:
        return F.col("order_date").between(F.lit(first - timedelta(days=shift)), F.lit(last - timedelta(days=shift)))

    total = lambda c, shift: F.sum(F.when(between(shift), F.col(c)))
    sums = rows.agg(
        *[total(c, s).alias(f"{c}_{s}") for c in ("revenue", "profit", "total_orders") for s in (0, 7, 364)]
    )
    rev, week, year = F.col("revenue_0"), F.col("revenue_7"), F.col("revenue_364")
    return sums.select(
        gbp(rev).alias("revenue_gbp"), F.col("total_orders_0").alias("total_orders"),
        ratio(rev, F.col("total_orders_0") * 100, 2).alias("avg_order_value_gbp"),
        percent(F.col("profit_0"), rev, 2).alias("gross_margin_pct"),
        percent(rev - week, week, 1).alias("revenue_vs_last_week_pct"),
        percent("total_orders_0 - total_orders_7", "total_orders_7", 1).alias("orders_vs_last_week_pct"),
        percent(rev - year, year, 1).alias("revenue_yoy_pct"),
    )


def revenue_by_region(star: Star) -> DataFrame:
    """Revenue and distinct orders per region; an order that two stores of a region serve counts once."""
    sales = int_sales_enriched(star, parts=("customer", "store"))
    agg = count_layers(sales, ["store_region"], {"revenue": F.col("net_revenue_pence")})
    return agg.select("store_region", gbp("revenue").alias("revenue_gbp"), F.col("orders").cast("bigint").alias("orders"))


def store_table(star: Star, as_of: date) -> DataFrame:
    """Revenue, orders, order value and margin per store over seven days, against the seven days before."""
    day = F.col("order_date")
    sales = int_sales_enriched(star, parts=("date", "store")).filter(
        (day > _since(as_of, 14)) & (day <= F.lit(as_of)) & F.col("store_id").isNotNull()
    ).withColumn("recent", day > _since(as_of, 7))
    per_order = sales.groupBy("store_id", "store_name", "recent", "order_id").agg(
        F.sum("net_revenue_pence").alias("revenue"), F.sum("gross_profit_pence").alias("profit")
    )
    recent = lambda c: F.sum(F.when(F.col("recent"), F.col(c)))
    per_store = per_order.groupBy("store_id", "store_name").agg(
        recent("revenue").alias("revenue"), recent("profit").alias("profit"), F.count_if("recent").alias("orders"),
        F.sum(F.when(~F.col("recent"), F.col("revenue"))).alias("before"),
    )
    return per_store.select(
        "store_id", "store_name", gbp("revenue").alias("revenue_gbp"), "orders",
        ratio("revenue", "orders * 100", 2).alias("aov_gbp"),
        percent("profit", "revenue", 2).alias("margin_pct"),
        percent("revenue - before", "before", 1).alias("wow_pct"),
    )


def top_bottom_products(star: Star, n: int = 10) -> DataFrame:
    """The n products with the highest and the n with the lowest revenue."""
    totals = product_totals(star).select("product_id", "product_name", "category", "revenue")
    parts = []
    for side, order in (("top", F.desc("revenue")), ("bottom", F.asc("revenue"))):
        # The limit is a top-k; the numbering below runs over its n rows only.
        best = totals.orderBy(order, "product_id").limit(n)
        place = F.row_number().over(Window.orderBy(order, "product_id"))
        parts.append(best.select(F.lit(side).alias("side"), place.cast("bigint").alias("place"), "product_id", "product_name",
                                 "category", gbp("revenue").alias("revenue_gbp")))
    return parts[0].unionByName(parts[1])


def top_customers(rfm: DataFrame, n: int = 100) -> DataFrame:
    return rfm.orderBy(F.desc("total_revenue_pence"), "customer_id").limit(n).select(
        "customer_id", "rfm_segment", F.col("total_revenue_gbp").alias("ltv_gbp"), "total_orders", "last_purchase_date"
    )


def status_by_category(status: DataFrame) -> DataFrame:
    """Items per category and stock status with their shares; `items` counts those of any other status too."""
    names = ("RED", "AMBER", "GREEN")
    counts = status.groupBy("category").agg(
        *[F.count_if(F.col("stock_status") == s).alias(f"{s.lower()}_items") for s in names], F.count(F.lit(1)).alias("items")
    )
    return counts.select("*", *[percent(f"{s.lower()}_items", "items", 1).alias(f"{s.lower()}_pct") for s in names])


def days_of_stock_histogram(status: DataFrame, width: int = 5) -> DataFrame:
    low = F.floor(F.col("days_of_stock_remaining") / width) * width
    return status.filter(F.col("days_of_stock_remaining").isNotNull()).groupBy(low.cast("bigint").alias("days_from")).agg(
        F.count(F.lit(1)).alias("items")
    )


def critical_stock(status: DataFrame) -> DataFrame:
    """RED items, fewest days of stock first."""
    return status.filter(F.col("stock_status") == "RED").select(
        "product_id", "product_name", "category", "store_id", "store_name", "stock_on_hand", "reorder_point", "days_of_stock_remaining"
    ).orderBy(F.asc_nulls_last("days_of_stock_remaining"), "product_id", "store_id")


def lost_revenue(status: DataFrame) -> DataFrame:
    return status.agg(
        F.count_if(F.col("stock_status") == "RED").alias("red_items"), F.count_if(F.col("stock_status") == "AMBER").alias("amber_items"),
        F.count(F.lit(1)).alias("items"), gbp(F.sum(_pence("potential_lost_revenue_gbp"))).alias("potential_lost_revenue_gbp"),
    )


def spend_vs_revenue(attribution: DataFrame) -> DataFrame:
    """One row per campaign over all months."""
    return attribution.groupBy("campaign_id", "marketing_channel").agg(
        F.sum(_pence("total_spend_gbp")).alias("spend"), F.sum(_pence("attributed_revenue_gbp")).alias("revenue"),
        F.sum("attributed_orders").cast("bigint").alias("orders"),
        F.sum("total_clicks").alias("clicks"), F.sum("total_impressions").alias("impressions"),
    ).select(
        "campaign_id", "marketing_channel", gbp("spend").alias("spend_gbp"), gbp("revenue").alias("revenue_gbp"), "orders",
        ratio("revenue", "spend", 2).alias("roas"), percent("clicks", "impressions", 2).alias("ctr_pct"),
    )


def filter_view(
    sales: DataFrame, as_of: date, first: date | None = None, last: date | None = None, stores: list[str] | None = None,
    categories: list[str] | None = None, channels: list[str] | None = None,
) -> DataFrame:
    """The common dashboard filters; without a date range the current month so far."""
    day = F.col("order_date")
    if first is None and last is None:
        first, last = as_of.replace(day=1), as_of
    out = sales
    if first is not None:
        out = out.filter(day >= F.lit(first))
    if last is not None:
        out = out.filter(day <= F.lit(last))
    for column, chosen in (("store_id", stores), ("category", categories), ("channel", channels)):
        if chosen:
            out = out.filter(F.col(column).isin(*chosen))
    return out


def filtered_kpis(sales: DataFrame) -> DataFrame:
    """Headline numbers of a filtered view."""
    per_order = sales.groupBy("order_id").agg(F.sum("net_revenue_pence").alias("revenue"), F.sum("gross_profit_pence").alias("profit"), F.sum("units_sold").alias("units"))
    return per_order.agg(F.sum("revenue").alias("revenue"), F.sum("profit").alias("profit"), F.sum("units").alias("units"), F.count("order_id").alias("orders")).select(
        gbp("revenue").alias("revenue_gbp"), F.col("orders").alias("total_orders"), F.col("units").cast("bigint").alias("total_units"),
        ratio("revenue", "orders * 100", 2).alias("avg_order_value_gbp"), percent("profit", "revenue", 2).alias("gross_margin_pct"),
    )


def restrict_to_store(df: DataFrame, store_id: str) -> DataFrame:
    """Row-level security: the rows of one store."""
    return df.filter(F.col("store_id") == store_id)


def secured(df: DataFrame, entitlements: DataFrame, user: Column | None = None, key: str = "store_id") -> DataFrame:
    """Row-level security by a table of (user_name, `key`): the rows of the user's entries, and none without an entry.

    The user is the session's unless given. A null key is no one's; repeated entries do not repeat rows.
    """
    mine = entitlements.filter(F.col("user_name") == (F.session_user() if user is None else user)).select(F.col(key).alias("_granted"))
    return df.join(mine, F.col(key) == F.col("_granted"), "left_semi")


def blend(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join of two marts on shared keys."""
    return left.join(right, keys, "left")


def store_wtd_mtd(star: Star) -> DataFrame:
    """Running revenue per store within each week and month.

    The running sums see one row per store and day: at most 7 and 31 rows per group.
    """
    sales = int_sales_enriched(star, parts=("date", "store")).filter(F.col("store_id").isNotNull() & F.col("order_date").isNotNull())
    daily = sales.groupBy("store_id", "order_date").agg(F.sum("net_revenue_pence").alias("revenue"))

    def running(unit: str) -> Column:
        group = Window.partitionBy("store_id", F.trunc("order_date", unit)).orderBy("order_date")
        return F.sum("revenue").over(group.rowsBetween(Window.unboundedPreceding, 0))

    return daily.select(
        "store_id", "order_date", gbp("revenue").alias("revenue_gbp"), gbp(running("week")).alias("wtd_gbp"), gbp(running("month")).alias("mtd_gbp")
    )
