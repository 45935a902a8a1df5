"""Enriched sales and the summary of each customer's orders."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions import scale
from tillwise.functions.columns import date_key, gbp, percent, ratio, safe_divide, surrogate_key
from tillwise.operators import dims

# Output columns of enriched sales, and the dimension columns they come from.
DATE_COLUMNS = {
    "order_year": "year", "order_month": "month_num", "order_month_name": "month_name", "order_quarter": "quarter",
    "order_week": "week_number", "order_iso_year": "iso_year", "order_day_of_week": "day_of_week",
    "is_weekend": "is_weekend", "is_uk_public_holiday": "is_uk_public_holiday",
    "is_promotional_period": "is_promotional", "season": "season",
}
CUSTOMER_COLUMNS = {
    "customer_id": "customer_id", "age_band": "age_band", "gender": "gender", "customer_region": "region",
    "customer_city": "city", "loyalty_tier": "loyalty_tier", "acquisition_channel": "acquisition_channel",
    "acquisition_date": "acquisition_date", "rfm_segment": "rfm_segment", "customer_ltv_gbp": "customer_ltv_gbp",
}
PRODUCT_COLUMNS = {
    "product_id": "product_id", "product_name": "product_name", "category": "category", "subcategory": "subcategory",
    "brand": "brand", "supplier_id": "supplier_id", "rrp_pence": "rrp_pence",
}
STORE_COLUMNS = {
    "store_id": "store_id", "store_name": "store_name", "store_type": "store_type", "store_region": "region",
    "store_city": "city",
}
# Attributes that many members of a dimension share: their combinations can travel as one number.
SHARED = {
    "customer": ("age_band", "gender", "customer_region", "customer_city", "loyalty_tier", "acquisition_channel", "rfm_segment"),
    "product": ("category", "subcategory", "brand", "supplier_id"),
}
MEASURES = (
    "gross_revenue_pence", "discount_pence", "net_revenue_pence", "cost_of_goods_pence", "gross_profit_pence",
)


class Star:
    """The frames enriched sales are made of: validated orders and lines, and current dimensions.

    `raw` has the raw tables as attributes; a dimension is only planned when it is used.
    Joins use the natural ids: surrogate keys have 9 digits, so two of them may be equal in a
    large dimension, and a join on them would then repeat lines.
    """

    def __init__(
        self, raw, first_day: date = date(1990, 1, 1), last_day: date = date(2030, 12, 31),
        load_time: datetime | None = None, run_id: str = "run",
    ):
        self.raw, self.load_time, self.run_id = raw, load_time, run_id
        self.first_day, self.last_day = first_day, last_day
        self._small: dict[str, bool] = {}

    def is_small(self, part: str, attributes: DataFrame) -> bool:
        """Whether a dimension's attributes may be broadcast; measured once."""
        if part not in self._small:
            self._small[part] = scale.is_small(attributes)
        return self._small[part]

    @cached_property
    def orders(self) -> DataFrame:
        return self.raw.orders

    @cached_property
    def lines(self) -> DataFrame:
        return self.raw.order_lines

    @cached_property
    def customers(self) -> DataFrame:
        return dims.transform_customers(self.raw.customers, self.load_time)

    @cached_property
    def products(self) -> DataFrame:
        return dims.transform_products(self.raw.products, self.load_time)

    @cached_property
    def stores(self) -> DataFrame:
        return dims.transform_stores(self.raw.stores, self.load_time)

    @cached_property
    def dates(self) -> DataFrame:
        return dims.build_dim_date(self.raw.spark, self.first_day, self.last_day)


def _attributes(dim: DataFrame, columns: dict[str, str], natural: str) -> DataFrame:
    current = dim.filter("is_current") if "is_current" in dim.columns else dim
    return current.select(F.col(natural).alias("_id"), *[F.col(src).alias(out) for out, src in columns.items()])


def _numbered(rows: DataFrame, shared: Sequence[str], number: str) -> tuple[DataFrame, DataFrame | None]:
    """The rows with `number` in place of the shared columns, and the frame that gives these back.

    The combinations are written, so that both frames have the same numbers. Where there are too many of them to
    broadcast, the rows stay as they are.
    """
    sets = scale.stage(rows.select(*shared).distinct().withColumn(number, F.monotonically_increasing_id()), "shared")
    if not scale.is_small(sets):
        return rows, None
    theirs = sets.select(number, *[F.col(c).alias(f"_of_{c}") for c in shared])
    same = F.lit(True)
    for c in shared:
        same = same & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    kept = [c for c in rows.columns if c not in shared]
    return rows.join(F.broadcast(theirs), same, "left").select(*kept, number), sets


def int_sales_enriched(
    star: Star, parts: Sequence[str] = ("date", "customer", "product", "store"), numbered: bool = False
) -> DataFrame:
    """Order lines with date, customer, product and store attributes; unknown ids give nulls.

    Only the dimensions named in `parts` are joined. Customer attributes are attached to the orders before
    these meet their lines, so the large join carries them once. Lines meet
    their orders last: no shuffle of lines carries these attributes, the widest of all, and the lines
    stay partitioned by order, which the per-order aggregations of the marts reuse. Small dimensions are
    broadcast. With `numbered`, attributes that members share go through the shuffles as numbers of their
    combinations; that is for those who want all attributes of large dimensions.
    """
    orders = star.orders.select("order_id", F.col("customer_id").alias("_customer"), "order_date", "channel")
    sets: dict[str, DataFrame] = {}

    def attributes(part: str, dim: DataFrame, columns: dict[str, str]) -> DataFrame:
        found = _attributes(dim, columns, f"{part}_id")
        if numbered and part in SHARED and not star.is_small(part, found):
            found, named = _numbered(found, SHARED[part], f"_{part}_set")
            if named is not None:
                sets[f"_{part}_set"] = named
        return found

    if "customer" in parts:
        who = attributes("customer", star.customers, CUSTOMER_COLUMNS)
        who = F.broadcast(who) if star.is_small("customer", who) else who
        orders = orders.join(who, F.col("_customer") == F.col("_id"), "left").drop("_id", "_customer")
    else:
        orders = orders.withColumnRenamed("_customer", "customer_id")

    # As staged sales have it: a line without id has no key and is no sale.
    sales = star.lines.filter(F.col("order_line_id").isNotNull()).withColumnsRenamed({"product_id": "_product", "store_id": "_store"})
    kept = [c for c in star.lines.columns if c != "order_id" and not (c == "product_id" and "product" in parts) and not (c == "store_id" and "store" in parts)]
    added: list[str] = []
    late: list[tuple[str, DataFrame]] = []
    for part, columns in (("store", STORE_COLUMNS), ("product", PRODUCT_COLUMNS)):
        if part in parts:
            dim = attributes(part, star.products if part == "product" else star.stores, columns)
            if star.is_small(part, dim):
                late.append((part, dim))
            else:
                sales = sales.join(dim, F.col(f"_{part}") == F.col("_id"), "left").drop("_id", f"_{part}")
            added = [*columns, *added]
        else:
            sales = sales.withColumnRenamed(f"_{part}", f"{part}_id")
    sales = sales.join(orders, "order_id", "left")
    for part, dim in late:
        # What is broadcast needs no shuffle, so no shuffle carries it.
        sales = sales.join(F.broadcast(dim), F.col(f"_{part}") == F.col("_id"), "left").drop("_id", f"_{part}")
    of_order = [*(() if "customer" in parts else ("customer_id",)), "order_date", "channel"]
    if "date" in parts:
        # One row per calendar day: a few thousand rows whatever the size of the facts.
        days = star.dates.select(F.col("full_date").alias("_id"), *[F.col(s).alias(c) for c, s in DATE_COLUMNS.items()])
        # A day outside the calendar keeps its date and has no other date attributes.
        sales = sales.join(F.broadcast(days), F.col("order_date") == F.col("_id"), "left").drop("_id")
        of_order += DATE_COLUMNS
    for number, named in sets.items():
        sales = sales.join(F.broadcast(named), number, "left")
    if "customer" in parts:
        of_order += CUSTOMER_COLUMNS
    return sales.select("order_id", *kept, *of_order, *added)


def enriched_columns(sales: DataFrame, run_id: str) -> DataFrame:
    """The published column list of enriched sales: money in pounds and derived ratios."""
    money = {m.replace("_pence", "_gbp"): gbp(m) for m in (*MEASURES, "rrp_pence")}
    out = sales.withColumns(
        {
            **money,
            "sale_key": surrogate_key("order_line_id"),
            "gross_margin_pct": percent("gross_profit_pence", "net_revenue_pence", 2, wide=False),
            "revenue_per_unit": safe_divide(gbp("net_revenue_pence"), "units_sold"),
            "discount_pct": safe_divide(gbp("discount_pence"), gbp("gross_revenue_pence")) * 100,
            "return_date_key": date_key("return_date"),
            "pipeline_run_id": F.lit(run_id),
        }
    )
    date_out = [c for c in DATE_COLUMNS if c != "order_iso_year"]
    customer_out = [c for c in CUSTOMER_COLUMNS if c != "acquisition_date"]
    return out.select(
        "sale_key", "order_id", "order_line_id", "order_date", *date_out, *customer_out,
        "product_id", "product_name", "category", "subcategory", "brand", "supplier_id", "rrp_gbp",
        *STORE_COLUMNS, "units_sold", *[m.replace("_pence", "_gbp") for m in MEASURES], "gross_margin_pct",
        "revenue_per_unit", "discount_pct", "is_returned", "return_date_key", "pipeline_run_id",
    )


def count_layers(
    sales: DataFrame, keys: Sequence[str], sums: dict[str, Column], customer: str = "customer_id"
) -> DataFrame:
    """Per group: sums, distinct orders (`orders`) and distinct customers (`customers`).

    Aggregates in layers (order, then customer, then group) in place of several distinct counts:
    the first layer is local to the partitions of the line-order join, and a hot group is
    split over its orders and customers until only counts are left. An order has one customer.
    """
    per_order = sales.groupBy(*keys, customer, "order_id").agg(*[F.sum(c).alias(n) for n, c in sums.items()])
    again = [F.sum(n).alias(n) for n in sums]
    per_customer = per_order.groupBy(*keys, customer).agg(*again, F.count("order_id").alias("orders"))
    return per_customer.groupBy(*keys).agg(
        *again, F.sum("orders").alias("orders"), F.count(customer).alias("customers")
    )


def not_returned(sales: DataFrame) -> DataFrame:
    return sales.filter(~F.col("is_returned"))


def customer_top_category(sales: DataFrame) -> DataFrame:
    """The category with the highest revenue per customer; equal revenue goes to the first name."""
    per_category = sales.groupBy("customer_id", "category").agg(F.sum("net_revenue_pence").alias("revenue"))
    return per_category.groupBy("customer_id").agg(_best_category().alias("top_category"))


def _best_category() -> Column:
    return F.min_by("category", F.struct(-F.col("revenue"), F.col("category")))


CUSTOMER_GROUP = ("customer_region", "loyalty_tier", "acquisition_channel")


def int_customer_orders(
    star: Star, as_of: date, window_months: int | None = None, until: date | None = None
) -> DataFrame:
    """One row per customer over lines that were not returned: recency, frequency, value, habits.

    Lines meet their orders once. Sums are taken per order and category where the join left the rows;
    an order's first category row stands for the order, and a day's first row for the day, so distinct
    orders and days are sums too. `window_months` limits the history to the months before `as_of`,
    `until` to orders before a day (the state of an earlier run).
    """
    sales = not_returned(int_sales_enriched(star))
    if window_months is not None:
        sales = sales.filter(F.col("order_date") >= F.add_months(F.lit(as_of), -window_months))
    if until is not None:
        sales = sales.filter(F.col("order_date") < F.lit(until))

    who = ["customer_id", *CUSTOMER_GROUP]
    one = F.lit(1)
    per_order = sales.groupBy(*who, "order_date", "order_id", "category").agg(
        F.sum("units_sold").alias("units"),
        F.sum("net_revenue_pence").alias("revenue"),
        F.sum("gross_profit_pence").alias("profit"),
        F.count(one).alias("lines"),
        F.count_if("is_weekend").alias("weekend_orders"),
        F.count_if("is_promotional_period").alias("promo_orders"),
        F.count_if(F.col("store_type") == "Online").alias("online_orders"),
        F.count_if(F.col("store_type") == "Physical").alias("instore_orders"),
    )
    added = ["units", "revenue", "profit", "lines", "weekend_orders", "promo_orders", "online_orders", "instore_orders"]

    def first_row(key: str) -> Column:
        """1 on one row of each order (or day) of a customer; at most one row per category each."""
        place = F.row_number().over(Window.partitionBy("customer_id", key).orderBy("category"))
        return ((place == 1) & F.col(key).isNotNull()).cast("bigint")

    marked = per_order.withColumn("orders", first_row("order_id"))
    # One exchange serves the sums per day and the mark of the day.
    per_day = marked.repartition("customer_id", "order_date").groupBy(*who, "order_date", "category").agg(
        *[F.sum(c).alias(c) for c in (*added, "orders")]
    ).withColumn("days", first_row("order_date"))
    added += ["orders", "days"]
    per_category = per_day.groupBy(*who, "category").agg(
        F.max("order_date").alias("last_purchase_date"), F.min("order_date").alias("first_purchase_date"), *[F.sum(c).alias(c) for c in added]
    )
    joined = per_category.groupBy(*who).agg(
        _best_category().alias("top_category"),
        F.max("last_purchase_date").alias("last_purchase_date"),
        F.min("first_purchase_date").alias("first_purchase_date"),
        *[F.sum(c).alias(c) for c in added],
    ).withColumnsRenamed({"orders": "total_orders", "days": "purchase_frequency"})
    day = F.lit(as_of).cast("date")
    return joined.select(
        "customer_id", *CUSTOMER_GROUP,
        F.datediff(day, "last_purchase_date").cast("bigint").alias("days_since_last_purchase"),
        "last_purchase_date", "first_purchase_date",
        F.col("purchase_frequency").cast("bigint").alias("purchase_frequency"),
        F.col("total_orders").cast("bigint").alias("total_orders"),
        F.col("units").cast("bigint").alias("total_units_purchased"),
        gbp("revenue").alias("total_revenue_gbp"),
        ratio("revenue", "lines * 100", 2).alias("avg_order_value_gbp"),
        gbp("profit").alias("total_profit_gbp"),
        *[F.col(c).cast("bigint").alias(c) for c in ("weekend_orders", "promo_orders", "online_orders", "instore_orders")],
        "top_category",
        F.datediff(day, "first_purchase_date").cast("bigint").alias("customer_age_days"),
        F.col("revenue").cast("bigint").alias("total_revenue_pence"),
        F.col("profit").cast("bigint").alias("total_profit_pence"),
    )
