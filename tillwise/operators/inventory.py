"""Stock status, alerts and turnover."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.columns import ratio


def rag_status(stock: Column, reorder_point: Column, policy: str = "reorder_point") -> Column:
    """RED, AMBER or GREEN.

    `reorder_point`: RED at or below the reorder point. `zero_stock`: RED only when nothing is left.
    Both: AMBER up to 120 % of the reorder point.
    """
    red = stock <= reorder_point if policy == "reorder_point" else stock <= 0
    amber = stock * 10 <= reorder_point * 12
    return F.when(red, "RED").when(amber, "AMBER").otherwise("GREEN")


def with_stock_status(inventory: DataFrame, policy: str = "reorder_point", by_product: bool = False) -> DataFrame:
    """Add status and days of stock (stock over mean units sold per snapshot of the product in the store).

    A product has one snapshot a day in a store, so a window group is bounded by the calendar. With `by_product` the
    rows are partitioned by product, which groups the pairs too, so that products join without another shuffle.
    """
    pair = Window.partitionBy("product_id", "store_id")
    rows = inventory.repartition("product_id") if by_product else inventory
    return rows.withColumns({"_units": F.sum("units_sold").over(pair), "_days": F.count(F.lit(1)).over(pair)}).withColumns(
        {
            "stock_status": rag_status(F.col("stock_on_hand"), F.col("reorder_point"), policy),
            "days_of_stock_remaining": ratio("stock_on_hand * _days", "_units", 1),
        }
    ).drop("_units", "_days")


def next_days_demand(product_daily: DataFrame, as_of: date, days: int = 7) -> DataFrame:
    """Forecast units per product from `as_of` to `days` later, both included."""
    first = F.lit(as_of)
    return product_daily.filter(F.col("forecast_date").between(first, F.date_add(first, days))).groupBy(
        F.col("product_id").alias("_fc_product")
    ).agg(F.sum("forecast_milli_units").alias("_milli"))


def stockout_risk(inventory: DataFrame, products: DataFrame, stores: DataFrame, product_daily: DataFrame, as_of: date) -> DataFrame:
    """Yesterday's RED and AMBER rows with the demand forecast for the next seven days."""
    yesterday = F.date_sub(F.lit(as_of), 1)
    risky = inventory.filter((F.col("snapshot_date") == yesterday) & F.col("stock_status").isin("RED", "AMBER"))
    item = products.select(F.col("product_id").alias("_product"), "product_name", "category")
    shop = stores.select(F.col("store_id").alias("_store"), "store_name", "region")
    demand = next_days_demand(product_daily, as_of)
    return (
        risky.join(item, F.col("product_id") == F.col("_product"))
        .join(shop, F.col("store_id") == F.col("_store"))
        .join(demand, F.col("product_id") == F.col("_fc_product"), "left")
        .select(
            "product_id", "product_name", "category", "store_name", "region", "stock_on_hand", "reorder_point",
            "reorder_quantity", "stock_status", "days_of_stock_remaining",
            (F.col("_milli").cast("double") / 1000.0).alias("forecast_units_7d"),
        )
        .orderBy(F.when(F.col("stock_status") == "RED", 1).otherwise(2), "days_of_stock_remaining")
    )


def stock_alerts(status: DataFrame, product_daily: DataFrame, as_of: date) -> DataFrame:
    """Current RED items with their forecast demand: the daily alert list as a table."""
    demand = next_days_demand(product_daily, as_of)
    return status.filter(F.col("stock_status") == "RED").join(
        demand, F.col("product_id") == F.col("_fc_product"), "left"
    ).select(
        "product_id", "product_name", "category", "supplier_id", "store_id", "store_name", "stock_on_hand", "reorder_point",
        "reorder_quantity", "days_of_stock_remaining", (F.col("_milli").cast("double") / 1000.0).alias("forecast_units_7d"),
    )


def inventory_turnover(inventory: DataFrame) -> DataFrame:
    """Units sold over mean stock per product (the requirement gives no formula)."""
    per_product = inventory.groupBy("product_id").agg(
        F.sum("units_sold").alias("units"), F.sum("stock_on_hand").alias("stock"), F.count(F.lit(1)).alias("snapshots")
    )
    return per_product.select(
        "product_id", F.col("units").cast("bigint").alias("units_sold"),
        ratio("stock", "snapshots", 2).alias("avg_stock"),
        ratio("units * snapshots", "stock", 4).alias("turnover_rate"),
    )
