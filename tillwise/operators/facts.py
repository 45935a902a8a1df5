"""Fact tables: order lines, stock snapshots and marketing spend with their dimension keys."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise import model
from tillwise.functions import scale
from tillwise.functions.columns import date_key, safe_divide, surrogate_key
from tillwise.operators import dims


# Natural ids of the rows whose id has several parts, as SQL.
INVENTORY_ID = "concat(product_id, store_id, date_format(snapshot_date, 'yyyy-MM-dd'))"
SPEND_ID = "concat(campaign_id, date_format(date, 'yyyy-MM-dd'))"


def _now(load_time: datetime | None) -> Column:
    return F.current_timestamp() if load_time is None else F.lit(load_time).cast("timestamp")


def lookup(df: DataFrame, dim: DataFrame, natural: str, key: str, keep: bool = True) -> DataFrame:
    """Add the dimension key of a natural id; null where the dimension does not know it.

    The dimension is reduced to one row per id first, so a repeated id cannot repeat facts. Small dimensions are
    broadcast. Without `keep` the key takes the place of the id.
    """
    keys = dim.groupBy(F.col(natural).alias("_id")).agg(F.max(key).alias(key))
    if scale.is_small(dim.select(natural, key)):
        keys = F.broadcast(keys)
    return df.join(keys, F.col(natural) == F.col("_id"), "left").drop("_id", *(() if keep else (natural,)))


def lookup_on(df: DataFrame, dim: DataFrame, natural: str, key: str, day: str) -> DataFrame:
    """As `lookup`; of a dimension with versions the key of the one valid on `day`."""
    return dims.versions_on(df, dim, natural, day, key) if "version" in dim.columns else lookup(df, dim, natural, key)


def channel_key(channel: Column) -> Column:
    out = F.when(F.lit(False), F.lit(0))
    for name, key in model.CHANNEL_KEYS.items():
        out = out.when(channel == name, F.lit(key))
    return out.otherwise(F.lit(model.UNKNOWN_CHANNEL_KEY)).cast("bigint")


def build_fact_sales(
    orders: DataFrame, lines: DataFrame, customers: DataFrame, products: DataFrame, stores: DataFrame,
    run_id: str, load_time: datetime | None = None,
) -> DataFrame:
    """One row per order line with dimension keys and audit columns.

    Customer keys are looked up on the orders, before these meet their more numerous lines; keys of products and stores
    take the place of their ids before the lines meet the orders, so no shuffle of lines carries what the orders add.
    Where customers or products are given in versions, the keys are those of the versions valid on the order's day.
    """
    keyed_orders = lookup_on(orders, customers, "customer_id", "customer_key", "order_date")
    from_order = ["order_id", "customer_key", "order_date", "channel", "campaign_id"]
    versioned, by_order = "version" in products.columns, "store_id" not in lines.columns
    if by_order:
        from_order.append("store_id")
    else:
        lines = lookup(lines, stores, "store_id", "store_key", keep=False)
    if not versioned:
        lines = lookup(lines, products, "product_id", "product_key", keep=False)
    fact = lines.join(keyed_orders.select(*from_order), "order_id", "left")
    if versioned:
        fact = lookup_on(fact, products, "product_id", "product_key", "order_date")
    if by_order:
        fact = lookup(fact, stores, "store_id", "store_key")
    now = _now(load_time)
    fact = fact.withColumns(
        {
            "sale_key": surrogate_key("order_line_id"),
            "date_key": date_key("order_date"),
            "channel_key": channel_key(F.col("channel")),
            "campaign_key": surrogate_key("campaign_id"),
            "source_system": F.lit("POS"),
            "pipeline_run_id": F.lit(run_id),
            "created_at": now,
            "updated_at": now,
        }
    )
    if "return_date" in fact.columns:
        fact = fact.withColumn("return_date_key", date_key("return_date"))
    return fact.select(*[c for c in model.FACT_SALES_COLUMNS if c in fact.columns])


def build_fact_inventory(
    df: DataFrame, products: DataFrame, stores: DataFrame, run_id: str, load_time: datetime | None = None
) -> DataFrame:
    out = lookup(lookup_on(df, products, "product_id", "product_key", "snapshot_date"), stores, "store_id", "store_key")
    return out.withColumns(
        {
            "date_key": date_key("snapshot_date"),
            "inventory_key": surrogate_key(INVENTORY_ID),
            "pipeline_run_id": F.lit(run_id),
            "created_at": _now(load_time),
        }
    )


def build_fact_marketing(df: DataFrame, run_id: str, load_time: datetime | None = None) -> DataFrame:
    """Spend rows with keys and derived rates: click rate, cost per click (half-even pence), return on spend."""
    cpc = F.coalesce(F.bround(safe_divide("spend_pence", "clicks"), 0), F.lit(0.0)).cast("bigint")
    return df.withColumns(
        {
            "date_key": date_key("date"),
            "campaign_key": surrogate_key("campaign_id"),
            "spend_key": surrogate_key(SPEND_ID),
            "ctr": safe_divide("clicks", "impressions"),
            "cpc_pence": cpc,
            "roas": safe_divide("attributed_revenue_pence", "spend_pence"),
            "pipeline_run_id": F.lit(run_id),
            "created_at": _now(load_time),
        }
    )
