"""Staging models: one projection and filter per warehouse table, pence shown as pounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.columns import gbp, percent

# Output columns of the staging models, in order. A column ending in _gbp is made from _pence.
COLUMNS = {
    "customers": (
        "customer_key", "customer_id", "email_masked", "age_band", "gender", "city", "region", "postcode_district",
        "acquisition_channel", "acquisition_date", "loyalty_tier", "rfm_recency_score", "rfm_frequency_score",
        "rfm_monetary_score", "rfm_segment", "rfm_updated_at", "customer_ltv_gbp", "is_current", "valid_from",
        "valid_to", "created_at", "updated_at",
    ),
    "products": (
        "product_key", "product_id", "product_name", "category", "subcategory", "brand", "supplier_id",
        "supplier_name", "cost_price_gbp", "rrp_gbp", "is_active", "launch_date", "discontinue_date", "is_current",
        "valid_from", "valid_to", "created_at", "updated_at",
    ),
    "stores": (
        "store_key", "store_id", "store_name", "store_type", "city", "region", "country", "postcode",
        "opening_date", "is_active", "is_current", "valid_from", "valid_to", "created_at", "updated_at",
    ),
    "sales": (
        "sale_key", "order_id", "order_line_id", "date_key", "customer_key", "product_key", "store_key",
        "channel_key", "campaign_key", "units_sold", "gross_revenue_gbp", "discount_gbp", "net_revenue_gbp",
        "cost_of_goods_gbp", "gross_profit_gbp", "gross_margin_pct", "is_returned", "return_date_key",
        "source_system", "pipeline_run_id", "created_at", "updated_at",
    ),
    "inventory": (
        "inventory_key", "date_key", "product_key", "store_key", "stock_on_hand", "units_received", "units_sold",
        "units_returned", "reorder_point", "reorder_quantity", "stock_status", "days_of_stock_remaining",
        "source_system", "pipeline_run_id", "created_at",
    ),
    "marketing": (
        "spend_key", "date_key", "campaign_key", "impressions", "clicks", "spend_gbp", "attributed_revenue_gbp",
        "attributed_orders", "ctr", "cpc_gbp", "roas", "source_system", "pipeline_run_id", "created_at",
    ),
}


def _staged(df: DataFrame, table: str, key: str, current_only: bool) -> DataFrame:
    rows = df.filter(F.col(key).isNotNull())
    if current_only:
        rows = rows.filter("is_current")
    out = []
    for c in COLUMNS[table]:
        from_pence = c.removesuffix("_gbp") + "_pence"
        if c in df.columns:
            out.append(F.col(c))
        elif c.endswith("_gbp") and from_pence in df.columns:
            out.append(gbp(from_pence).alias(c))
        elif c == "gross_margin_pct":
            out.append(percent("gross_profit_pence", "net_revenue_pence", 2, wide=False).alias(c))
    return rows.select(*out)


def stg_customers(df: DataFrame) -> DataFrame:
    return _staged(df, "customers", "customer_key", current_only=True)


def stg_products(df: DataFrame) -> DataFrame:
    return _staged(df, "products", "product_key", current_only=True)


def stg_stores(df: DataFrame) -> DataFrame:
    return _staged(df, "stores", "store_key", current_only=True)


def stg_sales(df: DataFrame) -> DataFrame:
    return _staged(df, "sales", "sale_key", current_only=False)


def stg_inventory(df: DataFrame) -> DataFrame:
    return _staged(df, "inventory", "inventory_key", current_only=False)


def stg_marketing_spend(df: DataFrame) -> DataFrame:
    return _staged(df, "marketing", "spend_key", current_only=False)
