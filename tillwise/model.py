"""Table schemas and fixed values of the retail model."""

from __future__ import annotations

from pyspark.sql import types as T

S, L, D, B, DBL, TS = (
    T.StringType(), T.LongType(), T.DateType(), T.BooleanType(), T.DoubleType(), T.TimestampType(),
)


def schema(**columns: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in columns.items()])


# --- raw inputs: one schema per landed file -------------------------------------------------

RAW = {
    "customers": schema(
        customer_id=S, email_masked=S, age_band=S, gender=S, city=S, region=S, postcode_district=S,
        acquisition_channel=S, acquisition_date=D, loyalty_tier=S,
    ),
    "products": schema(
        product_id=S, product_name=S, category=S, subcategory=S, brand=S, supplier_id=S,
        cost_price_pence=L, rrp_pence=L, is_active=B, launch_date=D,
    ),
    "stores": schema(
        store_id=S, store_name=S, store_type=S, city=S, region=S, postcode=S, opening_date=D, is_active=B,
    ),
    # order_date stays text: the date check decides which values are dates.
    "orders": schema(
        order_id=S, customer_id=S, store_id=S, order_date=S, channel=S, campaign_id=S,
        order_total_pence=L, source_system=S,
    ),
    "order_lines": schema(
        order_line_id=S, order_id=S, product_id=S, units_sold=L, gross_revenue_pence=L, discount_pence=L,
        net_revenue_pence=L, cost_of_goods_pence=L, gross_profit_pence=L, is_returned=B, return_date=D,
    ),
    "inventory": schema(
        snapshot_date=D, product_id=S, store_id=S, stock_on_hand=L, units_received=L, units_sold=L,
        units_returned=L, reorder_point=L, reorder_quantity=L, stock_status=S, days_of_stock_remaining=DBL,
        source_system=S,
    ),
    "marketing": schema(
        campaign_id=S, channel=S, date=D, spend_pence=L, impressions=L, clicks=L, attributed_orders=L,
        attributed_revenue_pence=L, source_system=S,
    ),
}

RAW_FILES = {
    "customers": "customers.csv", "products": "products.csv", "stores": "stores.csv",
    "orders": "orders.csv", "order_lines": "order_lines.csv", "inventory": "inventory.csv",
    "marketing": "marketing_spend.csv",
}

RUN_LOG = schema(
    run_id=S, run_date=D, source_system=S, records_extracted=L, records_loaded=L, records_quarantined=L,
    status=S, error_message=S, started_at=TS, completed_at=TS, duration_seconds=L,
)

# --- fixed values ---------------------------------------------------------------------------

# Sales channel keys; a channel not listed gets UNKNOWN_CHANNEL_KEY.
CHANNEL_KEYS = {"Online": 1, "In-Store": 2, "App": 3, "Wholesale": 4}
UNKNOWN_CHANNEL_KEY = 99
CHANNEL_TYPES = {"Online": "Digital", "In-Store": "Physical", "App": "Digital", "Wholesale": "Physical"}

# Marketing channels that share the credit for a purchase.
TOUCH_CHANNELS = ("Paid Search", "Paid Social", "Email", "Organic Search", "Direct")

# Segment rules in order, first match wins: (segment, lowest and highest r, f, m score).
SEGMENT_RULES = (
    ("Champions", (4, 5), (4, 5), (4, 5)),
    ("Loyal Customers", (3, 5), (3, 5), (3, 5)),
    ("New Customers", (4, 5), (1, 2), (1, 5)),
    ("Potential Loyalists", (3, 5), (2, 5), (2, 5)),
    ("At Risk", (1, 2), (3, 5), (3, 5)),
    ("Needs Attention", (1, 2), (2, 5), (1, 5)),
    ("Lost", (1, 1), (1, 2), (1, 5)),
)
OTHER_SEGMENT = "Others"
SEGMENT_PRIORITY = {
    "Champions": 1, "Loyal Customers": 2, "Potential Loyalists": 3, "New Customers": 4,
    "Needs Attention": 5, "At Risk": 6, "Lost": 7, "Others": 8,
}

STOCK_STATUSES = ("RED", "AMBER", "GREEN")
LOYALTY_TIERS = ("Bronze", "Silver", "Gold", "Platinum")

# United Kingdom public holidays; the effect of each lasts until HOLIDAY_DAYS_AFTER days later.
UK_HOLIDAYS = (
    ("New Year", "2022-01-01"), ("New Year", "2023-01-02"),
    ("Good Friday", "2022-04-15"), ("Good Friday", "2023-04-07"),
    ("Easter Monday", "2022-04-18"), ("Easter Monday", "2023-04-10"),
    ("Early May Bank", "2022-05-02"), ("Early May Bank", "2023-05-01"),
    ("Spring Bank", "2022-06-02"), ("Spring Bank", "2023-05-29"),
    ("Summer Bank", "2022-08-29"), ("Summer Bank", "2023-08-28"),
    ("Christmas Day", "2022-12-25"), ("Christmas Day", "2023-12-25"),
    ("Boxing Day", "2022-12-26"), ("Boxing Day", "2023-12-26"),
)
HOLIDAY_DAYS_AFTER = 1

# Promotional periods as first and last MMDD of each year (our choice; the default of the model is none).
PROMO_PERIODS = ((1124, 1130), (1226, 1231))

HOME_COUNTRY = "United Kingdom"

# Columns of the sales fact, in order.
FACT_SALES_COLUMNS = (
    "sale_key", "order_id", "order_line_id", "date_key", "customer_key", "product_key", "store_key",
    "channel_key", "campaign_key", "units_sold", "gross_revenue_pence", "discount_pence",
    "net_revenue_pence", "cost_of_goods_pence", "gross_profit_pence", "is_returned", "return_date",
    "return_date_key", "source_system", "pipeline_run_id", "created_at", "updated_at",
)
