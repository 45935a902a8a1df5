"""The generated test tables seen as the raw retail inputs.

Attributes the tables lack follow fixed integer rules, so any engine derives the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The tables that grow.
TABLES = ("customer", "supplier", "part", "orders", "lineitem", "events")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pence(pounds: str) -> str:
    return f"CAST(round({pounds} * 100) AS BIGINT)"


def _choice(value: str, *names: str) -> str:
    """SQL for names[i] where value = i; the last name for anything else."""
    cases = " ".join(f"WHEN {i} THEN '{name}'" for i, name in enumerate(names[:-1]))
    return f"CASE {value} {cases} ELSE '{names[-1]}' END"


def _places(spark: SparkSession, folder: str) -> DataFrame:
    nation, region = table(spark, folder, "nation"), table(spark, folder, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def raw_customers(spark: SparkSession, folder: str) -> DataFrame:
    customer = table(spark, folder, "customer")
    return customer.join(_places(spark, folder), F.col("c_nationkey") == F.col("n_nationkey")).selectExpr(
        "concat('CUS-', c_custkey) AS customer_id",
        "concat('user', c_custkey, '@example.com') AS email",
        _choice("c_custkey % 6", "18-24", "25-34", "35-44", "45-54", "55-64", "65+") + " AS age_band",
        _choice("c_custkey % 4", "female", "MALE", " non-binary ", "prefer not to say") + " AS gender",
        "n_name AS city",
        "r_name AS region",
        "c_mktsegment AS acquisition_channel",
        "date_add(DATE'1995-01-01', CAST(c_custkey % 2400 AS INT)) AS acquisition_date",
        "CASE WHEN c_acctbal < 3000 THEN 'bronze' WHEN c_acctbal < 6500 THEN 'silver' "
        "WHEN c_acctbal < 9000 THEN 'gold' ELSE 'platinum' END AS loyalty_tier",
    )


def raw_products(spark: SparkSession, folder: str) -> DataFrame:
    rrp = _pence("p_retailprice")
    return table(spark, folder, "part").selectExpr(
        "concat('SKU-', p_partkey) AS product_id",
        "p_name AS product_name",
        "p_type AS category",
        "p_brand AS subcategory",
        "p_brand AS brand",
        "concat('SUP-', p_partkey % 30) AS supplier_id",
        f"({rrp} * 40) div 100 AS cost_price_pence",
        f"{rrp} AS rrp_pence",
        "p_partkey % 20 <> 0 AS is_active",
        "date_add(DATE'1994-01-01', CAST(p_partkey % 365 AS INT)) AS launch_date",
    )


def raw_stores(spark: SparkSession, folder: str) -> DataFrame:
    supplier = table(spark, folder, "supplier")
    return supplier.join(_places(spark, folder), F.col("s_nationkey") == F.col("n_nationkey")).selectExpr(
        "concat('STR-', s_suppkey) AS store_id",
        "s_name AS store_name",
        "CASE WHEN s_suppkey % 5 = 0 THEN 'Online' ELSE 'Physical' END AS store_type",
        "n_name AS city",
        "r_name AS region",
        "CAST(NULL AS STRING) AS postcode",
        "date_add(DATE'1990-01-01', CAST(s_suppkey % 1500 AS INT)) AS opening_date",
        "true AS is_active",
    )


def raw_orders(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    return table(spark, folder, "orders").selectExpr(
        "concat('ORD-', o_orderkey) AS order_id",
        "concat('CUS-', o_custkey) AS customer_id",
        "CAST(o_orderdate AS DATE) AS order_date",
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'Online' WHEN '2-HIGH' THEN 'In-Store' WHEN '3-MEDIUM' THEN 'App' "
        "WHEN '5-LOW' THEN 'Wholesale' ELSE 'Kiosk' END AS channel",
        "CASE WHEN o_orderkey % 5 < 2 THEN concat('CAM-', o_orderkey % 100) END AS campaign_id",
        _pence("o_totalprice") + " AS order_total_pence",
        "'POS' AS source_system",
        *extra,
    )


def raw_order_lines(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    gross = _pence("l_extendedprice")
    discount = f"(({gross} * CAST(round(l_discount * 100) AS BIGINT)) div 100)"
    cost = f"(({gross} * (40 + l_partkey % 30)) div 100)"
    return table(spark, folder, "lineitem").selectExpr(
        "concat('ORD-', l_orderkey, '-', l_linenumber) AS order_line_id",
        "concat('ORD-', l_orderkey) AS order_id",
        "concat('SKU-', l_partkey) AS product_id",
        "concat('STR-', l_suppkey) AS store_id",
        "CAST(l_quantity AS BIGINT) AS units_sold",
        f"{gross} AS gross_revenue_pence",
        f"{discount} AS discount_pence",
        f"{gross} - {discount} AS net_revenue_pence",
        f"{cost} AS cost_of_goods_pence",
        f"{gross} - {discount} - {cost} AS gross_profit_pence",
        "l_returnflag = 'R' AS is_returned",
        "CASE WHEN l_returnflag = 'R' THEN CAST(l_shipdate AS DATE) END AS return_date",
        *extra,
    )


def raw_inventory(spark: SparkSession, folder: str) -> DataFrame:
    """Stock snapshots; status and days of stock are derived by the inventory operators."""
    return (
        table(spark, folder, "lineitem")
        .groupBy("l_partkey", "l_suppkey", F.expr("CAST(l_shipdate AS DATE)").alias("snapshot_date"))
        .agg(F.max("l_linenumber").alias("line"), F.expr("sum(CAST(l_quantity AS BIGINT))").alias("units"))
        .selectExpr(
            "snapshot_date",
            "concat('SKU-', l_partkey) AS product_id",
            "concat('STR-', l_suppkey) AS store_id",
            "CAST((l_partkey * 7 + l_suppkey * 13 + line * 29) % 201 AS BIGINT) AS stock_on_hand",
            "0L AS units_received",
            "units AS units_sold",
            "0L AS units_returned",
            "CAST(10 + l_partkey % 31 AS BIGINT) AS reorder_point",
            "CAST(3 * (10 + l_partkey % 31) AS BIGINT) AS reorder_quantity",
            "'WMS' AS source_system",
        )
    )


_K = "CAST(get_json_object(props, '$.k') AS BIGINT)"


def raw_marketing(spark: SparkSession, folder: str) -> DataFrame:
    keyed = table(spark, folder, "events").selectExpr(
        f"concat('CAM-', {_K}) AS campaign_id",
        _choice(f"{_K} % 3", "Paid Search", "Paid Social", "Email") + " AS channel",
        "CAST(ts AS DATE) AS date", "event_type", "value",
    )
    total = f"CAST(coalesce(sum({_pence('value')}) FILTER (WHERE event_type = '%s'), 0) AS BIGINT)"
    return (
        keyed.groupBy("campaign_id", "channel", "date")
        .agg(
            F.expr(total % "view").alias("spend_pence"),
            F.expr("count(*) * 20").alias("impressions"),
            F.expr("count_if(event_type = 'click')").alias("clicks"),
            F.expr("count_if(event_type = 'purchase')").alias("attributed_orders"),
            F.expr(total % "purchase").alias("attributed_revenue_pence"),
        )
        .withColumn("source_system", F.expr("upper(replace(channel, ' ', '_'))"))
    )


def raw_touches(spark: SparkSession, folder: str) -> DataFrame:
    channel = _choice(f"{_K} % 5", "Paid Search", "Paid Social", "Email", "Organic Search", "Direct")
    return table(spark, folder, "events").filter("event_type IN ('click', 'view')").selectExpr(
        "event_id AS touch_id", "concat('CUS-', user_id) AS customer_id", "ts", f"{channel} AS channel"
    )


def raw_conversions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").filter("event_type = 'purchase'").selectExpr(
        "event_id AS conversion_id", "concat('CUS-', user_id) AS customer_id", "ts", _pence("value") + " AS revenue_pence"
    )


# --- the same inputs with faults, for the validation checks ---------------------------------

def faulty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """All orders, some with missing or wrong values, some twice. order_date is text."""
    return (
        raw_orders(spark, folder, "o_orderkey AS k")
        .selectExpr(
            "CASE WHEN k % 97 <> 0 THEN order_id END AS order_id",
            "CASE WHEN k % 101 <> 0 THEN customer_id END AS customer_id",
            "CASE WHEN k % 103 <> 0 THEN concat('STR-', k % 100) END AS store_id",
            "CASE WHEN k % 73 = 0 THEN 'not-a-date' WHEN k % 109 <> 0 THEN date_format(order_date, 'yyyy-MM-dd') END AS order_date",
            "channel", "campaign_id",
            "CASE WHEN k % 83 = 0 THEN -500L WHEN k % 79 <> 0 THEN order_total_pence END AS order_total_pence",
            "source_system",
            "explode(sequence(1, CASE WHEN k % 89 = 0 THEN 2 ELSE 1 END)) AS copy",
        )
        .drop("copy")
    )


def faulty_order_lines(spark: SparkSession, folder: str) -> DataFrame:
    base = raw_order_lines(spark, folder, "l_orderkey AS ok", "l_partkey AS pk")
    changed = ("order_line_id", "order_id", "product_id", "units_sold", "ok", "pk")
    return base.selectExpr(
        "CASE WHEN ok % 107 <> 0 THEN order_line_id END AS order_line_id",
        "CASE WHEN ok % 71 = 0 THEN 'ORD-X' WHEN ok % 97 <> 0 THEN order_id END AS order_id",
        "CASE WHEN pk % 67 = 0 THEN 'SKU-X' WHEN pk % 113 <> 0 THEN product_id END AS product_id",
        "CASE WHEN pk % 61 = 0 THEN 0L ELSE units_sold END AS units_sold",
        *[c for c in base.columns if c not in changed],
    )


READERS = {
    "customers": raw_customers, "products": raw_products, "stores": raw_stores, "orders": raw_orders,
    "order_lines": raw_order_lines, "inventory": raw_inventory, "marketing": raw_marketing,
    "touches": raw_touches, "conversions": raw_conversions,
}


class Inputs:
    """The raw inputs of one folder. Each is planned when first asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        if name not in READERS:
            raise AttributeError(name)
        df = READERS[name](self.spark, self.folder)
        setattr(self, name, df)
        return df
