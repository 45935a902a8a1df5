"""Customer segments by recency, frequency and spend, and what is derived from them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise import model
from tillwise.functions.columns import gbp, percent, ratio
from tillwise.functions.ranking import with_scores
from tillwise.functions.scale import stage


def segment(r: str = "r_score", f: str = "f_score", m: str = "m_score") -> Column:
    """First rule of the table that the three scores satisfy."""
    def match(ranges) -> str:
        return " AND ".join(f"{c} BETWEEN {low} AND {high}" for c, (low, high) in zip((r, f, m), ranges))

    rules = " ".join(f"WHEN {match(ranges)} THEN '{name}'" for name, *ranges in model.SEGMENT_RULES)
    return F.expr(f"CASE {rules} ELSE '{model.OTHER_SEGMENT}' END")


def segment_priority(name: str = "rfm_segment") -> Column:
    cases = " ".join(f"WHEN '{label}' THEN {p}" for label, p in model.SEGMENT_PRIORITY.items())
    return F.expr(f"CAST(CASE {name} {cases} ELSE {model.SEGMENT_PRIORITY[model.OTHER_SEGMENT]} END AS BIGINT)")


def score(metrics: DataFrame, method: str = "ntile", recency: str = "best_high") -> DataFrame:
    """Add r, f, m scores of 1 to 5, their sum, the segment and its priority.

    `ntile` makes groups whose sizes differ by at most one; `qcut` cuts the ranks at their
    interpolated quantiles. Equal values are ordered by customer id; a missing value counts as the
    lowest. `recency="literal"` numbers the most recent customers 1.

    The metrics are written once to the shared folder: ranks and rows must come from one run.
    """
    staged = stage(metrics, "rfm-metrics")
    days = F.col("days_since_last_purchase")
    recent = -days if method == "ntile" else days
    scored = with_scores(
        staged, "customer_id", {"r_score": recent, "f_score": F.col("purchase_frequency"), "m_score": F.col("total_revenue_pence")}, method
    )
    if method == "qcut" or recency == "literal":
        scored = scored.withColumn("r_score", F.lit(6) - F.col("r_score"))
    return scored.withColumns(
        {"r_score": F.col("r_score").cast("bigint"), "rfm_total_score": F.col("r_score") + F.col("f_score") + F.col("m_score"),
         "rfm_segment": segment()}
    ).withColumn("segment_priority", segment_priority())


def mart_customer_rfm(customer_orders: DataFrame, recency: str = "best_high") -> DataFrame:
    scored = score(customer_orders, "ntile", recency)
    return scored.select(
        "customer_id", "customer_region", "loyalty_tier", "acquisition_channel", "top_category", "first_purchase_date",
        "last_purchase_date", "days_since_last_purchase", "purchase_frequency", "total_orders", "total_revenue_gbp",
        "avg_order_value_gbp", "total_profit_gbp", "customer_age_days", "online_orders", "instore_orders",
        percent("online_orders", "total_orders", 1).alias("online_pct"),
        percent("instore_orders", "total_orders", 1).alias("instore_pct"),
        "r_score", "f_score", "m_score", "rfm_total_score", "rfm_segment", "segment_priority", "total_revenue_pence",
    )


# --- the stand-alone segmentation job -------------------------------------------------------

def load_sales(lines: DataFrame, orders: DataFrame) -> DataFrame:
    cols = ["order_id", "customer_id", "order_date"] + (["store_id"] if "store_id" in orders.columns and "store_id" not in lines.columns else [])
    return lines.join(orders.select(*cols), "order_id")


def rfm_metrics(sales: DataFrame, as_of: date) -> DataFrame:
    """Recency, frequency and value per customer; lines not known to be returned count.

    Lines without customer belong to nobody and are left out; missing revenue adds nothing.

    Aggregated per order and per day first, which counts distinct orders and dates without
    repeating rows. After the line-order join the first step needs no shuffle.
    """
    kept = sales.filter(~F.col("is_returned").eqNullSafe(F.lit(True)) & F.col("customer_id").isNotNull())
    per_order = kept.groupBy("customer_id", "order_date", "order_id").agg(
        F.sum("net_revenue_pence").alias("revenue"), F.count("net_revenue_pence").alias("lines")
    )
    per_day = per_order.groupBy("customer_id", "order_date").agg(
        F.sum("revenue").alias("revenue"), F.sum("lines").alias("lines"), F.count("order_id").alias("orders")
    )
    day = F.lit(as_of).cast("date")
    return per_day.groupBy("customer_id").agg(
        F.max("order_date").alias("last_purchase_date"),
        F.min("order_date").alias("first_purchase_date"),
        F.count("order_date").alias("purchase_frequency"),
        F.sum("orders").cast("bigint").alias("total_orders"),
        F.coalesce(F.sum("revenue"), F.lit(0)).cast("bigint").alias("total_revenue_pence"),
        F.sum("lines").alias("_lines"),
    ).select(
        "customer_id", "last_purchase_date", "first_purchase_date", "purchase_frequency", "total_orders",
        gbp("total_revenue_pence").alias("total_revenue_gbp"),
        ratio("total_revenue_pence", "_lines * 100", 2).alias("avg_order_value_gbp"),
        F.datediff(day, "last_purchase_date").cast("bigint").alias("days_since_last_purchase"),
        F.datediff(day, "first_purchase_date").cast("bigint").alias("customer_age_days"),
        "total_revenue_pence",
    )


def attach_attributes(rfm: DataFrame, customers: DataFrame) -> DataFrame:
    who = customers.select(F.col("customer_id").alias("_who"), "region", "loyalty_tier", "acquisition_channel")
    return rfm.join(who, F.col("customer_id") == F.col("_who"), "left").drop("_who")


def calculate_rfm(lines: DataFrame, orders: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    return attach_attributes(score(rfm_metrics(load_sales(lines, orders), as_of), "qcut"), customers)


# --- summaries of a scored table ------------------------------------------------------------

def _with_total(per_segment: DataFrame) -> DataFrame:
    """Add the number of all customers; there is one row per segment, so the total is one row too."""
    total = per_segment.agg(F.sum("customers").alias("_all"))
    return per_segment.crossJoin(F.broadcast(total))


def segment_summary(rfm: DataFrame) -> DataFrame:
    n = F.col("customers")
    per_segment = rfm.groupBy("rfm_segment").agg(
        F.count("customer_id").alias("customers"), F.sum("total_revenue_pence").alias("revenue"),
        F.sum("total_orders").alias("orders"), F.sum("days_since_last_purchase").alias("days"),
    )
    return _with_total(per_segment).select(
        "rfm_segment", n, percent(n, F.col("_all"), 1).alias("pct_of_base"), gbp("revenue").alias("total_revenue"),
        ratio(F.col("revenue"), n * 100, 2).alias("avg_ltv"), ratio(F.col("orders"), n, 2).alias("avg_orders"),
        ratio(F.col("days"), n, 2).alias("avg_days_since"),
    ).orderBy(F.desc("total_revenue"))


def rfm_heatmap(rfm: DataFrame) -> DataFrame:
    """Mean revenue per recency score (rows) and frequency score (columns), in whole pounds."""
    cells = rfm.groupBy("r_score", "f_score").agg(
        ratio(F.sum("total_revenue_pence"), F.count(F.lit(1)) * 100, 0).alias("mean")
    )
    wide = cells.groupBy("r_score").pivot("f_score", [1, 2, 3, 4, 5]).agg(F.first("mean"))
    return wide.select("r_score", *[F.col(str(f)).alias(f"f{f}") for f in range(1, 6)])


def segment_counts(rfm: DataFrame) -> DataFrame:
    """Size, revenue, share of all revenue and mean order value per segment."""
    per_segment = rfm.groupBy("rfm_segment").agg(
        F.count("customer_id").alias("customers"), F.sum("total_revenue_pence").alias("revenue"),
        F.sum(F.round(F.col("avg_order_value_gbp") * 100).cast("bigint")).alias("aov"),
    )
    total = per_segment.agg(F.sum("revenue").alias("_all"))
    return per_segment.crossJoin(F.broadcast(total)).select(
        "rfm_segment", "customers", gbp("revenue").alias("revenue_gbp"),
        percent("revenue", "_all", 1).alias("revenue_share_pct"),
        ratio("aov", "customers * 100", 2).alias("avg_aov_gbp"),
    )


def update_customers(customers: DataFrame, rfm: DataFrame) -> DataFrame:
    """Write scores, segment and lifetime value into the customer dimension."""
    new = rfm.select(
        F.col("customer_id").alias("_who"), "r_score", "f_score", "m_score", F.col("rfm_segment").alias("_segment"),
        "total_revenue_gbp",
    )
    joined = customers.join(new, F.col("customer_id") == F.col("_who"), "left")
    return joined.withColumns(
        {
            "rfm_recency_score": F.coalesce("r_score", "rfm_recency_score"),
            "rfm_frequency_score": F.coalesce("f_score", "rfm_frequency_score"),
            "rfm_monetary_score": F.coalesce("m_score", "rfm_monetary_score"),
            "rfm_segment": F.coalesce("_segment", "rfm_segment"),
            "customer_ltv_gbp": F.coalesce("total_revenue_gbp", "customer_ltv_gbp"),
        }
    ).select(*customers.columns)


def segment_distribution(customers: DataFrame) -> DataFrame:
    """Segment sizes and lifetime value over the current customers that have a segment."""
    ltv = F.round(F.col("customer_ltv_gbp") * 100).cast("bigint")
    per_segment = customers.filter(F.col("is_current") & F.col("rfm_segment").isNotNull()).groupBy("rfm_segment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum(ltv).alias("ltv"), F.count(ltv).alias("known")
    )
    return _with_total(per_segment).select(
        "rfm_segment", F.col("customers").alias("customer_count"),
        percent("customers", "_all", 1).alias("pct_of_base"),
        ratio("ltv", "known * 100", 2).alias("avg_ltv_gbp"), gbp("ltv").alias("total_ltv_gbp"),
    ).orderBy(F.desc("total_ltv_gbp"))


# --- history, migration, value --------------------------------------------------------------

def segment_migration(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Customers per move between segments; NONE stands for not yet or no longer scored."""
    before = previous.select(F.col("customer_id").alias("_who"), F.col("rfm_segment").alias("_from"))
    joined = current.select("customer_id", "rfm_segment").join(before, F.col("customer_id") == F.col("_who"), "full_outer")
    return joined.groupBy(
        F.coalesce("_from", F.lit("NONE")).alias("from_segment"), F.coalesce("rfm_segment", F.lit("NONE")).alias("to_segment")
    ).agg(F.count(F.lit(1)).alias("customers"))


def moved_to(previous: DataFrame, current: DataFrame, segment_name: str) -> DataFrame:
    """Customers that are in a segment now and were in another one before."""
    before = previous.select(F.col("customer_id").alias("_who"), F.col("rfm_segment").alias("from_segment"))
    return (
        current.filter(F.col("rfm_segment") == segment_name)
        .join(before.filter(F.col("from_segment") != segment_name), F.col("customer_id") == F.col("_who"))
        .select("customer_id", "from_segment", "days_since_last_purchase", F.col("total_revenue_gbp").alias("ltv_gbp"))
    )


def append_history(rfm: DataFrame, run_date: date, path: str) -> None:
    """Keep the segments of a run; writing the same run again replaces only that run."""
    rfm.withColumn("run_date", F.lit(run_date)).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("run_date").parquet(path)


def segment_by_acquisition(rfm: DataFrame) -> DataFrame:
    """Segment by the channel that brought the customer: size and value."""
    return rfm.groupBy("rfm_segment", "acquisition_channel").agg(
        F.count(F.lit(1)).alias("customers"), gbp(F.sum("total_revenue_pence")).alias("revenue_gbp")
    )


def first_last_channel(orders: DataFrame) -> DataFrame:
    """Channel of each customer's first and most recent order."""
    place = F.struct("order_date", "order_id")
    return orders.groupBy("customer_id").agg(
        F.min_by("channel", place).alias("first_channel"), F.max_by("channel", place).alias("last_channel")
    )


def segment_by_channel(rfm: DataFrame, orders: DataFrame) -> DataFrame:
    """Segment by sales channel: customers whose first, and whose latest, order came through it."""
    channels = first_last_channel(orders).withColumnRenamed("customer_id", "_who")
    joined = rfm.select("customer_id", "rfm_segment").join(channels, F.col("customer_id") == F.col("_who"))
    sides = F.array(
        F.struct(F.col("first_channel").alias("channel"), F.lit(1).alias("first"), F.lit(0).alias("last")),
        F.struct(F.col("last_channel").alias("channel"), F.lit(0).alias("first"), F.lit(1).alias("last")),
    )
    return joined.select("rfm_segment", F.inline(sides)).groupBy("rfm_segment", "channel").agg(
        F.sum("first").cast("bigint").alias("first_purchase_customers"), F.sum("last").cast("bigint").alias("last_purchase_customers")
    )


def customer_clv(metrics: DataFrame) -> DataFrame:
    """Lifetime value so far: net revenue of lines not returned."""
    return metrics.select("customer_id", F.col("total_revenue_gbp").alias("clv_gbp"), "total_orders", "avg_order_value_gbp")


def churn_risk(metrics: DataFrame) -> DataFrame:
    """Days since the last purchase over the mean gap between purchase days; null after a single day.

    The requirement gives no formula. The gaps of a customer add up to last minus first day, so
    their mean needs no window over the purchases.
    """
    span = F.datediff("last_purchase_date", "first_purchase_date").cast("bigint")
    gaps = F.col("purchase_frequency") - 1
    return metrics.select(
        "customer_id", "days_since_last_purchase", ratio(span, gaps, 2).alias("mean_gap_days"),
        ratio(F.col("days_since_last_purchase") * gaps, span, 3).alias("churn_score"),
    )


def export_segment(rfm: DataFrame, customers: DataFrame, name: str) -> DataFrame:
    """Members of a segment for the CRM, with masked e-mail."""
    who = customers.select(F.col("customer_id").alias("_who"), "email_masked")
    return rfm.filter(F.col("rfm_segment") == name).join(who, F.col("customer_id") == F.col("_who"), "left").select(
        "customer_id", "email_masked", F.col("rfm_segment").alias("segment"), "last_purchase_date",
        F.col("total_revenue_gbp").alias("ltv_gbp"),
    )
