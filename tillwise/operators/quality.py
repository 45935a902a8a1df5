"""Validation, quarantine and data-quality measures.

Every check reads the rows once: a chain of conditions names the first check a row fails.
Rejected rows are kept with their reason.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.columns import percent
from tillwise.functions.scale import mark_first

FAILED = "failed_check"

ORDER_KEYS = ("order_id", "customer_id", "store_id", "order_date")
LINE_KEYS = ("order_line_id", "order_id", "product_id")

# Reason per kind of check.
REASONS = {
    "null_check": "NULL_PRIMARY_KEY",
    "duplicate_check": "DUPLICATE_RECORD",
    "range_check": "INVALID_RANGE",
    "date_check": "INVALID_DATE",
    "ref_integrity:order_id": "ORPHAN_RECORD",
    "ref_integrity:product_id": "UNKNOWN_PRODUCT",
    "ref_integrity:customer_id": "UNKNOWN_CUSTOMER",
}


def failure_reason(check: Column) -> Column:
    """Reason that belongs to a `kind:field` check name."""
    out = F.lit(None).cast("string")
    for prefix, reason in REASONS.items():
        out = F.when(check.startswith(prefix), F.lit(reason)).otherwise(out)
    return out


def first_failure(checks: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first check whose condition says the row is bad, else null."""
    out = F.lit(None).cast("string")
    for name, bad in reversed(checks):
        out = F.when(bad, F.lit(name)).otherwise(out)
    return out


def null_checks(df: DataFrame, fields: Sequence[str]) -> list[tuple[str, Column]]:
    return [(f"null_check:{f}", F.col(f).isNull()) for f in fields if f in df.columns]


def null_check(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    return df.withColumn(FAILED, first_failure(null_checks(df, fields)))


def range_bad(col: str, low: int | None = None, high: int | None = None, open_low: bool = False) -> Column:
    """True outside the range; a missing measure is out of range too."""
    bad = F.col(col).isNull()
    if low is not None:
        bad = bad | (F.col(col) <= low if open_low else F.col(col) < low)
    if high is not None:
        bad = bad | (F.col(col) > high)
    return bad


def range_check(df: DataFrame, col: str, low: int | None = None, high: int | None = None, open_low: bool = False) -> DataFrame:
    checks = [(f"range_check:{col}", range_bad(col, low, high, open_low))] if col in df.columns else []
    return df.withColumn(FAILED, first_failure(checks))


def as_date(col: str) -> Column:
    """The date, or null where the text is not one. Real dates pass through."""
    return F.col(col).try_cast("date")


def date_check(df: DataFrame, col: str) -> DataFrame:
    return df.withColumn(FAILED, first_failure([(f"date_check:{col}", as_date(col).isNull())]))


def duplicate_check(df: DataFrame, key: str) -> DataFrame:
    """Mark all rows but one per key. The first row in the order of all columns stays."""
    marked = mark_first(df, [key], df.columns, "_first")
    return marked.withColumn(FAILED, F.when(~F.col("_first"), F.lit(f"duplicate_check:{key}"))).drop("_first")


def ref_integrity(df: DataFrame, col: str, ref: DataFrame, name: str | None = None) -> DataFrame:
    """Mark rows whose `col` is absent from the reference table.

    The reference is reduced to its distinct keys, so the join adds no rows. Spark broadcasts
    the keys when their measured size allows it and splits hot keys otherwise.
    """
    keys = ref.select(F.col(col).alias("_key")).filter(F.col("_key").isNotNull()).distinct()
    return (
        df.join(keys, F.col(col) == F.col("_key"), "left")
        .withColumn(FAILED, F.when(F.col("_key").isNull(), F.lit(name or f"ref_integrity:{col}")))
        .drop("_key")
    )


def quarantine(failed: DataFrame, run_id: str, source: str) -> DataFrame:
    """Rejected rows in the quarantine layout; the original row is kept as JSON with its nulls."""
    raw = [c for c in failed.columns if c != FAILED]
    return failed.select(
        F.uuid().alias("quarantine_id"),
        F.lit(run_id).alias("run_id"),
        F.lit(source).alias("source_system"),
        F.to_json(F.struct(*raw), {"ignoreNullFields": "false"}).alias("record_raw"),
        failure_reason(F.col(FAILED)).alias("failure_reason"),
        F.col(FAILED),
        F.current_timestamp().alias("quarantined_at"),
    )


def check_orders(df: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Orders with the first failed check: missing keys, duplicates, total, date, customer, in this order.

    The customer is checked where the customers are given.
    """
    columns = df.columns
    missing = df.withColumn("_missing", first_failure(null_checks(df, ORDER_KEYS)))
    complete = missing.filter(F.col("_missing").isNull()).drop("_missing")
    kept = mark_first(complete, ["order_id"], columns, "_first")
    checks = [("duplicate_check:order_id", ~F.col("_first"))]
    if "order_total_pence" in columns:
        checks.append(("range_check:order_total_pence", range_bad("order_total_pence", 0, open_low=True)))
    checks.append(("date_check:order_date", as_date("order_date").isNull()))
    # Incomplete rows never meet a shuffle: a hot null key cannot gather in one task.
    incomplete = missing.filter(F.col("_missing").isNotNull()).withColumnRenamed("_missing", FAILED)
    if customers is not None:
        known = customers.select(F.col("customer_id").alias("_known")).filter(F.col("_known").isNotNull()).distinct()
        kept = kept.join(known, F.col("customer_id") == F.col("_known"), "left")
        checks.append(("ref_integrity:customer_id", F.col("_known").isNull()))
    return kept.withColumn(FAILED, first_failure(checks)).select(*columns, FAILED).unionByName(incomplete)


def check_order_lines(df: DataFrame, orders: DataFrame, products: DataFrame) -> DataFrame:
    """Order lines with the first failed check: missing keys, order, product, units."""
    known_orders = orders.select(F.col("order_id").alias("_order")).filter(F.col("_order").isNotNull()).distinct()
    known_products = (
        products.select(F.col("product_id").alias("_product")).filter(F.col("_product").isNotNull()).distinct()
    )
    joined = df.join(known_orders, F.col("order_id") == F.col("_order"), "left").join(
        known_products, F.col("product_id") == F.col("_product"), "left"
    )
    checks = null_checks(df, LINE_KEYS) + [
        ("ref_integrity:order_id", F.col("_order").isNull()),
        ("ref_integrity:product_id", F.col("_product").isNull()),
    ]
    if "units_sold" in df.columns:
        checks.append(("range_check:units_sold", range_bad("units_sold", 1)))
    return joined.withColumn(FAILED, first_failure(checks)).drop("_order", "_product")


def clean(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(FAILED).isNull()).drop(FAILED)


def clean_orders(checked: DataFrame) -> DataFrame:
    """Accepted orders, with the order date as a date."""
    return clean(checked).withColumn("order_date", as_date("order_date"))


def failed(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col(FAILED).isNotNull())


def dq_report(checked: DataFrame, source: str) -> DataFrame:
    """One row of counts and the rejected share in percent (0 for an empty input)."""
    n, bad = F.count(F.lit(1)), F.count(FAILED)
    return checked.agg(
        F.lit(source).alias("source"),
        n.alias("records_input"),
        (n - bad).alias("records_clean"),
        bad.alias("records_quarantined"),
        F.coalesce(percent(bad, n, 2), F.lit(0.0)).alias("quarantine_rate_pct"),
    )


def validate_orders(df: DataFrame, run_id: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(clean, quarantine, report) of an orders frame."""
    checked = check_orders(df)
    return clean_orders(checked), quarantine(failed(checked), run_id, "POS"), dq_report(checked, "orders")


def validate_order_lines(
    df: DataFrame, orders: DataFrame, products: DataFrame, run_id: str
) -> tuple[DataFrame, DataFrame, DataFrame]:
    checked = check_order_lines(df, orders, products)
    return clean(checked), quarantine(failed(checked), run_id, "POS"), dq_report(checked, "order_lines")


# --- requirements beyond the four checks ----------------------------------------------------

def dedupe_latest(df: DataFrame, keys: Sequence[str], newest: Sequence[str]) -> DataFrame:
    """One row per composite key, that with the greatest `newest` columns, then the greatest of the others.

    Missing values are the smallest. A maximum per key combines before the shuffle, so hot keys cost nothing.
    """
    ranked = [*newest, *[c for c in df.columns if c not in newest and c not in keys]]
    best = df.groupBy(*keys).agg(F.max(F.struct(*ranked)).alias("_best"))
    return best.select(*[F.col(c) if c in keys else F.col("_best")[c].alias(c) for c in df.columns])


def fill_missing(
    df: DataFrame, zero: Sequence[str] = (), mean: Sequence[str] = (), text: Sequence[str] = (), dates: Sequence[str] = ()
) -> DataFrame:
    """Missing numbers become 0 or the column mean, text becomes UNKNOWN, dates are flagged."""
    if mean:
        means = df.agg(*[F.avg(c).alias(f"_mean_{c}") for c in mean])
        df = df.crossJoin(F.broadcast(means))  # one row
    out = {c: F.coalesce(F.col(c), F.lit(0)) for c in zero}
    out |= {c: F.coalesce(F.col(c).cast("double"), F.col(f"_mean_{c}")) for c in mean}
    out |= {c: F.coalesce(F.col(c), F.lit("UNKNOWN")) for c in text}
    if dates:
        missing = F.lit(False)
        for c in dates:
            missing = missing | F.col(c).isNull()
        out["date_missing"] = missing
    return df.withColumns(out).drop(*[f"_mean_{c}" for c in mean])


def order_value_ceiling(orders: DataFrame, ceiling_pence: int = 5_000_000) -> DataFrame:
    """Flag orders of 50,000 pounds or more for review; nothing is rejected."""
    return orders.withColumn("needs_review", F.col("order_total_pence") >= ceiling_pence)


def unknown_customers(orders: DataFrame, customers: DataFrame) -> DataFrame:
    return orders.join(customers.select("customer_id").distinct(), "customer_id", "left_anti")


def freshness_check(df: DataFrame, ts: str, source: str, as_of: datetime, hours: int = 26) -> DataFrame:
    """Age of the newest row and whether it is older than allowed (an empty source is stale)."""
    newest = F.max(F.col(ts).cast("timestamp_ntz"))
    age = F.timestamp_diff("SECOND", newest, F.lit(as_of).cast("timestamp_ntz"))
    return df.agg(
        F.lit(source).alias("source"),
        age.cast("bigint").alias("age_seconds"),
        F.coalesce(age > hours * 3600, F.lit(True)).alias("is_stale"),
    )


def volume_check(daily: DataFrame, group: Sequence[str], day: str, count: str, tolerance_pct: int = 20) -> DataFrame:
    """Compare each day's row count with the mean over the seven days before it.

    Days without rows are left out of the mean, which then covers fewer days, but never older ones; `day` is a
    date or a day number. `daily` has one row per group and day, so a window holds at most the days of the calendar.
    """
    number = F.unix_date(day) if daily.schema[day].dataType == T.DateType() else F.col(day)
    before = Window.partitionBy(*group).orderBy(number).rangeBetween(-7, -1)
    total, days = F.sum(count).over(before), F.count(count).over(before)
    # |count - total/days| > tolerance * total/days, in integers
    off = F.abs(F.col(count) * days - total) * 100 > total * tolerance_pct
    return daily.select(
        *group, day, count, total.alias("prior_total"), days.alias("prior_days"),
        F.coalesce(off, F.lit(False)).alias("is_outside"),
    )


def quality_dashboard(run_log: DataFrame, tests: DataFrame, tables: Mapping[str, tuple[DataFrame, str]], as_of: datetime) -> DataFrame:
    """Run counts, tests passed and failed, and hours since the last load of each table."""
    runs = run_log.groupBy(F.lit("run").alias("kind"), F.col("status").alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("records_extracted").cast("double").alias("value")
    )
    results = tests.groupBy(F.lit("test").alias("kind"), F.when(F.col("failures") == 0, "passed").otherwise("failed").alias("name")).agg(
        F.count(F.lit(1)).alias("n"), F.sum("failures").cast("double").alias("value")
    )
    out = runs.unionByName(results)
    for name, (df, ts) in tables.items():
        fresh = freshness_check(df, ts, name, as_of)
        out = out.unionByName(
            fresh.select(F.lit("freshness").alias("kind"), F.col("source").alias("name"), F.lit(1).cast("bigint").alias("n"),
                         (F.col("age_seconds") / 3600.0).alias("value"))
        )
    return out
