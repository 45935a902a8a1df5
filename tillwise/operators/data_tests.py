"""Declarative table tests, evaluated together in one aggregate per table, and the publishing gate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillwise.functions.scale import scratch_path


@dataclass(frozen=True)
class Test:
    """One test of one column; `failures` counts the rows that break it."""

    kind: str
    column: str
    values: tuple = field(default=())

    @property
    def name(self) -> str:
        return f"{self.kind}:{self.column}"


def not_null(column: str) -> Test:
    return Test("not_null", column)


def unique(*columns: str) -> Test:
    return Test("unique", ",".join(columns))


def accepted_values(column: str, values: Sequence) -> Test:
    return Test("accepted_values", column, tuple(values))


def _row_failures(test: Test) -> Column:
    c = F.col(test.column)
    if test.kind == "not_null":
        return F.count_if(c.isNull())
    return F.count_if(~c.isin(*test.values))  # null passes


def run_tests(df: DataFrame, table: str, tests: Sequence[Test]) -> DataFrame:
    """One row per test: table, test, failures.

    Row tests share a single aggregate; each uniqueness test counts keys that occur more than once.
    """
    parts = []
    by_row = [t for t in tests if t.kind != "unique"]
    if by_row:
        agg = df.agg(*[_row_failures(t).alias(f"t{i}") for i, t in enumerate(by_row)])
        pairs = F.array(*[F.struct(F.lit(t.name).alias("test"), F.col(f"t{i}").alias("failures")) for i, t in enumerate(by_row)])
        parts.append(agg.select(F.inline(pairs)))
    for t in (t for t in tests if t.kind == "unique"):
        keys = t.column.split(",")
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        repeated = df.filter(known).groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        parts.append(repeated.agg(F.count(F.lit(1)).alias("failures")).select(F.lit(t.name).alias("test"), "failures"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(F.lit(table).alias("table_name"), "test", F.col("failures").cast("bigint").alias("failures"))


def assert_revenue_positive(sales: DataFrame) -> DataFrame:
    """Lines that were not returned and yet have negative revenue."""
    return sales.filter((F.col("net_revenue_gbp") < 0) & ~F.col("is_returned")).select(
        "sale_key", "order_id", "net_revenue_gbp"
    )


def assert_rfm_covers(customer_orders: DataFrame, rfm: DataFrame) -> DataFrame:
    """Purchasing customers without a segment."""
    buyers = customer_orders.filter(F.col("total_orders") > 0).select("customer_id").distinct()
    scored = rfm.select(F.col("customer_id").alias("_scored")).distinct()
    return buyers.join(scored, F.col("customer_id") == F.col("_scored"), "left_anti")


class GateClosed(Exception):
    """The new version of a table failed its tests and was not published."""


def gate(df: DataFrame, table: str, tests: Sequence[Test], publish) -> DataFrame:
    """Stage `df`, test the staged rows, and publish them only if every test passes.

    `publish` is called with the staged frame. Returns the test results; raises GateClosed,
    leaving the published version as it is, when a test fails.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"gate-{table}")
    df.write.parquet(path)
    staged = spark.read.schema(df.schema).parquet(path)
    results = run_tests(staged, table, tests)
    broken = [(r["test"], r["failures"]) for r in results.collect() if r["failures"]]
    if broken:
        raise GateClosed(f"{table}: {broken}")
    publish(staged)
    return results


def reject_rate_gate(report: DataFrame, max_pct: float = 5.0) -> DataFrame:
    """Whether each source may be published: keep the previous version above the allowed reject rate."""
    return report.withColumn(
        "action", F.when(F.col("quarantine_rate_pct") > max_pct, "KEEP_PREVIOUS").otherwise("PUBLISH")
    )
