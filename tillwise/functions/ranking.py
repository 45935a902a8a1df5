"""Exact ranks and quantile scores without gathering a table in one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import null_safe_join, stage


def exact_ranks(df: DataFrame, id_col: str, metrics: Mapping[str, Column]) -> DataFrame:
    """(id, metric, rank, rows): the rank 1..rows of each row by (metric, id), for several metrics at once.

    Missing values come first. The values of all metrics are range-partitioned and sorted by (metric,
    value, id), so a value shared by most rows is still split by id. A row's rank is its place in its
    partition plus the rows of the partitions before it, of which there are as many numbers as partitions.
    The placed rows are written once, as places and counts must come from the same run. Ids should be unique;
    rows equal in value and id are ranked in any order.
    """
    values = F.array(*[
        F.struct(F.lit(name).alias("metric"), value.cast("bigint").alias("value")) for name, value in metrics.items()
    ])
    long = df.select(F.col(id_col).alias("id"), F.explode(values).alias("m")).select("id", "m.metric", "m.value")
    order = ["metric", F.col("value").asc_nulls_first(), F.col("id").asc_nulls_first()]
    placed = stage(
        long.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "ranks"
    )
    # The id's upper bits are the partition, the lower 33 the place in it.
    rows = placed.select("id", "metric", F.shiftright("at", 33).alias("part"), F.col("at").bitwiseAND((1 << 33) - 1).alias("place"))
    parts = rows.groupBy("metric", "part").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    by_metric = Window.partitionBy("metric")
    before = F.sum("n").over(by_metric.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = parts.select(
        F.col("metric").alias("_metric"), F.col("part").alias("_part"),
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("start"), F.sum("n").over(by_metric).alias("rows"),
    )
    joined = rows.join(F.broadcast(starts), (F.col("metric") == F.col("_metric")) & (F.col("part") == F.col("_part")))
    return joined.select("id", "metric", (F.col("place") + F.col("start") + 1).alias("rank"), "rows")


def ntile_of(rank: Column, rows: Column, tiles: int = 5) -> Column:
    """Tile of a rank as `ntile(tiles)` deals it: larger tiles first."""
    size, extra = F.floor(rows / tiles), rows % tiles
    large = extra * (size + 1)
    return F.when(rank <= large, F.floor((rank - 1) / (size + 1)) + 1).otherwise(extra + F.floor((rank - 1 - large) / F.greatest(size, F.lit(1))) + 1)


def qcut_of(rank: Column, rows: Column, bins: int = 5) -> Column:
    """Bin of a rank when ranks 1..rows are cut at their linear-interpolated quantiles."""
    return F.when(rows == 1, F.lit(1)).otherwise(F.greatest(F.lit(1), F.ceil(bins * (rank - 1) / F.greatest(rows - 1, F.lit(1)))))


def with_scores(df: DataFrame, id_col: str, metrics: Mapping[str, Column], method: str = "ntile", bins: int = 5) -> DataFrame:
    """`df` with one score column per metric: 1 for the lowest values to `bins` for the highest."""
    of = ntile_of if method == "ntile" else qcut_of
    ranks = exact_ranks(df, id_col, metrics).withColumn("score", of(F.col("rank"), F.col("rows"), bins).cast("bigint"))
    wide = ranks.groupBy(F.col("id").alias("_id")).agg(
        *[F.max(F.when(F.col("metric") == name, F.col("score"))).alias(name) for name in metrics]
    )
    return null_safe_join(df, wide, {id_col: "_id"})
