"""Hourly sales by store and stock status, from streams of orders, order lines and stock.

Lines meet their orders in a join of two streams: both have a watermark, and a line belongs to an order only
within a span of time after it, so an order leaves the state when no line can come any more, and a line that
has found no order leaves it as unmatched. Stock is a stream of its own that keeps the newest row of each
product and store. Batches add to tables of small folders, which are put together from time to time.

What has arrived is one batch, and all its rows are state until the watermark passes them. A large backlog is
therefore cut into files by time and replayed oldest first, so that the state holds two such files and the rows
within the watermark's span, however large the backlog.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions import scale
from tillwise.functions.columns import gbp
from tillwise.operators.inventory import rag_status
from tillwise.sources import writers
from tillwise.streaming.hourly import run_stream

KEPT_BATCHES = 24  # folders that are read as they are before they are put together
SLICE_BYTES = 96 << 20  # of a backlog's files for one batch of its replay
SLICE = "slice"


def read_files(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader).parquet(path)


def _hours_that_cut(seconds: DataFrame, parts: int) -> list[int]:
    """The full hours, as seconds, that cut the rows into about equal parts; the driver gets a count for each hour."""
    hours = seconds.filter("s IS NOT NULL").groupBy(F.expr("s div 3600").alias("hour")).count().collect()
    total, before, cuts = sum(r["count"] for r in hours), 0, []
    for r in sorted(hours, key=lambda r: r.hour):
        if before * parts >= total * (len(cuts) + 1) and len(cuts) < parts - 1:
            cuts.append(r.hour * 3600)
        before += r["count"]
    return cuts


@contextmanager
def _unsorted_writes(spark: SparkSession) -> Iterator[None]:
    """Tasks whose rows are all of one folder, or two, write them as they come; else they would sort them by folder first."""
    key = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(key)
    spark.conf.set(key, "2")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def in_time_order(tables: Mapping[str, tuple[DataFrame, str]], path: str, slices: int) -> bool:
    """Write each table to `path`/name as files that a stream takes in order of time, one a batch; whether that is possible.

    `tables` has rows and the SQL expression of their time. All tables are cut at the same times, full hours that cut
    the first one into about equal parts, and get equally many files, so the streams over them advance together and none of
    their rows is late. Rows without a time come first. A file stream goes by the files' times of modification; in a
    store that does not keep the times given to files the answer is false.
    """
    first, stamp = next(iter(tables.values()))
    cuts = _hours_that_cut(first.select(F.unix_seconds(F.expr(stamp)).alias("s")), slices)
    began = int(time.time()) * 1000
    for name, (rows, ts) in tables.items():
        at, folder = F.unix_seconds(F.expr(ts)), f"{path}/{name}"
        place = F.lit(0)
        for cut in cuts:
            place = place + F.coalesce((at >= cut).cast("int"), F.lit(0))
        # A slice is one task's file, in row groups small enough for several tasks to read it.
        cut_up = rows.withColumn(SLICE, place).repartitionByRange(len(cuts) + 1, SLICE)
        with _unsorted_writes(rows.sparkSession):
            cut_up.write.option("parquet.block.size", 8 << 20).partitionBy(SLICE).parquet(folder)
        for k in range(len(cuts) + 1):
            part = f"{folder}/{SLICE}={k}"
            if not scale.folder_exists(rows.sparkSession, part):
                rows.limit(0).coalesce(1).write.parquet(part)
            if not scale.set_times(rows.sparkSession, part, began + 1000 * k):
                return False
    return True


def lines_with_orders(
    orders: DataFrame, lines: DataFrame, delay: str = "1 hour", within: str = "2 hours", line_id: Sequence[str] = ("order_line_id",)
) -> DataFrame:
    """Every line once, with `order_ts` of its order: null where none came in time.

    `orders` has order_id and order_ts, `lines` order_id and line_ts, at most `within` after the order's. Rows
    repeated within `delay` are dropped, rows later than `delay` are lost (and counted by `run_stream`). A line is
    given out when its order is there, or when the watermarks have passed the last moment an order could come.
    """
    first = orders.select(F.col("order_id").alias("of_order"), "order_ts").withWatermark("order_ts", delay)
    first = first.dropDuplicatesWithinWatermark(["of_order"])
    then = lines.withWatermark("line_ts", delay).dropDuplicatesWithinWatermark(list(line_id))
    span = F.col("line_ts").between(F.col("order_ts"), F.col("order_ts") + F.expr(f"INTERVAL {within}"))
    return then.join(first, (F.col("order_id") == F.col("of_order")) & span, "left").drop("of_order")


class BatchTable:
    """A table that grows by batches of a stream, each under its own number.

    A batch that is run again replaces its own folder. `compact` puts all batches into one published version that
    knows the last batch it holds; folders up to that number no longer count, whether they are deleted yet or not.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame]):
        self.spark, self.path, self.schema, self.merge = spark, path, schema, merge

    def add(self, rows: DataFrame, number: int) -> None:
        if number > self._through():
            rows.write.mode("overwrite").parquet(f"{self.path}/batches/batch={number}")

    def _through(self) -> int:
        current = writers.current_version(self.spark, f"{self.path}/base")
        return -1 if current is None else int(self.spark.read.parquet(f"{current[1]}").agg(F.max("through")).first()[0])

    def read(self, only: Callable[[DataFrame], DataFrame] = lambda parts: parts) -> DataFrame:
        """The table's rows, those of equal key merged; `only` may leave out keys before that."""
        return self.merge(only(self._parts(self._through())))

    def _parts(self, through: int) -> DataFrame:
        parts = self.spark.createDataFrame([], self.schema)
        if through >= 0:
            parts = writers.read_published(self.spark, f"{self.path}/base").filter("NOT is_mark").select(parts.columns)
        if self._batches():
            stored = self.spark.read.schema(f"{self.schema}, batch bigint").parquet(f"{self.path}/batches")
            parts = parts.unionByName(stored.filter(F.col("batch") > through).drop("batch"))
        return parts

    def _batches(self) -> list[int]:
        return sorted(int(n.removeprefix("batch=")) for n in scale.names_in(self.spark, f"{self.path}/batches") if n.startswith("batch="))

    def compact(self, keep: int = KEPT_BATCHES) -> bool:
        """Put the batches together if there are more than `keep`; whether it was done."""
        through, batches = self._through(), self._batches()
        if len(batches) <= keep:
            return False
        rows = self.merge(self._parts(through)).withColumns({"through": F.lit(batches[-1]).cast("bigint"), "is_mark": F.lit(False)})
        # One row more, so that an empty table knows its last batch too.
        mark = self.spark.range(1).select(
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields[:-2]], F.lit(batches[-1]).cast("bigint").alias("through"),
            F.lit(True).alias("is_mark"),
        )
        writers.publish_version(rows.unionByName(mark), f"{self.path}/base")
        for number in batches:
            scale.delete_path(self.spark, f"{self.path}/batches/batch={number}")
        return True


SALES = "hour timestamp, store_id string, stock_status string, lines bigint, units bigint, revenue_pence bigint"
STOCK = "product_id string, store_id string, snapshot_ts timestamp, stock_on_hand bigint, reorder_point bigint"
UNMATCHED = "order_line_id string, order_id string, line_ts timestamp"


def _summed(rows: DataFrame) -> DataFrame:
    return rows.groupBy("hour", "store_id", "stock_status").agg(*[F.sum(c).cast("bigint").alias(c) for c in ("lines", "units", "revenue_pence")])


def _newest(rows: DataFrame) -> DataFrame:
    best = rows.groupBy("product_id", "store_id").agg(F.max(F.struct("snapshot_ts", "stock_on_hand", "reorder_point")).alias("s"))
    return best.select("product_id", "store_id", "s.*")


class StoreSales:
    """The tables that the streams fill: sales by hour, store and stock status; stock; lines without an order."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = path
        self.sales = BatchTable(spark, f"{path}/sales", SALES, _summed)
        self.stock = BatchTable(spark, f"{path}/stock", STOCK, _newest)
        self.unmatched = BatchTable(spark, f"{path}/unmatched", UNMATCHED, lambda rows: rows)

    def take_stock(self, stock: DataFrame, delay: str = "1 hour") -> int:
        """Stock that has arrived; each batch keeps the newest row per product and store. Returns rows too late."""
        def write(batch: DataFrame, number: int) -> None:
            self.stock.add(_newest(batch), number)

        rows = stock.withWatermark("snapshot_ts", delay).dropDuplicatesWithinWatermark(["product_id", "store_id", "snapshot_ts", "stock_on_hand"])
        late = run_stream(rows.select("product_id", "store_id", "snapshot_ts", "stock_on_hand", "reorder_point"), write, f"{self.path}/stock-checkpoint", "append")
        self.stock.compact()
        return late

    def take_sales(self, sold: DataFrame) -> int:
        """Lines (of `lines_with_orders`) that have arrived, with the stock status known when their batch is taken."""
        def write(batch: DataFrame, number: int) -> None:
            # Both tables need the batch: it is written once, or the join of the streams would run for each of them.
            with scale.scratch_scope(batch.sparkSession):
                self._add_sold(scale.stage(batch, "sold"), number)

        late = run_stream(sold, write, f"{self.path}/sales-checkpoint", "append")
        self.sales.compact()
        self.unmatched.compact()
        return late

    def _add_sold(self, batch: DataFrame, number: int) -> None:
        known = batch.filter("order_ts IS NOT NULL")
        # Only stock of what was sold is merged. The pairs are written, so that few of them spare the stock a shuffle.
        pairs = scale.stage(known.select("product_id", "store_id").distinct(), "pairs")
        stock = self.stock.read(lambda parts: parts.join(pairs, ["product_id", "store_id"], "left_semi")).select(
            F.col("product_id").alias("p"), F.col("store_id").alias("s"), rag_status(F.col("stock_on_hand"), F.col("reorder_point")).alias("stock_status")
        )
        rows = known.join(stock, (F.col("product_id") == F.col("p")) & (F.col("store_id") == F.col("s")), "left").select(
            F.date_trunc("hour", "order_ts").alias("hour"), "store_id", F.coalesce("stock_status", F.lit("UNKNOWN")).alias("stock_status"),
            F.lit(1).cast("bigint").alias("lines"), F.col("units_sold").alias("units"), F.col("net_revenue_pence").alias("revenue_pence"),
        )
        self.unmatched.add(batch.filter("order_ts IS NULL").select("order_line_id", "order_id", "line_ts"), number)
        self.sales.add(_summed(rows), number)

    def hourly(self) -> DataFrame:
        return self.sales.read().select(
            F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour_start"), "store_id", "stock_status", "lines", "units", gbp("revenue_pence").alias("revenue_gbp")
        )
