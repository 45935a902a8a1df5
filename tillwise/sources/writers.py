"""Writing warehouse tables, rejects, audit rows and exports."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillwise.functions import scale
from tillwise.model import RUN_LOG


def write_processed(tables: Mapping[str, DataFrame], folder: str, fmt: str = "parquet") -> None:
    """Each table as files in its own folder."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        (writer.option("header", True).csv if fmt == "csv" else writer.parquet)(f"{folder}/{name}")


def _counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def load_table(df: DataFrame, path: str, mode: str = "append", partition_by: str | None = None) -> int:
    """Append to or replace a table; the row count is taken while writing.

    An empty frame changes nothing, also in overwrite mode.
    """
    if mode == "overwrite" and df.isEmpty():
        return 0
    counted, seen = _counted(df)
    writer = counted.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)
    return seen.get["rows"]


def replace_run(df: DataFrame, path: str, run_id: str, column: str = "pipeline_run_id", partition_by: str | None = None) -> int:
    """Store a run's rows in a folder of the run, in place of what the same run stored before.

    Readers of the whole table find the run's id as column `column`.
    """
    counted, seen = _counted(df.drop(column))
    writer = counted.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(f"{path}/{column}={run_id}")
    return seen.get["rows"]


def append_quarantine(df: DataFrame, path: str, run_id: str) -> int:
    """Add a run's rejects; a repeated run replaces its own."""
    return replace_run(df, path, run_id, "run_id")


def run_log_row(
    spark: SparkSession, run_id: str, source: str, extracted: int, loaded: int, quarantined: int, status: str,
    started: datetime, completed: datetime, error: str | None = None,
) -> DataFrame:
    """One audit row."""
    seconds = int((completed - started).total_seconds())
    row = (run_id, started.date(), source, extracted, loaded, quarantined, status, error, started, completed, seconds)
    return spark.createDataFrame([row], RUN_LOG)


def run_log_of(
    report: DataFrame, run_id: str, source: str, status: str, started: datetime, completed: datetime, error: str | None = None
) -> DataFrame:
    """The audit row of a run as a sum over its quality reports."""
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    values = {
        "run_id": F.lit(run_id), "run_date": F.lit(started.date()), "source_system": F.lit(source),
        "records_extracted": total("records_input"), "records_loaded": total("records_clean"),
        "records_quarantined": total("records_quarantined"), "status": F.lit(status), "error_message": F.lit(error),
        "started_at": F.lit(started), "completed_at": F.lit(completed), "duration_seconds": F.lit(int((completed - started).total_seconds())),
    }
    assert list(values) == RUN_LOG.fieldNames()
    return report.agg(*[v.cast(RUN_LOG[c].dataType).alias(c) for c, v in values.items()])


def write_yearly_partitioned(df: DataFrame, path: str, sort_by: tuple[str, ...] = (), mode: str = "overwrite") -> None:
    """Partition by the year of `date_key`, sorted inside the files so that scans can skip row groups.

    Spark rebalances the partitions by their measured size: a year with a third of the rows is
    split over many tasks, small years share one.
    """
    yearly = df.withColumn("year", F.expr("date_key div 10000").cast("int")).hint("rebalance", "year")
    writer = yearly.sortWithinPartitions("year", *sort_by).write.mode(mode)
    if mode == "overwrite":
        writer = writer.option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("year").parquet(path)


def publish_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


MARKERS = "_current"
KEPT_VERSIONS = 3


def current_version(spark: SparkSession, path: str) -> tuple[int, str] | None:
    """(number, folder) of the published version of the table at `path`; None before the first."""
    numbers = [n for n in scale.names_in(spark, f"{path}/{MARKERS}") if n.isdigit()]
    return (int(numbers[-1]), f"{path}/{scale.read_small_file(spark, f'{path}/{MARKERS}/{numbers[-1]}')}") if numbers else None


def read_published(spark: SparkSession, path: str) -> DataFrame:
    """The published version; the frame goes on reading it when another one is published."""
    current = current_version(spark, path)
    if current is None:
        raise FileNotFoundError(f"nothing is published at {path}")
    return spark.read.parquet(current[1])


def publish_version(df: DataFrame, path: str, keep: int = KEPT_VERSIONS) -> int:
    """Store `df` as the next version of the table at `path` and switch readers to it; returns its row count.

    The rows are written in full into a folder of their own. Then one small file, a marker with the next number,
    names that folder, and from then on it is the current version: readers see all of the old rows or all of the
    new ones, and a run that ends before the marker leaves the old version. `df` may read the current version.
    Two runs that publish at once cannot take the same number; the later one fails. The last `keep` versions
    stay for readers under way.
    """
    spark = df.sparkSession
    current = current_version(spark, path)
    number, folder = (current[0] + 1 if current else 1), f"v-{uuid.uuid4().hex}"
    counted, seen = _counted(df)
    counted.write.parquet(f"{path}/{folder}")
    if not _switch(spark, path, number, folder):
        scale.delete_path(spark, f"{path}/{folder}")
        raise RuntimeError(f"version {number} of {path} was published by another run")
    _drop_old(spark, path, number, keep)
    return seen.get["rows"]


def _switch(spark: SparkSession, path: str, number: int, folder: str) -> bool:
    return scale.write_small_file(spark, f"{path}/{MARKERS}/{number:010d}", folder)


def _drop_old(spark: SparkSession, path: str, number: int, keep: int) -> None:
    """Delete the versions before the last `keep`, each marker before its rows."""
    for marker in scale.names_in(spark, f"{path}/{MARKERS}"):
        if marker.isdigit() and int(marker) <= number - keep:
            folder = scale.read_small_file(spark, f"{path}/{MARKERS}/{marker}")
            scale.delete_path(spark, f"{path}/{MARKERS}/{marker}")
            scale.delete_path(spark, f"{path}/{folder}")


def publish_table(df: DataFrame, name: str, path: str | None = None) -> None:
    """Publish a version of a table at `path`, or in the session's warehouse, and point the catalog's table at it.

    Moving an existing table is one change of its location; readers of files use `read_published`.
    """
    spark = df.sparkSession
    path = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{name}"
    publish_version(df, path)
    folder = current_version(spark, path)[1]
    if spark.catalog.tableExists(name):
        if spark.table(name).schema.simpleString() == df.schema.simpleString():
            spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(name)
            return
        spark.sql(f"DROP TABLE {name}")
    spark.catalog.createTable(name, folder, "parquet")


def write_export(df: DataFrame, path: str) -> None:
    """CSV for other systems."""
    df.write.mode("overwrite").option("header", True).csv(path)
