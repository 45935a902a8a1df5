"""Reading landed files and tables. Schemas are always given, never inferred."""

from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tillwise.model import RAW, RAW_FILES

log = logging.getLogger(__name__)


def read_raw(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The seven raw CSV inputs. A missing file gives a warning and an empty frame."""
    out = {}
    for name, file in RAW_FILES.items():
        schema = RAW[name]
        try:
            out[name] = spark.read.schema(schema).option("header", True).csv(f"{folder}/{file}")
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e.getCondition()):
                raise
            log.warning("%s not found in %s", file, folder)
            out[name] = spark.createDataFrame([], schema)
    return out


def read_table(spark: SparkSession, name: str, folder: str | None = None) -> DataFrame:
    """A warehouse table: parquet files under `folder`, else a table of the catalog."""
    return spark.read.parquet(f"{folder}/{name}") if folder else spark.table(name)


def read_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Only some columns; the selection reaches the file scan."""
    return df.select(*columns)


def lower_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.lower() for c in df.columns])


def run_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """Run SQL; frames passed by name can be used as tables as {name}."""
    return spark.sql(sql, **tables)


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


CORRUPT = "_corrupt_record"


def read_json_landing(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines from a feed. Unreadable lines keep their text in `_corrupt_record`."""
    with_corrupt = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    return spark.read.schema(with_corrupt).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).json(path)
