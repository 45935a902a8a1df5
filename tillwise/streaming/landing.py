"""Landed JSON files taken in once, as a stream of what has arrived."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.sources.readers import CORRUPT
from tillwise.streaming.hourly import run_stream
from tillwise.streaming.store_sales import BatchTable

EXTRA = "extra"


class Landing:
    """A feed's folder of JSON lines, taken into two tables: accepted rows and quarantined lines.

    Every file is read by one batch, and a batch that runs again replaces its own rows, so each line is taken in
    exactly once, however often `take` runs. Fields beyond the schema are kept by name in the map `extra`, so a
    feed may add optional columns at any time; missing ones are null. Lines that are no JSON object, or whose values
    do not fit the schema, go to quarantine as text.
    """

    def __init__(self, spark: SparkSession, source: str, out: str, schema: T.StructType):
        self.spark, self.source, self.out, self.schema = spark, source, out, schema
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        self.accepted = BatchTable(spark, f"{out}/accepted", f"{columns}, {EXTRA} map<string, string>", lambda rows: rows)
        self.quarantined = BatchTable(spark, f"{out}/quarantined", "line string, file string", lambda rows: rows)

    def _parsed(self, lines: DataFrame) -> DataFrame:
        marked = T.StructType([*self.schema.fields, T.StructField(CORRUPT, T.StringType())])
        options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
        known = F.array(*[F.lit(f.name) for f in self.schema])
        return lines.filter(F.trim("value") != "").select(
            "value", "file", F.from_json("value", marked, options).alias("row"),
            F.map_filter(F.from_json("value", "map<string, string>"), lambda k, _: ~F.array_contains(known, k)).alias(EXTRA),
        )

    def take(self, files_per_batch: int | None = None) -> None:
        """Take in the files that have come since the last time."""
        reader = self.spark.readStream.format("text")
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        lines = reader.load(self.source).select("value", F.col("_metadata.file_name").alias("file"))

        def write(batch: DataFrame, number: int) -> None:
            rows = self._parsed(batch)
            bad = F.col(f"row.{CORRUPT}").isNotNull() | F.col("row").isNull()
            self.quarantined.add(rows.filter(bad).select(F.col("value").alias("line"), "file"), number)
            self.accepted.add(rows.filter(~bad).select(*[F.col("row")[f.name].alias(f.name) for f in self.schema], EXTRA), number)

        run_stream(lines, write, f"{self.out}/checkpoint", "append")
        self.accepted.compact()
        self.quarantined.compact()
