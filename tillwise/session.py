"""Spark session settings the engine is designed for."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

# Runtime settings; all can be changed on a live session.
RUNTIME_CONF = {
    # The calendar arithmetic of the engine is in UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split a hot join key even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort-merge joins where every partition of one side was measured to be small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Streams keep the state of their last batch in memory, not also that of the one before; a batch that runs again reads it from its files.
    "spark.sql.streaming.maxBatchesToRetainInMemory": "1",
}


# Shuffles of large inputs start with a partition for each so many bytes of input, and small ones are put together
# up to the second figure: the rows of one task, and the memory it takes, then do not grow with the input.
# Scans are cut likewise: a scan's task holds what it shuffles, which is several times its compressed split.
INPUT_BYTES_PER_PARTITION = 1 << 20
_FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
_ADVISED = "16MB"
_SPLIT = "spark.sql.files.maxPartitionBytes"
_SPLIT_AT = _ADVISED


_shipped: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application.

    Their Python workers then need no copy of it on their own path. Spark serves the archive to them
    for as long as the application runs; it is removed when the driver's Python ends.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    folder = tempfile.TemporaryDirectory(prefix="tillwise-")
    root, archive = Path(__file__).parent, f"{folder.name}/tillwise.zip"
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
        for source in sorted(root.rglob("*.py")):
            out.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(archive)
    _shipped[context.applicationId] = folder


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to an existing session, and send the package along."""
    ship_package(spark)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def partition_for(spark: SparkSession, input_bytes: int) -> SparkSession:
    """Let the shuffles and scans that follow have partitions in proportion to an input; settings given with the session stay."""
    given = spark.sparkContext.getConf()
    count = input_bytes // INPUT_BYTES_PER_PARTITION
    large = count > int(spark.conf.get("spark.sql.shuffle.partitions"))
    for key, value in ((_FIRST_PARTITIONS, str(count)), (_ADVISORY, _ADVISED), (_SPLIT, _SPLIT_AT)):
        if given.contains(key):
            continue
        if large:
            spark.conf.set(key, value)
        else:
            spark.conf.unset(key)
    return spark


def local_session(cpus: int | str = 8, partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tillwise")
        .config("spark.driver.memory", memory)
        # Wide aggregations generate methods above the size the JVM compiles by default.
        .config("spark.driver.extraJavaOptions", "-XX:-DontCompileHugeMethods")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in RUNTIME_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)
