"""Helpers that keep a plan safe on large and skewed data."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 << 20  # of rows in memory: a frame measured to be no larger is sent to all tasks

_made: ContextVar[list[str] | None] = ContextVar("made", default=None)


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for staged tables: `spark.checkpoint.dir`, or a local one in tests only."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_dir(spark)}/tillwise/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that no other run uses, in the folder of the application."""
    path = f"{_application_folder(spark)}/{name}-{uuid.uuid4().hex}"
    if (made := _made.get()) is not None:
        made.append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Delete at its end what was staged inside (in the same thread). Frames built on it must not outlive it."""
    token = _made.set([])
    try:
        yield
    finally:
        made = _made.get()
        _made.reset(token)
        for path in made:
            delete_path(spark, path)


def _file_system(spark: SparkSession, folder: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def folder_exists(spark: SparkSession, folder: str) -> bool:
    files, path = _file_system(spark, folder)
    return files.exists(path)


def bytes_in(spark: SparkSession, path: str) -> int:
    """The bytes of a file or of all files of a folder; 0 where it does not exist."""
    files, where = _file_system(spark, path)
    return files.getContentSummary(where).getLength() if files.exists(where) else 0


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """The names in a folder, sorted; none where it does not exist."""
    files, path = _file_system(spark, folder)
    return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []


def set_times(spark: SparkSession, folder: str, millis: int) -> bool:
    """Give a folder's files a time of modification; false where the store does not keep it."""
    files, path = _file_system(spark, folder)
    for f in files.listStatus(path):
        files.setTimes(f.getPath(), millis, -1)
    return all(f.getModificationTime() == millis for f in files.listStatus(path))


def write_small_file(spark: SparkSession, path: str, text: str) -> bool:
    """Make a small file at once: it is written aside and renamed. False, and no change, where `path` exists."""
    files, aside = _file_system(spark, f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = files.create(aside, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not files.exists(target) and files.rename(aside, target):
        return True
    files.delete(aside, False)
    return False


def read_small_file(spark: SparkSession, path: str) -> str:
    files, where = _file_system(spark, path)
    source = files.open(where)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(source)).decode()
    finally:
        source.close()


def delete_path(spark: SparkSession, path: str) -> None:
    files, where = _file_system(spark, path)
    files.delete(where, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete what the application has staged. Call it when no frame built on staged rows is read any more."""
    files, path = _file_system(spark, _application_folder(spark))
    files.delete(path, True)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared folder and go on from the written table.

    Used where several branches need the same expensive rows, or where two branches must
    see exactly the same rows. Unlike a cached frame it survives the loss of executors, and
    unlike a checkpoint its readers prune columns and know its size.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def is_small(df: DataFrame) -> bool:
    """Whether the rows, counted with the bytes of their texts, may be broadcast; never where broadcasts are turned off.

    Spark's own estimate, from file sizes, does not hold for frames made by joins, and what it measures at run time comes
    after the other side of the join was shuffled. Meant for dimensions, as their rows are read once more.
    """
    if df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() < 0:
        return False
    fixed, texts = 8 + 8 * len(df.columns), F.lit(0)
    for f in df.schema:
        if isinstance(f.dataType, T.StringType | T.BinaryType):
            texts = texts + F.coalesce(F.octet_length(f.name) + 7, F.lit(0)).cast("bigint")
    found = df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(texts), F.lit(0)).alias("texts")).first()
    return found["rows"] * fixed + found["texts"] <= BROADCAST_BYTES


def broadcast_if_small(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if is_small(df) else df


def mark_first(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str) -> DataFrame:
    """Add `flag`: true on exactly one row per key, the first by the `order` columns, missing values last.

    Ties are broken by the other columns, and of rows equal in all columns one is marked. Only the keys are
    shuffled to find those that stand more than once. They are written, so that their size is known when the
    rows meet them: where they are few, as they should be, all other rows pass without a shuffle.
    """
    repeated = stage(
        df.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n"), "repeated-keys"
    )
    again = F.lit(True)
    for k in keys:
        again = again & F.col(k).eqNullSafe(F.col(f"_of_{k}"))
    once = df.join(repeated, again, "left_anti").withColumn(flag, F.lit(True))
    return once.unionByName(_mark_first_of_repeated(df.join(repeated, again, "left_semi"), keys, order, flag))


def _mark_first_of_repeated(df: DataFrame, keys: Sequence[str], order: Sequence[str], flag: str) -> DataFrame:
    """`mark_first` where any key may be hot.

    Equal rows are first counted, then each key's first row is found; both combine before the shuffle, so no task
    gathers the rows of a hot key. The rows meet their key's first one in a join whose hot keys are split.
    """
    ranked = [*order, *[c for c in df.columns if c not in order]]
    place = F.struct(*[x for c in ranked for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(c))])
    counted = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    firsts = counted.groupBy(*[F.col(k).alias(f"_of_{k}") for k in keys]).agg(F.min(place).alias("_first"))
    joined = null_safe_join(counted, firsts, {k: f"_of_{k}" for k in keys}, "left")
    copies = F.sequence(F.lit(1).cast("bigint"), F.col("_copies"))
    return joined.select(
        *df.columns, place.eqNullSafe(F.col("_first")).alias("_is_first"), F.explode(copies).alias("_copy")
    ).select(*df.columns, (F.col("_is_first") & (F.col("_copy") == 1)).alias(flag))


def null_safe_join(left: DataFrame, right: DataFrame, pairs: dict[str, str], how: str = "inner") -> DataFrame:
    """Equi-join in which null matches null; the right-hand key columns are dropped."""
    condition = F.lit(True)
    for mine, other in pairs.items():
        condition = condition & F.col(mine).eqNullSafe(F.col(other))
    return left.join(right, condition, how).drop(*pairs.values())
