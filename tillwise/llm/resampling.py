"""Importance resampling towards a target distribution: hashed word runs, array-scored weights, an exact draw.

1. The runs of one and two words of both tables are counted in hash buckets, a task's counts as one array.
2. The log ratios of the buckets form one array, sent to all tasks; a document's weight is the floored
   mean of the entries of its runs. Gumbel noise from a hash of the id makes the highest scores a draw
   without replacement in proportion to the weights.
3. The draw's cutoff is found by weighted median-of-medians: every chunk of the scored table gives the
   median of its remaining keys; the median of these, weighted by the chunks' remaining sizes, is at or
   above a guaranteed quarter of the keys and at or below another. It is counted against all of them, one
   side goes, and so on to the exact key. Nothing is sorted but the winners.

All steps read tables where they lie; only counts of a bucket and the winners are shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.scale import stage
from tillwise.llm.common import fingerprint, split_words

BUCKETS = 10_000
MIN_WORDS = 20
SHARE = 25  # per cent of the documents long enough
SEED = 7
CHUNK = 200_000  # remaining keys whose median is taken at a time
LAST_KEYS = 1_000  # so few remaining keys are sorted on the driver
HASH_RANGE = 1 << 32


def _crc_steps() -> np.ndarray:
    """The table of CRC-32 (reflected polynomial 0xEDB88320), by its rule."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


CRC_STEPS = _crc_steps()


def run_hashes(words: list[bytes]) -> np.ndarray:
    """CRC-32 of each word, then of each two consecutive words with a space between."""
    single = np.fromiter(map(crc32, words), np.uint32, len(words))
    inverted = ~single[:-1]
    spaced = ~(CRC_STEPS[(inverted ^ 0x20) & 0xFF] ^ (inverted >> 8))
    double = np.fromiter(map(crc32, words[1:], spaced.tolist()), np.uint32, max(len(words) - 1, 0))
    return np.concatenate([single, double])


def _counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                total += np.bincount(run_hashes(split_words(text or b"")) % buckets, minlength=buckets)
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(total[used], pa.int64())], names=["bucket", "n"])

    return run


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many word runs of a table fall into each bucket, an array of `buckets` numbers."""
    per_task = df.select(F.col(text).cast("binary")).mapInArrow(_counts(buckets), "bucket bigint, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in per_task.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[row["bucket"]] = row["n"]
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of a bucket's smoothed shares), target over source."""
    in_source, in_target, buckets = int(source.sum()), int(target.sum()), len(source)
    return np.array([
        math.floor(1000 * math.log((t + 1) * (in_source + buckets) / ((s + 1) * (in_target + buckets))))
        for s, t in zip(source.tolist(), target.tolist())
    ], np.int64)


_WEIGHED = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])


def _weigh(gains):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        array = gains.value
        for batch in batches:
            out = []
            for text in batch.column("text").to_pylist():
                words = split_words(text or b"")
                found = run_hashes(words) % len(array)
                out.append((len(words), len(found), int(array[found].sum()) // len(found) if len(found) else 0))
            columns = np.array(out, np.int64).reshape(-1, 3).T
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("row", "id", "fp")), *(pa.array(c, pa.int64()) for c in columns)],
                names=["row", "id", "fp", *_WEIGHED.names],
            )

    return run


def noise(id_col: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from the first 32 bits of SHA-256 of `<seed>:<id>`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    uniform = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / float(HASH_RANGE)
    return F.floor(-1000 * F.log(-F.log(uniform)))


KEY = ("low", "no_id", "id", "fp", "at")


def _medians(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, held = [], 0

    def median() -> pa.RecordBatch:
        keys = np.concatenate(parts, axis=1)
        order = np.lexsort(keys[::-1])
        middle = keys[:, order[(keys.shape[1] - 1) // 2]]
        return pa.RecordBatch.from_arrays(
            [*(pa.array([int(v)], pa.int64()) for v in middle), pa.array([keys.shape[1]], pa.int64())], names=[*KEY, "n"]
        )

    for batch in batches:
        if batch.num_rows:
            parts.append(np.stack([batch.column(c).to_numpy(zero_copy_only=False) for c in KEY]))
            held += batch.num_rows
        if held >= CHUNK:
            yield median()
            parts, held = [], 0
    if held:
        yield median()


def _before(key: tuple[int, ...]) -> Column:
    """Whether a row's key comes before `key`, as comparisons of plain columns."""
    out = F.lit(False)
    for name, value in zip(KEY[::-1], key[::-1]):
        out = (F.col(name) < value) | ((F.col(name) == value) & out)
    return out


def _at_most(key: tuple[int, ...]) -> Column:
    same = F.lit(True)
    for name, value in zip(KEY, key):
        same = same & (F.col(name) == value)
    return _before(key) | same


def weighted_median(medians: list[tuple[tuple[int, ...], int]]) -> tuple[int, ...]:
    """The least median such that those up to it stand for half of all keys."""
    medians = sorted(medians)
    half, seen = sum(n for _, n in medians) / 2, 0
    for key, n in medians:
        seen += n
        if seen >= half:
            return key
    raise ValueError("no keys")


def cutoff_key(keys: DataFrame, take: int, last_keys: int = LAST_KEYS) -> tuple[int, ...]:
    """The `take`-th smallest of the distinct keys (columns `KEY`) of a stored table; 1 <= take <= rows."""
    left, remaining = keys, None
    while True:
        medians = [(tuple(r[c] for c in KEY), r["n"]) for r in left.mapInArrow(_medians, ", ".join(f"{c} bigint" for c in (*KEY, "n"))).collect()]
        remaining = sum(n for _, n in medians)
        if remaining <= last_keys:
            rest = sorted(tuple(r[c] for c in KEY) for r in left.collect())
            return rest[take - 1]
        pivot = weighted_median(medians)
        less = left.filter(_before(pivot)).count()
        if take == less + 1:
            return pivot
        if take <= less:
            left = left.filter(_before(pivot))
        else:
            left, take = left.filter(~_at_most(pivot)), take - less - 1


def _ranked(df: DataFrame) -> DataFrame:
    """`df` with `rank`: 1, 2, 3, ... by the key. Rows are range-partitioned and sorted; each partition begins after those before it."""
    placed = stage(
        df.repartitionByRange(*KEY).sortWithinPartitions(*KEY).withColumn("place", F.monotonically_increasing_id()), "resampling-winners"
    )
    part = F.shiftright("place", 33)
    parts = placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition
    starts = parts.select(F.col("part").alias("start_part"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    joined = placed.join(F.broadcast(starts), part == F.col("start_part"))
    return joined.withColumn("rank", F.col("start") + F.col("place").bitwiseAND((1 << 33) - 1) + 1)


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text: str = "text", target_text: str = "text",
    carry: tuple[str, ...] = ("doc_id",), buckets: int = BUCKETS, min_words: int = MIN_WORDS, share: int = SHARE, seed: int = SEED,
) -> DataFrame:
    """Every document as `row` (struct of the carried columns) with n_words, n_features, weight, score and rank.

    Of the documents with at least `min_words` words, floor(share / 100 of them) are drawn: those of highest
    score; `rank` counts them from 1 and is null for all others. Ties go to the smaller id (an integer;
    missing ids come last), then by text hash and place, so repeated rows count one by one. Null texts have no
    words and weight 0; an empty target makes all documents' gains those of an empty histogram; an empty
    table gives no rows; other columns may have any name.
    """
    spark = docs.sparkSession
    gains = bucket_gains(bucket_counts(docs, text, buckets), bucket_counts(target, target_text, buckets))
    inner = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(fingerprint(F.col(text)), F.lit(0)).alias("fp"), F.col(text).cast("binary").alias("text"),
    )
    schema = T.StructType([*(inner.schema[c] for c in ("row", "id", "fp")), *_WEIGHED.fields])
    weighed = inner.mapInArrow(_weigh(spark.sparkContext.broadcast(gains)), schema)
    scored = weighed.withColumn("score", F.col("weight") + noise(F.col("id"), seed))
    scored = stage(scored.select(
        "row", *_WEIGHED.names, "score", (-F.col("score")).alias("low"), F.col("id").isNull().cast("bigint").alias("no_id"),
        F.coalesce("id", F.lit(0)).alias("id"), "fp", F.monotonically_increasing_id().alias("at"),
    ), "resampling-scored")
    long_enough = F.col("n_words") >= min_words
    take = share * scored.filter(long_enough).count() // 100
    out = ["row", *_WEIGHED.names, "score"]
    if not take:
        return scored.select(*out, F.lit(None).cast("bigint").alias("rank"))
    drawn = long_enough & _at_most(cutoff_key(scored.filter(long_enough).select(*KEY), take))
    winners = _ranked(scored.filter(drawn)).select(*out, "rank")
    return winners.unionByName(scored.filter(~drawn).select(*out, F.lit(None).cast("bigint").alias("rank")))
