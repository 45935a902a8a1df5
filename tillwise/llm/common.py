"""Helpers shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.session import tune

# ASCII white space: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"

# Bytes that end a word of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` become spaces, A-Z become a-z; every
# byte of a character beyond ASCII stays.
WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)

RUNTIME_CONF = {
    # Texts differ in size by orders of magnitude: what a Python worker gets at once is bounded in
    # bytes, and in rows for the sake of the objects made from them.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(16 << 20),
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings the corpus operators are designed for."""
    tune(spark)
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with `value` computed once per row, however often the body uses it.

    A plain column would be pasted into every place of use, and inside a lambda be computed again
    for each element.
    """
    return F.transform(F.array(value), body)[0]


def space_words(text: Column) -> Column:
    """The words `[^\\x20\\x09-\\x0D]+` of a text as an array; empty for null."""
    trimmed = F.btrim(text, F.lit(SPACES))
    empty = F.array().cast("array<string>")
    return F.when(F.length(trimmed) > 0, F.split(trimmed, SPACE_RUN)).otherwise(empty)


def fingerprint(text: Column) -> Column:
    """With the id, tells documents apart where ids repeat: rows equal in both are one document."""
    return F.xxhash64(text)


def split_words(text: bytes) -> list[bytes]:
    """Lower-cased words of letters, digits and characters beyond ASCII."""
    return text.translate(WORD_BYTES).split()


def free_name(name: str, taken: tuple[str, ...]) -> str:
    """`name`, with underscores added until no column has it (names differ in more than case)."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name
