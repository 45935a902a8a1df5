"""Small tables with what real ones hold: nulls, empty and long texts, repeated rows, clashing names."""

import random

from pyspark.sql import types as T

# Columns that have the names which the operators use inside.
CLASHES = ["row", "id", "fp", "key", "n", "h", "g", "pos", "spans", "kept", "host", "m", "body", "block", "place", "i",
           "no_id", "n_tokens", "token_ids", "round_trip", "keep", "d_id", "bucket", "train", "base_failed"]
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in CLASHES],
])


def words(n, seed, vocabulary=4000):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def texts():
    base = words(120, 1)
    near = [*base[:60], "Änderung", *base[61:]]
    rows = [
        (1, " ".join(base)), (1, " ".join(base)), (2, " ".join(near)), (3, " ".join(base).upper()),
        (4, None), (5, ""), (6, " \n\t \n"), (None, " ".join(words(50, 2))), (None, None), (7, "one two three"),
        (8, "one  two\tthree"), (9, " ".join(words(30_000, 3, 20_000))), (10, "\n".join(["Same line here.", "", "same LINE here. "] * 5)),
        (11, "é É ß\x00 ▁x 日本 🎉"), (12, " ".join(["a b c d e f g h"] * 6)), (13, "#*$%&|<>"),
    ]
    rows += [(100 + k, f"  Shared Line ÀÉ\nown {k} text {' '.join(words(30, k))}\n\nlast") for k in range(12)]
    return rows


def table(spark, rows=None):
    rows = texts() if rows is None else rows
    return spark.createDataFrame(
        [(i, t, "en", None if k % 5 == 0 else f"s{k % 3}", None if t is None else len(t), *["x"] * len(CLASHES)) for k, (i, t) in enumerate(rows)],
        SCHEMA,
    )


def empty(spark):
    return table(spark, [])
