"""Removal of passages that an earlier document already has, by hashing units of text.

A text is cut into units (lines, paragraphs or sentences), which are normalised and hashed. The digests
are grouped over all documents with sums and minima that combine before the shuffle, and each digest
keeps its earliest place by (id, unit). Consecutive later occurrences form a passage; passages of enough
words are removed, and their offsets in the original text are returned. Only digests and places are
shuffled; offsets are found again in the texts that lose something.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.functions.scale import stage
from tillwise.llm.common import fingerprint, split_words

MIN_WORDS = 20  # of a passage
ENDS = {
    "line": re.compile(r"\n"),
    "paragraph": re.compile(r"\n[ \t\r]*\n\s*"),
    "sentence": re.compile(r"\n|[.!?]+(?=\s)"),
}


def units(text: str, kind: str = "sentence") -> list[tuple[int, int]]:
    """(start, end) of the units of a text; together they cover it."""
    out, start = [], 0
    for m in ENDS[kind].finditer(text):
        out.append((start, m.end()))
        start = m.end()
    if start < len(text):
        out.append((start, len(text)))
    return out


def worded_units(text: str, kind: str) -> list[tuple[int, int, list[bytes]]]:
    """The units of a text that have words, with their words."""
    return [(a, b, w) for a, b in units(text, kind) if (w := split_words(text[a:b].encode()))]


def _hashed(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, sizes = [], []
            for text in batch.column("text").to_pylist():
                own = [xxhash.xxh3_128_digest(b" ".join(w)) for _, _, w in worded_units(text or "", kind)]
                digests += own
                sizes.append(len(own))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32())
            halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("fp"), *(pa.ListArray.from_arrays(offsets, pa.array(halves[:, k])) for k in (0, 1))],
                names=["id", "fp", "h", "g"],
            )

    return run


def repeated_units(docs: DataFrame, doc: str = "doc_id", text: str = "text", kind: str = "sentence") -> DataFrame:
    """For each document with units that stand earlier: id, fp, found (their numbers among its units with words).

    Units are compared by their lower-cased words and a 128-bit hash. The first occurrence of a unit is that
    of the smallest id, a null id before all, then of the smaller text fingerprint, then the first in the
    text; a document's own repetitions count too. Rows with the same id and text are one document. Null and
    empty texts have no units.
    """
    inner = docs.select(
        F.col(doc).cast("bigint").alias("id"), fingerprint(F.col(text)).alias("fp"), F.col(text).cast("string").alias("text")
    )
    packed = inner.mapInArrow(_hashed(kind), "id bigint, fp bigint, h array<bigint>, g array<bigint>")
    rows = stage(packed.select("id", "fp", F.posexplode(F.arrays_zip("h", "g")).alias("pos", "u")).select("id", "fp", "pos", "u.*"), "units")
    place = F.struct("id", "fp", "pos")
    shared = rows.groupBy("h", "g").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("origin")).filter("n > 1")
    later = rows.join(shared.select("h", "g", "origin"), ["h", "g"]).filter(~place.eqNullSafe(F.col("origin")))
    return later.groupBy("id", "fp").agg(F.sort_array(F.collect_set("pos")).alias("found"))  # bounded by the document


SPAN = "array<struct<start: int, end: int, units: int>>"
_SPAN_ARROW = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("units", pa.int32())]))


def passages(text: str, found: list[int], kind: str, min_words: int) -> list[dict]:
    """Consecutive units put together, where they have enough words."""
    own, group, all_units = [], [], worded_units(text, kind)
    for k in [*found, None]:
        if group and k != group[-1] + 1:
            if sum(len(all_units[u][2]) for u in group) >= min_words:
                own.append({"start": all_units[group[0]][0], "end": all_units[group[-1]][1], "units": len(group)})
            group = []
        group.append(k)
    return own


def _cut(kind: str, min_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed = [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
                spans = passages(text, found, kind, min_words) if found else []
                parts, at = [], 0
                for s in spans:
                    parts.append(text[at : s["start"]])
                    at = s["end"]
                kept.append("".join(parts) + text[at:] if spans else text)
                removed.append(spans)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(kept, pa.string()), pa.array(removed, _SPAN_ARROW)], names=["row", "kept_text", "spans"]
            )

    return run


def remove_passages(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ("doc_id",), kind: str = "sentence",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """All documents as `row` (struct of the carried columns), kept_text, spans (empty where nothing goes).

    `spans` (start, end, units) are the removed passages: runs of units that stand earlier (`repeated_units`), of
    at least `min_words` words, as offsets in characters of the original text. A null text stays null.
    Other columns may have any name.
    """
    found = repeated_units(docs, doc, text, kind).select(F.col("id").alias("f_id"), F.col("fp").alias("f_fp"), "found")
    inner = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(doc).cast("bigint").alias("id"),
        fingerprint(F.col(text)).alias("fp"), F.col(text).cast("string").alias("text"),
    )
    joined = inner.join(found, F.col("id").eqNullSafe(F.col("f_id")) & (F.col("fp") == F.col("f_fp")), "left").select("row", "text", "found")
    schema = T.StructType([joined.schema["row"], T.StructField("kept_text", T.StringType()), T.StructField("spans", T.DataType.fromDDL(SPAN))])
    return joined.mapInArrow(_cut(kind, min_words), schema)
