"""Removal of lines that stand in many documents, by DataFrame operations only.

The lines' hashes are range-partitioned together with a bucket of their document, and sorted by
document and position inside each range. A window streams over this order and marks a line's first
occurrence in a document, so documents can be counted by sums that combine before any shuffle.
The bucket splits a line that a large part of all documents share over many ranges. What comes back
is one compressed keep bitmap per document (runs of kept lines), never text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillwise.functions.scale import stage
from tillwise.llm.common import SPACES, fingerprint, let

BUCKETS = 64  # ranges over which one line can be spread
MIN_DOCS = 10
MIN_CHARS = 1
OPEN_END = 2**31 - 1  # the last run of a bitmap goes to the end of the document, however long that is


def _caseless(line: Column) -> Column:
    """Equal for two stripped lines exactly if they are equal after lower-casing A-Z.

    Each UTF-8 byte is read as one Latin-1 character and lower-cased. That maps A-Z as wanted, and first
    bytes C0-DE (two-byte characters) to E0-FE, which in valid UTF-8 are followed by more bytes: the
    number of bytes that follow still tells them apart. It costs a fifth of a `translate` over the text.
    """
    return F.lower(F.decode(F.btrim(line, F.lit(SPACES)).cast("binary"), "ISO-8859-1"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def sorted_lines(docs: DataFrame, doc: str, text: str, min_chars: int = MIN_CHARS) -> DataFrame:
    """Staged rows (h, g, bucket, id, fp, pos, first): line hashes in range order.

    A key is told apart by two 64-bit hashes. `first` marks the key's first line in its document.
    """
    lines = docs.select(
        F.col(doc).alias("id"), fingerprint(F.col(text)).alias("fp"), F.posexplode(_lines(F.col(text))).alias("pos", "line")
    ).filter(F.char_length(F.btrim("line", F.lit(SPACES))) >= min_chars)
    key = _caseless(F.col("line"))
    # Written before it is dealt out, as finding the range bounds reads the rows a second time.
    hashed = stage(lines.select(
        F.xxhash64(key).alias("h"), F.xxhash64(F.lit(1), key).alias("g"),
        F.pmod(F.xxhash64("id", "fp"), F.lit(BUCKETS)).cast("int").alias("bucket"), "id", "fp", "pos",
    ), "hashed-lines")
    ranged = hashed.repartitionByRange("h", "g", "bucket").sortWithinPartitions("h", "g", "bucket", "id", "fp", "pos")
    # Needs no further shuffle or sort: the ranges never divide (h, g, bucket).
    order = Window.partitionBy("h", "g", "bucket").orderBy("id", "fp", "pos")
    before = F.lag(F.struct("id", "fp")).over(order)
    return stage(
        ranged.withColumn("first", before.isNull() | ~before.eqNullSafe(F.struct("id", "fp"))), "sorted-lines"
    )


def keep_bitmaps(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS,
    keep_first: bool = False, keep_first_doc: bool = False,
) -> DataFrame:
    """For each document that loses lines: id, fp, n_dropped, keep (runs `start`, `length` of kept lines).

    A line is dropped if its key (stripped, A-Z lower-cased) has at least `min_chars` characters and
    is found in at least `min_docs` documents; with `keep_first` its first occurrence by (id,
    fingerprint, position) stays, with `keep_first_doc` all its places in the first document by (id,
    fingerprint). Rows with the same id and text are one document. Null texts are one
    empty line. Documents that lose nothing have no row.
    """
    rows = sorted_lines(docs, doc, text, min_chars)
    common = (
        rows.filter("first")
        .groupBy("h", "g")
        .agg(F.count(F.lit(1)).alias("docs"), F.min(F.struct("id", "fp", "pos")).alias("origin"))
        .filter(F.col("docs") >= min_docs)
        .select(F.col("h").alias("ch"), F.col("g").alias("cg"), "origin")
    )
    dropped = rows.join(common, (F.col("h") == F.col("ch")) & (F.col("g") == F.col("cg")))
    if keep_first:
        dropped = dropped.filter(~F.struct("id", "fp", "pos").eqNullSafe(F.col("origin")))
    if keep_first_doc:
        dropped = dropped.filter(~F.struct("id", "fp").eqNullSafe(F.struct("origin.id", "origin.fp")))
    per_doc = dropped.groupBy("id", "fp").agg(
        F.sort_array(F.collect_set("pos")).alias("gone")  # bounded by the document
    )

    def runs(gone: Column) -> Column:
        # A kept run starts before the first, between two, or after the last dropped line.
        edges = F.concat(F.array(F.lit(-1)), gone, F.array(F.lit(OPEN_END)))
        return let(
            edges,
            lambda e: F.filter(
                F.transform(
                    F.slice(e, 2, F.size(e) - 1),
                    lambda x, i: F.struct((e[i] + 1).alias("start"), (x - e[i] - 1).alias("length")),
                ),
                lambda r: r["length"] > 0,
            ),
        )

    return per_doc.select("id", "fp", F.size("gone").cast("bigint").alias("n_dropped"), runs(F.col("gone")).alias("keep"))


def apply_bitmaps(docs: DataFrame, bitmaps: DataFrame, doc: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Documents as `row` (struct of the carried columns) with n_lines, n_dropped and kept_text."""
    inner = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(doc).alias("d_id"), F.col(text).alias("body"),
        fingerprint(F.col(text)).alias("d_fp"),
    )
    joined = inner.join(bitmaps, F.col("d_id").eqNullSafe(F.col("id")) & (F.col("d_fp") == F.col("fp")), "left")
    kept = let(
        _lines(F.col("body")),
        lambda x: F.array_join(F.flatten(F.transform(F.col("keep"), lambda r: F.slice(x, r["start"] + 1, r["length"]))), "\n"),
    )
    return joined.select(
        "row",
        F.size(_lines(F.col("body"))).cast("bigint").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("bigint").alias("n_dropped"),
        F.when(F.col("keep").isNull(), F.coalesce("body", F.lit(""))).otherwise(kept).alias("kept_text"),
    )


def _emptied(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """Keys (e_id, e_fp) of the documents that lose every line that is not blank."""
    full = F.size(F.filter(_lines(F.col("text")), lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    sizes = docs.select(F.col("doc_id").alias("e_id"), fingerprint(F.col("text")).alias("e_fp"), full.alias("full"))
    same = F.col("e_id").eqNullSafe(F.col("id")) & (F.col("e_fp") == F.col("fp"))
    return sizes.join(bitmaps.select("id", "fp", "n_dropped"), same).filter("n_dropped = full").select("e_id", "e_fp").distinct()


def line_dedup_stage(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The documents without their common lines; `n_chars` follows the text.

    Documents that would lose all their lines are mostly copies of each other. Among them each line stays
    in the first one that has it, so one full copy of such a text is left; those that even then have no
    line go. A text without lines before the stage stays, a null text stays null.
    """
    columns = tuple(docs.columns)
    bitmaps = stage(keep_bitmaps(docs, min_docs=min_docs), "line-bitmaps")
    emptied = stage(_emptied(docs, bitmaps), "emptied-docs")
    keys = docs.select(F.col("doc_id"), F.col("text"), fingerprint(F.col("text")).alias("fp"))
    hit = F.col("doc_id").eqNullSafe(F.col("e_id")) & (F.col("fp") == F.col("e_fp"))
    copies = keys.join(emptied, hit, "left_semi").select("doc_id", "text")
    again = keep_bitmaps(copies, min_docs=1, keep_first_doc=True)
    other = bitmaps.join(emptied, F.col("id").eqNullSafe(F.col("e_id")) & (F.col("fp") == F.col("e_fp")), "left_anti")
    cut = apply_bitmaps(docs, other.unionByName(again), carry=columns)
    changed = F.col("n_dropped") > 0
    cut = cut.filter(~(changed & (F.btrim("kept_text", F.lit(SPACES)) == "")))
    values = {c: F.col("row")[c] for c in columns}
    if "n_chars" in values:
        values["n_chars"] = F.when(changed, F.char_length("kept_text").cast(docs.schema["n_chars"].dataType)).otherwise(values["n_chars"])
    values["text"] = F.when(changed, F.col("kept_text")).otherwise(values["text"])
    return cut.select(*[v.alias(c) for c, v in values.items()])
