"""Writing pages as WARC archives and reading them back, with segmented records and chunked bodies.

Writing is one narrow job: a page's record, or its segments, are built as strings and written by the
text writer with the record end (two CR LF) as line separator. The files are gzipped WARC 1.1 and
bounded in records and thereby in bytes, as a long record is cut into segments. Reading takes whole files as
rows, parses them record by record, groups the segments of a record by its origin identifier, puts them
in order, verifies the total length, and decodes the chunked transfer framing.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwise.functions.scale import scratch_path, stage
from tillwise.llm.common import let

CRLF = "\r\n"
RECORD_END = CRLF * 2
SEGMENT_CHARS = 32_768
CHUNK_CHARS = 8_192
FILE_RECORDS = 2048  # of at most SEGMENT_CHARS characters each
MIN_REVISIT_BYTES = 1000
DATE = "2024-01-01T00:00:00Z"


def _record_id(page: Column, url: Column, digest: Column) -> Column:
    """A UUID made from the page, so that another record can name it."""
    h = F.md5(F.concat_ws("\n", F.coalesce(page.cast("string"), F.lit("null")), F.coalesce(url, F.lit("null")), digest))
    return let(h, lambda x: F.concat(
        F.lit("<urn:uuid:"), F.substring(x, 1, 8), F.lit("-"), F.substring(x, 9, 4), F.lit("-"), F.substring(x, 13, 4),
        F.lit("-"), F.substring(x, 17, 4), F.lit("-"), F.substring(x, 21, 12), F.lit(">"),
    ))


def _pieces(text: Column, chars: int) -> Column:
    """The text cut into pieces of at most `chars` characters; none for an empty text."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{chars}}}"), F.lit(0))


def _chunked(payload: Column) -> Column:
    chunk = lambda c: F.concat(F.hex(F.octet_length(c).cast("bigint")), F.lit(CRLF), c, F.lit(CRLF))
    return F.concat(F.array_join(F.transform(_pieces(payload, CHUNK_CHARS), chunk), ""), F.lit(f"0{CRLF}{CRLF}"))


def _header(fields: list[tuple[str, Column]]) -> Column:
    """WARC header lines; a field whose value is null is left out."""
    lines = [F.lit("WARC/1.1" + CRLF)]
    lines += [F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit("")) for name, value in fields]
    return F.concat(*lines, F.lit(CRLF))


def write_archives(
    pages: DataFrame, path: str, page: str = "page_id", url: str = "url", html: str = "html",
    segment_chars: int = SEGMENT_CHARS, min_revisit: int = MIN_REVISIT_BYTES,
) -> None:
    """Write one record per row: a response, or a revisit of the response with an equal payload.

    Of records with equal payloads (SHA-1 and length) of at least `min_revisit` bytes, those of the largest
    page id are responses. A null payload is empty, a null id or URL has no header field; rows repeated
    in all three columns are records of equal identifier. An empty table writes an empty archive.
    """
    rows = pages.select(
        F.col(page).cast("bigint").alias("page"), F.regexp_replace(F.col(url), "[\r\n]", "").alias("url"),
        F.coalesce(F.col(html).cast("string"), F.lit("")).alias("payload"),
    ).select("*", F.sha1("payload").alias("digest"), F.octet_length("payload").cast("bigint").alias("bytes"))
    groups = (
        rows.filter(F.col("bytes") >= min_revisit).groupBy("digest", "bytes")
        .agg(F.max(F.struct("page", "url")).alias("top"), F.count(F.lit(1)).alias("copies")).filter("copies > 1")
        .select(F.col("digest").alias("g_digest"), F.col("bytes").alias("g_bytes"), "top")
    )
    joined = rows.join(groups, (F.col("digest") == F.col("g_digest")) & (F.col("bytes") == F.col("g_bytes")), "left")
    again = F.col("top").isNotNull() & ~F.col("page").eqNullSafe(F.col("top.page"))
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Transfer-Encoding: chunked{CRLF}{CRLF}"),
        F.when(again, F.lit("")).otherwise(_chunked(F.col("payload"))),
    )
    blocks = joined.select(
        "page", "url", "digest", again.alias("again"),
        _record_id(F.col("page"), F.col("url"), F.col("digest")).alias("id"),
        F.when(again, _record_id(F.col("top.page"), F.col("top.url"), F.col("digest"))).alias("refers"),
        F.octet_length(http).cast("string").alias("total"), _pieces(http, segment_chars).alias("segments"),
    )
    one = blocks.select("*", F.size("segments").alias("n"), F.posexplode("segments").alias("at", "block"))
    first, several = F.col("at") == 0, F.col("n") > 1
    own_id = F.when(first, F.col("id")).otherwise(_record_id(F.col("page"), F.concat_ws("#", "url", "at"), F.col("digest")))
    header = _header([
        ("WARC-Type", F.when(~first, "continuation").when(F.col("again"), "revisit").otherwise("response")),
        ("WARC-Record-ID", own_id),
        ("WARC-Date", F.lit(DATE)),
        ("WARC-Target-URI", F.col("url")),
        ("WARC-Page-ID", F.when(first, F.col("page").cast("string"))),
        ("WARC-Payload-Digest", F.when(first, F.concat(F.lit("sha1:"), F.col("digest")))),
        ("WARC-Refers-To", F.when(first, F.col("refers"))),
        ("WARC-Segment-Number", F.when(several, (F.col("at") + 1).cast("string"))),
        ("WARC-Segment-Origin-ID", F.when(~first, F.col("id"))),
        ("WARC-Segment-Total-Length", F.when(several & (F.col("at") + 1 == F.col("n")), F.col("total"))),
        ("Content-Type", F.when(first, "application/http; msgtype=response")),
        ("Content-Length", F.octet_length("block").cast("string")),
    ])
    (
        one.select(F.concat(header, "block").alias("value")).write.option("lineSep", RECORD_END)
        .option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(path)
    )


BATCH_BYTES = 4 << 20
READ_BYTES = 1 << 18


def unpacked(data: bytes) -> Iterator[bytes]:
    """The contents of an archive piece by piece, those of all members of a gzip file one after the other.

    ValueError for a damaged or truncated member.
    """
    view = memoryview(data)
    pieces = (view[k : k + READ_BYTES] for k in range(0, len(view), READ_BYTES))
    if data[:2] != b"\x1f\x8b":
        yield from map(bytes, pieces)
        return
    member = zlib.decompressobj(zlib.MAX_WBITS | 16)
    started = False
    for piece in pieces:
        rest = bytes(piece)
        while rest:
            started = True
            try:
                yield member.decompress(rest)
            except zlib.error as e:
                raise ValueError(f"damaged gzip member: {e}") from e
            rest = member.unused_data
            if member.eof:
                member, started = zlib.decompressobj(zlib.MAX_WBITS | 16), False
    if started:
        raise ValueError("gzip member cut short")


def parse_records(data: bytes) -> Iterator[tuple]:
    """The records of an archive in the order of RECORD_FIELDS, read one by one. ValueError if it is damaged."""
    source, held, passed = unpacked(data), bytearray(), 0

    def more() -> bool:
        piece = next(source, None)
        held.extend(piece or b"")
        return piece is not None

    while held or more():
        if not held:
            continue
        end = -1
        while (end := held.find(b"\r\n\r\n", max(0, end))) < 0 and more():
            pass
        if end < 0 or not held.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {passed}")
        lines = held[:end].decode("utf-8", "replace").split(CRLF)[1:]
        h = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
        for name in ("warc-type", "warc-record-id", "content-length"):
            if name not in h:
                raise ValueError(f"record at byte {passed} has no {name}")
        number = lambda k: int(h[k]) if k in h else None
        start, stop = end + 4, end + 4 + int(h["content-length"])
        while len(held) < stop + 4 and more():
            pass
        if held[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at byte {passed} has another length than it says")
        yield (
            h["warc-type"], h["warc-record-id"], number("warc-page-id"), h.get("warc-payload-digest", "").removeprefix("sha1:"),
            h.get("warc-refers-to"), number("warc-segment-number"), h.get("warc-segment-origin-id"),
            number("warc-segment-total-length"), bytes(held[start:stop]),
        )
        del held[: stop + 4]
        passed += stop + 4


def dechunk(body: bytes) -> bytes:
    """The body without chunked transfer framing. ValueError if a chunk is cut short."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk without a size")
        size = int(body[at:end].split(b";")[0], 16)
        if size < 0:
            raise ValueError("chunk of a negative size")
        if size == 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        if len(out[-1]) != size or body[end + 2 + size : end + 4 + size] != b"\r\n":
            raise ValueError("chunk cut short")
        at = end + 4 + size


def payload_of(block: bytes) -> bytes:
    """The payload of an HTTP response block."""
    head, _, body = block.partition(b"\r\n\r\n")
    return dechunk(body) if b"transfer-encoding: chunked" in head.lower() else body


_HEAD = [("type", pa.string()), ("id", pa.string()), ("page", pa.int64()), ("digest", pa.string()), ("refers", pa.string()),
         ("segment", pa.int32()), ("origin", pa.string()), ("total", pa.int64()), ("block", pa.binary())]
_PAYLOAD = [("bytes", pa.int64()), ("sha1", pa.string()), ("payload", pa.binary())]
RECORDS = (
    "type string, id string, page bigint, digest string, refers string, segment int, origin string, total bigint, "
    "block binary, bytes bigint, sha1 string, payload binary"
)


def _payload_columns(block: bytes, with_payload: bool) -> tuple:
    """Length, SHA-1 and payload; nulls where the body's framing is damaged."""
    try:
        payload = payload_of(block)
    except ValueError:
        return None, None, None
    return len(payload), hashlib.sha1(payload, usedforsecurity=False).hexdigest(), payload if with_payload else None


def _parse(with_payload: bool):
    """Archive contents to records. A whole response is decoded at once and its block dropped."""
    fields = _HEAD + _PAYLOAD

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, (_, t) in zip(zip(*rows), fields)], names=[n for n, _ in fields]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for record in parse_records(content.as_py()):
                    whole = record[0] == "response" and record[5] is None
                    if whole:
                        row = record[:-1] + (None, *_payload_columns(record[-1], with_payload))
                    else:
                        row = (record if record[5] is not None else record[:-1] + (None,)) + (None, None, None)
                    rows.append(row)
                    size += sum(len(x) for x in (row[8], row[11]) if x)
                    if size >= BATCH_BYTES or len(rows) >= 2000:
                        yield batch_of(rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    return run


def _decode(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = zip(batch.column("block").to_pylist(), batch.column("complete").to_pylist())
            decoded = [_payload_columns(block, with_payload) if complete else (None,) * 3 for block, complete in blocks]
            decoded = list(zip(*decoded)) or [()] * 3
            added = [pa.array(c, t) for c, (_, t) in zip(decoded, _PAYLOAD)]
            kept = ["id", "page", "digest", "complete", "copies"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + added, names=kept + [n for n, _ in _PAYLOAD]
            )

    return run


def reassemble(records: DataFrame) -> DataFrame:
    """Segments of a record put together: id, page, digest, block, complete, copies.

    Equal segments of repeated records meet as one, so a group never holds more than one record's bytes.
    """
    parts = records.filter("segment IS NOT NULL").groupBy(F.coalesce("origin", "id").alias("id")).agg(
        F.max("page").alias("page"), F.max(F.when(F.col("segment") == 1, F.col("digest"))).alias("digest"),
        F.sort_array(F.collect_set(F.struct("segment", "block"))).alias("parts"), F.max("total").alias("total"),
        F.count_if(F.col("segment") == 1).cast("int").alias("copies"),
    )
    block = F.array_join(F.transform("parts", lambda p: p["block"].cast("string")), "").cast("binary")
    ordered = (F.size("parts") == F.element_at("parts", -1)["segment"]) & (F.element_at("parts", 1)["segment"] == 1)
    complete = F.coalesce(ordered & (F.octet_length(block) == F.coalesce("total", F.lit(-1))), F.lit(False))
    return parts.select("id", "page", "digest", block.alias("block"), complete.alias("complete"), "copies")


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """One row per response or revisit record of the archives in a folder.

    Columns: page_id, payload_bytes, payload_digest (both of the full payload; a revisit has its
    response's length), record_type, refers_to (page of the response, for revisits), intact (digest, order
    and total length agree), payload (null unless asked for, and for revisits). A record that lacks a segment or
    whose chunked body is damaged has no length, digest or payload and is not intact; an archive in which
    the records themselves cannot be told apart raises an error. A revisit whose response is missing has its digest, but no length.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    records = stage(files.mapInArrow(_parse(with_payload), RECORDS), "warc-records")
    columns = ["id", "page", "bytes", "sha1", "payload"]
    intact = F.coalesce(F.col("digest") == F.col("sha1"), F.lit(False)).alias("intact")
    whole = records.filter("type = 'response' AND segment IS NULL").select(*columns, intact)
    assembled = reassemble(records).mapInArrow(
        _decode(with_payload),
        "id string, page bigint, digest string, complete boolean, copies int, bytes bigint, sha1 string, payload binary",
    )
    # Repeated records came together as one; they are counted out again.
    copied = assembled.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select(
        *columns, (F.col("complete") & F.coalesce(F.col("digest") == F.col("sha1"), F.lit(False))).alias("intact")
    )
    responses = stage(whole.unionByName(copied), "warc-responses")
    origins = responses.groupBy("id").agg(
        F.max("page").alias("o_page"), F.max("bytes").alias("o_bytes"), F.bool_and("intact").alias("o_intact"), F.max("sha1").alias("o_sha1")
    ).withColumnRenamed("id", "o_id")
    revisits = records.filter("type = 'revisit'").join(origins, F.col("refers") == F.col("o_id"), "left")
    same = F.coalesce(F.col("o_intact") & (F.col("digest") == F.col("o_sha1")), F.lit(False))
    return responses.select(
        F.col("page").alias("page_id"), F.col("bytes").alias("payload_bytes"), F.col("sha1").alias("payload_digest"),
        F.lit("response").alias("record_type"), F.lit(None).cast("bigint").alias("refers_to"), "intact", "payload",
    ).unionByName(revisits.select(
        F.col("page").alias("page_id"), F.col("o_bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"),
        F.lit("revisit").alias("record_type"), F.col("o_page").alias("refers_to"), same.alias("intact"),
        F.lit(None).cast("binary").alias("payload"),
    ))


def pages_through_archives(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder, and read these."""
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
