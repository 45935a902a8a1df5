"""Operators over documents against plain Python, on edge cases and on the small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

import edges
from tillwise.llm import decontamination, katz_lm, licenses, line_dedup, near_dedup, quality_rules, sentencepiece_codec, substring_dedup
from tillwise.llm.common import prepare, split_words
from tillwise.llm.queries import TOKENIZER

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


@pytest.fixture(scope="module")
def docs(spark):
    prepare(spark)
    return edges.table(spark)


def key_of(row):
    return (row["doc_id"] is None, row["doc_id"], row["text"] is None, row["text"])


# --- quality rules ---------------------------------------------------------------------------

def repeated(words):
    windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    count = Counter(windows)
    return len({k + j for k, w in enumerate(windows) if count[w] > 1 for j in range(8)})


def test_quality_measures(spark, docs):
    got = quality_rules.apply_rules(docs, carry=("doc_id", "text")).collect()
    assert len(got) == docs.count()
    for r in got:
        text = r["row"]["text"] or ""
        words = SPACE.findall(text)
        lines = [x for x in text.split("\n") if SPACE.search(x)]
        n = repeated(words)
        assert (r["n_words"], r["word_chars"], r["n_symbols"]) == (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text))
        assert (r["n_dup_lines"], r["n_repeat_words"]) == (len(lines) - len(set(lines)), n)
        assert r["base_failed"] == (len(words) < 20 or 100 * n > 30 * len(words))
        if r["kept"]:
            assert not r["base_failed"]


def test_bad_host_takes_only_failing_documents(spark):
    good = " ".join(edges.words(60, 5))
    symbols = " ".join(f"# {w}" for w in edges.words(60, 6))
    rows = [(k, "short", "bad") for k in range(40)] + [(100, good, "bad"), (101, symbols, "bad")]
    rows += [(200 + k, good, "fine") for k in range(40)] + [(300, symbols, "fine")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    kept = {r["row"]["doc_id"]: r["kept"] for r in quality_rules.apply_rules(df).collect()}
    assert kept[100] and kept[200] and kept[300]  # clean, or in a good host
    assert not kept[101] and not kept[0]


def test_rule_that_many_of_a_host_fail_is_not_let_off(spark):
    """At ordinary rates: one in five documents fails the symbol rule in one host, one in fifty in the others."""
    good, symbols = " ".join(edges.words(60, 5)), " ".join(f"# {w}" for w in edges.words(60, 6))
    rows = [(1000 * h + k, symbols if k % (5 if h == 0 else 50) == 0 else good, f"h{h}") for h in range(8) for k in range(200)]
    out = quality_rules.apply_rules(spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()
    dropped = {r["row"]["doc_id"] for r in out if not r["kept"]}
    assert dropped == set(range(0, 200, 5)) and not any(r["host_bad"] or r["base_failed"] for r in out)


def test_quality_stage_keeps_columns(spark, docs):
    out = quality_rules.quality_stage(docs)
    assert out.columns == docs.columns
    assert quality_rules.quality_stage(edges.empty(spark)).count() == 0


# --- lines -----------------------------------------------------------------------------------

def line_brute(rows, min_docs):
    found = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            k = low(x.strip(" \t\n\x0b\x0c\r"))
            if k:
                found[k].add((i, t))
    common = {k for k, v in found.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if low(x.strip(" \t\n\x0b\x0c\r")) not in common]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(spark, docs):
    cut = line_dedup.apply_bitmaps(docs, line_dedup.keep_bitmaps(docs))
    got = [(r["row"]["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in cut.collect()]
    order = lambda x: tuple(map(str, x))
    assert sorted(got, key=order) == sorted(line_brute(edges.texts(), 10), key=order)
    assert line_dedup.keep_bitmaps(edges.empty(spark)).count() == 0


def test_line_dedup_keeps_first(spark):
    df = spark.createDataFrame([(1, "A\nb\na"), (2, "a\nc"), (3, None)], "doc_id bigint, text string")
    cut = line_dedup.apply_bitmaps(df, line_dedup.keep_bitmaps(df, min_docs=2, keep_first=True))
    assert {r["row"]["doc_id"]: r["kept_text"] for r in cut.collect()} == {1: "A\nb", 2: "c", 3: ""}


def test_line_stage(spark, docs):
    out = line_dedup.line_dedup_stage(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    row = out.filter("doc_id = 100").first()
    assert not row["text"].startswith("  Shared") and row["n_chars"] == len(row["text"])


def test_line_stage_leaves_a_full_copy(spark):
    copied = "First of many\n\nsecond of many\nFirst of many"
    rows = [(k, copied) for k in range(20, 32)] + [(50 + k, f"second of many\nown line {k}") for k in range(3)]
    rows += [(90, "FIRST of many"), (91, ""), (92, None), (19, "second of many\nown")]
    got = {r["doc_id"]: (r["text"], r["n_chars"]) for r in line_dedup.line_dedup_stage(edges.table(spark, rows)).collect()}
    assert got.pop(20) == (copied, len(copied))
    assert got == {**{50 + k: (f"own line {k}", 10) for k in range(3)}, 91: ("", 0), 92: (None, None), 19: ("own", 3)}


# --- near duplicates --------------------------------------------------------------------------

def shingle_set(text):
    w = low(text or "")
    w = SPACE.findall(w)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def groups_brute(rows, pct):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= pct * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return [(i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)]


def near_rows():
    """Chains and stars: copies whose likeness to each other is around the limit."""
    rows = edges.texts()
    base = edges.words(100, 50)
    for k in range(25):  # each a few words away from the base, further from each other
        w = list(base)
        for j in range(k % 3 + 1):
            w[(7 * k + 31 * j) % 100] = f"new{k}_{j}"
        rows.append((1000 + k, " ".join(w)))
    chain = edges.words(150, 51)
    for k in range(12):
        chain = [*chain[2:], f"c{k}a", f"c{k}b"]
        rows.append((2000 + k, " ".join(chain)))
    return rows


@pytest.mark.parametrize("pct", [80, 85])
def test_near_duplicates(spark, pct):
    rows = near_rows()
    got = near_dedup.near_duplicates(edges.table(spark, rows), min_pct=pct).collect()
    order = lambda x: tuple(map(str, x))
    assert sorted([(r["id"], r["n_shingles"], r["component_id"]) for r in got], key=order) == sorted(groups_brute(rows, pct), key=order)
    assert all(r["kept"] == (r["id"] == r["component_id"]) for r in got)


def test_near_stage_leaves_one_of_each(spark):
    rows = near_rows()
    out = near_dedup.near_dedup_stage(edges.table(spark, rows))
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(x for x in ids if x is not None) == sorted({c for i, _, c in groups_brute(rows, 80) if c is not None})
    assert near_dedup.near_dedup_stage(edges.empty(spark)).count() == 0


def test_near_stage_leaves_one_row_where_ids_repeat_or_are_missing(spark):
    rows = []
    for i, seed in ((5, 90), (None, 91)):
        base = edges.words(100, seed)
        rows += [(i, " ".join([*base[:50], f"new{k}", *base[51:]])) for k in range(3)]
    rows += [(None, rows[0][1] + " end"), (6, ""), (None, "unlike all others"), (None, "unlike all others")]
    ids = [r["doc_id"] for r in near_dedup.near_dedup_stage(edges.table(spark, rows)).collect()]
    assert sorted(map(str, ids)) == ["5", "6", "None", "None"]


# --- decontamination --------------------------------------------------------------------------

def passages_brute(rows, items):
    windows = defaultdict(set)
    for item, t in items:
        w = PLAIN.findall(low(t or ""))
        for k in range(max(1, len(w) - 9) if w else 0):
            windows[tuple(w[k : k + 10])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for i, t in rows:
        w = PLAIN.findall(low(t or ""))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (x := tuple(w[k : k + n])) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[x]
        names = sorted(str(x) for x in found if x is not None)
        out.append((i, len(w), len(hit), names, bool(hit)))
    return out


@pytest.mark.parametrize("block_words", [2_000_000, 15])
def test_decontamination(spark, docs, block_words):
    base = edges.words(120, 1)
    items = [(1, " ".join(base[10:40])), (20, " ".join(base[35:50]).upper()), (3, "two three"), (4, ""), (5, None),
             (6, " ".join(base[100:]) + " more words than the document has"), (7, "日本"), (None, "one two"), (1, " ".join(base[10:40]))]
    df = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id bigint, text string, row int")
    got = decontamination.verdicts(decontamination.find_passages(docs, df, block_words=block_words)).collect()
    order = lambda x: tuple(map(str, x))
    mine = [(r["row"]["doc_id"], r["n_words"], r["n_hit"], list(r["items"]), r["contaminated"]) for r in got]
    assert sorted(mine, key=order) == sorted(passages_brute(edges.texts(), items), key=order)


def test_longest_match_and_empty_benchmark(spark, docs):
    base = edges.words(120, 1)
    df = spark.createDataFrame([(1, " ".join(base[10:40]))], "item_id bigint, text string")
    spans = {r["row"]["doc_id"]: r["spans"] for r in decontamination.find_passages(docs, df).collect()}
    assert [tuple(s) for s in spans[1]] == [(1, 10, 40, 30)]
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.decontaminate_stage(docs, none).count() == docs.count()


def test_repeated_words_cost_no_more_than_others(spark):
    """400 equal words against 100,000: every window of the item is the same, and so are all places."""
    import time

    items = [(1, b"a " * 400), (2, b"a b " * 200), (3, b"x y z " * 50 + b"end")]
    block = decontamination.BenchmarkBlock(items)
    assert len(block.starts) == 1 + 2 + 4
    rows = [(1, "a " * 100_000), (2, "b a " * 30_000), (3, "q " + "y z x " * 60 + "q")]
    df = spark.createDataFrame([(i, t.decode()) for i, t in items], "item_id bigint, text string")
    began = time.time()
    got = {r["row"]["doc_id"]: [tuple(s) for s in r["spans"]] for r in decontamination.find_passages(edges.table(spark, rows), df).collect()}
    assert time.time() - began < 20
    assert got == {1: [(1, 0, 100_000, 400)], 2: [(2, 0, 60_000, 400)], 3: [(3, 1, 181, 150)]}


def longest_brute(item, words):
    return max((n for a in range(len(words)) for n in range(1, len(words) - a + 1)
                if any(item[k : k + n] == words[a : a + n] for k in range(len(item) - n + 1))), default=0)


def test_longest_run_of_an_item():
    import random

    r = random.Random(4)
    for _ in range(60):
        item, words = ([r.randrange(1, 4) for _ in range(r.randrange(1, 14))] for _ in range(2))
        block = decontamination.BenchmarkBlock([(1, " ".join(map(str, item)).encode())], window=3)
        numbers = [block.number.get(str(w).encode(), 0) for w in words]
        assert block.longest(0, numbers) == longest_brute(item, words)


# --- SentencePiece ----------------------------------------------------------------------------

def test_encoding_equals_the_library(spark, docs):
    coded = sentencepiece_codec.encode(docs, TOKENIZER, carry=("doc_id", "text")).collect()
    texts = [r["row"]["text"] for r in coded]
    expected = sentencepiece_codec.reference_encode(TOKENIZER, [t or "" for t in texts])
    for r, t, e in zip(coded, texts, expected):
        assert r["ids"] == (None if t is None else e)
        assert r["round_trip"] == (None if t is None else "▁" not in t)


def test_unigram_model(tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(sentencepiece_codec.load_model(TOKENIZER))
    proto.trainer_spec.model_type = 1
    for k, p in enumerate(proto.pieces):
        if p.type == 1:
            p.score = -math.log(k + 2.5) - 3
    data = proto.SerializeToString()
    library = sentencepiece.SentencePieceProcessor(model_proto=data)
    lattice = sentencepiece_codec.Lattice(data)
    texts = [t for _, t in edges.texts() if t]
    mine = sentencepiece_codec.Encoder(lattice).encode(texts)

    def value(ids):
        return sum(lattice.score[i] for i in ids)

    for t, a, b in zip(texts, mine, library.encode(texts)):
        assert lattice.decode(a) == library.decode(b)
        assert a == b or math.isclose(value(a), value(b), rel_tol=1e-5)  # equal paths, or a tie in single precision


def test_decoding(spark, docs):
    coded = sentencepiece_codec.encode(docs, TOKENIZER, carry=("doc_id", "text")).select("row.*", "ids")
    for r in sentencepiece_codec.decode(coded, TOKENIZER, carry=("text",)).collect():
        assert r["text"] == (None if r["row"]["text"] is None else r["row"]["text"].replace("▁", " "))


def test_encode_stage(spark, docs):
    out = sentencepiece_codec.encode_stage(docs, TOKENIZER)
    assert out.columns[: len(docs.columns)] == docs.columns and out.columns[-3:] == ["token_ids_", "n_tokens_", "round_trip_"]
    assert sentencepiece_codec.encode_stage(edges.empty(spark), TOKENIZER).count() == 0


# --- passages ---------------------------------------------------------------------------------

def test_substring_dedup(spark):
    passage = " ".join(edges.words(30, 70)) + ". " + " ".join(edges.words(30, 71)) + "."
    rows = [(1, f"Start one. {passage} End one."), (2, f"Begin. {passage.upper()} Stop."), (3, "Start one. Unlike all others."),
            (3, "Start one. Unlike all others."), (4, None), (5, ""), (None, "alone")]
    got = {(r["row"]["doc_id"], r["row"]["text"]): r for r in substring_dedup.remove_passages(edges.table(spark, rows), carry=("doc_id", "text")).collect()}
    assert got[1, rows[0][1]]["spans"] == []
    second = got[2, rows[1][1]]
    (span,) = second["spans"]
    assert rows[1][1][span["start"] : span["end"]].strip() == passage.upper()
    assert second["kept_text"] == "Begin. " + " Stop.".lstrip() or second["kept_text"].split() == ["Begin.", "Stop."]
    assert got[3, rows[2][1]]["spans"] == [] and got[4, None]["kept_text"] is None
    assert substring_dedup.remove_passages(edges.empty(spark)).count() == 0


def passages_removed(rows, min_words=20):
    """Per row the kept text, by looking every sentence up among all earlier ones."""
    ends = re.compile(r"\n|[.!?]+(?=\s)")
    cut, first = [], {}
    for i, t in rows:
        out, start = [], 0
        for m in [*ends.finditer(t or ""), None]:
            end = m.end() if m else len(t or "")
            w = tuple(PLAIN.findall(low((t or "")[start:end])))
            if w:
                out.append((w, start, end))
            start = end
        cut.append(out)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0))
    for k in order:
        for p, (w, _, _) in enumerate(cut[k]):
            first.setdefault(w, (rows[k], p))
    kept = []
    for (i, t), out in zip(rows, cut):
        drop, group = [], []
        for p, (w, a, b) in enumerate([*out, (None, 0, 0)]):
            if w is not None and first[w] != ((i, t), p):
                group.append((w, a, b))
                continue
            if sum(len(g[0]) for g in group) >= min_words:
                drop.append((group[0][1], group[-1][2]))
            group = []
        text, at = "", 0
        for a, b in drop:
            text, at = text + t[at:a], b
        kept.append((i, None if t is None else text + t[at:]))
    return kept


def test_passages_against_brute_force(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    rows += [(9000 + k, t) for k, (_, t) in enumerate(edges.texts())] + [(None, rows[0][1] + " More words here.")]
    got = [(r["row"]["doc_id"], r["kept_text"]) for r in substring_dedup.remove_passages(edges.table(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, passages_removed(rows)))


@pytest.mark.parametrize("kind", ["line", "paragraph"])
def test_other_units(spark, kind):
    rows = [(1, "First line is short\n\n" + " ".join(edges.words(30, 1))), (2, " ".join(edges.words(30, 1)).upper() + "\n\nNew end")]
    got = {r["row"]["doc_id"]: r["kept_text"] for r in substring_dedup.remove_passages(edges.table(spark, rows), kind=kind).collect()}
    assert got == {1: rows[0][1], 2: "New end" if kind == "paragraph" else "\nNew end"}


# --- licences ---------------------------------------------------------------------------------

def test_license_places(spark):
    rows = [(1, "Under the MIT License, or CC-BY cc by."), (2, "apache license"), (3, None), (4, "limit license mit licenses"),
            (5, "GNU General Public License, version 3"), (None, "SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND Apache-2.0"),
            (6, "// SPDX-License-Identifier: GPL-2.0-only WITH Classpath-exception-2.0"), (7, "SPDX-License-Identifier: (MIT OR"), (8, "")]
    got = {r["row"]["doc_id"]: r for r in licenses.scan_licenses(edges.table(spark, rows)).collect()}
    assert (got[1]["n_base"], got[1]["first_word"], got[1]["last_word"], got[1]["base_labels"]) == (3, 2, 7, "cc-by,mit")
    assert got[2]["base_labels"] == "apache" and got[3]["n_words"] == 0 and got[3]["first_word"] is None
    assert got[4]["n_base"] == 0 and got[4]["labels"] == "" and got[4]["score"] == 0
    assert got[5]["labels"] == "gpl,gpl-3.0"
    assert got[None]["labels"] == "apache-2.0,gpl-2.0-only,mit" and got[None]["duty"] == "permissive" and got[None]["score"] == 1
    assert got[6]["labels"] == "gpl-2.0-only" and got[6]["duty"] == "weak-copyleft"
    assert got[7]["duty"] is None and 0 < got[7]["score"] < 1


def test_unknown_identifiers_are_no_licences(spark):
    tag = "SPDX-License-Identifier: "
    rows = [(1, tag + "banana AND cabbage"), (2, tag + "MIT OR banana"), (3, tag + "MIT WITH MIT"), (4, tag + "GPL-2.0-only WITH banana"),
            (5, tag + "LicenseRef-Own-1 OR mit"), (6, tag + "Classpath-exception-2.0"), (7, tag + "GPL-3.0+ AND (Zlib OR X11)")]
    got = {r["row"]["doc_id"]: (r["labels"], r["score"], r["duty"]) for r in licenses.scan_licenses(edges.table(spark, rows)).collect()}
    assert all(got[k] == ("", 0.5, None) for k in (1, 2, 3, 4, 6))
    assert got[5] == ("licenseref-own-1,mit", 1.0, "permissive") and got[7][:2] == ("gpl-3.0+,x11,zlib", 1.0)


def test_broken_bytes_end_no_scan():
    found = licenses.Scanner().scan(b"\xff\xfe the MIT license \xc3")
    assert found["base_labels"] == "mit" and found["n_base"] == 1


def test_licenses_against_brute_force(spark):
    """Every phrase looked up at every word of every document."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()] + edges.texts()
    rows += [(7000, "cc by cc by cc-by-nc 4.0 MIT license mit"), (7001, "the apache license version 2 0 bsd 3 clause ISC License")]
    phrases = {tuple(p.split()): (p in licenses.BASE, label) for p, label in (licenses.BASE | licenses.NOTICES).items()}
    expected = []
    for i, t in rows:
        w = PLAIN.findall(low(t or ""))
        places, labels = [], set()
        for k in range(len(w)):
            for p, (base, label) in phrases.items():
                if tuple(w[k : k + len(p)]) == p:
                    labels.add(label)
                    places += [(k, label)] if base else []
        expected.append((i, len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None,
                         ",".join(sorted({x for _, x in places})), ",".join(sorted(labels))))
    got = [(r["row"]["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"], r["labels"])
           for r in licenses.scan_licenses(edges.table(spark, rows)).collect()]
    assert sorted(map(str, got)) == sorted(map(str, expected)) and sum(g[2] > 0 for g in got) > 20


@pytest.mark.parametrize("text, order", [
    ("MIT", ["mit"]), ("A OR B AND C", ["a", "b", "c", "and", "or"]), ("(A OR B) AND C", ["a", "b", "or", "c", "and"]),
    ("A WITH E OR B", ["a", "e", "with", "b", "or"]), ("A B", None), ("", None), ("(A", None), ("A)", None), ("OR A", None), ("A AND", None), ("()", None),
])
def test_shunting_yard(text, order):
    assert licenses.postfix(text) == order


# --- language model ---------------------------------------------------------------------------

def katz_brute(rows):
    uni, bi, seqs = Counter(), Counter(), []
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), 1]
        seqs.append((i, w))
        if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2:
            uni.update(w)
            bi.update(zip([0, *w], w))
    total, distinct = sum(uni.values()), len(uni)
    du, db = katz_lm.discounts(Counter(uni.values())), katz_lm.discounts(Counter(bi.values()))
    cut = lambda d, c: d[min(c, len(d) - 1)] * c
    whole = math.fsum(cut(du, c) for c in uni.values())
    norm = total + (whole >= total)
    prob = lambda w: cut(du, uni[w]) / norm if w in uni else 1 - whole / norm
    ctx, kept, after = Counter(), defaultdict(float), defaultdict(set)
    for (v, w), c in bi.items():
        ctx[v] += c
        kept[v] += cut(db, c)
        after[v].add(w)
    out = {}
    below = {v: math.fsum(map(prob, ws)) for v, ws in after.items()}

    def pair(v, w):
        if v not in ctx:
            return prob(w)
        size = ctx[v] + (kept[v] >= ctx[v])
        return cut(db, bi[v, w]) / size if bi.get((v, w)) else (1 - kept[v] / size) / (1 - below[v]) * prob(w)

    for v in list(ctx)[:20]:  # exactly normalised over all words and the unknown one
        assert math.isclose(math.fsum(pair(v, w) for w in [*uni, "?"]), 1, rel_tol=1e-9)
    for i, w in seqs:
        out.setdefault(i, []).append((
            len(w), sum(uni[x] > 0 for x in w), total, sum(math.log10((uni[x] + 1) / (total + distinct + 1)) for x in w),
            sum(math.log10(pair(v, x)) for v, x in zip([0, *w], w)),
        ))
    return out


@pytest.mark.parametrize("hot", [2048, 5, 0])
def test_katz(spark, hot):
    rows = edges.texts() + [(k, " ".join(edges.words(80, k, 60))) for k in range(500, 560)]
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    options = {"block_tokens": 500, "word_entries": 3000, "pair_tokens": 3000, "hot": hot}
    got = katz_lm.score(edges.table(spark, rows), held_out, **options).collect()
    expected = katz_brute(rows)
    assert len(got) == len(rows)
    for r in got:
        mine = (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
        assert any(mine[:3] == e[:3] and mine[3:] == pytest.approx(e[3:], rel=1e-9) for e in expected[r["doc_id"]])


def test_katz_deals_out_pairs_after_unknown_words():
    unigrams = katz_lm.Unigrams(np.array([3]), np.array([0]), {3: 1})
    numbers = np.array([katz_lm.UNKNOWN_ID, katz_lm.UNKNOWN_ID, 0] * 40, np.uint32)
    rows = [{"block": b << 32, "train": [False], "lengths": [len(numbers)], "slices": [{"bucket": 0, "numbers": numbers.tobytes()}],
             "tokens": zstandard.compress(np.arange(len(numbers), dtype=np.uint32).tobytes())} for b in range(32)]
    used = {}
    for out in katz_lm._pairs(SimpleNamespace(value=unigrams), 8, 0)([pa.RecordBatch.from_pylist(rows)]):
        for bucket, pairs in zip(out["bucket"].to_pylist(), out["pairs"].to_pylist()):
            chunk = katz_lm._unpack_chunk(pairs)
            for w, n in zip(chunk["w"][chunk["v"] == katz_lm.UNKNOWN_ID], chunk["places"][chunk["v"] == katz_lm.UNKNOWN_ID]):
                used.setdefault(int(w), Counter())[bucket] += int(n)
    assert set(used) == {0, katz_lm.UNKNOWN_ID}
    assert all(max(x.values()) < 0.5 * sum(x.values()) for x in used.values())


def test_katz_with_nothing_learned(spark):
    assert katz_lm.score(edges.empty(spark), F.lit(False)).count() == 0
    row = katz_lm.score(edges.table(spark, [(1, "a b")]), F.lit(True)).first()
    assert (row["train_tokens"], row["score"], row["base_score"], row["n_known"]) == (0, 0.0, 0.0, 0)


def test_split_words():
    assert split_words("A-b_c É1\x00ü".encode()) == [b"a", b"b", b"c", "É1".encode(), "ü".encode()]
    assert hashlib.sha256(b"").hexdigest()  # the digest of no items


def test_encoder_takes_a_batch_in_parts(monkeypatch):
    """Only a part's words are held as Python objects at a time; the rows stay whole and in order."""
    from types import SimpleNamespace

    import pyarrow as pa

    sizes, encode = [], sentencepiece_codec.Encoder.encode
    monkeypatch.setattr(sentencepiece_codec.Encoder, "encode", lambda self, texts: sizes.append(len(texts)) or encode(self, texts))
    n = 2 * sentencepiece_codec.PART_ROWS + 1
    texts = [f"word {i}" if i % 7 else None for i in range(n)]
    batch = pa.RecordBatch.from_arrays([pa.array([{"doc_id": i} for i in range(n)]), pa.array(texts)], names=["row", "body"])
    run = sentencepiece_codec._encode(SimpleNamespace(value=sentencepiece_codec.load_model(TOKENIZER)))
    out = [r for b in run(iter([batch, batch.slice(0, 0)])) for r in b.to_pylist()]
    assert max(sizes) == sentencepiece_codec.PART_ROWS and [r["row"]["doc_id"] for r in out] == list(range(n))
    assert [r["ids"] for r in out if r["ids"] is not None] == sentencepiece_codec.reference_encode(TOKENIZER, [t for t in texts if t is not None])


def test_encoder_searches_a_word_once_in_a_worker(monkeypatch):
    """A later task knows the words of an earlier one, and a stop is no part of the word before it."""
    from types import SimpleNamespace

    import pyarrow as pa

    searched, search = [], sentencepiece_codec.Lattice.encode_sorted
    monkeypatch.setattr(sentencepiece_codec.Lattice, "encode_sorted", lambda self, words: searched.extend(words) or search(self, words))
    texts = ["qorvex qorvex. qorvex, sqorvex!", "", None, "qorvex. x.com 3.5 É.É (qorvex)", "..a ▁b.c  d.\ne.f"]
    batch = pa.RecordBatch.from_arrays([pa.array([{"doc_id": i} for i in range(len(texts))]), pa.array(texts)], names=["row", "body"])
    model = sentencepiece_codec.load_model(TOKENIZER)
    for _ in range(2):
        out = [r for b in sentencepiece_codec._encode(SimpleNamespace(value=model))(iter([batch.slice(0, 4)])) for r in b.to_pylist()]
        assert [r["ids"] for r in out if r["ids"] is not None] == sentencepiece_codec.reference_encode(TOKENIZER, [t for t in texts[:4] if t is not None])
    assert searched.count("▁qorvex") == 1 and "▁qorvex." not in searched
    lattice = sentencepiece_codec.Lattice(model)
    for as_bytes in (False, True):
        ids = sentencepiece_codec.Encoder(lattice, as_bytes=as_bytes).encode(texts)[-1]
        assert (np.frombuffer(ids, np.int32).tolist() if as_bytes else ids) == sentencepiece_codec.reference_encode(TOKENIZER, texts[-1:])[0]
