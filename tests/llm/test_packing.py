"""Packing: every id in exactly one piece, no gaps, little padding; the tokenizer's ids; plans for awkward histograms."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import edges
from tillwise.llm import packing
from tillwise.llm.common import prepare
from tillwise.llm.queries import WORD_TOKENIZER, op13_packing


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(WORD_TOKENIZER)


def whole_ids(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 1]


def check(rows, texts, library, size=2048):
    """rows: (text key, start, length, crc, doc_tokens, sequence, offset)."""
    ids = {k: np.array(whole_ids(library, t), "<u4") for k, t in texts.items()}
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for key, start, length, crc, total, sequence, offset in rows:
        assert total == len(ids[key]) and crc == zlib.crc32(ids[key][start : start + length].tobytes())
        by_doc[key].append((start, length))
        by_sequence[sequence].append((offset, length))
    assert set(by_doc) == set(texts)
    for key, parts in by_doc.items():
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == len(ids[key])
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    total = sum(map(len, ids.values()))
    return 1 - total / (size * len(by_sequence)), len(rows)


def test_query_packs_every_id_once(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = [tuple(r) for r in op13_packing(spark, folder).collect()]
    padding, _ = check(rows, texts, library)
    assert padding < 0.02


def test_small_sequences_and_edges(spark, library):
    prepare(spark)
    docs = edges.table(spark)
    out = packing.pack(docs, WORD_TOKENIZER, carry=("doc_id", "text"), size=64, width=4).collect()
    rows = [((r["row"]["doc_id"], r["row"]["text"]), *[r[c] for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]) for r in out]
    # The table holds one row twice: its pieces come twice.
    twice = [r for r in rows if r[0][0] == 1]
    keys = {}
    for r in sorted(twice, key=lambda r: (r[1], r[5], r[6])):
        keys.setdefault(r[1:3], []).append(r)
    assert sum(r[2] for r in twice) == 2 * twice[0][4]
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r[5]].append((r[6], r[2]))
    for parts in by_sequence.values():
        assert sum(n for _, n in parts) <= 64 and sorted(parts)[0][0] == 0
    rest = [r for r in rows if r[0][0] != 1]
    texts = {(i, t): t for i, t in edges.texts() if i != 1}
    ids = {k: np.array(whole_ids(library, t), "<u4") for k, t in texts.items()}
    for key, start, length, crc, total, *_ in rest:
        assert total == len(ids[key]) and crc == zlib.crc32(ids[key][start : start + length].tobytes())
    assert sum(r[2] for r in rest) == sum(map(len, ids.values()))
    assert packing.pack(edges.empty(spark), WORD_TOKENIZER).count() == 0


def test_size_must_be_a_multiple_of_the_width(spark):
    with pytest.raises(ValueError):
        packing.pack(edges.empty(spark), WORD_TOKENIZER, size=100, width=8)


AWKWARD = [
    "It's THE end, isn't it? İstanbul ΣΑΣ ÀÉß café. J̌ é 3.14,15 (x) ... a.b.c.",
    "tab\tnew\nline\x0bvt\x0cff\x85nel nbsp em　wide sep", "unit\x1fsep\x1cfile", "<|endoftext|> <|ENDOFTEXT|> <|endoftext|>. x<|startoftext|>y",
    "日本語の 文章。 \U0001f389\U0001f389", "ªºµ ×÷ Word; word: WORD! word? .", "", "   ", "'s 't DON'T don't.", "a" * 3000,
]


def test_word_ids_equal_the_library(library):
    words = packing.WordTokens(WORD_TOKENIZER)
    for texts in (AWKWARD, AWKWARD[::-1], [t] if (t := " ".join(AWKWARD)) else []):
        for text, ids in zip(texts, words.ids(texts), strict=True):
            assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("aBéÉß'.,;!? \t\n\x1f1̌İ<|>Σ一"), max_size=30))
def test_any_text_equals_the_library(text):
    words = test_any_text_equals_the_library.words
    assert words.ids([text])[0].tolist() == words.library.encode(text, add_special_tokens=False).ids


test_any_text_equals_the_library.words = packing.WordTokens(WORD_TOKENIZER)


def placed(demand, lengths, capacity, width):
    classes = -(-lengths // width)
    plan = packing.make_plan(demand, capacity)
    ranks = packing._running(classes, np.zeros(capacity + 1, np.int64))
    sub = packing.place_pieces(plan, classes, ranks, lengths, width)
    fill = np.bincount(sub["sequence"], weights=sub["length"], minlength=plan.sequences)
    slots = set(zip(sub["sequence"].tolist(), sub["slot"].tolist()))
    assert len(slots) == len(sub["slot"]) and fill.max() <= capacity * width and fill.min() > 0
    covered = defaultdict(list)
    for i, b, n in zip(sub["of"].tolist(), sub["begin"].tolist(), sub["length"].tolist()):
        covered[i].append((b, n))
    for i, parts in covered.items():
        at = 0
        for b, n in sorted(parts):
            assert b == at and n > 0
            at += n
        assert at == lengths[i]
    assert len(covered) == len(lengths)
    return 1 - lengths.sum() / (plan.sequences * capacity * width), plan.cuts


def test_too_long_halves_are_cut():
    """Pieces just over half a sequence waste 46 % whole; cut they fill the sequences."""
    lengths = np.full(4000, 1100)
    padding, cuts = placed(np.bincount(-(-lengths // 8), minlength=257)[1:], lengths, 256, 8)
    assert padding < 0.01 and 0 < cuts < 4000


def test_mixed_lengths_are_mostly_left_whole():
    lengths = np.random.default_rng(3).integers(1, 2049, 20_000)
    padding, cuts = placed(np.bincount(-(-lengths // 8), minlength=257)[1:], lengths, 256, 8)
    assert padding < 0.01 and cuts < 2000


@settings(max_examples=12, deadline=None)
@given(st.lists(st.integers(1, 32), min_size=1, max_size=60))
def test_any_histogram_is_placed_whole(lengths):
    lengths = np.array(lengths)
    placed(np.bincount(-(-lengths // 2), minlength=17)[1:], lengths, 16, 2)


def test_knapsack_against_all_sums():
    prices = np.array([-np.inf, 1.0, 2.5, 2.0, 6.0, 0.0, 0.0, 0.0, 0.0])
    best, last = packing.knapsack(prices, 8)
    brute = {0: 0.0}
    for f in range(1, 9):
        brute[f] = max(brute[f - c] + prices[c] for c in range(1, f + 1))
        assert best[f] == brute[f]
        assert sum(c * n for c, n in packing._taken(last, f).items()) == f


def test_a_word_goes_to_the_library_once(library):
    """Whatever its case and the punctuation around it, also in later groups."""
    class Counting:
        def __init__(self):
            self.asked = []

        def encode(self, text, **how):
            self.asked += text.split()
            return library.encode(text, **how)

        def encode_batch_fast(self, texts, **how):
            self.asked += texts
            return library.encode_batch_fast(texts, **how)

    words = packing.WordTokens(WORD_TOKENIZER)
    words.library = Counting()
    texts = ["Qorvex qorvex, (QORVEX) qorvex&&&", None, "", " \n", 'QORVEX! "qorvex".\x0bqorvex]$%', "qorvex's <qorvex> qorvex-é"]
    for text, ids in zip(texts * 2, [*words.ids(texts), *words.ids(pa.array(texts))], strict=True):
        assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids, text
    assert sorted(w for w in words.library.asked if "qorvex" in w.lower()) == ["<qorvex>", "qorvex", "qorvex's", "qorvex-é"]
    assert len(words.library.asked) == len(set(words.library.asked))


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZéÀµª'\"#&$(-_`~[]\\^.7 \n\x1ć̸日"), max_size=12), max_size=5))
def test_punctuation_around_words_equals_the_library(texts):
    words = test_any_text_equals_the_library.words
    for text, ids in zip(texts, words.ids(texts), strict=True):
        assert ids.tolist() == words.library.encode(text, add_special_tokens=False).ids


def test_texts_are_grouped_by_bytes():
    texts = pa.array(["abc", None, "de", "éé", "x" * 9, "", "y"])
    groups = [g.to_pylist() for g in packing._in_groups(texts, 5)]
    assert groups == [["abc", None, "de"], ["éé"], ["x" * 9], ["", "y"]]
    assert list(packing._in_groups(pa.array([], pa.string()), 5)) == []
