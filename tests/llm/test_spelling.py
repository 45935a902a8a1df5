"""Spelling variants against all pairs in plain Python, with the trie whole and cut into small shards."""

import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import edges
from tillwise.llm import spelling
from tillwise.llm.common import prepare

RUN = re.compile(r"[A-Za-zÀ-ÿ]+")


def low(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = low(run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= 3}
    letters = set("".join(n))

    def edits(w):
        out = {w[:k] + w[k + 1 :] for k in range(len(w))}
        out |= {w[:k] + c + w[k:] for k in range(len(w) + 1) for c in letters}
        out |= {w[:k] + c + w[k + 1 :] for k in range(len(w)) for c in letters}
        return {x for x in out if x != w and x in n}

    form, near = {}, {}
    for w in n:
        found = edits(w)
        near[w] = len(found)
        best = min(found, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    out = set()
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n[w], near[w], n.get(form[w])))
    return out


def variant_rows(seed=1, words=150):
    r = random.Random(seed)
    base = ["".join(r.choice("abcdeéßst") for _ in range(r.randrange(5, 9))) for _ in range(words)]
    base += ["aaaaa", "aaaaaa", "aaaaaaa", "abababab", "babababa", "stressed", "desserts", "x" * 90, "x" * 89 + "y", "x" * 91]
    rows = []
    for i in range(60):
        body = []
        for w in r.choices(base, k=80):
            k, what = r.randrange(len(w)), r.random()
            body.append(w if what < 0.6 else w[:k] + w[k + 1 :] if what < 0.7 else w[:k] + "e" + w[k:] if what < 0.8 else w[:k] + "A" + w[k + 1 :])
        rows.append((i, " ".join(body) + " É É× ×÷é Straße STRAßE straÞe naïve, naive-naïve_naïve"))
    return rows


@pytest.mark.parametrize("most", [20_000, 40, 3])
def test_variants_equal_all_pairs(spark, monkeypatch, most):
    prepare(spark)
    monkeypatch.setattr(spelling, "SHARD_WORDS", most)
    rows = variant_rows()
    docs = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "doc_id bigint, text string, word string, n string")
    got = [tuple(r) for r in spelling.spelling_variants(docs).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(rows)


def test_edge_cases(spark):
    prepare(spark)
    got = {tuple(r) for r in spelling.spelling_variants(edges.table(spark)).collect()}
    assert got == brute(edges.texts()) and got
    assert spelling.spelling_variants(edges.empty(spark)).count() == 0
    with pytest.raises(ValueError):
        spelling.spelling_variants(edges.empty(spark), ratio=1)


def test_paths_of_forms_end_at_the_root(spark):
    chain = [("letterabcdefg"[: 5 + k], 3 * 2**k) for k in range(8)]
    text = " ".join(w for w, n in chain for _ in range(n))
    out = {r["word"]: r for r in spelling.spelling_variants(spark.createDataFrame([("", text)], "doc_id string, text string")).collect()}
    assert all(out[w]["root"] == chain[-1][0] for w, _ in chain if w in out) and out["lette"]["form"] == "letter"


def test_a_task_passes_words_on(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(spelling, "TASK_WORDS", 1)
    docs = spark.createDataFrame([(k, "alpha beta alpha gamma") for k in range(5)], "doc_id bigint, text string").coalesce(1)
    got = {r["word"]: r["n"] for r in spelling.spelling_variants(docs).collect()}
    assert got["alpha"] == 10 and got["gamma"] == 5


def distance_one(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


WORD = st.binary(min_size=5, max_size=8).map(lambda b: bytes(97 + x % 3 for x in b))


@settings(max_examples=80, deadline=None)
@given(st.sets(WORD, min_size=1, max_size=40))
def test_each_pair_is_found_once(words):
    words = sorted(words)
    q, i = spelling.near_pairs(words, words)
    got = Counter(frozenset((words[a], words[b])) for a, b in zip(q.tolist(), i.tolist()))
    want = {frozenset((a, b)) for a in words for b in words if distance_one(a, b)}
    assert set(got) == want and set(got.values()) <= {1}
    assert all(spelling.one_edit(a, b) == distance_one(a, b) for a in words for b in words)


@settings(max_examples=40, deadline=None)
@given(st.lists(WORD, min_size=2, max_size=30, unique=True), st.integers(1, 6))
def test_pairs_meet_in_one_shard(words, most):
    vectors = dict(zip(words, spelling._packed(spelling.count_vectors(words))))
    heavy = {v[:k] for v in vectors.values() for k in range(0, 2 * spelling.LEVELS, 2)
             if sum(x[:k] == v[:k] for x in vectors.values()) > most}
    home = {w: spelling.home_shard(v, heavy) for w, v in vectors.items()}
    search = {w: spelling.search_shards(v, heavy) for w, v in vectors.items()}
    for a in words:
        assert len(search[a]) == len(set(search[a])) and home[a] in search[a]
        for b in words:
            if distance_one(a, b):
                assert home[b] in search[a] or home[a] in search[b]


def test_blocks_are_split(monkeypatch):
    monkeypatch.setattr(spelling, "FRONTIER", 7)
    words = sorted({bytes(97 + c % 4 for c in np.random.default_rng(k).integers(0, 99, 6)) for k in range(150)})
    q, i = spelling.near_pairs(words, words)
    got = {frozenset((words[a], words[b])) for a, b in zip(q.tolist(), i.tolist())}
    assert got == {frozenset((a, b)) for a in words for b in words if distance_one(a, b)}
