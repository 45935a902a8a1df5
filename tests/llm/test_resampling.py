"""Importance resampling against plain Python: weights, scores, the exact draw, ties and repeated rows."""

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

import edges
from tillwise.llm import resampling
from tillwise.llm.common import prepare, split_words

PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def low(text):
    return "".join(c.lower() if c.isascii() else c for c in text)


def runs(text):
    w = PLAIN.findall(low(text or ""))
    return w, [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]


def brute(rows, items, buckets, min_words, share):
    bucket = lambda g: crc32(g.encode()) % buckets
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(map(bucket, runs(text)[1]))
    for text in items:
        t.update(map(bucket, runs(text)[1]))
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for doc_id, text in rows:
        w, g = runs(text)
        weight = sum(gain[bucket(x)] for x in g) // len(g) if g else 0
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(g), weight, score, None, len(w)])
    order = sorted((r for r in out if r[5] >= min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(order[: share * len(order) // 100], 1):
        r[4] = k
    return sorted((tuple(r[:5]) for r in out), key=str)


def test_draw_equals_plain_python(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(resampling, "CHUNK", 50)
    r = random.Random(5)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "日本", "x1"]
    rows = [(k, " ".join(r.choices(vocabulary, k=r.randrange(0, 60))) + ("!" if k % 2 else " A-b_C")) for k in range(3000)]
    items = [" ".join(r.choices(vocabulary[:15], k=40)) for _ in range(20)] + [None, ""]
    docs = spark.createDataFrame([(i, t, "x", "x") for i, t in rows], "doc_id bigint, text string, score string, at string").repartition(7)
    target = spark.createDataFrame([(t,) for t in items], "body string")
    for share in (25, 100, 0, 1):
        got = resampling.resample(docs, target, target_text="body", buckets=500, share=share).collect()
        got = sorted(((x["row"]["doc_id"], x["n_features"], x["weight"], x["score"], x["rank"]) for x in got), key=str)
        assert got == brute(rows, items, 500, 20, share)


def test_edges_and_repeated_rows(spark):
    prepare(spark)
    target = spark.createDataFrame([(1, "w1 w2 w3")], "item_id bigint, text string")
    got = resampling.resample(edges.table(spark), target, min_words=1, share=60).collect()
    rows = edges.texts()
    want = brute(rows, ["w1 w2 w3"], resampling.BUCKETS, 1, 60)
    ranks = sorted(x["rank"] for x in got if x["rank"])
    assert ranks == list(range(1, len([r for r in want if r[4]]) + 1))
    assert sorted(((x["row"]["doc_id"], x["weight"], x["score"]) for x in got), key=str) == sorted(((r[0], r[2], r[3]) for r in want), key=str)
    assert resampling.resample(edges.empty(spark), target).count() == 0
    none = resampling.resample(edges.table(spark), target.limit(0)).collect()
    assert len(none) == len(rows)


def test_cutoff_is_exact_for_every_rank(spark):
    values = [3, 3, 3, 1, 2, 5, 5, 8, 9, 9, 9, 9]
    keys = spark.createDataFrame([(v, 0, 7, 0, k) for k, v in enumerate(values)], ", ".join(f"{c} bigint" for c in resampling.KEY)).repartition(3)
    order = sorted((v, 0, 7, 0, k) for k, v in enumerate(values))
    for take in (1, 4, 7, 12):
        assert resampling.cutoff_key(keys, take, last_keys=1) == order[take - 1]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 50), min_size=1, max_size=20), min_size=1, max_size=12))
def test_weighted_median_parts_the_keys(parts):
    """At least a quarter of the keys is on either side."""
    medians = [((sorted(p)[(len(p) - 1) // 2],), len(p)) for p in parts]
    (pivot,) = resampling.weighted_median(medians)
    keys = [k for p in parts for k in p]
    assert 4 * sum(k <= pivot for k in keys) >= len(keys) and 4 * sum(k >= pivot for k in keys) >= len(keys) - 2 * len(parts)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=40))
def test_run_hashes(text):
    words, grams = runs(text)
    got = resampling.run_hashes(split_words(text.encode("utf-8", "replace")))
    assert got.tolist() == [crc32(g.encode("utf-8", "replace")) for g in grams]
    assert np.bincount(got % 10, minlength=10).sum() == len(grams) == (2 * len(words) - 1 if words else 0)
