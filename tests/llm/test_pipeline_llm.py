"""The pipeline against its stages in plain Python, and the registered corpus queries."""

import corpus_pipeline
import __spark_entry__ as entry
from conftest import SF
from test_documents import groups_brute, line_brute, passages_brute, repeated, SPACE
from tillwise.llm import sentencepiece_codec
from tillwise.llm.queries import TOKENIZER


def failing(text):
    """The rules a text fails: base, symbols, duplicate lines, word length."""
    w = SPACE.findall(text or "")
    lines = [x for x in (text or "").split("\n") if SPACE.search(x)]
    symbols, chars = sum(c in "#*$%&|<>" for c in text or ""), sum(map(len, w))
    return (len(w) < 20 or 100 * repeated(w) > 30 * len(w), 100 * symbols > 10 * len(w),
            100 * (len(lines) - len(set(lines))) > 30 * len(lines), not 2 * len(w) <= chars <= 15 * len(w))


def quality_brute(rows):
    """Documents (id, text, host) kept: rates of a host, shrunk towards those of all by the method of moments."""
    fails = [failing(t) for _, t, _ in rows]
    hosts = {h: [f for f, r in zip(fails, rows) if r[2] == h] for h in {r[2] for r in rows}}
    n = {h: len(f) for h, f in hosts.items()}
    rates = {h: [] for h in hosts}
    for rule in range(4):
        k = {h: sum(f[rule] for f in fs) for h, fs in hosts.items()}
        docs, p = len(rows), sum(k.values()) / len(rows)
        between = sum(k[h] ** 2 / n[h] for h in hosts) - docs * p * p
        spread = (between - (len(hosts) - 1) * p * (1 - p)) / (docs - sum(x * x for x in n.values()) / docs)
        weight = min(max(p * (1 - p) / spread - 1, 1), 1e6) if spread > 0 else 1e6
        for h in hosts:
            rates[h].append((k[h] + p * weight) / (n[h] + weight))
    return [(i, t) for (i, t, h), f in zip(rows, fails)
            if not f[0] and not any(f[r] and (rates[h][r] > 0.05 or max(rates[h]) > 0.5) for r in (1, 2, 3))]


def test_pipeline(spark):
    rows = [(r["doc_id"], r["text"], r["source"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = quality_brute(rows)
    assert len(kept) < sum(not failing(t)[0] for _, t, _ in rows)  # hosts' verdicts reject some
    kept = [(i, t) for i, _, _, t in line_brute(kept, 10)]
    alive = {c for _, _, c in groups_brute(kept, 80)}
    kept = [(i, t) for i, t in kept if i in alive]
    dirty = {i for i, _, _, _, bad in passages_brute(kept, items) if bad}
    kept = {i: t for i, t in kept if i not in dirty}
    expected = dict(zip(kept, sentencepiece_codec.reference_encode(TOKENIZER, list(kept.values()))))
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"]: (r["text"], r["token_ids"]) for r in got} == {i: (t, expected[i]) for i, t in kept.items()}


def test_stage_names():
    assert len(corpus_pipeline.STAGES) == 5 and all(callable(f) for _, f in corpus_pipeline.STAGES)
    assert {"pipeline", *(f"op{n}" for n in range(1, 14))} <= {k.split("_")[0] for k in entry.queries()}
