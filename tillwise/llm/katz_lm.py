"""A Katz backoff language model of word pairs: counted, normalised and evaluated over partitioned tables.

Tokens are the words of a text and an end mark. P(w|v) is the Good-Turing discounted share of the pair
where it was seen, else alpha(v) P(w); P(w) is the discounted share of the word, else the mass left for
unknown words. alpha(v) makes the probabilities after v sum to exactly one.

Rows of single tokens would cost more to move than to count, so tokens travel as packed arrays:

1. blocks: the documents' words hashed, as arrays of places in the block's own word list;
2. words: lists by hash range, summed to the counts of all words; each word gets its rank by frequency,
   so that a number names a word and tells its count, and goes back to the blocks;
3. pairs: each block's pairs with counts and the documents they stand in, dealt out by context. The
   contexts of the `HOT` most frequent words are dealt out by pair, those of unknown words by pair and
   block. A bucket counts its pairs, then
   evaluates them for every document that has them, and sums of logarithms go back per block.

No step holds more than a bounded number of tokens, and nothing but sums of fixed size comes to the
driver (count classes: at most sqrt(2 N) numbers for N tokens).
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwise.functions.scale import stage

BLOCK_TOKENS = 2_000_000
BLOCK_DOCS = 60_000
WORD_ENTRIES = 1_000_000  # entries of word lists in a bucket
PAIR_TOKENS = 1_500_000  # tokens whose pairs are in a bucket
HOT = 2048  # contexts dealt out by pair: no other learned word can have more than 1/HOT of the learned tokens
CUTOFF = 5  # counts up to this are discounted
END = np.uint64(1)
START_ID, UNKNOWN_ID = 2**32 - 2, 2**32 - 1  # word numbers go up to 2^32 - 3


def tokens(text: bytes | None) -> np.ndarray:
    """Hashes of the lower-cased words of a text and of the end mark."""
    words = (text or b"").lower().split()
    out = np.empty(len(words) + 1, np.uint64)
    out[:-1] = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    out[-1] = END
    return out


def discounts(classes: dict[int, int], cutoff: int = CUTOFF) -> np.ndarray:
    """Katz's factor for counts 0..cutoff + 1 (the last stands for all above) from the numbers of counts.

    Good-Turing factors up to the largest k <= cutoff for which all are between 0 and 1; where there is
    none, as in tiny corpora, half a count is taken from each.
    """
    n = [classes.get(r, 0) for r in range(cutoff + 2)]
    for k in range(cutoff, 0, -1):
        if not all(n[1 : k + 2]):
            continue
        tail = (k + 1) * n[k + 1] / n[1]
        if tail >= 1:
            continue
        d = [((r + 1) * n[r + 1] / (r * n[r]) - tail) / (1 - tail) for r in range(1, k + 1)]
        if all(0 < x < 1 for x in d):
            return np.array([0.0, *d] + [1.0] * (cutoff + 1 - k))
    return np.array([0.0] + [1 - 0.5 / r for r in range(1, cutoff + 1)] + [1 - 0.5 / (cutoff + 1)])


def _pack(a: np.ndarray, kind) -> bytes:
    return np.ascontiguousarray(a, kind).tobytes()


def _join(column: pa.ChunkedArray, kind) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x is not None), kind)


BLOCKS = (
    "block bigint, ids array<bigint>, train array<boolean>, lengths array<int>, words binary, counts binary, tokens binary, "
    "n_tokens bigint, n_words bigint"
)


def _blocks(block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        pack = zstandard.ZstdCompressor(level=1).compress
        ids, train, docs, size = [], [], [], 0

        def block() -> pa.RecordBatch:
            lengths = np.array([len(d) for d in docs], np.int32)
            words, places = np.unique(np.concatenate(docs), return_inverse=True)
            learned = np.repeat(np.array(train, bool), lengths)
            counts = np.bincount(places[learned], minlength=len(words))
            return pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([train], pa.list_(pa.bool_())),
                 pa.array([lengths.tolist()], pa.list_(pa.int32())), pa.array([_pack(words, np.uint64)], pa.binary()),
                 pa.array([_pack(counts, np.uint32)], pa.binary()), pa.array([pack(_pack(places, np.uint32))], pa.binary()),
                 pa.array([len(places)], pa.int64()), pa.array([len(words)], pa.int64())],
                names=["block", "ids", "train", "lengths", "words", "counts", "tokens", "n_tokens", "n_words"],
            )

        for batch in batches:
            for i, t, text in zip(*(batch.column(c).to_pylist() for c in ("id", "train", "text"))):
                ids.append(i)
                train.append(t)
                docs.append(tokens(text))
                size += len(docs[-1])
                if size >= block_tokens or len(docs) >= BLOCK_DOCS:
                    yield block()
                    number += 1
                    ids, train, docs, size = [], [], [], 0
        if docs:
            yield block()

    return run


def _slices(buckets: int):
    """A block's word list cut by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edges = np.array([(k << 64) // buckets for k in range(buckets)], np.uint64)
        for batch in batches:
            for block, w, c in zip(*(batch.column(x).to_pylist() for x in ("block", "words", "counts"))):
                words, counts = np.frombuffer(w, np.uint64), np.frombuffer(c, np.uint32)
                cut = np.append(np.searchsorted(words, edges), len(words))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(buckets), pa.int64()), pa.array([block] * buckets, pa.int64()),
                     pa.array([_pack(words[a:b], np.uint64) for a, b in zip(cut, cut[1:])], pa.binary()),
                     pa.array([_pack(counts[a:b], np.uint32) for a, b in zip(cut, cut[1:])], pa.binary())],
                    names=["bucket", "block", "words", "counts"],
                )

    return run


def _count_words(group: pa.Table) -> pa.Table:
    """A hash range's words ranked by falling count, in place of the hashes of each block's slice.

    One row per block, with the ranks of its words (UNKNOWN_ID for words that were not learned), and one
    row without block with the counts that occur and how many words have each.
    """
    lists = [np.frombuffer(x, np.uint64) for x in group["words"].to_pylist()]
    words, places = np.unique(np.concatenate(lists), return_inverse=True)
    counts = np.bincount(places, weights=_join(group["counts"], np.uint32), minlength=len(words)).astype(np.int64)
    order = np.argsort(-counts, kind="stable")
    learned = int((counts > 0).sum())
    rank = np.full(len(words), UNKNOWN_ID, np.uint32)
    rank[order[:learned]] = np.arange(learned)
    classes, n = np.unique(counts[counts > 0], return_counts=True)
    cut = np.cumsum([0, *map(len, lists)])
    ranks = [_pack(rank[places[a:b]], np.uint32) for a, b in zip(cut, cut[1:])]
    bucket, blocks = group["bucket"][0].as_py(), group["block"].to_pylist()
    return pa.table({
        "bucket": pa.array([bucket] * (len(blocks) + 1), pa.int64()), "block": pa.array([*blocks, None], pa.int64()),
        "ranks": pa.array([*ranks, None], pa.binary()),
        "classes": pa.array([None] * len(blocks) + [classes.tolist()], pa.list_(pa.int64())),
        "sizes": pa.array([None] * len(blocks) + [n.tolist()], pa.list_(pa.int64())),
    })


WORDS = "bucket bigint, block bigint, ranks binary, classes array<bigint>, sizes array<bigint>"


def _number_words(classes):
    """Numbers of the words of each block's slice: their rank by frequency among all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        falling, first = classes.value
        for batch in batches:
            numbers = []
            for ranks, own in zip(batch.column("ranks").to_pylist(), batch.column("offsets").to_pylist()):
                rank = np.frombuffer(ranks, np.uint32)
                out = np.full(len(rank), UNKNOWN_ID, np.uint32)
                if own:
                    own = sorted(own, key=lambda x: -x["c"])
                    counts, sizes, before = (np.array([x[k] for x in own], np.int64) for k in ("c", "n", "before"))
                    start = np.cumsum(sizes) - sizes  # first rank of each count in this range
                    shift = first[np.searchsorted(-falling, -counts)] + before - start
                    seen = rank != UNKNOWN_ID
                    out[seen] = rank[seen] + shift[np.searchsorted(start, rank[seen], "right") - 1]
                numbers.append(out.tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("bucket"), pa.array(numbers, pa.binary())], names=["block", "bucket", "numbers"]
            )

    return run


class Unigrams:
    """Discounted word probabilities, looked up by word number."""

    def __init__(self, falling: np.ndarray, first: np.ndarray, sizes: dict[int, int], cutoff: int = CUTOFF):
        self.falling, self.first = falling, first
        self.total = sum(c * n for c, n in sizes.items())
        d = discounts(sizes, cutoff)
        factor = d[np.minimum(falling, cutoff + 1)] if len(falling) else np.empty(0)
        kept = factor * falling
        whole = math.fsum(p * sizes[int(c)] for p, c in zip(kept, falling))
        # Where no count was low enough to be discounted, unknown words count as one more token.
        self.share = kept / max(self.total + (whole >= self.total), 1)
        seen = math.fsum(p * sizes[int(c)] for p, c in zip(self.share, falling))
        self.unknown = 1.0 - seen  # one event for all unknown words

    def count(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.falling):
            return np.zeros(len(ids), np.int64)
        at = np.searchsorted(self.first, ids, "right") - 1
        return np.where(ids >= START_ID, 0, self.falling[at])

    def probability(self, ids: np.ndarray) -> np.ndarray:
        if not len(self.falling):
            return np.full(len(ids), self.unknown)
        at = np.searchsorted(self.first, ids, "right") - 1
        return np.where(ids >= START_ID, self.unknown, self.share[at])


PAIRS = "bucket bigint, block bigint, pairs binary, base binary, known binary"
_CHUNK = (("v", np.uint32), ("w", np.uint32), ("learned", np.uint32), ("places", np.uint32), ("docs", np.uint16))


def _pack_chunk(arrays: list[np.ndarray]) -> bytes:
    """Pairs of a block and bucket, compressed. Bytes of equal weight stand together, which packs best."""
    n = np.array([len(arrays[0]), len(arrays[-1])], np.int64).tobytes()
    parts = [np.ascontiguousarray(a, k).view(np.uint8).reshape(len(a), np.dtype(k).itemsize).T.tobytes() for a, (_, k) in zip(arrays, _CHUNK)]
    return n + zstandard.ZstdCompressor(level=1).compress(b"".join(parts))


def _unpack_chunk(data: bytes) -> dict[str, np.ndarray]:
    n_pairs, n_docs = np.frombuffer(data, np.int64, 2)
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[16:]), np.uint8)
    out, at = {}, 0
    for name, kind in _CHUNK:
        n, width = int(n_docs if name == "docs" else n_pairs), np.dtype(kind).itemsize
        out[name] = np.ascontiguousarray(raw[at : at + n * width].reshape(width, n).T).view(kind).ravel()
        at += n * width
    return out


def _pairs(unigrams, buckets: int, hot_words: int):
    """A block's distinct pairs by bucket: learned count, number of places, and the documents of the places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Unigrams = unigrams.value
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for row in batch.to_pylist():
                numbers = np.concatenate([np.frombuffer(x["numbers"], np.uint32) for x in sorted(row["slices"], key=lambda x: x["bucket"])])
                w = numbers[np.frombuffer(unpack(row["tokens"]), np.uint32)].astype(np.uint64)
                lengths = np.array(row["lengths"], np.int64)
                doc = np.repeat(np.arange(len(lengths), dtype=np.uint16), lengths)
                ends = np.cumsum(lengths)
                v = np.empty(len(w), np.uint64)
                v[1:] = w[:-1]
                v[ends - lengths] = START_ID
                counts = model.count(w)
                base = np.bincount(doc, weights=np.log10(counts + 1.0), minlength=len(lengths))
                known = np.bincount(doc, weights=counts > 0, minlength=len(lengths))
                order = np.argsort((v << np.uint64(32)) | w, kind="stable")
                v, w, doc = v[order], w[order], doc[order]
                first = np.flatnonzero(np.append(True, (v[1:] != v[:-1]) | (w[1:] != w[:-1])))
                places = np.diff(np.append(first, len(v)))
                learned = np.add.reduceat(np.array(row["train"], bool)[doc].astype(np.int64), first)
                pv, pw = v[first], w[first]
                # Pairs after the unknown word have no learned count, so each block may send its own anywhere.
                unknown = pv == UNKNOWN_ID
                hot = (pv < hot_words) | (pv == START_ID) | unknown
                salt = np.where(unknown, np.uint64(zlib.crc32(str(row["block"]).encode()) << 32), np.uint64(0))
                mixed = (np.where(hot, pv * np.uint64(0x9E3779B97F4A7C15) + pw + salt, pv) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
                mixed ^= mixed >> np.uint64(29)
                bucket = (((mixed * np.uint64(0x94D049BB133111EB)) >> np.uint64(33)) % np.uint64(buckets)).astype(np.int64)
                by = np.argsort(bucket, kind="stable")
                cut = np.searchsorted(bucket[by], np.arange(buckets + 1))
                # The documents of the places, in the order of the pairs by bucket.
                size = places[by]
                at = np.repeat(first[by] - (np.cumsum(size) - size), size) + np.arange(len(v))
                docs = doc[at]
                doc_cut = np.append(0, np.cumsum(size))[cut]
                pv, pw, learned = pv[by], pw[by], learned[by]
                home = row["block"] % buckets
                for start in range(0, buckets, 64):
                    span = [k for k in range(start, min(start + 64, buckets)) if cut[k + 1] > cut[k] or k == home]
                    if not span:
                        continue
                    chunks = [_pack_chunk([*(a[cut[k] : cut[k + 1]] for a in (pv, pw, learned, size)), docs[doc_cut[k] : doc_cut[k + 1]]]) for k in span]
                    once = lambda a: pa.array([_pack(a, np.float64) if k == home else None for k in span], pa.binary())
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(span, pa.int64()), pa.array([row["block"]] * len(span), pa.int64()), pa.array(chunks, pa.binary()), once(base), once(known)],
                        names=["bucket", "block", "pairs", "base", "known"],
                    )

    return run


class _Bucket:
    """The pairs of a bucket over all blocks."""

    def __init__(self, group: pa.Table):
        chunks = [_unpack_chunk(x) for x in group["pairs"].to_pylist()]
        both = [(c.pop("v").astype(np.uint64) << np.uint64(32)) | c.pop("w") for c in chunks]
        pairs, self.place = np.unique(np.concatenate(both), return_inverse=True)
        learned = np.concatenate([c.pop("learned") for c in chunks])
        self.chunks = chunks
        self.counts = np.bincount(self.place, weights=learned, minlength=len(pairs)).astype(np.int64)
        self.v, self.w = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(2**32 - 1)).astype(np.int64)
        self.first = np.flatnonzero(np.append(True, self.v[1:] != self.v[:-1])) if len(pairs) else np.empty(0, np.int64)
        self.contexts = self.v[self.first]

    def context_sums(self, model: Unigrams, factors: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per context: count, discounted count, and the word probability of all words seen after it."""
        if not len(self.first):
            return (np.empty(0),) * 3
        seen = self.counts > 0
        kept = factors[np.minimum(self.counts, len(factors) - 1)] * self.counts
        below = np.where(seen, model.probability(self.w), 0.0)
        return tuple(np.add.reduceat(x.astype(np.float64), self.first) for x in (self.counts, kept, below))


def _classes(group: pa.Table) -> pa.Table:
    counts = _Bucket(group).counts
    return pa.table({"n": pa.array([np.bincount(np.minimum(counts, CUTOFF + 2), minlength=CUTOFF + 3).tolist()], pa.list_(pa.int64()))})


def _factors(group: pa.Table) -> np.ndarray:
    n = group["n"][0].as_py()
    return discounts({r: n[r] for r in range(1, CUTOFF + 2)})


def _hot_sums(unigrams, hot_words: int):
    def run(group: pa.Table) -> pa.Table:
        bucket = _Bucket(group)
        sums = bucket.context_sums(unigrams.value, _factors(group))
        hot = (bucket.contexts < hot_words) | (bucket.contexts == START_ID)
        return pa.table({"v": pa.array(bucket.contexts[hot], pa.int64())} | {c: pa.array(x[hot], pa.float64()) for c, x in zip(("c", "k", "b"), sums)})

    return run


def _score(unigrams, hot_words: int):
    """Sums of log10 P(w|v) of a bucket's pairs for each document of each block."""

    def run(group: pa.Table) -> pa.Table:
        model, bucket = unigrams.value, _Bucket(group)
        factors = _factors(group)
        count, kept, below = bucket.context_sums(model, factors)
        hot = {x["v"]: x for x in group["hot"][0].as_py() or ()}
        for k in np.flatnonzero((bucket.contexts < hot_words) | (bucket.contexts == START_ID)) if len(bucket.contexts) else ():
            x = hot[int(bucket.contexts[k])]
            count[k], kept[k], below[k] = x["c"], x["k"], x["b"]
        # A context whose counts are all too high for a discount gets one more, unseen, token.
        whole = np.maximum(count + (kept >= count), 1)
        alpha = np.where(count > 0, (1.0 - kept / whole) / np.maximum(1.0 - below, 1e-300), 1.0)
        of = np.repeat(np.arange(len(bucket.first)), np.diff(np.append(bucket.first, len(bucket.v))))
        seen = factors[np.minimum(bucket.counts, len(factors) - 1)] * bucket.counts / whole[of]
        logs = np.log10(np.where(bucket.counts > 0, seen, alpha[of] * model.probability(bucket.w)))
        # Sums only for the documents that have pairs here: (chunk, document) as one number.
        docs = np.concatenate([c["docs"] for c in bucket.chunks]).astype(np.int64)
        docs += np.repeat(np.arange(len(bucket.chunks)) << 16, [len(c["docs"]) for c in bucket.chunks])
        weights = np.repeat(logs[bucket.place], np.concatenate([c["places"] for c in bucket.chunks]))
        present, place = np.unique(docs, return_inverse=True)
        sums = np.bincount(place, weights=weights, minlength=len(present))
        cut = np.searchsorted(present, np.arange(len(bucket.chunks) + 1) << 16)
        return pa.table({
            "block": group["block"], "docs": pa.array([_pack(present[a:b] & 0xFFFF, np.uint16) for a, b in zip(cut, cut[1:])], pa.binary()),
            "sums": pa.array([_pack(sums[a:b], np.float64) for a, b in zip(cut, cut[1:])], pa.binary()),
            "base": group["base"], "known": group["known"],
        })

    return run


SCORES = "block bigint, ids array<bigint>, train array<boolean>, lengths array<int>, sums array<double>, base array<double>, known array<double>"


def _gather(group: pa.Table, blocks: pa.Table) -> pa.Table:
    docs, n = _join(group["docs"], np.uint16), len(blocks["ids"][0])
    sums = np.bincount(docs, weights=_join(group["sums"], np.float64), minlength=n).tolist()
    once = lambda c: _join(group[c], np.float64).tolist()
    columns = {"sums": sums, "base": once("base"), "known": once("known")}
    return pa.table({
        **{c: blocks[c] for c in ("block", "ids", "train", "lengths")},
        **{c: pa.array([x], pa.list_(pa.float64())) for c, x in columns.items()},
    })


def score(
    docs: DataFrame, held_out, doc: str = "doc_id", text: str = "text", block_tokens: int = BLOCK_TOKENS,
    word_entries: int = WORD_ENTRIES, pair_tokens: int = PAIR_TOKENS, hot: int = HOT,
) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    `held_out` is a boolean column (null: false) of the documents that nothing is learned from. `base_score` is the sum of
    log10((c + 1) / (N + V + 1)) over the tokens, `score` the model's log10 probability of the text. A null
    text is empty and has the end mark only. Without anything learned every token is the one unknown event
    of probability 1. Repeated rows count and are scored each for itself; other columns may have any name.
    """
    spark = docs.sparkSession
    inner = docs.select(
        F.col(doc).cast("bigint").alias("id"), (~F.coalesce(held_out, F.lit(False))).alias("train"), F.col(text).cast("binary").alias("text")
    )
    blocks = stage(inner.mapInArrow(_blocks(block_tokens), BLOCKS), "lm-blocks")
    sizes = blocks.agg(F.sum("n_tokens").alias("t"), F.sum("n_words").alias("w")).first()
    word_buckets = max(8, math.ceil((sizes["w"] or 0) / word_entries))
    pair_buckets = max(8, math.ceil((sizes["t"] or 0) / pair_tokens))

    slices = blocks.select("block", "words", "counts").mapInArrow(_slices(word_buckets), "bucket bigint, block bigint, words binary, counts binary")
    words = stage(slices.repartition(word_buckets, "bucket").groupBy("bucket").applyInArrow(_count_words, WORDS), "lm-words")
    classes = words.filter("block IS NULL").select("bucket", F.explode(F.arrays_zip(F.col("classes").alias("c"), F.col("sizes").alias("n"))).alias("x")).select("bucket", "x.*")
    totals = classes.groupBy("c").agg(F.sum("n").alias("n")).orderBy(F.desc("c")).collect()
    falling, n = (np.array([r[c] for r in totals], np.int64) for c in ("c", "n"))
    first = np.cumsum(n) - n
    if n.sum() >= START_ID:
        raise ValueError("more than 2^32 - 3 distinct words")
    model = Unigrams(falling, first, dict(zip(falling.tolist(), n.tolist())))
    before = F.sum("n").over(Window.partitionBy("c").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    offsets = classes.select("bucket", F.struct("c", "n", F.coalesce(before, F.lit(0)).alias("before")).alias("o")).groupBy("bucket").agg(
        F.collect_list("o").alias("offsets")
    )
    numbers = words.filter("block IS NOT NULL").select("bucket", "block", "ranks").join(offsets, "bucket", "left").mapInArrow(
        _number_words(spark.sparkContext.broadcast((falling, first))), "block bigint, bucket bigint, numbers binary"
    )
    per_block = numbers.groupBy("block").agg(F.collect_list(F.struct("bucket", "numbers")).alias("slices"))
    numbered_blocks = blocks.select("block", "train", "lengths", "tokens").join(per_block, "block")
    unigrams = spark.sparkContext.broadcast(model)
    pairs = numbered_blocks.mapInArrow(_pairs(unigrams, pair_buckets, hot), PAIRS).repartition(pair_buckets, "bucket")

    # One exchange of the pairs serves the three passes; each broadcast is one row of fixed size.
    counted = pairs.groupBy("bucket").applyInArrow(_classes, "n array<bigint>")
    n_of = counted.agg(*[F.sum(F.col("n")[r]).alias(f"n{r}") for r in range(CUTOFF + 3)]).select(
        F.array(*[F.coalesce(f"n{r}", F.lit(0)) for r in range(CUTOFF + 3)]).alias("n")
    )
    with_n = pairs.crossJoin(F.broadcast(n_of))
    sums = with_n.groupBy("bucket").applyInArrow(_hot_sums(unigrams, hot), "v bigint, c double, k double, b double")
    sums = sums.groupBy("v").agg(*[F.sum(c).alias(c) for c in "ckb"]).agg(F.collect_list(F.struct("v", "c", "k", "b")).alias("hot"))
    scored = with_n.crossJoin(F.broadcast(sums)).groupBy("bucket").applyInArrow(
        _score(unigrams, hot), "block bigint, docs binary, sums binary, base binary, known binary"
    )
    gathered = scored.groupBy("block").cogroup(blocks.select("block", "ids", "train", "lengths").groupBy("block")).applyInArrow(_gather, SCORES)
    rows = gathered.select(F.explode(F.arrays_zip("ids", "train", "lengths", "sums", "base", "known")).alias("r")).select("r.*")
    norm = math.log10(model.total + int(n.sum()) + 1)
    return rows.select(
        F.col("ids").alias("doc_id"), (~F.col("train")).alias("held_out"), F.col("lengths").cast("bigint").alias("n_tokens"),
        F.col("known").cast("bigint").alias("n_known"), F.lit(model.total).cast("bigint").alias("train_tokens"),
        (F.col("base") - F.col("lengths") * F.lit(norm)).alias("base_score"), F.col("sums").alias("score"),
    )
