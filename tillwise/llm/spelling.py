"""Grouping of spelling variants: pairs of words one edit apart from a trie over letter-group counts.

Every code point belongs to one of a few letter groups; a word's vector counts its code points by group.
One inserted code point adds one to one count, a replaced one adds one to one count and takes one from
another, or leaves all counts. The words are arranged in a trie by successive counts, and a depth-first
search with a budget of one surplus and one deficit reaches all words one edit away. Words at the leaves
are compared exactly.

The trie is cut into shards: a node that holds more words than a shard may is cut at its children. Only
these heavy nodes, at most levels * words / shard size of them, are sent to the tasks, which walk them
depth-first to find the shards a word must be looked up in. Each pair is found in one direction only, where
the first difference of the counts is a surplus, and so in one shard only.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwise.functions.scale import stage

MIN_CHARS = 5
MIN_COUNT = 3
SLIP = 97  # runs whose hash this divides have lost a code point
FORM_RATIO = 2  # a form occurs at least this many times as often
TASK_WORDS = 500_000  # different words a task counts before it passes them on
SHARD_WORDS = 20_000
MAX_SHARDS = 20_000
FRONTIER = 200_000  # (word, node) pairs searched at a time
LONG = 64  # longer words are compared one by one

# Runs are of Latin letters up to U+00FF, which have one byte each in Latin-1; all else ends a run.
LETTER_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0xC0 else 0x20 for b in range(256)
)
# Letter groups in the order of the trie's levels: the letters whose counts tell most words apart come first.
GROUPS = ("e", "n", "t", "i", "a", "r", "o", "s", "u", "l", "hd", "mcp", "gbfv", "jkqwxyz")


def _group_of() -> np.ndarray:
    table = np.full(256, len(GROUPS), np.int64)  # the last group: all beyond a-z
    for g, letters in enumerate(GROUPS):
        for letter in letters:
            table[ord(letter)] = g
    return table


GROUP_OF = _group_of()
LEVELS = len(GROUPS) + 1


# --- words -----------------------------------------------------------------------------------

def text_words(text: str, doc_id: str) -> Counter[bytes]:
    """The words of a document with their numbers, as Latin-1, after some runs have lost a code point."""
    runs = text.encode("latin-1", "replace").translate(LETTER_BYTES).split()
    seed, out = crc32(f"{doc_id}:".encode()), Counter()
    for run, n in Counter([r for r in runs if len(r) >= MIN_CHARS]).items():
        h = crc32(run if run.isascii() else run.decode("latin-1").encode(), seed)
        if h % SLIP == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < MIN_CHARS:
                continue
        out[run] += n
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[bytes, int] = defaultdict(int)

    def rows() -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            for word, n in text_words(text or "", doc_id or "").items():
                counts[word] += n
            if len(counts) >= TASK_WORDS:
                yield rows()
                counts.clear()
    if counts:
        yield rows()


def count_vectors(words: list[bytes]) -> np.ndarray:
    """Counts of the code points of each word by letter group: a row of `LEVELS` numbers for each word."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    groups = GROUP_OF[np.frombuffer(b"".join(words), np.uint8)]
    flat = np.repeat(np.arange(len(words)), lengths) * LEVELS + groups
    return np.bincount(flat, minlength=len(words) * LEVELS).reshape(-1, LEVELS)


def _packed(vectors: np.ndarray) -> list[bytes]:
    """Vectors as bytes, two a level. Counts above 65535 are taken as 65535, which brings no two words further apart."""
    wide = np.minimum(vectors, 65535).astype(">u2")
    flat, step = wide.tobytes(), 2 * LEVELS
    return [flat[k : k + step] for k in range(0, len(flat), step)]


def _with_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        words = [w.encode("latin-1") for w in batch.column("word").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("word"), batch.column("n"), pa.array(_packed(count_vectors(words)), pa.binary())], names=["word", "n", "vector"]
        )


# --- shards ----------------------------------------------------------------------------------

def heavy_nodes(words: DataFrame, most: int) -> set[bytes]:
    """The trie's nodes, as the packed counts on their paths, with more than `most` words below them."""
    by_vector = words.groupBy("vector").agg(F.count(F.lit(1)).alias("n"))
    paths = by_vector.select("n", "vector", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))).alias("level"))
    nodes = paths.groupBy(F.expr("substring(vector, 1, 2 * level)").alias("node")).agg(F.sum("n").alias("n"))
    return {bytes(r["node"]) for r in nodes.filter(F.col("n") > most).select("node").collect()}


def home_shard(vector: bytes, heavy: set[bytes]) -> bytes:
    """The shard a word lies in: the first node on its path that is not heavy, or its leaf."""
    for end in range(0, 2 * LEVELS, 2):
        if vector[:end] not in heavy:
            return vector[:end]
    return vector


def search_shards(vector: bytes, heavy: set[bytes]) -> list[bytes]:
    """The shards in which words with a first surplus and then a deficit against `vector`, or neither, may lie."""
    counts = [int.from_bytes(vector[k : k + 2]) for k in range(0, 2 * LEVELS, 2)]
    found, waiting = [], [(b"", 0)]
    while waiting:
        node, spent = waiting.pop()
        level = len(node) // 2
        if level == LEVELS or node not in heavy:
            found.append(node)
            continue
        own = counts[level]
        waiting.append((node + own.to_bytes(2), spent))
        if spent == 0 and own < 65535:
            waiting.append((node + (own + 1).to_bytes(2), 1))
        elif spent == 1 and own:
            waiting.append((node + (own - 1).to_bytes(2), 2))
    return found


def _routed(heavy):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        homes: dict[bytes, bytes] = {}
        searches: dict[bytes, list[bytes]] = {}
        for batch in batches:
            rows, shards, queries = [], [], []
            for k, vector in enumerate(batch.column("vector").to_pylist()):
                if vector not in homes:
                    if len(homes) > 100_000:
                        homes.clear()
                        searches.clear()
                    homes[vector], searches[vector] = home_shard(vector, heavy.value), search_shards(vector, heavy.value)
                to = searches[vector]
                rows += [k] * (1 + len(to))
                shards.append(homes[vector])
                shards += to
                queries += [False, *[True] * len(to)]
            of = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(shards, pa.binary()), pa.array(queries, pa.bool_()), batch.column("word").take(of), batch.column("n").take(of)],
                names=["shard", "query", "word", "n"],
            )

    return run


# --- the search in a shard -------------------------------------------------------------------

class Trie:
    """Words by successive letter-group counts; a level's nodes are found by (parent, count)."""

    def __init__(self, vectors: np.ndarray):
        order = np.lexsort(vectors.T[::-1])
        ordered = vectors[order]
        node, self.levels = np.zeros(len(ordered), np.int64), []
        for level in range(LEVELS):
            keys, node = np.unique((node << 32) | ordered[:, level], return_inverse=True)
            self.levels.append(keys)
        self.leaf = np.empty(len(ordered), np.int64)
        self.leaf[order] = node

    def search(self, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(vector, leaf, spent) by depth-first search over blocks of at most `FRONTIER` pairs.

        `spent` is 0 for equal counts, 1 for one surplus at the leaf, 2 for a surplus and then a deficit.
        """
        start = np.arange(len(vectors))
        waiting = [(0, start, np.zeros(len(start), np.int64), np.zeros(len(start), np.int8))]
        while waiting:
            level, query, node, spent = waiting.pop()
            if len(query) > FRONTIER:
                half = len(query) // 2
                waiting += [(level, query[:half], node[:half], spent[:half]), (level, query[half:], node[half:], spent[half:])]
                continue
            if level == LEVELS:
                yield query, node, spent
                continue
            keys, own, found = self.levels[level], vectors[query, level], []
            for change, may, then in ((0, None, 0), (1, 0, 1), (-1, 1, 1)):
                some = np.arange(len(query)) if may is None else np.flatnonzero(spent == may)
                wanted = (node[some] << 32) | np.maximum(own[some] + change, 0)
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                hit = (keys[at] == wanted) & (own[some] + change >= 0)
                found.append((query[some[hit]], at[hit], spent[some[hit]] + np.int8(then)))
            waiting.append((level + 1, *(np.concatenate(x) for x in zip(*found))))


def one_edit(a: bytes, b: bytes) -> bool:
    """Whether exactly one inserted, deleted or replaced code point makes `b` of `a`."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


class Letters:
    """Words as one array of bytes, compared in blocks of equal length."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.length = np.fromiter(map(len, words), np.int64, len(words))
        self.start = np.cumsum(self.length) - self.length
        self.bytes = np.frombuffer(b"".join(words), np.uint8)

    def matrix(self, of: np.ndarray, length: int) -> np.ndarray:
        return self.bytes[self.start[of][:, None] + np.arange(length)]


def verified(left: Letters, a: np.ndarray, right: Letters, b: np.ndarray) -> np.ndarray:
    """Which pairs are one edit apart; the right words are as long as the left ones or one longer."""
    out = np.zeros(len(a), bool)
    kinds = left.length[a] * 2 + (right.length[b] - left.length[a])
    for kind in np.unique(kinds):
        mine = np.flatnonzero(kinds == kind)
        n, longer = int(kind) // 2, int(kind) % 2
        if n > LONG:
            out[mine] = [one_edit(left.words[i], right.words[j]) for i, j in zip(a[mine], b[mine])]
            continue
        for block in np.array_split(mine, 1 + len(mine) // FRONTIER):
            x, y = left.matrix(a[block], n), right.matrix(b[block], n + longer)
            if longer:
                before = np.logical_and.accumulate(x == y[:, :n], axis=1).sum(axis=1)
                after = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
                out[block] = before + after >= n
            else:
                out[block] = (x != y).sum(axis=1) == 1
    return out


def _halves(words: list[bytes], shorter: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a word's two halves, as a word of its length less `shorter` would be halved."""
    firsts, seconds = [], []
    for w in words:
        n = len(w) - shorter
        firsts.append(hash(w[: n // 2]))
        seconds.append(hash(w[len(w) - n + n // 2 :]))
    return np.array(firsts, np.int64).view(np.uint64), np.array(seconds, np.int64).view(np.uint64)


def _matches(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in wanted, place in keys) of equal values."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    low, high = np.searchsorted(ordered, wanted, "left"), np.searchsorted(ordered, wanted, "right")
    n = high - low
    of = np.repeat(np.arange(len(wanted)), n)
    return of, order[np.repeat(low, n) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)]


def near_pairs(index: list[bytes], queries: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(query, index word) one edit apart, in the direction in which this search finds them, each once.

    Words one edit apart share their first or their second half, so at a leaf only those are compared.
    """
    none = np.empty(0, np.int64)
    if not index or not queries:
        return none, none
    trie, letters, asked = Trie(count_vectors(index)), Letters(index), Letters(queries)
    spread = np.uint64(0x9E3779B97F4A7C15)
    mix = trie.leaf.astype(np.uint64) * spread
    same, longer, own = _halves(index, 0), _halves(index, 1), _halves(queries, 0)
    out_q, out_i = [none], [none]
    for query, leaf, spent in trie.search(count_vectors(queries)):
        for is_longer, halves in ((False, same), (True, longer)):
            some = np.flatnonzero((spent == 1) == is_longer)
            q, at = query[some], leaf[some].astype(np.uint64) * spread
            for half in (0, 1):
                of, i = _matches(halves[half] ^ mix, own[half][q] ^ at)
                if half:  # those that share the first half too were found by it
                    new = halves[0][i] != own[0][q[of]]
                    of, i = of[new], i[new]
                # A hash may belong to another leaf, whose words need not have the right length.
                fits = (trie.leaf[i] == leaf[some][of]) & (letters.length[i] == asked.length[q[of]] + is_longer)
                of, i = of[fits], i[fits]
                ok = verified(asked, q[of], letters, i)
                # Of words with equal counts each finds the other: the smaller one's find is kept.
                level = np.flatnonzero(ok & (spent[some][of] == 0))
                ok[level] = [queries[x] < index[y] for x, y in zip(q[of[level]], i[level])]
                out_q.append(q[of[ok]])
                out_i.append(i[ok])
    return np.concatenate(out_q), np.concatenate(out_i)


def _best(words: list[str], n: np.ndarray, target: np.ndarray, partner: np.ndarray) -> pa.Table:
    """For each target word: how many near words, and the one of largest n, the smallest in code-point order."""
    order = sorted(range(len(words)), key=words.__getitem__)
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    by = np.lexsort((rank[partner], -n[partner], target))
    target, partner = target[by], partner[by]
    first = np.flatnonzero(np.r_[True, target[1:] != target[:-1]]) if len(target) else np.empty(0, np.int64)
    n_near = np.diff(np.r_[first, len(target)])
    return pa.table({
        "word": pa.array([words[k] for k in target[first]], pa.string()), "n_near": pa.array(n_near, pa.int64()),
        "form": pa.array([words[k] for k in partner[first]], pa.string()), "form_n": pa.array(n[partner[first]], pa.int64()),
    })


def _search_shard(group: pa.Table) -> pa.Table:
    words, n = group["word"].to_pylist(), group["n"].to_numpy()
    is_query = group["query"].to_numpy(zero_copy_only=False) if group.num_rows else np.empty(0, bool)
    asked, kept = np.flatnonzero(is_query), np.flatnonzero(~is_query)
    raw = [w.encode("latin-1") for w in words]
    q, i = near_pairs([raw[k] for k in kept], [raw[k] for k in asked])
    q, i = asked[q], kept[i]
    # A word stands here twice, once as a query and once in the trie; each is the target of its own finds.
    return pa.concat_tables([_best(words, n, q, i), _best(words, n, i, q)])


def near_words(words: DataFrame) -> DataFrame:
    """(word, n, n_near, form, form_n): each word with its number of near words and the best of these, if any.

    `words` is a stored table of distinct words with n and vector.
    """
    spark = words.sparkSession
    heavy = heavy_nodes(words, max(SHARD_WORDS, words.count() // MAX_SHARDS))
    routed = words.mapInArrow(_routed(spark.sparkContext.broadcast(heavy)), "shard binary, query boolean, word string, n bigint")
    found = routed.groupBy("shard").applyInArrow(_search_shard, "word string, n_near bigint, form string, form_n bigint")
    best = F.struct((-F.col("form_n")).alias("low"), F.col("form").alias("form"))
    rows = words.select("word", "n", F.lit(0).cast("bigint").alias("n_near"), F.lit(None).cast("struct<low:bigint,form:string>").alias("best"))
    rows = rows.unionByName(found.select("word", F.lit(None).cast("bigint").alias("n"), "n_near", F.when(F.col("form").isNotNull(), best).alias("best")))
    merged = rows.groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), F.min("best").alias("best"))
    return merged.select("word", "n", "n_near", F.col("best.form").alias("form"), (-F.col("best.low")).alias("form_n"))


def with_roots(forms: DataFrame) -> DataFrame:
    """`forms` (stored) with `root`: where following the forms from a word ends.

    Steps are doubled in every round. A form occurs at least twice as often as its word, so no path is longer than
    the logarithm of the largest count, and the rounds are as many as its own logarithm.
    """
    top = forms.agg(F.max("n")).first()[0] or 1
    steps = forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(math.log2(top) + 1)) if top > 1 else 0):
        ahead = steps.select(F.col("word").alias("from"), F.col("root").alias("ahead"))
        steps = stage(steps.join(ahead, F.col("root") == F.col("from"), "left").select("word", F.coalesce("ahead", "root").alias("root")), "spelling-roots")
    ends = steps.select(F.col("word").alias("of"), "root")
    return forms.join(ends, F.col("word") == F.col("of"), "left").select(*forms.columns, F.coalesce("root", "word").alias("root"))


def spelling_variants(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", min_count: int = MIN_COUNT, ratio: int = FORM_RATIO
) -> DataFrame:
    """(word, form, root, n, n_near, form_n): the words of all texts, grouped by the more frequent word they are a variant of.

    `n_near` counts the words one edit away; `form` is the most frequent of them, the smallest in code-point order
    of several, if it occurs at least `ratio` times as often as the word; `root` is where the forms lead to.
    Null texts have no words; a null id counts as an empty one; repeated rows count as often as they stand
    there; an empty table, or one without words, gives no rows; other columns may have any name.
    """
    if ratio < 2:
        raise ValueError("forms must be at least twice as frequent, or paths might not end")
    inner = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text).cast("string").alias("text"))
    counted = inner.mapInArrow(_counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)
    words = stage(counted.mapInArrow(_with_vectors, "word string, n bigint, vector binary"), "spelling-words")
    near = near_words(words)
    is_form = F.col("form_n") >= ratio * F.col("n")
    forms = stage(near.select(
        "word", "n", "n_near", F.when(is_form, F.col("form")).alias("form"), F.when(is_form, F.col("form_n")).alias("form_n")
    ), "spelling-forms")
    return with_roots(forms).select("word", "form", "root", "n", "n_near", "form_n")
