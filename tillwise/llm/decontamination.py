"""Removal of documents that hold passages of a benchmark, by suffix arrays over the documents.

The benchmark is numbered word by word and sent to the tasks in blocks of bounded size. A task sorts
the suffixes of its documents into a suffix array per batch (a shard) and finds every benchmark suffix
in it by binary search; the range found gives the places. Suffixes that begin with the same window of an
item are searched once, and the longest verbatim match of a passage is read off the item's suffix automaton
in one walk along the passage, so words repeated without end cost no more than others. Only suffixes that begin with enough consecutive benchmark word pairs to hold a
window enter the array: no other suffix can be in a range that a search returns.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillwise.llm.common import split_words

WINDOW = 10
BLOCK_WORDS = 2_000_000  # benchmark words sent to the tasks at once: about 100 MB of index
SHARD_BYTES = 8 << 20
AUTOMATON_WORDS = 100_000  # words of items whose automata a task keeps: some 50 MB
SPANS = "array<struct<item_id: bigint, start: bigint, end: bigint, longest: bigint>>"
SPAN_ARROW = pa.list_(pa.struct([(n, pa.int64()) for n in ("item_id", "start", "end", "longest")]))


class BenchmarkBlock:
    """Benchmark items as numbers: words are numbered from 1, and 0 is any other word."""

    def __init__(self, items: list[tuple[int, bytes]], window: int = WINDOW):
        self.window = window
        self.number: dict[bytes, int] = {}
        texts, ids = [], []
        for item, text in items:
            words = split_words(text or b"")
            if words:
                ids.append(item)
                texts.append(np.array([self.number.setdefault(w, len(self.number) + 1) for w in words], np.int64))
        starts, owner, lengths = [], [], []
        at = 0
        for k, t in enumerate(texts):
            first = self._distinct(t, window)
            starts.append(at + first)
            owner.append(np.full(len(first), k))
            lengths.append(np.full(len(first), min(window, len(t))))
            at += len(t) + 1
        self.ids = ids
        self.begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
        self.automata: dict[int, list[tuple[dict[int, int], int, int]]] = {}
        self.automaton_words = 0
        # Items one after another, each ended by -1, which equals no word; then room for a window.
        tail = [np.full(window, -1, np.int64)]
        self.words = np.concatenate([np.append(t, -1) for t in texts] + tail)
        self.starts = np.concatenate(starts) if starts else np.empty(0, np.int64)
        self.owner = np.concatenate(owner) if owner else np.empty(0, np.int64)
        self.lengths = np.concatenate(lengths) if lengths else np.empty(0, np.int64)
        self.shortest = int(self.lengths.min()) if len(self.lengths) else 0
        pairs = self.words[:-1] * (len(self.number) + 1) + self.words[1:]
        self.pairs = np.unique(pairs[(self.words[:-1] > 0) & (self.words[1:] > 0)])

    @staticmethod
    def _distinct(words: np.ndarray, window: int) -> np.ndarray:
        """The first place of each different window of an item."""
        if len(words) <= window or len(np.unique(words)) == len(words):
            return np.arange(max(1, len(words) - window + 1))
        return np.sort(np.unique(np.lib.stride_tricks.sliding_window_view(words, window), axis=0, return_index=True)[1])

    def longest(self, owner: int, words: list[int]) -> int:
        """The most consecutive `words` that stand so in an item."""
        if owner not in self.automata:
            item = self.words[self.begins[owner] : self.begins[owner + 1] - 1].tolist()
            if self.automaton_words > AUTOMATON_WORDS:
                self.automata.clear()
                self.automaton_words = 0
            self.automata[owner] = suffix_automaton(item)
            self.automaton_words += len(item)
        states, state, size, most = self.automata[owner], 0, 0, 0
        for w in words:
            while state and w not in states[state][0]:
                state = states[state][1]
                size = states[state][2]
            if w in states[state][0]:
                state, size = states[state][0][w], size + 1
            most = max(most, size)
        return most

    def suffix_array(self, words: np.ndarray) -> np.ndarray:
        """Places in `words` at which a window can begin, in the order of the `window` words from there."""
        live = words > 0
        at = np.flatnonzero(live[:-1] & live[1:])
        hit = np.zeros(len(words), np.int64)
        if len(self.pairs):
            code = words[at] * (len(self.number) + 1) + words[at + 1]
            near = np.minimum(np.searchsorted(self.pairs, code), len(self.pairs) - 1)
            hit[at] = self.pairs[near] == code
        need = self.shortest - 1
        if need > 0:
            total = np.concatenate([[0], np.cumsum(hit)])
            ok = np.zeros(len(words), bool)
            if len(words) > need:
                ok[: len(words) - need] = total[need : len(words)] - total[: len(words) - need] == need
        else:
            ok = live
        places = np.flatnonzero(ok)
        return places[np.argsort(self.keys(words, places), kind="stable")]

    def keys(self, words: np.ndarray, places: np.ndarray, lengths: np.ndarray | None = None, fill: int = 0) -> np.ndarray:
        """The words from each place as comparable byte strings; beyond `lengths` filled up."""
        block = words[places[:, None] + np.arange(self.window)] + 1
        if lengths is not None:
            block = np.where(np.arange(self.window) < lengths[:, None], block, fill)
        # Padded by one byte: numpy drops zero bytes at the end of a string when it compares.
        big = np.ascontiguousarray(block.astype(">u4")).view(np.uint8).reshape(len(places), 4 * self.window)
        return np.hstack([big, np.ones((len(places), 1), np.uint8)]).reshape(-1).view(f"S{4 * self.window + 1}")

    def matches(self, words: np.ndarray) -> tuple[np.ndarray, ...]:
        """(place, item, length) of every window of the block found in `words`, which ends with at least `window` entries of -1."""
        order = self.suffix_array(words)
        if not len(order) or not len(self.starts):
            return (np.empty(0, np.int64),) * 3
        keys = self.keys(words, order)
        low = np.searchsorted(keys, self.keys(self.words, self.starts, self.lengths), "left")
        high = np.searchsorted(keys, self.keys(self.words, self.starts, self.lengths, 2**32 - 1), "right")
        count = np.maximum(high - low, 0)
        which = np.repeat(np.arange(len(count)), count)
        inside = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        place = order[np.repeat(low, count) + inside]
        return place, self.owner[which], self.lengths[which]


def suffix_automaton(words: list[int]) -> list[tuple[dict[int, int], int, int]]:
    """States (next state by word, suffix link, length) of the smallest automaton of all runs of `words`; 0 is the start."""
    steps, link, length, last = [{}], [-1], [0], 0
    for w in words:
        new = len(steps)
        steps.append({})
        link.append(0)
        length.append(length[last] + 1)
        at, last = last, new
        while at >= 0 and w not in steps[at]:
            steps[at][w] = new
            at = link[at]
        if at < 0:
            continue
        to = steps[at][w]
        if length[to] == length[at] + 1:
            link[new] = to
            continue
        copy = len(steps)
        steps.append(dict(steps[to]))
        link.append(link[to])
        length.append(length[at] + 1)
        while at >= 0 and steps[at].get(w) == to:
            steps[at][w] = copy
            at = link[at]
        link[to] = link[new] = copy
    return list(zip(steps, link, length))


def _merge(doc: np.ndarray, place: np.ndarray, item: np.ndarray, length: np.ndarray):
    """Windows of one item that overlap or touch in a document, put together: one row per passage."""
    order = np.lexsort((place, item, doc))
    doc, place, item, end = doc[order], place[order], item[order], (place + length)[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (place[1:] > end[:-1])
    first = np.flatnonzero(new)
    if not len(first):
        return doc, item, place, end
    last = np.append(first[1:], len(doc)) - 1
    return doc[first], item[first], place[first], end[last]


def _find(block_of, last: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: BenchmarkBlock = block_of.value
        get = block.number.get
        gap = np.full(block.window, -1, np.int64)
        for batch in batches:
            counts, found = [], []
            spans = batch.column("spans").to_pylist()
            for texts in _shards(batch.column("text").cast(pa.binary()).to_pylist()):
                arrays, starts, at = [], [], 0
                for text in texts:
                    words = split_words(text or b"")
                    starts.append(at)
                    counts.append(len(words))
                    arrays += [np.fromiter(map(get, words, repeat(0)), np.int64, len(words)), gap]
                    at += len(words) + block.window
                shard = np.concatenate(arrays)
                place, item, length = block.matches(shard)
                doc = np.searchsorted(starts, place, "right") - 1
                first = len(counts) - len(texts)
                for d, i, a, b in zip(*(x.tolist() for x in _merge(doc, place, item, length))):
                    found.append((first + d, {
                        "item_id": block.ids[i], "start": a - starts[d], "end": b - starts[d],
                        "longest": block.longest(i, shard[a:b].tolist()),
                    }))
            for d, span in found:
                spans[d].append(span)
            columns = {"row": batch.column("row"), "text": batch.column("text"), "n_words": pa.array(counts, pa.int64()),
                       "spans": pa.array(spans, SPAN_ARROW)}
            if last:
                del columns["text"]
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def _shards(texts: list) -> Iterator[list]:
    part, size = [], 0
    for text in texts:
        part.append(text)
        size += len(text or b"")
        if size >= SHARD_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def benchmark_blocks(items: DataFrame, item: str, text: str, window: int, block_words: int) -> Iterator[BenchmarkBlock]:
    """The benchmark in blocks of about `block_words` words; at least one, possibly empty."""
    part, size, any_yet = [], 0, False
    rows = items.select(F.col(item).cast("bigint").alias("i"), F.col(text).cast("binary").alias("t")).filter("t IS NOT NULL")
    for row in rows.toLocalIterator():
        part.append((row["i"], bytes(row["t"])))
        size += len(split_words(bytes(row["t"])))
        if size >= block_words:
            yield BenchmarkBlock(part, window)
            part, size, any_yet = [], 0, True
    if part or not any_yet:
        yield BenchmarkBlock(part, window)


def _with_last(blocks: Iterator[BenchmarkBlock]) -> Iterator[tuple[BenchmarkBlock, bool]]:
    block = next(blocks)
    for following in blocks:
        yield block, False
        block = following
    yield block, True


def find_passages(
    docs: DataFrame, items: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), item: str = "item_id",
    item_text: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Documents as `row` (struct of the carried columns), n_words, spans.

    `spans` are the passages that a document shares with items, as (item_id, start, end, longest): words
    start to end - 1 are covered by windows of `window` words of the item (or all its words, if fewer);
    `longest` is the longest verbatim match that begins in the passage. Words are runs of letters, digits
    and characters beyond ASCII, A-Z lower-cased. Null texts have no words; items without text or words
    match nothing; an item without id matches but is not named. Repeated documents are searched each for
    itself, repeated items count once. Tables may be empty and have further columns of any name.
    """
    spark = docs.sparkSession
    found = docs.select(
        F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(text).cast("string").alias("text"),
        F.lit(0).cast("bigint").alias("n_words"), F.array().cast(SPANS).alias("spans"),
    )
    # A block goes to the tasks, and leaves the driver, before the block after the next one is made.
    for block, last in _with_last(benchmark_blocks(items, item, item_text, window, block_words)):
        schema = T.StructType([f for f in found.schema if not (last and f.name == "text")])
        found = found.mapInArrow(_find(spark.sparkContext.broadcast(block), last), schema)
    return found


def verdicts(found: DataFrame) -> DataFrame:
    """`found` with n_hit, n_items, items (ids as sorted strings) and contaminated."""
    ordered = F.sort_array(F.transform("spans", lambda s: F.struct(s["start"].alias("a"), s["end"].alias("b"))))
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0).cast("bigint").alias("to"))

    def add(state, s):
        fresh = F.greatest(s["b"] - F.greatest(s["a"], state["to"]), F.lit(0).cast("bigint"))
        return F.struct((state["n"] + fresh).alias("n"), F.greatest(state["to"], s["b"]).alias("to"))

    items = F.array_sort(F.array_distinct(F.transform(F.filter("spans", lambda s: s["item_id"].isNotNull()), lambda s: s["item_id"].cast("string"))))
    return found.select(
        "*", F.aggregate(ordered, start, add, lambda s: s["n"]).alias("n_hit"), F.size(items).cast("bigint").alias("n_items"),
        items.alias("items"), (F.size("spans") > 0).alias("contaminated"),
    )


def decontaminate_stage(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that share no window with any item, with all their columns."""
    return find_passages(docs, items, carry=tuple(docs.columns)).filter(F.size("spans") == 0).select("row.*")
