"""Packing of token sequences as a cutting-stock problem solved by column generation.

1. Documents become token ids where they lie. A document longer than a sequence is cut into whole
   sequences and a rest; pieces are counted in a histogram of length classes of `width` tokens each.
2. The driver solves the linear program over the histogram, whose size does not depend on the corpus:
   a column is a pattern of classes that fill one sequence, or the cut of a class into two. A knapsack
   dynamic program under the current prices finds the columns that lower the cost. Counts are rounded
   down, and what is left, a few patterns at most, is packed one by one.
3. Every piece has a rank in its class: its place in its task's output and the counts of the tasks
   before. The plan maps a class and a rank to a place in a sequence, so pieces are assigned where they
   lie. Only cut pieces meet their ids again.

Classes round lengths up, so a sequence never overflows; what rounding loses is at most `width - 1` tokens a piece.
"""

from __future__ import annotations

import functools
import math
import os
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tillwise.functions.scale import stage

# Spark's tasks use all cores already.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

SIZE = 2048
WIDTH = 8
END_ID = 1
CUT_COST = 2  # a cut must save more than this many classes' worth of padding
CACHE_WORDS = 600_000
GROUP_BYTES = 8_000_000  # texts encoded together
CACHE_CHARS = 40
FEW_CUTS = 100_000  # so many cut pieces are sent to the ids; more of them meet in a shuffle

# --- token ids -------------------------------------------------------------------------------

# Letters up to U+00FF with ASCII punctuation around them. Apostrophes are left out, as the tokenizer splits off contractions
# first, and marks of special tokens.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
MARKS = r"""!"#$%&()*+,\-./:;=?@\[\\\]^_`{}~"""
AROUND = rf"^(?P<before>[{MARKS}]*)(?P<letters>[{LETTERS}]+)(?P<after>[{MARKS}]*)\z"


class WordTokens:
    """Ids of texts by a tokenizer whose tokens never hold or cross white space and that ignores case.

    Ids of a text are those of its words (between ASCII white space) one after the other. Arrow splits the texts of
    a group and numbers their distinct words. Letters up to U+00FF are taken in lower case and apart from the punctuation
    before and after them, as the tokenizer splits these too; other words stay whole. Each distinct part is looked up once, and
    only new ones go to the library, those of letters many at once. The ids are then put in the order of the texts by numbers.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        vocabulary = self.library.get_vocab()
        self.kind = np.dtype("<u2" if max(vocabulary.values()) < 1 << 16 else "<u4")
        self.known: dict[str, bytes] = {"": b""}  # a text's outer white space gives empty words
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)  # tokens that end a word
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True

    def _encode(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _encode_letters(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words of letters, told apart in the ids of all of them by the tokens that end a word."""
        ids = np.array(self.library.encode(" ".join(words), add_special_tokens=False).ids, self.kind)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(words):
            return {w: self._encode(w) for w in words}
        raw, size = ids.tobytes(), self.kind.itemsize
        return {w: raw[a * size : b * size] for w, a, b in zip(words, [0, *ends.tolist()], ends.tolist())}

    def _learn(self, parts: list[str]) -> dict[str, bytes]:
        """Ids of new parts; kept for later while there is room."""
        letters, others = [], []
        for part in parts:
            (letters if part.isalpha() and (part.isascii() or max(part) <= "\xff") and part.islower() else others).append(part)
        fresh = self._encode_letters(letters) if letters else {}
        for part, encoded in zip(others, self.library.encode_batch_fast(others, add_special_tokens=False)):
            fresh[part] = np.array(encoded.ids, self.kind).tobytes()
        if len(self.known) + len(fresh) <= CACHE_WORDS:
            self.known.update(fresh if len(max(fresh, key=len)) <= CACHE_CHARS else {w: i for w, i in fresh.items() if len(w) <= CACHE_CHARS})
        return fresh

    @staticmethod
    def _parts(words: pa.StringArray) -> pa.DictionaryArray:
        """Three parts of each word, one after the other: punctuation, letters in lower case, punctuation; or the word between empty ones."""
        found = pc.extract_regex(words, AROUND)
        before, letters, after = (pc.struct_field(found, name) for name in ("before", "letters", "after"))
        middle = pc.if_else(found.is_valid(), pc.utf8_lower(letters), words)
        columns = [pc.if_else(found.is_valid(), before, ""), middle, pc.if_else(found.is_valid(), after, "")]
        parts = pa.concat_arrays(columns).dictionary_encode()
        order = np.arange(3 * len(words)).reshape(3, -1).T.ravel()
        return parts.take(pa.array(order))

    def ids(self, texts: Sequence[str | None] | pa.StringArray) -> list[np.ndarray]:
        """The ids of each text (null: none); the words and ids of all of them are in memory at once."""
        lists = pc.ascii_split_whitespace(pc.fill_null(pa.array(texts, pa.string()), ""))
        words = lists.flatten().dictionary_encode()
        parts = self._parts(words.dictionary)
        vocabulary = parts.dictionary.to_pylist()
        found = list(map(self.known.get, vocabulary))
        if None in found:
            learnt = self._learn([w for w, ids in zip(vocabulary, found) if ids is None])
            found = [learnt[w] if ids is None else ids for w, ids in zip(vocabulary, found)]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.kind.itemsize
        pool, begins = np.frombuffer(b"".join(found), self.kind), np.cumsum(sizes) - sizes
        numbers = parts.indices.to_numpy().reshape(-1, 3)[words.indices.to_numpy()].ravel()
        lengths = sizes[numbers]
        ends = np.cumsum(lengths)
        # Each id's place in the pool: its part's begin there, and how far it is from its part's begin in the texts.
        places = np.repeat(begins[numbers] - ends + lengths, lengths)
        places += np.arange(len(places))
        borders = np.r_[0, ends][3 * lists.value_lengths().to_numpy().cumsum()]
        return np.split(pool[places], borders)[:-1]


@functools.lru_cache(maxsize=1)
def word_tokens(path: str) -> WordTokens:
    """The tokenizer with the words a Python worker has met, at most `CACHE_WORDS`; its tasks share them."""
    return WordTokens(path)


def _in_groups(texts: pa.StringArray, most: int) -> Iterator[pa.StringArray]:
    """Consecutive texts, at most `most` bytes together or one text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    begin = size = 0
    for k, n in enumerate(sizes.tolist()):
        if size + n > most and k > begin:
            yield texts.slice(begin, k - begin)
            begin, size = k, 0
        size += n
    if begin < len(texts):
        yield texts.slice(begin)


def crc_of(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _running(classes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """The number of each element among those of its class, counting on from `seen`, which is updated."""
    order = np.argsort(classes, kind="stable")
    ordered = classes[order]
    first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(ordered) else np.empty(0, int)
    sizes = np.diff(np.r_[first, len(ordered)])
    out = np.empty(len(classes), np.int64)
    out[order] = np.arange(len(ordered)) - np.repeat(first, sizes) + seen[ordered]
    seen[ordered[first]] += sizes
    return out


PIECE = T.StructType([
    T.StructField("at", T.LongType()), T.StructField("part", T.LongType()), T.StructField("class", T.IntegerType()),
    T.StructField("place", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids_crc32", T.LongType()), T.StructField("doc_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
])


def _pieces(tokenizer: str, end_id: int, size: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_tokens(tokenizer)
        part, seen, number = TaskContext.get().partitionId(), np.zeros(-(-size // width) + 1, np.int64), 0
        for batch in batches:
            docs, starts, lengths, crcs, totals, ids = [], [], [], [], [], []
            groups = map(words.ids, _in_groups(batch.column("text"), GROUP_BYTES))
            for k, found in enumerate(chain.from_iterable(groups)):
                found = np.append(found, np.array(end_id, words.kind))
                for start in range(0, len(found), size):
                    piece = found[start : start + size]
                    docs.append(k)
                    starts.append(start)
                    lengths.append(len(piece))
                    crcs.append(crc_of(piece))
                    totals.append(len(found))
                    # Whole sequences are never cut.
                    ids.append(piece.tobytes() if len(piece) < size else None)
            classes = -(-np.array(lengths, np.int64) // width)
            place = _running(classes, seen)
            at = (part << 33) + number + np.arange(len(docs))
            number += len(docs)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").take(pa.array(docs, pa.int64())), pa.array(at, pa.int64()), pa.array([part] * len(docs), pa.int64()),
                 pa.array(classes, pa.int32()), pa.array(place, pa.int64()), pa.array(starts, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(crcs, pa.int64()), pa.array(totals, pa.int64()), pa.array(ids, pa.binary())],
                names=["row", *PIECE.names],
            )

    return run


# --- the plan --------------------------------------------------------------------------------

Pattern = dict[int, int]


def knapsack(prices: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """For each fill up to `capacity`: the best sum of prices of classes that add up to it, and the last class taken.

    `prices[c]` is the price of class c; a fill that no classes add up to has minus infinity.
    """
    best, last = np.full(capacity + 1, -np.inf), np.zeros(capacity + 1, np.int64)
    best[0] = 0
    for fill in range(1, capacity + 1):
        values = best[fill - 1 :: -1] + prices[1 : fill + 1]
        last[fill] = values.argmax() + 1
        best[fill] = values[last[fill] - 1]
    return best, last


def _taken(last: np.ndarray, fill: int) -> Pattern:
    out: Pattern = Counter()
    while fill:
        out[int(last[fill])] += 1
        fill -= int(last[fill])
    return dict(out)


class Master:
    """The linear program: rows are classes 1..capacity, columns patterns and cuts, by the revised simplex method."""

    def __init__(self, demand: np.ndarray, capacity: int):
        classes = np.arange(1, capacity + 1)
        copies = capacity // classes
        self.columns: list[Pattern] = [{int(c): int(n)} for c, n in zip(classes, copies)]
        self.cost = np.full(capacity, float(capacity))
        self.inverse = np.diag(1.0 / copies)
        self.x = demand / copies
        self.prices = self.cost / copies

    def value(self) -> float:
        return float(self.cost @ self.x)

    def enter(self, column: Pattern, cost: float) -> bool:
        """Bring a column into the basis if it lowers the cost under the present prices."""
        rows = np.array(list(column)) - 1
        amounts = np.array(list(column.values()), float)
        gain = cost - self.prices[rows] @ amounts
        if gain > -1e-7:
            return False
        step = self.inverse[:, rows] @ amounts
        can_leave = step > 1e-9
        if not can_leave.any():
            return False
        ratio = np.where(can_leave, self.x / np.where(can_leave, step, 1), np.inf)
        out = int(ratio.argmin())
        row = self.inverse[out] / step[out]
        self.inverse -= np.outer(step, row)
        self.inverse[out] = row
        amount = ratio[out]
        self.x = np.maximum(self.x - amount * step, 0)
        self.x[out] = amount
        self.prices = self.prices + gain * row
        self.columns[out], self.cost[out] = column, cost
        return True


def generate_columns(
    demand: np.ndarray, capacity: int, tolerance: float = 5e-4, rounds: int = 600, at_once: int = 30
) -> tuple[list[Pattern], np.ndarray]:
    """Columns and how often each is used, covering `demand` (of classes 1..capacity) at nearly the least cost.

    A pattern costs `capacity` whatever it holds. A cut holds +1 of the class it takes and -1 of each class
    it makes, and costs `CUT_COST`. No plan can cost less than the classes' sum, which ends the search.
    """
    classes = np.arange(1, capacity + 1)
    least = float(demand @ classes)
    # A little of every class keeps the steps of the simplex method from being empty ones; rounding drops it.
    chance = np.random.default_rng(0)
    master = Master(demand + 1e-6 * least / capacity * chance.uniform(0.5, 1, capacity), capacity)
    for k in range(rounds):
        if master.value() - least <= tolerance * least:
            break
        prices = np.r_[-np.inf, master.prices]
        best, last = knapsack(prices, capacity)
        fills = np.argsort(-best)[:at_once]
        entered = [master.enter(_taken(last, int(f)), capacity) for f in fills if best[f] > capacity + 1e-7]
        # The best pattern through one or the other class, not only the best of all.
        for c in chance.permutation(capacity)[:at_once] + 1:
            column = Counter(_taken(last, capacity - int(c)))
            column[int(c)] += 1
            entered.append(master.enter(dict(column), capacity))
        # Cuts change less from round to round and are looked for in every fifth.
        for c in range(2, capacity + 1) if k % 5 == 0 else ():
            made = master.prices[: c - 1] + master.prices[c - 2 :: -1][: c - 1]
            a = int(made.argmin()) + 1
            if master.prices[c - 1] - made[a - 1] > CUT_COST + 1e-7:
                column = Counter({a: -1})
                column[c - a] -= 1
                entered.append(master.enter({c: 1, **column}, CUT_COST))
        if k % 5 == 0 and not any(entered):
            break
    return master.columns, master.x


@dataclass
class Plan:
    """Where the pieces of a class go, by rank: entries sorted by (class, first rank).

    A pattern's entry gives `each` pieces to every sequence from `first` on, at slots from `slot` on. A cut's
    entry makes of each piece one of class `left` (its first left * width tokens) and one of the class of
    the rest, whose ranks begin at `left_rank` and `right_rank`; there `each` is 0.
    """

    classes: np.ndarray
    ranks: np.ndarray
    each: np.ndarray
    first: np.ndarray
    slot: np.ndarray
    left: np.ndarray
    left_rank: np.ndarray
    right_rank: np.ndarray
    sequences: int
    cuts: int


def is_cut(column: Pattern) -> bool:
    return min(column.values()) < 0


def _halves(column: Pattern) -> tuple[int, int, int]:
    """(class taken, class made first, class of the rest) of a cut."""
    whole = next(c for c, n in column.items() if n > 0)
    left = min(c for c, n in column.items() if n < 0)
    return whole, left, whole - left


def _rounded(columns: list[Pattern], x: np.ndarray, demand: np.ndarray) -> tuple[list[tuple[Pattern, int]], np.ndarray]:
    """Columns with whole counts, and the pieces of each class that they leave (index 0 is unused)."""
    used = [[c, int(math.floor(n + 1e-6))] for c, n in zip(columns, x)]
    left = np.r_[0, demand].astype(np.int64)
    for column, n in used:
        for c, k in column.items():
            left[c] -= k * n
    # Rounded cuts make fewer pieces than patterns may count on: take back patterns that want too many.
    while (left < 0).any():
        c = int(np.flatnonzero(left < 0)[-1])
        entry = max((u for u in used if u[1] > 0 and u[0].get(c, 0) > 0), key=lambda u: u[1])
        n = min(entry[1], -(-int(-left[c]) // entry[0][c]))
        entry[1] -= n
        for k, m in entry[0].items():
            left[k] += m * n
    return [(c, n) for c, n in used if n > 0], left


def _best_fit(left: np.ndarray, room: int) -> int:
    """The class to put into `room` next, 0 if none fits: one that fills it alone or with one more, else the largest."""
    fitting = np.flatnonzero(left[: room + 1])
    if not len(fitting):
        return 0
    if fitting[-1] == room:
        return room
    paired = fitting[left[room - fitting] > (2 * fitting == room)]
    return int((paired if len(paired) else fitting)[-1])


def _pack_rest(left: np.ndarray, capacity: int) -> list[tuple[Pattern, int]]:
    """One pattern after the other for the few pieces that rounding left: the largest first, then what fits
    best; where nothing fits, the smallest piece is cut, unless a cut would not pay."""
    left, out = left.copy(), []
    while left.any():
        pattern: Pattern = Counter()
        largest = int(np.flatnonzero(left)[-1])
        pattern[largest] += 1
        left[largest] -= 1
        room = capacity - largest
        while room and left.any():
            c = _best_fit(left, room)
            if c:
                left[c] -= 1
            elif room <= CUT_COST:
                break
            else:
                whole, c = int(np.flatnonzero(left)[0]), room
                out.append((_cut(whole, c), 1))
                left[whole] -= 1
                left[whole - c] += 1
            pattern[c] += 1
            room -= c
        out.append((dict(pattern), 1))
    return out


def _cut(whole: int, left: int) -> Pattern:
    made = Counter({left: -1})
    made[whole - left] -= 1
    return {whole: 1, **made}


def make_plan(demand: np.ndarray, capacity: int) -> Plan:
    """The plan for `demand[c - 1]` pieces of each class c of 1..capacity."""
    columns, x = generate_columns(demand, capacity)
    used, left = _rounded(columns, x, demand)
    used += _pack_rest(left, capacity)
    entries: list[list[int]] = []
    next_rank, made, sequences = np.zeros(capacity + 1, np.int64), np.r_[0, demand].astype(np.int64), 0
    for column, n in used:
        if is_cut(column):
            continue
        slot = 0
        for c, each in sorted(column.items(), reverse=True):
            entries.append([c, next_rank[c], each, sequences, slot, 0, 0, 0])
            next_rank[c] += each * n
            slot += each
        sequences += n
    cuts = 0
    for column, n in used:
        if is_cut(column):
            whole, a, b = _halves(column)
            entries.append([whole, next_rank[whole], 0, 0, 0, a, made[a], made[b] + (n if a == b else 0)])
            next_rank[whole] += n
            made[a] += n
            made[b] += n
            cuts += n
    table = np.array(sorted(entries), np.int64).reshape(-1, 8)
    return Plan(*table.T, sequences=sequences, cuts=cuts)


# --- assignment ------------------------------------------------------------------------------

def place_pieces(plan: Plan, classes: np.ndarray, ranks: np.ndarray, lengths: np.ndarray, width: int) -> dict[str, np.ndarray]:
    """The sub-pieces of pieces: which piece, its begin and length in it, its sequence and slot there."""
    starts = np.searchsorted(plan.classes, np.arange(plan.classes.max(initial=0) + 2))
    of, begin, length = np.arange(len(classes)), np.zeros(len(classes), np.int64), lengths.astype(np.int64)
    classes, ranks, done = classes.astype(np.int64), ranks.astype(np.int64), []
    while len(of):
        entry = np.empty(len(of), np.int64)
        for c in np.unique(classes):
            mine = classes == c
            a, b = starts[c], starts[c + 1]
            entry[mine] = a + np.searchsorted(plan.ranks[a:b], ranks[mine], "right") - 1
        each, inside = plan.each[entry], ranks - plan.ranks[entry]
        put = each > 0
        some = np.maximum(each, 1)
        done.append((of[put], begin[put], length[put], (plan.first[entry] + inside // some)[put], (plan.slot[entry] + inside % some)[put]))
        cut = ~put
        left = plan.left[entry][cut]
        head = left * width
        of, begin, length = np.r_[of[cut], of[cut]], np.r_[begin[cut], begin[cut] + head], np.r_[head, length[cut] - head]
        ranks = np.r_[(plan.left_rank[entry] + inside)[cut], (plan.right_rank[entry] + inside)[cut]]
        classes = np.r_[left, classes[cut] - left]
    done = done or [(np.empty(0, np.int64),) * 5]
    return dict(zip(("of", "begin", "length", "sequence", "slot"), map(np.concatenate, zip(*done))))


def _assign(plan, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("class", "rank", "length")}
            sub = place_pieces(plan.value, got["class"], got["rank"], got["length"], width)
            of = pa.array(sub["of"], pa.int64())
            whole = sub["length"] == got["length"][sub["of"]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(of) for c in ("row", "at", "start", "ids_crc32", "doc_tokens")),
                 *(pa.array(sub[c], pa.int64()) for c in ("begin", "length", "sequence", "slot")), pa.array(whole, pa.bool_())],
                names=["row", "at", "start", "ids_crc32", "doc_tokens", "begin", "length", "sequence_id", "slot", "whole"],
            )

    return run


def _cut_crcs(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, lengths = batch.column("begin").to_pylist(), batch.column("length").to_pylist()
            crcs = [
                crc_of(np.frombuffer(ids, kind)[b : b + n]) for ids, b, n in zip(batch.column("ids").to_pylist(), begins, lengths)
            ]
            columns = {name: batch.column(name) for name in batch.schema.names if name != "ids"} | {"ids_crc32": pa.array(crcs, pa.int64())}
            yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return run


def pack(
    docs: DataFrame, tokenizer: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",),
    end_id: int = END_ID, size: int = SIZE, width: int = WIDTH,
) -> DataFrame:
    """A row for each piece of each document: `row` (struct of the carried columns), start, length, ids_crc32,
    doc_tokens, sequence_id, offset.

    A document is its text's ids and then `end_id`. Documents that fit are cut only where that saves padding.
    Null texts are empty documents of one token; every row is a document of its own, also where rows are
    equal or ids are missing; an empty table gives no rows; other columns may have any name.
    """
    if size % width:
        raise ValueError("the size of a sequence must be a multiple of the width of a length class")
    spark = docs.sparkSession
    inner = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(text).cast("string").alias("text"))
    pieces = stage(
        inner.mapInArrow(_pieces(tokenizer, end_id, size, width), T.StructType([inner.schema["row"], *PIECE.fields])), "packing-pieces"
    )
    counts = pieces.groupBy("part", "class").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["class"]: r["n"] for r in counts.groupBy("class").agg(F.sum("n").alias("n")).collect()}
    capacity = size // width
    demand = np.array([histogram.get(c, 0) for c in range(1, capacity + 1)], np.int64)
    plan = make_plan(demand, capacity)
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select(
        F.col("part").alias("in_part"), F.col("class").alias("of_class"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    ranked = pieces.drop("ids").join(bases, (F.col("part") == F.col("in_part")) & (F.col("class") == F.col("of_class")))
    ranked = ranked.select("row", "at", "class", (F.col("place") + F.col("base")).alias("rank"), "start", "length", "ids_crc32", "doc_tokens")
    schema = T.StructType([
        ranked.schema["row"], *(T.StructField(c, T.LongType()) for c in ("at", "start", "ids_crc32", "doc_tokens", "begin", "length", "sequence_id", "slot")),
        T.StructField("whole", T.BooleanType()),
    ])
    placed = ranked.mapInArrow(_assign(spark.sparkContext.broadcast(plan), width), schema)
    if plan.cuts:
        placed = stage(placed, "packing-placed")
        cut = placed.filter(~F.col("whole"))
        ids = pieces.select(F.col("at").alias("ids_at"), "ids")
        met = ids.join(F.broadcast(cut) if plan.cuts <= FEW_CUTS else cut, F.col("ids_at") == F.col("at")).select(*placed.columns, "ids")
        kind = word_tokens(tokenizer).kind.str
        placed = placed.filter("whole").unionByName(met.mapInArrow(_cut_crcs(kind), schema))
    along = Window.partitionBy("sequence_id").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    return placed.select(
        "row", (F.col("start") + F.col("begin")).alias("start"), "length", "ids_crc32", "doc_tokens", "sequence_id",
        F.coalesce(F.sum("length").over(along), F.lit(0)).alias("offset"),
    )
