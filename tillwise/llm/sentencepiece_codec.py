"""SentencePiece encoding and decoding by a Viterbi search that words share.

A text becomes one marked string (spaces as U+2581, one in front). No piece spans a change from
another character to the mark, nor a character outside the alphabet of the pieces, so the string falls
into words that are encoded independently. The distinct words of a group of documents are sorted, which
is a depth-first order of their trie: the forward states of the prefix that a word has in common with
the one before are reused, and only its remaining characters are searched.

Both kinds of model are paths through the same lattice of pieces:

* unigram: the forward state of a prefix is its best sum of piece scores;
* BPE: a path is allowed if every two neighbouring pieces, encoded alone, stay as they are. For each
  prefix exactly one allowed path exists, the one that merging gives, so the forward state is its last piece.
"""

from __future__ import annotations

import functools
import math
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2 as model_pb2

from tillwise.llm.common import free_name

MARK = "▁"
NORMAL, UNKNOWN, CONTROL, USER, BYTE = 1, 2, 3, 4, 6
KNOWN_WORDS = 300_000  # words a Python worker remembers, twice; about 200 bytes each
PART_ROWS = 500  # rows encoded together
KNOWN_PAIRS = 500_000  # pairs of pieces it remembers


class Lattice:
    """The pieces of a model, and the shared-prefix search over sorted words."""

    def __init__(self, model: bytes):
        proto = model_pb2.ModelProto()
        proto.ParseFromString(model)
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces:
            raise ValueError("only models without text normalisation are supported")
        self.dummy = spec.add_dummy_prefix
        self.unigram = proto.trainer_spec.model_type == 1
        self.pieces = [p.piece for p in proto.pieces]
        kinds = [p.type for p in proto.pieces]
        if USER in kinds:
            raise ValueError("models with user-defined pieces are not supported")
        self.score = [p.score for p in proto.pieces]
        self.id = {p: i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == NORMAL}
        self.unknown = kinds.index(UNKNOWN)
        self.byte_id = {int(p[1:-1], 16): i for i, (p, k) in enumerate(zip(self.pieces, kinds)) if k == BYTE}
        self.alphabet = {c for p in self.id for c in p}
        self.worst = min((self.score[i] for i in self.id.values()), default=0.0) - 10.0
        # Rank of the merge that makes a piece, 0 for single characters.
        order = sorted({-self.score[i] for p, i in self.id.items() if len(p) > 1})
        place = {v: k + 1 for k, v in enumerate(order)}
        self.rank = {i: place[-self.score[i]] if len(p) > 1 else 0 for p, i in self.id.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        # For each piece: whether another may follow it.
        self.followers: list[dict[int, bool]] = [{} for _ in self.pieces]
        self.pairs = 0
        # Pieces by their characters from the last to the first: (id of the piece that begins here or -1, what comes before).
        self.backwards: dict[str, tuple[int, dict]] = {}
        for p, i in self.id.items():
            node = self.backwards
            for c in p[:0:-1]:
                node = node.setdefault(c, (-1, {}))[1]
            node[p[0]] = i, node.get(p[0], (-1, {}))[1]
        inner = "".join(map(re.escape, sorted(self.alphabet - {MARK})))
        letters, apart = self._borders()
        # A word: letters before a character that no piece joins to a letter; or marks and known characters after them;
        # or one character that no piece has.
        before = f"{MARK}*[{letters}]+(?=[{apart}])|" if letters and apart else ""
        self.words = re.compile(f"{before}{MARK}*[{inner}]+|{MARK}+|[^{MARK}{inner}]" if inner else f"{MARK}+|[^{MARK}]", re.DOTALL)
        # Bytes of each piece for decoding; control pieces have none.
        self.bytes = [
            b"" if k == CONTROL else bytes([int(p[1:-1], 16)]) if k == BYTE else
            " ⁇ ".encode() if k == UNKNOWN else p.replace(MARK, " ").encode()
            for p, k in zip(self.pieces, kinds)
        ]

    def _borders(self) -> tuple[str, str]:
        """Letters, and known characters that follow a letter in no piece, as parts of a character class.

        A text falls apart between the two, as no merge crosses a pair of characters that no piece has. Sums of
        scores are left whole, so that they round as before.
        """
        if self.unigram:
            return "", ""
        letters = {c for c in self.alphabet if c.isalpha() and c != MARK}
        joined = {b for p in self.id for a, b in zip(p, p[1:]) if a in letters}
        return tuple("".join(map(re.escape, sorted(x))) for x in (letters, self.alphabet - letters - joined - {MARK}))

    def marked(self, text: str) -> str:
        return (MARK if self.dummy and text else "") + text.replace(" ", MARK)

    def fallback(self, char: str) -> list[int]:
        """Ids of a character that no piece has."""
        if self.byte_id:
            return [self.byte_id[b] for b in char.encode()]
        return [self.unknown]

    def merged(self, text: str) -> list[str]:
        """Plain merging: the adjacent pair whose union has the best score, leftmost first, again and again."""
        parts = list(text)
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = self.score[k] if (k := self.id.get(parts[i] + parts[i + 1])) is not None else None
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def split(self, piece: int) -> tuple[int, int] | None:
        """The two pieces whose merge makes a piece; None if merging never gives it."""
        if piece not in self.halves:
            text, limit, found = self.pieces[piece], self.rank[piece], None
            for k in range(1, len(text)):
                left, right = self.id.get(text[:k]), self.id.get(text[k:])
                if left is not None and right is not None and self.whole(left) and self.whole(right) and self.meet(left, right, limit):
                    found = left, right
                    break
            self.halves[piece] = found
        return self.halves[piece]

    def whole(self, piece: int) -> bool:
        """Whether merging the characters of a piece gives the piece."""
        if self.pieces[piece].startswith(MARK * 2):
            return self.merged(self.pieces[piece]) == [self.pieces[piece]]
        return not self.rank[piece] or self.split(piece) is not None

    def meet(self, left: int, right: int, limit: float = math.inf) -> bool:
        """Whether two neighbouring pieces are both made, by merges before `limit`, without one across their border.

        The merges are taken back one by one, the latest first. A merge across the border would have come
        first if it ranks before the one just taken back; of equal ranks the one further left comes first.
        """
        ids, rank, pieces = self.id, self.rank, self.pieces
        while True:
            across = ids.get(pieces[left] + pieces[right])
            if across is not None and rank[across] < limit:
                return False
            a, b = rank[left], rank[right]
            if a > b:
                limit, left = a, self.split(left)[1]
            elif b:
                limit, right = b + 1, self.split(right)[0]
            else:
                return True

    def pair_stays(self, left: int, right: int) -> bool:
        found = self.followers[left].get(right)
        if found is None:
            a, b = self.pieces[left], self.pieces[right]
            # Runs of marks may be of equal rank though unlike, so they are merged in full.
            found = self.whole(right) and (
                self.merged(a + b) == [a, b] if a.startswith(MARK * 2) or b.startswith(MARK * 2) else self.meet(left, right)
            )
            if self.pairs >= KNOWN_PAIRS:
                self.pairs = 0
                for table in self.followers:
                    table.clear()
            self.pairs += 1
            self.followers[left][right] = found
        return found

    def encode_sorted(self, words: list[str]) -> Iterator[list[int]]:
        """Ids of each of the sorted words of known characters."""
        # State after i characters: last piece of the path there, and for unigram its score.
        last, total = [-1], [0.0]
        search = self._best_sums if self.unigram else self._merged_paths
        pieces, before = self.pieces, ""
        for word in words:
            shared = 0
            for a, b in zip(before, word):
                if a != b:
                    break
                shared += 1
            search(word, shared, last, total)
            path, at = [], len(word)
            while at > 0:
                piece = last[at]
                if piece < 0:
                    path += self.fallback(word[at - 1])[::-1]
                    at -= 1
                else:
                    path.append(piece)
                    at -= len(pieces[piece])
            path.reverse()
            yield path
            before = word

    def _best_sums(self, word: str, shared: int, last: list[int], total: list[float]) -> None:
        """The states of a word beyond those of its first `shared` characters, for unigram models."""
        del last[shared + 1 :], total[shared + 1 :]
        for end in range(shared + 1, len(word) + 1):
            choice, best, node, begin = -2, -math.inf, self.backwards, end
            while begin:
                begin -= 1
                found = node.get(word[begin])
                if found is None:
                    break
                piece, node = found
                if piece >= 0 and (value := total[begin] + self.score[piece]) > best:
                    choice, best = piece, value
            if choice < 0:
                # A known character that is no piece by itself.
                best = total[end - 1] + self.worst
            last.append(choice)
            total.append(best)

    def _merged_paths(self, word: str, shared: int, last: list[int], total: list[float]) -> None:
        """The same for BPE models, which have no sums."""
        del last[shared + 1 :]
        backwards, followers = self.backwards, self.followers
        for end in range(shared + 1, len(word) + 1):
            choice, node, begin = -2, backwards, end
            while begin:
                begin -= 1
                found = node.get(word[begin])
                if found is None:
                    break
                piece, node = found
                if piece < 0:
                    continue
                if begin:
                    left = last[begin]
                    if left >= 0:
                        stays = followers[left].get(piece)
                        if stays is None:
                            stays = self.pair_stays(left, piece)
                        if stays:
                            choice = piece
                            break
                elif self.whole(piece):
                    choice = piece
            last.append(choice)

    def decode(self, ids: list[int]) -> str:
        body = b"".join(map(self.bytes.__getitem__, ids)).decode("utf-8", "replace")
        return body[1:] if self.dummy and body.startswith(" ") else body


def packed(ids: list[int]) -> bytes:
    """Ids as 32-bit integers: one object a word, which joins into a text's ids without a step for each id."""
    return array("i", ids).tobytes()


class Encoder:
    """Encodes groups of texts; keeps a bounded number of words from group to group.

    A text's ids come as a list, or with `as_bytes` as 32-bit integers.
    """

    def __init__(self, lattice: Lattice, known_words: int = KNOWN_WORDS, as_bytes: bool = False):
        self.lattice, self.limit, self.as_bytes = lattice, known_words, as_bytes
        # Words met since the last turn, and those of the turn before.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def words(self, text: str) -> list[str] | None:
        """The words between single spaces; None where marks could meet, or the first word has none."""
        if not self.lattice.dummy or not text or MARK in text:
            return None
        words = text.split(" ")
        return None if "" in words else words

    def encode(self, texts: list[str | None]) -> list[bytes | list[int] | None]:
        lattice, known, older = self.lattice, self.known, self.older
        simple = [None if t is None else self.words(t) for t in texts]
        others = [lattice.words.findall(lattice.marked(t)) if t is not None and w is None else None for t, w in zip(texts, simple)]
        new = set(chain.from_iterable(w for w in simple if w is not None)).difference(known)
        again = new & older.keys()
        known.update((w, older[w]) for w in again)
        new -= again
        parts = {w: lattice.words.findall(MARK + w) for w in new}
        pieces = set(chain.from_iterable(parts.values()))
        pieces.update(chain.from_iterable(w for w in others if w is not None))
        plain = sorted(w for w in pieces if w[-1] in lattice.alphabet)
        coded = dict(zip(plain, map(packed, lattice.encode_sorted(plain))))
        coded.update((w, packed(lattice.fallback(w))) for w in pieces if w[-1] not in lattice.alphabet)
        known.update((w, coded[p[0]] if len(p) == 1 else b"".join(map(coded.__getitem__, p))) for w, p in parts.items())
        out = [
            b"".join(map(known.__getitem__, w)) if w is not None else None if o is None else b"".join(map(coded.__getitem__, o))
            for w, o in zip(simple, others)
        ]
        if len(known) > self.limit:
            self.older, self.known = known, {}
        return out if self.as_bytes else [None if ids is None else np.frombuffer(ids, np.int32).tolist() for ids in out]


@functools.lru_cache(maxsize=1)
def _encoder(model: bytes) -> Encoder:
    """The encoder of a Python worker: its later tasks know the words and pairs of pieces that it has met, as far as they are kept."""
    return Encoder(Lattice(model), as_bytes=True)


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in parts of at most PART_ROWS rows; an empty batch is one part."""
    return (batch.slice(k, PART_ROWS) for k in range(0, max(batch.num_rows, 1), PART_ROWS))


def _encode(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model.value)
        # A batch in parts: only a part's words and ids are held as Python objects at a time.
        for batch in chain.from_iterable(map(_parts, batches)):
            texts = batch.column("body").to_pylist()
            encoded = [None if e is None else np.frombuffer(e, np.int32) for e in encoder.encode(texts)]
            sizes = [0 if e is None else len(e) for e in encoded]
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.int32), *(e for e in encoded if e is not None)])
            missing = pa.array([e is None for e in encoded], pa.bool_())
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat), mask=missing)
            n = pa.array([None if e is None else len(e) for e in encoded], pa.int64())
            same = pa.array([None if e is None else encoder.lattice.decode(e.tolist()) == t for t, e in zip(texts, encoded)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("row"), ids, n, same], names=["row", "ids", "n_tokens", "round_trip"])
        # Workers are used again by other stages: give back what this task no longer needs.
        pa.default_memory_pool().release_unused()

    return run


def load_model(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, model_path: str, text: str = "text", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Documents as `row` (struct of the carried columns), ids, n_tokens, round_trip.

    The model file (a few MB whatever the data) is read by the driver and broadcast. `round_trip` tells
    whether decoding gives the text again; it fails only for texts that hold U+2581 itself, or characters
    outside a model without byte pieces. Null texts give nulls, empty texts no ids. Rows are encoded each
    for itself, repeated ones too; other columns may have any name.
    """
    model = docs.sparkSession.sparkContext.broadcast(load_model(model_path))
    rows = docs.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(text).alias("body"))
    schema = T.StructType([
        rows.schema["row"], T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("n_tokens", T.LongType()),
        T.StructField("round_trip", T.BooleanType()),
    ])
    return rows.mapInArrow(_encode(model), schema)


def _decode(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(model.value)
        for batch in batches:
            texts = [None if ids is None else lattice.decode(ids) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(texts, pa.string())], names=["row", "text"])

    return run


def decode(rows: DataFrame, model_path: str, ids: str = "ids", carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Rows as `row` (struct of the carried columns) and the text of their ids; null for null."""
    model = rows.sparkSession.sparkContext.broadcast(load_model(model_path))
    inner = rows.select(F.struct(*[F.col(c) for c in carry]).alias("row"), F.col(ids).cast("array<int>").alias("ids"))
    schema = T.StructType([inner.schema["row"], T.StructField("text", T.StringType())])
    return inner.mapInArrow(_decode(model), schema)


def reference_encode(model_path: str, texts: list[str]) -> list[list[int]]:
    """The ids that the public library gives, for tests."""
    return sentencepiece.SentencePieceProcessor(model_file=model_path).encode(texts, num_threads=1)


def encode_stage(docs: DataFrame, model_path: str) -> DataFrame:
    """The columns of the documents, with `token_ids`, `n_tokens` and `round_trip` added.

    A column that already has one of these names stays; the new one gets an underscore.
    """
    columns = tuple(docs.columns)
    coded = encode(docs, model_path, carry=columns)
    added = {"token_ids": "ids", "n_tokens": "n_tokens", "round_trip": "round_trip"}
    return coded.select("row.*", *[F.col(c).alias(free_name(n, columns)) for n, c in added.items()])
