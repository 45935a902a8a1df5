"""Near-duplicate groups by one-permutation MinHash, exact inside every bucket.

1. Each text is turned into its set of word shingles. Texts with equal sets form one node.
2. A node's set is dealt into bins by one hash; each bin keeps its smallest value, and empty bins
   borrow from a filled one chosen by a hash of (bin, attempt) (optimal densification). Bands of
   bins are the buckets.
3. In each bucket every node is compared with one hub only, the node that meets most others: a star,
   so pairs grow with the members. Links are confirmed on the full sets.
4. Nodes whose bucket is still in several components may be linked past the hub. Among them links are
   found exactly by prefixes: with the shingles of each set in one order, rarest first, two sets that are
   alike enough share one among the first few. Rare shingles have few holders, so few pairs come of it,
   and none inside a component. No link between two nodes that share a bucket is lost to the star form.

With 32 bands of 6 bins two texts of similarity 0.85 share no bucket with probability 3e-7.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tillwise.functions.scale import stage
from tillwise.llm.common import fingerprint

SHINGLE = 5
BANDS, BAND_BINS = 32, 6
MIN_PCT = 85
ATTEMPTS = 4096

SIGNATURE = "id bigint, fp bigint, key binary, n bigint, bands array<bigint>"
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


# Odd multipliers without a linear relation: with equally spaced ones, shingles that hold the same
# words in another order would collide.
_STEPS = mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: bytes | None, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of `size` words; of all words if they are fewer."""
    words = (text or b"").lower().split()  # bytes: A-Z only, ASCII white space only
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, n)
    width = min(n, size)
    rolled = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        rolled += h[k : n - width + 1 + k] * _STEPS[k]
    return np.unique(mix(rolled))


@lru_cache(maxsize=4)
def _choices(bins: int) -> np.ndarray:
    """For each attempt and bin, the bin that an empty one looks at."""
    grid = np.arange(ATTEMPTS * bins, dtype=np.uint64).reshape(ATTEMPTS, bins)
    return (mix(grid * _STEPS[1] + _STEPS[2]) % np.uint64(bins)).astype(np.int32)


def band_hashes(values: np.ndarray, bands: int = BANDS, width: int = BAND_BINS) -> np.ndarray:
    """Hashes of the bands of a densified one-permutation signature; `values` sorted and not empty."""
    bins = bands * width
    bin_of = ((values >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)
    at = np.searchsorted(bin_of, np.arange(bins, dtype=np.uint64))
    filled = np.zeros(bins, bool)
    inside = at < len(values)
    filled[inside] = bin_of[at[inside]] == np.flatnonzero(inside)
    source = np.arange(bins)
    empty = np.flatnonzero(~filled)
    choices, start, step = _choices(bins), 0, 32
    while len(empty) and start < ATTEMPTS:
        tried = choices[start : start + step, empty]
        hit = filled[tried]
        found, first = hit.any(axis=0), hit.argmax(axis=0)
        source[empty[found]] = tried[first[found], np.flatnonzero(found)]
        empty, start, step = empty[~found], start + step, step * 8
    source[empty] = np.flatnonzero(filled)[0]
    signature = values[at[source]].reshape(bands, width)
    mixed = np.arange(bands, dtype=np.uint64) * _STEPS[40]
    for k in range(width):
        mixed = mix(mixed + signature[:, k] * _STEPS[k])
    return mixed.view(np.int64)


def set_key(values: np.ndarray) -> bytes:
    return hashlib.md5(values.tobytes(), usedforsecurity=False).digest()


def _signatures(size: int, bands: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, sizes, hashes = [], [], []
            for text in batch.column("text").to_pylist():
                values = shingles(text, size)
                sizes.append(len(values))
                keys.append(set_key(values) if len(values) else None)
                hashes.append(band_hashes(values, bands, width) if len(values) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("fp"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
                 pa.array(hashes, pa.list_(pa.int64()))],
                names=["id", "fp", "key", "n", "bands"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(text, size) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_key(s) for s in sets], pa.binary()), pa.array([s.tobytes() for s in sets], pa.binary())],
                names=["key", "members"],
            )

    return run


def _confirm(min_pct: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("a_set").to_pylist(), batch.column("b_set").to_pylist()):
                a, b = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                a, b = (a, b) if len(a) <= len(b) else (b, a)
                at = np.minimum(np.searchsorted(b, a), len(b) - 1)
                both = int((b[at] == a).sum())
                linked.append(100 * both >= min_pct * (len(a) + len(b) - both))
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(linked, pa.bool_())], names=["a", "b", "linked"]
            )

    return run


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): connected components of undirected links; a component is its least node.

    Each pass takes the least label among the neighbours and then the label of that label, so chains
    shrink by a power. Every pass is written to the shared folder.
    """
    both = stage(
        links.select(F.col(a).alias("node"), F.col(b).alias("peer"))
        .unionByName(links.select(F.col(b).alias("node"), F.col(a).alias("peer"))).distinct(),
        "links",
    )
    labels = stage(both.groupBy("node").agg(F.min("peer").alias("p")).select("node", F.least("node", "p").alias("component")), "labels")
    while True:
        of_peer = labels.select(F.col("node").alias("peer"), F.col("component").alias("theirs"))
        least = both.join(of_peer, "peer").groupBy("node").agg(F.min("theirs").alias("theirs"))
        moved = labels.join(least, "node").select(
            "node", F.col("component").alias("old"), F.least("component", "theirs").alias("via")
        )
        of_via = labels.select(F.col("node").alias("via"), F.col("component").alias("further"))
        passed = stage(
            moved.join(of_via, "via").select("node", "old", F.least("via", "further").alias("component")), "labels"
        )
        changed = passed.filter(F.col("old") != F.col("component")).limit(1).count()
        labels = passed.drop("old")
        if not changed:
            return labels


def _explode_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = batch.column("members").to_pylist()
        sizes = np.array([len(x) // 8 for x in sets], np.int64)
        for a in range(0, len(sets), 100):
            part = slice(a, a + 100)
            at = pa.array(np.repeat(np.arange(len(sets))[part], sizes[part]))
            values = np.frombuffer(b"".join(sets[part]), np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("key").take(at), pa.array(values)], names=["key", "shingle"])


class _Rounds:
    """Candidate pairs among the nodes that share buckets, confirmed on their sets."""

    def __init__(self, shared: DataFrame, sets: DataFrame, min_pct: int):
        self.shared, self.sets, self.min_pct = shared, sets, min_pct
        self.tested: DataFrame | None = None
        self.labels: DataFrame | None = None

    def similar_size(self, x: str, y: str) -> Column:
        return (100 * F.col(x) >= self.min_pct * F.col(y)) & (100 * F.col(y) >= self.min_pct * F.col(x))

    def star(self) -> DataFrame:
        """Each bucket's members with its hub."""
        met = self.shared.groupBy("key").agg(F.sum("c").alias("met"))
        members = self.shared.join(met, "key")
        hubs = members.groupBy("bucket").agg(F.max(F.struct("met", "key", "n")).alias("hub"))
        pairs = members.join(hubs, "bucket").filter(F.col("key") != F.col("hub.key"))
        return pairs.select("key", "n", F.col("hub.key").alias("other"), F.col("hub.n").alias("m"))

    def open_nodes(self) -> DataFrame:
        """Nodes of buckets in several components: key, n, component."""
        known = self.labels.withColumnRenamed("node", "key")
        members = self.shared.join(known, "key", "left").withColumn("component", F.coalesce("component", "key"))
        split = members.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
        return stage(members.join(split.select("bucket"), "bucket").select("key", "n", "component").distinct(), "open-nodes")

    def prefixes(self, nodes: DataFrame) -> DataFrame:
        """(shingle, key, n, component, pos): the shingles of each node of which alike nodes share one.

        Shingles are ordered by the number of nodes that have them, then by hash. Those that only one
        node has come first and are counted, not listed.
        """
        held = stage(self.sets.join(nodes.select("key"), "key", "left_semi").mapInArrow(_explode_sets, "key binary, shingle bigint"), "held")
        often = held.groupBy("shingle").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
        listed = held.join(often, "shingle").groupBy("key").agg(
            F.sort_array(F.collect_list(F.struct("c", "shingle"))).alias("s")  # bounded by the text
        )
        alone = (F.col("n") - F.size("s")).cast("int")
        length = (F.col("n") - F.ceil(self.min_pct * F.col("n") / 100) + 1).cast("int")
        first = nodes.join(listed, "key").select(
            "key", "n", "component", alone.alias("alone"), F.slice("s", F.lit(1), F.greatest(length - alone, F.lit(0))).alias("s")
        )
        exploded = first.select("key", "n", "component", "alone", F.posexplode("s").alias("at", "x"))
        return stage(exploded.select(F.col("x.shingle").alias("shingle"), "key", "n", "component", (F.col("alone") + F.col("at")).alias("pos")), "prefixes")

    def beyond_hubs(self) -> DataFrame:
        """Pairs of different components that share a prefix shingle and can be alike enough.

        Of each shingle's holders, those outside its largest component are paired with all others.
        """
        rows = self.prefixes(self.open_nodes())
        sizes = rows.groupBy("shingle", "component").agg(F.count(F.lit(1)).alias("c"))
        largest = sizes.groupBy("shingle").agg(
            F.max(F.struct("c", "component")).alias("top"), F.count(F.lit(1)).alias("parts")
        ).filter("parts > 1").select("shingle", F.col("top.component").alias("top"))
        split = rows.join(largest, "shingle")
        one = split.filter("component <> top").select("shingle", "key", "n", F.col("pos").alias("p"), F.col("component").alias("mine"))
        two = split.select(
            "shingle", F.col("key").alias("other"), F.col("n").alias("m"), F.col("pos").alias("q"), "component",
            (F.col("component") != F.col("top")).alias("small"),
        )
        # What both can still share from this shingle on, if it is the first they share.
        most = F.least(F.col("n") - F.col("p"), F.col("m") - F.col("q"))
        pairs = one.join(two, "shingle").filter(
            (F.col("mine") != F.col("component")) & (~F.col("small") | (F.col("key") < F.col("other")))
            & self.similar_size("n", "m") & ((100 + self.min_pct) * most >= self.min_pct * (F.col("n") + F.col("m")))
        )
        return pairs.select("key", "n", "other", "m")

    def confirm(self, pairs: DataFrame) -> None:
        new = (
            pairs.filter(self.similar_size("n", "m"))
            .select(F.least("key", "other").alias("a"), F.greatest("key", "other").alias("b")).distinct()
        )
        if self.tested is not None:
            new = new.join(self.tested.select("a", "b"), ["a", "b"], "left_anti")
        with_a = new.join(self.sets.select(F.col("key").alias("a"), F.col("members").alias("a_set")), "a")
        with_b = with_a.join(self.sets.select(F.col("key").alias("b"), F.col("members").alias("b_set")), "b")
        tested = stage(
            with_b.select("a", "b", "a_set", "b_set").mapInArrow(_confirm(self.min_pct), "a binary, b binary, linked boolean"),
            "tested",
        )
        self.tested = tested if self.tested is None else self.tested.unionByName(tested)
        self.labels = components(self.tested.filter("linked"))


def grouped_rows(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = SHINGLE, min_pct: int = MIN_PCT,
    bands: int = BANDS, width: int = BAND_BINS,
) -> DataFrame:
    """The rows of `near_duplicates`, with `part`: the key of the row's group, null for texts without words."""
    columns = [F.col(doc).cast("bigint").alias("id"), F.col(text).cast("binary").alias("text")]
    signed = stage(
        docs.select(*columns, fingerprint(F.col(text)).alias("fp")).select("id", "fp", "text")
        .mapInArrow(_signatures(size, bands, width), SIGNATURE),
        "signatures",
    )
    filled = signed.filter("n > 0")
    nodes = stage(
        filled.groupBy("key").agg(F.min("id").alias("rep"), F.max("n").alias("n"), F.first("bands").alias("bands")), "nodes"
    )
    members = nodes.select(F.explode("bands").alias("bucket"), "key", "n")
    several = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = stage(members.join(several, "bucket"), "shared-buckets")

    # The sets of nodes that share a bucket are computed anew from one text each.
    wanted = nodes.join(shared.select("key").distinct(), "key", "left_semi").select("key", "rep")
    texts = docs.select(*columns)
    again = texts.join(wanted, texts["id"].eqNullSafe(wanted["rep"]), "left_semi").select("text").filter(F.col("text").isNotNull())
    found = again.mapInArrow(_sets(size), "key binary, members binary")
    sets = stage(found.join(wanted.select("key"), "key", "left_semi").dropDuplicates(["key"]), "sets")

    rounds = _Rounds(shared, sets, min_pct)
    rounds.confirm(rounds.star())
    rounds.confirm(rounds.beyond_hubs())

    labelled = nodes.select("key", "rep").join(rounds.labels.withColumnRenamed("node", "key"), "key", "left")
    least = labelled.filter("component IS NOT NULL").groupBy("component").agg(F.min("rep").alias("least"))
    node_ids = labelled.join(least, "component", "left").select(
        F.col("key").alias("node"), F.coalesce("component", "key").alias("part"),
        F.when(F.col("component").isNull(), F.col("rep")).otherwise(F.col("least")).alias("component_id"),
    )
    rows = signed.select("id", "fp", "key", "n").join(node_ids, F.col("key") == F.col("node"), "left")
    component = F.when(F.col("key").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return rows.select(
        "id", "fp", "part", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def near_duplicates(
    docs: DataFrame, doc: str = "doc_id", text: str = "text", size: int = SHINGLE, min_pct: int = MIN_PCT,
    bands: int = BANDS, width: int = BAND_BINS,
) -> DataFrame:
    """One row per document: id, fp (text fingerprint), n_shingles, component_id, kept.

    Words are divided by ASCII white space and A-Z lower-cased. Two documents are linked when their
    shingle sets have a Jaccard similarity of at least `min_pct` per cent; `component_id` is the
    smallest id reachable over links. Texts without words, and null texts, are linked with nothing.
    Null ids count only where a group has no other id (its component_id is then null). `kept` is
    true for the rows that carry the group's id. Repeated rows get equal verdicts.
    """
    return grouped_rows(docs, doc, text, size, min_pct, bands, width).drop("part")


def near_dedup_stage(docs: DataFrame, min_pct: int = 80) -> DataFrame:
    """One document of each near-duplicate group (five words, similarity of at least 0.8), with all columns.

    The row of smallest id (null ids last), then of smallest fingerprint, stays. Rows equal in id and text
    are copies, of which one stays. Texts without words all stay.
    """
    columns = tuple(docs.columns)
    found = grouped_rows(docs, min_pct=min_pct).select(
        "part", F.col("id").isNull().alias("no_id"), F.coalesce("id", F.lit(0)).alias("i"), "fp"
    )
    place = ["no_id", "i", "fp"]
    # Copies in id and text are always in one group.
    chosen = found.filter("part IS NOT NULL").groupBy("part").agg(F.min(F.struct(*place)).alias("first")).select("first.*")
    verdicts = chosen.unionByName(found.filter("part IS NULL").select(*place).distinct())
    rows = docs.select(
        F.struct(*[F.col(c) for c in columns]).alias("row"), F.coalesce(F.col("doc_id").cast("bigint"), F.lit(0)).alias("i"),
        F.col("doc_id").isNull().alias("no_id"), fingerprint(F.col("text")).alias("fp"),
    )
    kept = rows.join(verdicts, ["i", "no_id", "fp"], "left_semi")
    # Uses the partitions and the order of the join.
    place = F.row_number().over(Window.partitionBy("i", "no_id", "fp").orderBy("i", "no_id", "fp"))
    return kept.withColumn("place", place).filter("place = 1").select("row.*")
