"""Near duplicates by BagMinHash: signatures of weighted Jaccard similarity, bands, exact check.

A document is the multiset of its runs of five words. Every shingle owns Poisson processes
over time and weight. The weight axis is split into blocks [0, 1), [1, 2), [2, 4), [4, 8) and
so on; a block is one process whose rate is its width, its points have a time, a place in the
block and a component of the signature, all from hashes of shingle, block and number of the
point. A point counts if its place is below the shingle's weight, so a block is halved only as
far as a weight ends inside it. A component is the earliest time that counts. Two documents
agree in a component with the probability of their weighted Jaccard similarity. Processes are
followed in the order of time and dropped once they pass the latest component of their document.

Bands of ROWS components put documents into buckets. Equal multisets are one node. In a bucket
every node is compared with the smallest one (a second time with another centre where a bucket
still holds several classes), and links join nodes to classes. What is left between different
classes of a bucket is compared inside tasks, by blocks: a bucket is dealt into parts of at most
about PART nodes and PART_BYTES of text, and a task gets two parts at a time. It compares a byte of each
component first: a pair that agrees in fewer than LEAST_AGREEING is below the threshold (one in
a thousand million at the threshold is not). Only texts of pairs that are left are taken apart,
and compared pair by pair, or by matrix products where they are many. A block returns
only links that join classes, fewer than it has nodes. No pairs are written out and no task holds
a whole bucket. A pair at similarity 0.8 shares a bucket with probability above 0.99998.
Every link is an exact overlap of multisets.

Defined results: null texts and texts without words are classes of their own; a text of fewer
than five words is one shingle; rows alike in id and text fall into one class; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import (
    SHINGLE_WORDS, SIMILARITY, carried, components, packed, row_name, saved, small_batches, table,
)

ROWS = 6
BANDS = 36
COMPONENTS = ROWS * BANDS
#: Shingles whose processes are followed together.
BLOCK = 200_000
#: Nodes and bytes of text per part of a bucket, and elements per matrix product.
PART = 1024
PART_BYTES = 16 << 20
COLUMNS = 4096
#: Pairs left in a block, per node of theirs, from which matrix products are cheaper.
DENSE = 8
#: Parts of buckets that have several, sent to every task up to this number.
MOST_PARTED = 100_000

carried(__name__)

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finishing step of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _word_signs() -> np.ndarray:
    """Per code point whether words have it, as ``common.words`` counts them: letters, marks, numbers, underscore."""
    signs = np.array([unicodedata.category(chr(c))[0] in "LMN" for c in range(sys.maxunicode + 1)])
    signs[ord("_")] = True
    return signs


WORD_SIGNS = _word_signs()


def word_hashes(text: str) -> np.ndarray:
    """A hash of each word of a text in lower case: of the sum of its characters' hashes with their places."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    inside = np.concatenate(([False], WORD_SIGNS[codes], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    length = edges[1::2] - edges[::2]
    if not len(length):
        return np.empty(0, np.uint64)
    first = np.cumsum(length) - length
    place = np.arange(first[-1] + length[-1]) - np.repeat(first, length)
    signs = _mixed((codes[inside[1:-1]].astype(np.uint64) << np.uint64(32)) + place.astype(np.uint64) * _GOLDEN)
    return _mixed(np.add.reduceat(signs, first) + length.astype(np.uint64) * _GOLDEN)


def multiset(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted hashes of the distinct shingles of a text, and how often each occurs."""
    w = word_hashes(text) if text else np.empty(0, np.uint64)
    if not len(w):
        return w, np.empty(0, np.int64)
    runs = max(1, len(w) - SHINGLE_WORDS + 1)
    h = np.zeros(runs, np.uint64)
    for k in range(min(SHINGLE_WORDS, len(w))):
        h = _mixed((h ^ w[k:k + runs]) + _GOLDEN)
    return np.unique(h, return_counts=True)


def digest(hashes: np.ndarray, counts: np.ndarray) -> bytes | None:
    """128 bits that name a multiset."""
    return xxhash.xxh3_128_digest(hashes.tobytes() + counts.tobytes()) if len(hashes) else None


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], m: int = COMPONENTS) -> np.ndarray:
    """A row of ``m`` times per multiset; rows of empty multisets stay infinite."""
    h = np.full((len(bags), m), np.inf)
    if not bags:
        return h
    owner = np.repeat(np.arange(len(bags)), [len(x) for x, _ in bags])
    element = np.concatenate([x for x, _ in bags])
    weight = np.concatenate([c for _, c in bags]).astype(np.float64)
    starts, low, width, block = [], 0.0, 1.0, 0
    while True:  # the processes of each block that some weight reaches
        in_it = np.flatnonzero(weight > low)
        if not len(in_it):
            break
        key = _mixed(element[in_it] + np.array([block], np.uint64) * _GOLDEN)
        starts.append((owner[in_it], key, (weight[in_it] - low) / width, np.full(len(in_it), width)))
        low, width, block = low + width, max(1.0, low + width), block + 1
    if not starts:
        return h
    doc, key, part, rate = (np.concatenate(x) for x in zip(*starts))
    time = np.zeros(len(doc))
    flat, latest = h.reshape(-1), np.full(len(bags), np.inf)
    while len(doc):
        key += _GOLDEN
        one = _mixed(key.copy())
        two = _mixed(one ^ _GOLDEN)
        time -= np.log(((one >> np.uint64(11)).astype(np.float64) + 1.0) * 2.0**-53) / rate
        place = (two >> np.uint64(32)).astype(np.float64) * 2.0**-32
        component = ((two & np.uint64(0xFFFFFFFF)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        at = doc * m + component
        hit = np.flatnonzero((place < part) & (time < flat[at]))
        np.minimum.at(flat, at[hit], time[hit])
        touched = np.unique(doc[hit]) if len(hit) else hit
        latest[touched] = h[touched].max(axis=1)
        left = time < latest[doc]
        if not left.all():
            doc, key, part, rate, time = doc[left], key[left], part[left], rate[left], time[left]
    return h


def band_keys(h: np.ndarray, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """A 64-bit key per band of each signature."""
    bits = h.view(np.uint64).reshape(len(h), bands, rows)
    key = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], len(h), axis=0)
    for r in range(rows):
        key = _mixed((key ^ bits[:, :, r]) + _GOLDEN)
    return key.view(np.int64)


def marks(h: np.ndarray) -> np.ndarray:
    """A byte of each component."""
    return _mixed(h.view(np.uint64).copy()).astype(np.uint8)


def least_agreeing(similarity: float, m: int = COMPONENTS) -> int:
    """Components in which pairs of this similarity agree but for six standard deviations."""
    return math.floor(m * similarity - 6 * math.sqrt(m * similarity * (1 - similarity)))


def _sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows, bags, size = [], [], 0

        def flush():
            h = signatures(bags)
            return pd.DataFrame({
                "row": rows, "digest": [digest(*bag) for bag in bags],
                "bands": [k.tolist() if len(bag[0]) else [] for k, bag in zip(band_keys(h), bags)],
                "marks": [x.tobytes() for x in marks(h)]})

        for row, text in zip(batch["row"], batch["text"]):
            rows.append(row)
            bags.append(multiset(text))
            size += len(bags[-1][0]) + COMPONENTS
            if size >= BLOCK:
                yield flush()
                rows, bags, size = [], [], 0
        if rows:
            yield flush()


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two multisets."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    shared = int(np.minimum(a[1][i], b[1][j]).sum())
    return shared / max(1, int(a[1].sum()) + int(b[1].sum()) - shared)


def _verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    kept = None, None
    for batch in batches:
        similar = []
        for a, digest_a, text_a, digest_b, text_b in zip(
                batch["a"], batch["digest_a"], batch["text_a"], batch["digest_b"], batch["text_b"]):
            if kept[0] != a:
                kept = a, multiset(text_a)
            other = multiset(text_b)
            # the row's hash names the text; should two rows share it, the digest tells them apart
            same = digest(*kept[1]) == bytes(digest_a) and digest(*other) == bytes(digest_b)
            similar.append(overlap(kept[1], other) if same else 0.0)
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": similar})


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) of nodes with their exact similarity."""
    sides = pairs.join(texts.select(F.col("node").alias("b"), F.col("digest").alias("digest_b"),
                                    F.col("text").alias("text_b")), "b")
    both = sides.join(texts.select(F.col("node").alias("a"), F.col("digest").alias("digest_a"),
                                   F.col("text").alias("text_a")), "a")
    return both.mapInPandas(_verify, "a long, b long, similarity double")


def near_duplicates(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """Rows (row, doc_id, class_id, class) for each distinct (doc_id, text) of ``docs``.

    ``row`` names id and text by 128 bits; ``class_id`` is the smallest doc_id of the class, which
    classes may share where ids repeat and lack where they are null. ``class`` tells classes
    apart; it is null for texts without words, each of which is a class.
    """
    small_batches(docs.sparkSession)
    named = docs.select("doc_id", "text", row_name("doc_id", "text").alias("row"))
    signed = saved(named.select("row", "text").mapInPandas(
        _sign, "row binary, digest binary, bands array<long>, marks binary"), "signed")
    ids = named.select("doc_id", "row").distinct()
    # equal multisets are one node, numbered when it is written
    nodes = saved(
        signed.where("digest is not null").groupBy(F.hex("digest").alias("name"))
        .agg(F.min("row").alias("row"), F.first("digest").alias("digest"), F.first("bands").alias("bands"),
             F.first("marks").alias("marks"))
        .withColumn("node", F.monotonically_increasing_id()), "nodes")
    buckets = saved(nodes.select("node", F.explode("bands").alias("bucket")).join(
        nodes.select(F.explode("bands").alias("bucket")).groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"),
        "bucket").select("bucket", "node"), "buckets")
    member = buckets.select("node").distinct()
    rows = nodes.join(member, "node", "left_semi").select("node", "row", "digest", "marks")
    texts = saved(rows.join(named.select("row", "text").dropDuplicates(["row"]), "row").select(
        "node", "digest", "marks", "text"), "texts")

    compared = saved(verified(_with_centre(buckets, F.col("node")), texts), "compared")
    links = compared.where(F.col("similarity") >= similarity).select("a", "b")
    classes = components(links)
    open_buckets = saved(_several(buckets, classes), "open")
    if not open_buckets.isEmpty():  # another centre for what is open, then the rest by blocks
        pairs = _with_centre(open_buckets, F.xxhash64("node")).join(compared, ["a", "b"], "left_anti")
        links = saved(links.union(verified(pairs, texts).where(F.col("similarity") >= similarity).select("a", "b")), "links")
        classes = components(links)
        open_buckets = saved(_several(buckets, classes), "open")
        if not open_buckets.isEmpty():
            classes = components(links.union(_between_classes(open_buckets, texts, similarity)))
    named_class = saved(nodes.select("name", "node").join(classes.select("node", "class"), "node", "left").select(
        "name", F.coalesce("class", "node").alias("class")), "classes")
    of_row = signed.select("row", F.hex("digest").alias("name")).distinct().join(named_class, "name", "left")
    placed = saved(ids.join(of_row, "row", "left"), "placed")
    least = placed.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("class_id"))
    return placed.join(least, "class", "left").select(
        "row", "doc_id", F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        "class")


def elements(bag: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """A multiset as a set: a hash for the first, second and further occurrence of a shingle."""
    hashes, counts = bag
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    return _mixed(np.repeat(hashes, counts) + nth.astype(np.uint64) * _GOLDEN)


def shared_elements(one: list[np.ndarray], other: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of one list shares with each of the other."""
    _, column, n = np.unique(np.concatenate(one + other), return_inverse=True, return_counts=True)
    several = n > 1
    place = (np.cumsum(several) - 1)[column]
    owner = np.repeat(np.arange(len(one) + len(other)), [len(x) for x in one + other])
    order = np.flatnonzero(several[column])
    order = order[np.argsort(place[order], kind="stable")]
    place, owner = place[order], owner[order]
    total = np.zeros((len(one), len(other)), np.float32)
    for start in range(0, int(several.sum()), COLUMNS):
        lo, hi = np.searchsorted(place, [start, start + COLUMNS])
        table = np.zeros((len(one) + len(other), COLUMNS), np.float32)
        table[owner[lo:hi], place[lo:hi] - start] = 1
        total += table[:len(one)] @ table[len(one):].T
    return total


def agreeing(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """In how many bytes each row of one table agrees with each of the other."""
    total = np.zeros((len(one), len(other)), np.uint8 if one.shape[1] < 256 else np.uint16)
    for k in range(one.shape[1]):
        total += one[:, k][:, None] == other[:, k][None, :]
    return total


class Links:
    """Links between nodes of a block that join classes which no earlier link has joined."""

    def __init__(self, node: np.ndarray, group: np.ndarray) -> None:
        self.node, self.group, self.top, self.found = node, group.tolist(), {}, []

    def _find(self, x: int) -> int:
        while self.top.setdefault(x, x) != x:
            x = self.top[x]
        return x

    def joined(self, i: int, j: int) -> bool:
        return self._find(self.group[i]) == self._find(self.group[j])

    def add(self, i: int, j: int) -> None:
        x, y = self._find(self.group[i]), self._find(self.group[j])
        if x != y:
            self.top[x] = y
            self.found.append((int(self.node[i]), int(self.node[j])))


def _linked(rows: pd.DataFrame, similarity: float) -> list[tuple[int, int]]:
    """Links of a block: between its two parts, or within one that is met with itself."""
    part, node, group = rows["part"].to_numpy(), rows["node"].to_numpy(), rows["class"].to_numpy()
    a, b = np.flatnonzero(part == rows["one"].iloc[0]), np.flatnonzero(part == rows["two"].iloc[0])
    if not len(a) or not len(b):
        return []
    sign = np.frombuffer(b"".join(rows["marks"]), np.uint8).reshape(len(rows), -1)
    near = agreeing(sign[a], sign[b]) >= least_agreeing(similarity, sign.shape[1])
    near &= group[a][:, None] != group[b][None, :]
    at_a, at_b = np.nonzero(near)
    if not len(at_a):
        return []
    left_a, left_b = np.unique(a[at_a]), np.unique(b[at_b])
    text, links = rows["text"].to_numpy(), Links(node, group)
    if len(at_a) <= DENSE * (len(left_a) + len(left_b)):
        bags = {i: multiset(text[i]) for i in np.union1d(left_a, left_b).tolist()}
        for i, j in zip(a[at_a].tolist(), b[at_b].tolist()):
            if not links.joined(i, j) and overlap(bags[i], bags[j]) >= similarity:
                links.add(i, j)
        return links.found
    sets = {i: elements(multiset(text[i])) for i in np.union1d(left_a, left_b).tolist()}
    shared = shared_elements([sets[i] for i in left_a.tolist()], [sets[i] for i in left_b.tolist()])
    size_a, size_b = (np.array([len(sets[i]) for i in left.tolist()], np.float32) for left in (left_a, left_b))
    alike = shared >= similarity * (size_a[:, None] + size_b[None, :] - shared) - 1e-3
    alike &= group[left_a][:, None] != group[left_b][None, :]
    for i, j in np.argwhere(alike).tolist():
        links.add(int(left_a[i]), int(left_b[j]))
    return links.found


def _blocks(similarity: float):
    """Blocks come one after another; each is compared when all its rows are there."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, held = None, []

        def links() -> Iterator[pd.DataFrame]:
            if held:
                found = _linked(pd.concat(held, ignore_index=True), similarity)
                if found:
                    yield pd.DataFrame(found, columns=["a", "b"], dtype="int64")

        for batch in batches:
            key = batch[["bucket", "one", "two"]].to_numpy()
            cuts = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
            for low, high in zip(cuts, cuts[1:]):
                if now != tuple(key[low]):
                    yield from links()
                    now, held = tuple(key[low]), []
                held.append(batch.iloc[low:high])
        yield from links()

    return run


def _between_classes(open_buckets: DataFrame, texts: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join classes, from every bucket of ``open_buckets`` (bucket, node, class)."""
    sized = open_buckets.join(texts.select("node", F.octet_length("text").alias("size")), "node")
    parts = sized.groupBy("bucket").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(PART)), F.ceil(F.sum("size") / F.lit(PART_BYTES))).alias("parts"))
    several = saved(parts.where("parts > 1"), "parts")
    few = F.broadcast(several) if several.count() <= MOST_PARTED else several
    dealt = open_buckets.join(few, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))
    dealt = dealt.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")))
    met = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).select(
        "bucket", "node", "class", "part", F.least("part", "other").alias("one"), F.greatest("part", "other").alias("two"))
    block = ["bucket", "one", "two"]
    rows = met.join(texts.select("node", "marks", "text"), "node").repartition(*block).sortWithinPartitions(*block)
    return rows.mapInPandas(_blocks(similarity), "a long, b long")


def _with_centre(buckets: DataFrame, rank) -> DataFrame:
    """Pairs (a, b), the smaller node first, of each node with the node of its bucket that ranks lowest."""
    centre = buckets.groupBy("bucket").agg(F.min(F.struct(rank.alias("rank"), F.col("node"))).alias("top"))
    return buckets.join(centre, "bucket").where("node != top.node").select(
        F.least("node", "top.node").alias("a"), F.greatest("node", "top.node").alias("b")).distinct()


def _several(buckets: DataFrame, classes: DataFrame) -> DataFrame:
    """The rows (bucket, node, class) of buckets that hold nodes of several classes."""
    placed = saved(buckets.join(classes.select("node", "class"), "node", "left").select(
        "bucket", "node", F.coalesce("class", "node").alias("class")), "placed")
    mixed = placed.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high")).where("low < high")
    return placed.join(mixed.select("bucket"), "bucket")


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document; rows alike in id and text give one."""
    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each class stays: the one with the smallest (id, hash of the row), once.

    Copies of a row are dropped map-side, before their texts are exchanged.
    """
    classes = saved(near_duplicates(docs), "near")
    alone = F.when(F.col("class").isNull(), F.col("row")).alias("alone")
    keep = classes.groupBy("class", alone).agg(F.min(F.struct("doc_id", "row")).alias("first")).select(
        F.col("first.row").alias("row"))
    named = docs.select(row_name("doc_id", "text").alias("row"), packed(docs).alias("doc"))
    return named.dropDuplicates(["row"]).join(keep, "row").select("doc.*")
