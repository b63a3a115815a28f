"""Alignment of two tokenizers by interval coalescing, and how often their tokens end together.

The tokens of both, as byte ranges of one text, are sorted by start; the running maximum of the ends
tells where a group breaks: at a start that reaches it. There tokens of both sides end. Within a
group the tokens whose ranges overlap are expanded into pairs; a pair that also ends together is a
link. Texts are taken a block at a time, one after another on one axis, since a text ends with a
token of each side.

Links are counted over the corpus without moving them: a task counts the pairs of a chunk of
documents and keeps each document's links as places in the chunk's list of pairs. The lists are
added up by pair, the totals go back to the chunks that have the pair, and a chunk's documents look
theirs up. What is exchanged is a row per chunk and distinct pair, twice, and the places once.

The byte-level tokenizer is read from its JSON file and run by a merge of ranks, as its ids are in
the order of its merges; the results are those of the file's own library. The vocabularies travel
with the tasks: executors need no files.

Defined results: a null or empty text has no tokens, nor has one whose tokens of either side do not
spell it (a text that holds U+2581, which the piece tokenizer writes for a space); rows are
documents of their own, whether ids repeat or are null; texts are encoded whole; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablesync.llm.common import carried, saved, table

#: The folder of the vocabulary files, and the two that op13 uses.
TOKENIZERS = "/opt/tokenizers"
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Characters that are encoded together; text and documents per chunk; rows that become strings together.
BLOCK_CHARS = 1 << 20
CHUNK_CHARS = 8 << 20
CHUNK_DOCS = 20_000
ROWS = 64

# Fixed value: the pattern by which byte-level BPE of this family splits a text before merging.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACE_MARK = "▁"

carried(__name__)


@dataclass
class Tokenizer:
    """Texts to lists of ids, and the bytes of every id: empty for one that spells nothing."""

    encode: Callable[[list[str]], list[list[int]]]
    spelled: list[bytes]

    def __post_init__(self) -> None:
        self.lengths = np.array([len(b) for b in self.spelled], np.int64)


def byte_of_sign() -> dict[str, int]:
    """The sign that stands for each byte in byte-level vocabularies: visible ones for themselves."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(visible)]
    return {**{chr(b): b for b in visible}, **{chr(256 + k): b for k, b in enumerate(others)}}


def byte_level(content: bytes) -> Tokenizer:
    """A byte-level BPE from the JSON of its file; it encodes a space and the text."""
    described, sign = json.loads(content), byte_of_sign()
    special = {t["id"] for t in described["added_tokens"]}
    vocabulary = {i: t for t, i in described["model"]["vocab"].items() if i not in special}
    ranks = {bytes(sign[c] for c in t): i for i, t in vocabulary.items()}
    coder = tiktoken.Encoding("byte-level", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    spelled = [b""] * (max(vocabulary) + 1)
    for word, i in ranks.items():
        spelled[i] = word
    return Tokenizer(lambda texts: [coder.encode_ordinary(f" {t}") for t in texts], spelled)


def pieces(content: bytes) -> Tokenizer:
    """A sentence-piece model from its file; it adds the space itself."""
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    spelled = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            spelled.append(bytes([int(piece[3:-1], 16)]))
        else:
            known = not (model.is_control(i) or model.is_unknown(i))
            spelled.append(piece.replace(SPACE_MARK, " ").encode() if known else b"")
    return Tokenizer(partial(model.encode, num_threads=1), spelled)


# a block of texts


def groups(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The group of each interval: a sorted start that reaches the running maximum of the ends begins one."""
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    begins = np.ones(len(order), bool)
    begins[1:] = start[order][1:] >= reach[:-1]
    found = np.empty(len(order), np.int64)
    found[order] = np.cumsum(begins) - 1
    return found


def overlaps(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple:
    """Places of all pairs of overlapping ranges, each side's ranges lying one after another."""
    low, high = np.searchsorted(end_b, start_a, "right"), np.searchsorted(start_b, end_a, "left")
    n = high - low
    a = np.repeat(np.arange(len(start_a)), n)
    return a, np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def _spelled(tokenizer: Tokenizer, ids: list[list[int]], wanted: list[bytes]) -> np.ndarray:
    """Which of the texts their tokens spell."""
    flat = list(chain.from_iterable(ids))
    joined = b"".join(map(tokenizer.spelled.__getitem__, flat))
    if joined == b"".join(wanted):
        sizes = np.array(list(map(len, ids)))
        ends = np.concatenate(([0], np.cumsum(tokenizer.lengths[np.array(flat, np.int64)])))[np.cumsum(sizes)]
        if np.array_equal(ends, np.cumsum(list(map(len, wanted)))):
            return np.ones(len(ids), bool)
    return np.array([b"".join(map(tokenizer.spelled.__getitem__, one)) == text for one, text in zip(ids, wanted)], bool)


@dataclass
class Aligned:
    """A block of texts: per text how many tokens, groups and links, and the text of its groups; the links' ids."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    shown: list[str]
    link_a: np.ndarray
    link_b: np.ndarray


def align(texts: list[str | None], one: Tokenizer, other: Tokenizer, signs: list[str]) -> Aligned:
    """Align the tokens of texts. ``signs`` has, for each id, its digits before ``,``, ``|`` and ``;``."""
    n = len(texts)
    n_a, n_b, n_groups, n_links = (np.zeros(n, np.int64) for _ in range(4))
    shown, none = [""] * n, np.empty(0, np.int64)
    at = [i for i, t in enumerate(texts) if t]
    wanted = [b" " + texts[i].encode() for i in at]
    ids_a, ids_b = one.encode([texts[i] for i in at]), other.encode([texts[i] for i in at])
    if at:
        good = np.flatnonzero(_spelled(one, ids_a, wanted) & _spelled(other, ids_b, wanted)).tolist()
        at, ids_a, ids_b = [at[i] for i in good], [ids_a[i] for i in good], [ids_b[i] for i in good]
    if not at:
        return Aligned(n_a, n_b, n_groups, n_links, shown, none, none)
    n_a[at], n_b[at] = list(map(len, ids_a)), list(map(len, ids_b))
    a, b = np.fromiter(chain.from_iterable(ids_a), np.int64), np.fromiter(chain.from_iterable(ids_b), np.int64)
    end_a, end_b = np.cumsum(one.lengths[a]), np.cumsum(other.lengths[b])
    start_a, start_b = end_a - one.lengths[a], end_b - other.lengths[b]
    group = groups(np.concatenate((start_a, start_b)), np.concatenate((end_a, end_b)))
    group_a, group_b = group[:len(a)], group[len(a):]
    i, j = overlaps(start_a, end_a, start_b, end_b)
    together = end_a[i] == end_b[j]
    i, j = i[together], j[together]
    of_a, of_b = np.repeat(at, n_a[at]), np.repeat(at, n_b[at])
    n_links += np.bincount(of_a[i], minlength=n)
    last_a, last_b = np.append(group_a[1:] != group_a[:-1], True), np.append(group_b[1:] != group_b[:-1], True)
    n_groups += np.bincount(of_a[last_a], minlength=n)
    # groups one after another, the first side's tokens before the other's
    size_a, size_b = np.bincount(group_a), np.bincount(group_b)
    place_a = np.arange(len(a)) + (np.cumsum(size_b) - size_b)[group_a]
    place_b = np.arange(len(b)) + np.cumsum(size_a)[group_b]
    sign = np.empty(len(a) + len(b), np.int64)
    sign[place_a], sign[place_b] = a * 3 + last_a, b * 3 + 2 * last_b
    written, done = list(map(signs.__getitem__, sign.tolist())), 0
    for k in at:
        size = n_a[k] + n_b[k]
        shown[k] = "".join(written[done:done + size])[:-1]
        done += size
    return Aligned(n_a, n_b, n_groups, n_links, shown, a[i], b[j])


# a corpus

CHUNKS = ("chunk string, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
          "links binary, pairs binary, times binary")
RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ALIGNED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
           "groups_sha256 string")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list]]:
    """Ids and texts, as many at a time as make a block."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            for i, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                ids.append(i)
                texts.append(text)
                size += len(text or "")
                if size >= BLOCK_CHARS:
                    yield ids, texts
                    ids, texts, size = [], [], 0
    if ids:
        yield ids, texts


class Chunk:
    """Aligned documents, and their links as places in the list of their pairs."""

    def __init__(self) -> None:
        self.rows: list[tuple] = []
        self.links: list[np.ndarray] = []
        self.chars = 0

    def add(self, ids: list, texts: list[str | None], found: Aligned) -> None:
        self.rows += [(i, int(a), int(b), int(g), int(k), hashlib.sha256(shown.encode()).hexdigest() if a else "")
                      for i, a, b, g, k, shown in zip(ids, found.n_a, found.n_b, found.n_groups, found.n_links, found.shown)]
        self.links.append((found.link_a << 32) | found.link_b)
        self.chars += sum(len(t or "") for t in texts)

    def full(self) -> bool:
        return self.chars >= CHUNK_CHARS or len(self.rows) >= CHUNK_DOCS

    def batch(self, name: str) -> pa.RecordBatch:
        """A row per document, and one for the pairs."""
        pairs, place, times = np.unique(np.concatenate(self.links), return_inverse=True, return_counts=True)
        place = place.astype(np.uint16 if len(pairs) <= 1 << 16 else np.uint32)
        ends = np.cumsum([row[4] for row in self.rows])
        links = [place[end - row[4]:end].tobytes() for row, end in zip(self.rows, ends)]
        doc_id, n_a, n_b, n_groups, n_links, digests = zip(*self.rows)
        none = [None]
        n = len(self.rows)
        columns = [[name] * (n + 1), [*doc_id, *none], [*n_a, *none], [*n_b, *none], [*n_groups, *none], [*n_links, *none],
                   [*digests, *none], [*links, *none], [*none * n, pairs.tobytes()], [*none * n, times.tobytes()]]
        kinds = [pa.string(), *[pa.int64()] * 5, pa.string(), *[pa.binary()] * 3]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)],
                                          names=[c.split()[0] for c in CHUNKS.split(", ")])


def _chunks(file_a: bytes, file_b: bytes) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, other = byte_level(file_a), pieces(file_b)
        signs = [f"{i}{end}" for i in range(max(len(one.spelled), len(other.spelled))) for end in ",|;"]
        part, k, chunk = TaskContext.get().partitionId(), 0, Chunk()
        for ids, texts in _blocks(batches):
            chunk.add(ids, texts, align(texts, one, other, signs))
            if chunk.full():
                yield chunk.batch(f"{part}-{k}")
                k, chunk = k + 1, Chunk()
        if chunk.rows:
            yield chunk.batch(f"{part}-{k}")

    return run


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of chunks: (chunk, pair, n)."""
    for batch in batches:
        for chunk, pairs, times in zip(*[batch.column(c).to_pylist() for c in ("chunk", "pairs", "times")]):
            pair, n = np.frombuffer(pairs, np.int64), np.frombuffer(times, np.int64)
            for at in range(0, len(pair), 50_000):
                part = pair[at:at + 50_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * len(part), pa.string()), pa.array(part), pa.array(n[at:at + 50_000])],
                    names=["chunk", "pair", "n"])


def _looked_up(docs: pd.DataFrame, known: pd.DataFrame) -> pd.DataFrame:
    """A chunk's documents with what the corpus knows of their links."""
    order = np.argsort(known["pair"].to_numpy(np.int64))
    total = known["total"].to_numpy(np.int64)[order]
    best = known["best"].to_numpy(bool)[order]
    kind = np.uint16 if len(order) <= 1 << 16 else np.uint32
    links = [np.frombuffer(x, kind) for x in docs["links"]]
    docs = docs.assign(n_best=[int(best[x].sum()) for x in links], count_sum=[int(total[x].sum()) for x in links],
                       doc_id=[None if i is None else int(i) for i in docs["doc_id"]])
    return docs[RESULT].astype({"doc_id": object})


def aligned(docs: DataFrame, file_a: bytes, file_b: bytes) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) how its two encodings meet, with counts over the corpus."""
    chunks = saved(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _chunks(file_a, file_b), CHUNKS), "aligned", "zstd")
    listed = chunks.where("pairs is not null").select("chunk", "pairs", "times").mapInArrow(
        _listed, "chunk string, pair long, n long")
    totals = saved(listed.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    b = F.col("pair").bitwiseAND((1 << 32) - 1)
    highest = totals.groupBy(b.alias("b")).agg(F.max("total").alias("highest"))
    known = totals.withColumn("b", b).join(highest, "b").select(
        "pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    back = listed.drop("n").join(known, "pair")
    # as text, since ids with nulls would come as floats
    rows = chunks.where("pairs is null").drop("pairs", "times").withColumn("doc_id", F.col("doc_id").cast("string"))
    return rows.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInPandas(_looked_up, ALIGNED)


def _file(spark: SparkSession, path: str) -> bytes:
    """A vocabulary file, a few megabytes, read where the driver runs or through Spark's readers."""
    if "://" in path:
        return bytes(spark.read.format("binaryFile").load(path).first()["content"])
    with open(path, "rb") as file:
        return file.read()


def op13(spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS) -> DataFrame:
    return aligned(table(spark, sf_dir, "documents"), _file(spark, f"{tokenizers}/{FILE_A}"),
                   _file(spark, f"{tokenizers}/{FILE_B}"))
