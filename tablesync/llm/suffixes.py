"""Repeated 50-byte strings by a distributed merge sort of suffixes that knows common prefixes.

A string of SPAN bytes is repeated if it also starts in a document with a smaller id. Every
such window of a text contains one anchor: the run of GRAM bytes with the smallest hash in it,
the leftmost of several. Equal windows have equal anchors at the same offset, so only suffixes
at anchors have to be sorted, about one in sixteen bytes, and only those whose anchor occurs
in another text too.

1. Tasks hash the anchors of their texts; the hashes, one per distinct anchor and batch of
   texts, are exchanged by hash, and those that meet a second batch, or occur in two texts of
   a batch, are shared.
2. Tasks sort the suffixes at shared anchors into runs. Suffixes that are alike with all that
   their windows cover are kept once, for the smallest document; for the others the windows are
   repeated. A run is cut at the splitters of the key ranges and front-coded: of each suffix
   only what differs from the one before it is sent.
3. A task merges the runs of a range with a loser tree. Each run's suffix carries the length of
   its common prefix with the last suffix put out; the longer prefix wins without looking at
   bytes, and equal prefixes are compared from there on. The tree yields the common prefixes of
   the merged order, from which the windows at each offset fall into classes: equal to the right
   of the anchor by prefix length, to the left by its bytes. A window is repeated if its class
   has a document with a smaller id.
4. The spans of a document are joined with its text, united and cut out.

All suffixes at one anchor go to one range. Anchors that occur more often than a range is long,
as a sample of all occurrences tells, are hot: their windows are not sorted but dealt by a hash
of all their bytes. A run sends each distinct window once, for its smallest document.

A string that occurs in very many documents reaches a task once per run. Batches, runs and
ranges have a fixed size; their number grows with the input.

Defined results: a null text is empty; texts under 50 bytes have no windows; repeats inside one
document, and in rows with the same id, do not count; a null id is larger than all others; rows
alike in id and text get the same result each; matches never cross documents; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.llm.common import carried, saved, table

SPAN = 50
GRAM = 20
#: Bytes left of an anchor that a window can have.
LEFT = SPAN - GRAM
#: Bytes of text per bucket of anchor hashes, and suffixes per range of the sort.
BUCKET_BYTES = 24 << 20
RANGE_SUFFIXES = 250_000
#: Window starts that are looked at together, suffixes per run, texts per batch.
PIECE = 1 << 20
RUN = 400_000
BATCH_ROWS = 1 << 14
#: An anchor is hot if it was drawn so often, which at about one in RATE is RANGE_SUFFIXES occurrences.
DRAWN = 50
RATE = RANGE_SUFFIXES // DRAWN
#: Suffixes at hot anchors per run, and windows of theirs per task, about.
HOT_RUN = 40_000
HOT_WINDOWS = 1_000_000
#: Anchors from which the splitters are chosen, about; by hash, so each distinct anchor alike.
SAMPLE = 20_000
LAST = np.iinfo(np.int64).max
_LOW = (1 << 40) - 1

carried(__name__)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def anchors(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchors of a text's windows: (hash, place, first window, last window), by place."""
    parts = [_piece(text[at:at + PIECE + SPAN - 1], at) for at in range(0, len(text) - SPAN + 1, PIECE)]
    return tuple(np.concatenate(x) if parts else np.empty(0, np.int64) for x in zip(*parts)) if parts else (
        np.empty(0, np.uint64), *[np.empty(0, np.int64)] * 3)


def _piece(b: np.ndarray, at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    three = np.uint64(3)
    h1 = _mixed(b.astype(np.uint64) + np.uint64(1))
    h2 = _mixed(h1[:-1] * three + h1[1:])
    h4 = _mixed(h2[:-2] * three + h2[2:])
    h8 = _mixed(h4[:-4] * three + h4[4:])
    h16 = _mixed(h8[:-8] * three + h8[8:])
    n = len(b) - GRAM + 1
    gram = _mixed(h16[:n] * three + h4[16:16 + n])
    # the smallest (upper half of the hash, place) of each window: ties go to the left
    v = (gram & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    for step in (1, 2, 4, 8):
        v = np.minimum(v[:-step], v[step:])
    windows = len(b) - SPAN + 1
    reach = SPAN - GRAM + 1 - 16
    v = np.minimum(v[:windows], v[reach:reach + windows])
    first = np.flatnonzero(np.concatenate(([True], v[1:] != v[:-1])))
    last = np.append(first[1:], windows) - 1
    place = (v[first] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return gram[place], place + at, first + at, last + at


def bucketed(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Names of anchors: bucket and 40 further bits, so names stay apart however many buckets there are."""
    bucket = (hashes >> np.uint64(40)) % np.uint64(buckets)
    return (bucket << np.uint64(40)) | (hashes & np.uint64(_LOW))


def _bytes_of(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode(), np.uint8)


# -- step 1: shared anchors

def _anchor_rows(buckets: int, sampled: int):
    """Rows for the exchange of anchors: per batch the anchors of each bucket, and what the batch knows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        mark = (TaskContext.get().partitionId() << 32) - 1  # a batch is named by its place in the input
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_ROWS):
                mark += 1
                home = ((mark >> 32) + mark) % buckets  # where what is not bound to a bucket goes
                part = batch.slice(at, BATCH_ROWS)
                keys = np.array(part.column("row").to_pylist(), np.int64)
                names, owner, sample, drawn = [], [], [], []
                for i, text in enumerate(part.column("text").to_pylist()):
                    b = _bytes_of(text)
                    if len(b) < SPAN:
                        continue
                    hashes, place, _, _ = anchors(b)
                    for p in place[hashes % np.uint64(sampled) == 0].tolist():
                        sample.append(b[p:p + GRAM].tobytes())
                    drawn.append(bucketed(hashes[_drawn(place, keys[i])], buckets))
                    own = np.unique(bucketed(hashes, buckets))
                    names.append(own)
                    owner.append(np.full(len(own), i, np.uint16))
                if not names:
                    continue
                name, who = np.concatenate(names), np.concatenate(owner)
                order = np.argsort(name, kind="stable")
                name, who = name[order], who[order]
                starts = np.flatnonzero(np.concatenate(([True], name[1:] != name[:-1])))
                several = np.repeat(np.diff(np.append(starts, len(name))) > 1, np.diff(np.append(starts, len(name))))
                rows = [(home, 1, mark, keys.tobytes(), name[several].tobytes(), who[several].tobytes())]
                one, first = name[starts], who[starts]
                cut = np.searchsorted(one >> np.uint64(40), np.arange(buckets + 1, dtype=np.uint64))
                for k in range(buckets):
                    own = one[cut[k]:cut[k + 1]]
                    if len(own):
                        low = (own & np.uint64(_LOW)).view(np.uint8).reshape(-1, 8)[:, :5]
                        rows.append((k, 0, mark, b"", low.tobytes(), first[cut[k]:cut[k + 1]].tobytes()))
                if sample:
                    rows.append((home, 2, mark, b"", b"".join(sample), b""))
                often = np.concatenate(drawn)
                if len(often):
                    rows.append((home, 3, mark, b"", often.tobytes(), b""))
                yield pa.RecordBatch.from_pandas(pd.DataFrame(rows, columns=EXCHANGED), preserve_index=False)

    return run


def _drawn(place: np.ndarray, row: int) -> np.ndarray:
    """Whether an occurrence of an anchor is one of the sample, by row and place."""
    at = (place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ np.uint64(int(row) & 0xFFFFFFFFFFFFFFFF)
    return _mixed(_mixed(at)) % np.uint64(RATE) == 0


def _spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """How often each anchor was drawn."""
    for batch in batches:
        name, n = np.unique(np.frombuffer(b"".join(batch["names"]), np.uint64), return_counts=True)
        yield pd.DataFrame({"name": name.view(np.int64), "n": n})


EXCHANGED = ["bucket", "kind", "batch", "keys", "names", "who"]
EXCHANGE = "bucket long, kind long, batch long, keys binary, names binary, who binary"


def _shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come by bucket: anchors that several batches have go back to them; the rest passes."""
    def met(bucket: int, held: list[tuple[int, bytes, bytes]]) -> Iterator[pd.DataFrame]:
        sizes = [len(who) // 2 for _, _, who in held]
        low = np.zeros((sum(sizes), 8), np.uint8)
        low[:, :5] = np.frombuffer(b"".join(names for _, names, _ in held), np.uint8).reshape(-1, 5)
        name = low.reshape(-1).view(np.uint64)
        _, inverse, counts = np.unique(name, return_inverse=True, return_counts=True)
        several = counts[inverse] > 1
        ends = np.cumsum(sizes)
        rows = []
        for (batch, _, who), lo, hi in zip(held, ends - sizes, ends):
            mine = several[lo:hi]
            if mine.any():
                full = name[lo:hi][mine] | np.uint64(bucket << 40)
                rows.append((bucket, 0, batch, b"", full.tobytes(), np.frombuffer(who, np.uint16)[mine].tobytes()))
        if rows:
            yield pd.DataFrame(rows, columns=EXCHANGED)

    now, held = -1, []
    for batch in batches:
        passing = batch[batch["kind"] != 0]
        if len(passing):
            yield passing
        for bucket, mark, names, who in batch.loc[batch["kind"] == 0, ["bucket", "batch", "names", "who"]].itertuples(
                index=False):
            if bucket != now and held:
                yield from met(now, held)
                held = []
            now = bucket
            held.append((mark, names, who))
    if held:
        yield from met(now, held)


def _of_rows(rows: pd.DataFrame) -> pd.DataFrame:
    """The shared anchors of each text of a batch."""
    keys = np.frombuffer(b"".join(rows.loc[rows["kind"] == 1, "keys"]), np.int64)
    name = np.frombuffer(b"".join(rows["names"]), np.uint64)
    who = np.frombuffer(b"".join(rows["who"]), np.uint16)
    order = np.argsort(who, kind="stable")
    name, who = name[order], who[order]
    cut = np.searchsorted(who, np.arange(len(keys) + 1))
    found = [(int(keys[i]), np.unique(name[cut[i]:cut[i + 1]]).tobytes())
             for i in range(len(keys)) if cut[i] < cut[i + 1]]
    return pd.DataFrame({"row": pd.Series([row for row, _ in found], dtype="int64"),
                         "names": pd.Series([name for _, name in found], dtype="object")})


# -- step 2: runs

class Suffixes:
    """Suffixes at anchors: bytes to the right and, reversed, to the left; offsets of their windows."""

    def __init__(self, right, left, low, high, doc, row, place):
        self.right, self.left, self.low, self.high = right, left, low, high
        self.doc, self.row, self.place = doc, row, place

    def __len__(self) -> int:
        return len(self.doc)

    def take(self, at: np.ndarray) -> "Suffixes":
        return Suffixes(*[getattr(self, f)[at] for f in FIELDS])

    @staticmethod
    def joined(parts: list["Suffixes"]) -> "Suffixes":
        return Suffixes(*[np.concatenate([getattr(p, f) for p in parts]) for f in FIELDS])


FIELDS = ["right", "left", "low", "high", "doc", "row", "place"]


def suffixes(b: np.ndarray, names: np.ndarray, buckets: int, doc: int, row: int) -> Suffixes | None:
    """The suffixes of a text at its shared anchors."""
    hashes, place, first, last = anchors(b)
    held = np.isin(bucketed(hashes, buckets), names)
    place, first, last = place[held], first[held], last[held]
    if not len(place):
        return None
    padded = np.concatenate((np.zeros(LEFT, np.uint8), b, np.zeros(SPAN, np.uint8)))
    low, high = place - last, place - first  # a window starts so many bytes before the anchor
    right = padded[(place + LEFT)[:, None] + np.arange(SPAN)[None, :]]
    left = padded[(place + LEFT - 1)[:, None] - np.arange(LEFT)[None, :]]
    right[np.arange(SPAN)[None, :] >= (SPAN - low)[:, None]] = 0
    left[np.arange(LEFT)[None, :] >= high[:, None]] = 0
    n = len(place)
    return Suffixes(right, left, low.astype(np.uint8), high.astype(np.uint8), np.full(n, doc, np.int64),
                    np.full(n, row, np.int64), place)


def united(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans of rows, sorted, with those that touch or overlap made one."""
    if not len(row):
        return row, start, end
    order = np.lexsort((start, row))
    row, start, end = row[order], start[order], end[order]
    new_row = np.concatenate(([True], row[1:] != row[:-1]))
    # the furthest end so far within the row: shifted by row, so a maximum does not pass rows
    shift = np.cumsum(new_row).astype(np.int64) * (int(end.max()) + 1)
    reach = np.maximum.accumulate(end + shift) - shift
    first = new_row | np.concatenate(([True], start[1:] > reach[:-1]))
    at = np.flatnonzero(first)
    return row[at], start[at], np.maximum.reduceat(end, at)


def collapsed(s: Suffixes) -> tuple[Suffixes, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of suffixes alike those of the smallest document, and the spans of all windows of the others."""
    whole = np.zeros((len(s), 88), np.uint8)
    whole[:, :SPAN], whole[:, SPAN:SPAN + LEFT] = s.right, s.left
    whole[:, SPAN + LEFT], whole[:, SPAN + LEFT + 1] = s.low, s.high
    words = whole.view(np.uint64)
    mark = np.zeros(len(s), np.uint64)
    for k in range(words.shape[1]):
        mark = _mixed((mark ^ words[:, k]) + np.uint64(k + 1))
    order = np.lexsort((s.doc, mark))
    ordered = mark[order]
    start = np.concatenate(([True], ordered[1:] != ordered[:-1]))
    least = order[np.flatnonzero(start)][np.cumsum(start) - 1]
    gone = (s.doc[order] > s.doc[least]) & (words[order] == words[least]).all(axis=1)
    out = order[gone]
    begin, stop = s.place[out] - s.high[out], s.place[out] - s.low[out] + SPAN
    return s.take(np.sort(order[~gone])), united(s.row[out], begin, stop)


def prefixes(right: np.ndarray) -> np.ndarray:
    """Common prefix of each key with the one before it; 0 for the first."""
    if not len(right):
        return np.zeros(0, np.uint8)
    differs = right[1:] != right[:-1]
    first = np.where(differs.any(axis=1), differs.argmax(axis=1), SPAN)
    return np.concatenate(([0], first)).astype(np.uint8)


def coded(s: Suffixes) -> bytes:
    """Sorted suffixes, front-coded."""
    shared = prefixes(s.right)
    rest = s.right[np.arange(SPAN)[None, :] >= shared[:, None]]
    near = s.left[np.arange(LEFT)[None, :] < s.high[:, None]]
    parts = [x.tobytes() for x in (shared, s.low, s.high, s.doc, s.row, s.place.astype(np.int64), rest, near)]
    return zstandard.ZstdCompressor(level=1).compress(struct.pack("<I", len(s)) + b"".join(parts))


def decoded(block: bytes) -> tuple[np.ndarray, list[bytes], Suffixes]:
    """Common prefixes, keys and, without keys, the suffixes of a run."""
    data = zstandard.ZstdDecompressor().decompress(block)
    n, at = struct.unpack_from("<I", data)[0], 4

    def read(kind, count):
        nonlocal at
        out = np.frombuffer(data, kind, count, at)
        at += out.nbytes
        return out

    shared, low, high = read(np.uint8, n), read(np.uint8, n), read(np.uint8, n)
    doc, row, place = read(np.int64, n), read(np.int64, n), read(np.int64, n)
    lengths = SPAN - shared.astype(np.int64)
    rest = data[at:at + int(lengths.sum())]
    at += len(rest)
    left = np.zeros((n, LEFT), np.uint8)
    left[np.arange(LEFT)[None, :] < high[:, None]] = np.frombuffer(data, np.uint8, int(high.sum(dtype=np.int64)), at)
    keys, key, begin = [], b"", 0
    for p, size in zip(shared.tolist(), lengths.tolist()):
        key = key[:p] + rest[begin:begin + size]
        keys.append(key)
        begin += size
    return shared, keys, Suffixes(np.empty((n, 0), np.uint8), left, low, high, doc, row, place)


def _span_block(row: np.ndarray, start: np.ndarray, end: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(b"".join(x.astype(np.int64).tobytes() for x in (row, start, end)))


def _runs(buckets: int, splitters: list[bytes], hot: np.ndarray, hot_parts: int):
    """Sorted runs of suffixes, cut by range, and the spans that a run has found by itself.

    Suffixes at ``hot`` anchors make runs of their own, whose windows are dealt to ``hot_parts``
    parts behind the ranges.
    """
    bounds = np.array(splitters, dtype=f"S{GRAM}")

    def sorted_run(held: list[Suffixes]) -> Iterator[tuple[int, int, bytes]]:
        kept, spans = collapsed(Suffixes.joined(held))
        if len(spans[0]):
            yield int(spans[0][0]) % (len(bounds) + 1), 1, _span_block(*spans)
        kept = kept.take(np.argsort(np.ascontiguousarray(kept.right).view(f"S{SPAN}").reshape(-1), kind="stable"))
        gram = np.ascontiguousarray(kept.right[:, :GRAM]).view(f"S{GRAM}").reshape(-1)
        cut = [0, *np.searchsorted(gram, bounds, side="left").tolist(), len(kept)]
        for part, (lo, hi) in enumerate(zip(cut, cut[1:])):
            if lo < hi:
                yield part, 0, coded(kept.take(np.arange(lo, hi)))

    def windows_run(held: list[Suffixes]) -> Iterator[tuple[int, int, bytes]]:
        kept, spans = collapsed(Suffixes.joined(held))
        if len(spans[0]):
            yield int(spans[0][0]) % (len(bounds) + 1), 1, _span_block(*spans)
        w, spans = distinct_windows(windows(kept))
        if len(spans[0]):
            yield int(spans[0][0]) % (len(bounds) + 1), 1, _span_block(*spans)
        part = (w.mark() % np.uint64(hot_parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cut = np.searchsorted(part[order], np.arange(hot_parts + 1))
        for k in range(hot_parts):
            if cut[k] < cut[k + 1]:
                yield len(bounds) + 1 + k, 2, w.take(order[cut[k]:cut[k + 1]]).coded()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        warm, warm_size = [], 0

        def out(rows):
            return pa.RecordBatch.from_pandas(
                pd.DataFrame(list(rows), columns=["part", "kind", "block"]), preserve_index=False)

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("doc", "row", "names", "text")]
            for doc, row, names, text in zip(*columns):
                b, own = _bytes_of(text), np.frombuffer(names, np.uint64)
                is_hot = np.isin(own, hot)
                if is_hot.any():
                    all_warm = suffixes(b, own[is_hot], buckets, doc, row)
                    for at in range(0, len(all_warm or ()), HOT_RUN):  # a text of any length, a run at a time
                        warm.append(all_warm.take(slice(at, at + HOT_RUN)))
                        warm_size += len(warm[-1])
                        if warm_size >= HOT_RUN:
                            yield out(windows_run(warm))
                            warm, warm_size = [], 0
                    own = own[~is_hot]
                found = suffixes(b, own, buckets, doc, row)
                if found is not None:
                    held.append(found)
                    size += len(found)
                if size >= RUN:
                    yield out(sorted_run(held))
                    held, size = [], 0
        if held:
            yield out(sorted_run(held))
        if warm:
            yield out(windows_run(warm))

    return run


class Windows:
    """Windows as SPAN bytes each, with document, row and start."""

    def __init__(self, data, doc, row, start):
        self.data, self.doc, self.row, self.start = data, doc, row, start

    def take(self, at: np.ndarray) -> "Windows":
        return Windows(self.data[at], self.doc[at], self.row[at], self.start[at])

    def mark(self) -> np.ndarray:
        """A hash of the bytes of each."""
        words = np.zeros((len(self.doc), 56), np.uint8)
        words[:, :SPAN] = self.data
        words = words.view(np.uint64)
        mark = np.zeros(len(words), np.uint64)
        for k in range(words.shape[1]):
            mark = _mixed((mark ^ words[:, k]) + np.uint64(k + 1))
        return _mixed(mark)

    def coded(self) -> bytes:
        parts = [self.doc, self.row, self.start, self.data]
        return zstandard.ZstdCompressor(level=1).compress(b"".join(x.tobytes() for x in parts))

    @staticmethod
    def decoded(block: bytes) -> "Windows":
        data = zstandard.ZstdDecompressor().decompress(block)
        n = len(data) // (24 + SPAN)
        numbers = np.frombuffer(data, np.int64, 3 * n).reshape(3, n)
        return Windows(np.frombuffer(data, np.uint8, n * SPAN, 24 * n).reshape(n, SPAN), *numbers)

    @staticmethod
    def joined(parts: list["Windows"]) -> "Windows":
        return Windows(*[np.concatenate([getattr(p, f) for p in parts]) for f in ("data", "doc", "row", "start")])


def windows(s: Suffixes) -> Windows:
    """All windows of suffixes."""
    parts = []
    for offset in range(LEFT + 1):
        own = np.flatnonzero((s.low <= offset) & (s.high >= offset))
        data = np.concatenate((s.left[own, :offset][:, ::-1], s.right[own, :SPAN - offset]), axis=1)
        parts.append(Windows(data, s.doc[own], s.row[own], s.place[own] - offset))
    return Windows.joined(parts)


def distinct_windows(w: Windows) -> tuple[Windows, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Each window for its smallest document, and the spans of those of larger documents."""
    _, name = np.unique(np.ascontiguousarray(w.data).view(f"S{SPAN}").reshape(-1), return_inverse=True)
    order = np.lexsort((w.doc, name))
    start = np.concatenate(([True], name[order][1:] != name[order][:-1]))
    least = order[np.flatnonzero(start)][np.cumsum(start) - 1]
    gone = w.doc[order] > w.doc[least]
    out = order[gone]
    return w.take(np.sort(order[~gone])), united(w.row[out], w.start[out], w.start[out] + SPAN)


# -- step 3: merge

def merge(runs: list[tuple[np.ndarray, list[bytes]]]) -> tuple[np.ndarray, np.ndarray]:
    """Merge sorted runs of (common prefixes, keys) with a loser tree.

    Returns the places of the keys, counted through all runs, in sorted order, and the common
    prefix of each with the one before it.
    """
    k = len(runs)
    base = np.concatenate(([0], np.cumsum([len(keys) for _, keys in runs]))).tolist()
    size = 1 << max(0, k - 1).bit_length()
    shared = [p.tolist() for p, _ in runs]
    keys = [keys for _, keys in runs]
    head = [0] * k
    key = [x[0] if x else None for x in keys]
    known = [0 if x else -1 for x in keys]  # common prefix with the last key put out; -1: run at its end

    def beats(a: int, b: int) -> bool:
        """Whether run a is ahead of run b; notes the loser's common prefix with the winner."""
        if a < 0 or b < 0:
            return b < 0
        if known[a] != known[b]:
            return known[a] > known[b]
        at = known[a]
        if at < 0:
            return a < b
        x, y = key[a], key[b]
        if x == y:
            at = len(x)
        else:
            while x[at] == y[at]:
                at += 1
        first = a < b if x == y else x[at] < y[at]
        known[b if first else a] = at
        return first

    winner = [-1] * size + list(range(k)) + [-1] * (size - k)
    loser = [-1] * size
    for node in range(size - 1, 0, -1):
        a, b = winner[2 * node], winner[2 * node + 1]
        winner[node], loser[node] = (a, b) if beats(a, b) else (b, a)
    w = winner[1] if size > 1 else 0
    total = base[-1]
    order, common = [0] * total, [0] * total
    for n in range(total):
        at = head[w]
        order[n], common[n] = base[w] + at, known[w]
        head[w] = at = at + 1
        if at < len(keys[w]):
            key[w], known[w] = keys[w][at], shared[w][at]
        else:
            key[w], known[w] = None, -1
        node = (w + size) >> 1
        while node:
            other = loser[node]
            if other >= 0 and known[other] >= known[w] and (known[other] > known[w] or beats(other, w)):
                loser[node], w = w, other
            node >>= 1
    return np.array(order, np.int64), np.array(common, np.uint8)


def repeated(s: Suffixes, common: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Spans (row, start, end) of the repeated windows of sorted suffixes."""
    rows, starts = [], []
    mark = np.zeros(len(s), np.uint64)  # of the bytes left of the anchor, up to the offset
    for offset in range(LEFT + 1):
        if offset:
            mark = _mixed((mark ^ s.left[:, offset - 1]) + np.uint64(offset))
        own = np.flatnonzero((s.low <= offset) & (s.high >= offset))
        if not len(own):
            continue
        right = np.cumsum(common < SPAN - offset).astype(np.uint64)
        name = _mixed(right[own] * np.uint64(0x9E3779B97F4A7C15) ^ mark[own])
        doc = s.doc[own]
        order = np.lexsort((doc, name))
        name = name[order]
        start = np.concatenate(([True], name[1:] != name[:-1]))
        if start.all():
            continue
        at = own[order]
        least = at[np.flatnonzero(start)][np.cumsum(start) - 1]
        hit = np.flatnonzero(s.doc[at] > s.doc[least])
        at, least = at[hit], least[hit]
        # the names are hashes: what they say is checked on the bytes
        same = (right[at] == right[least]) & (s.left[at, :offset] == s.left[least, :offset]).all(axis=1)
        at = at[same]
        rows.append(s.row[at])
        starts.append(s.place[at] - offset)
    if not rows:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    start = np.concatenate(starts)
    return united(np.concatenate(rows), start, start + SPAN)


def _merged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Blocks come by range; a range is merged when all its blocks are there."""
    def found(blocks: list[bytes]) -> pd.DataFrame:
        runs = [decoded(b) for b in blocks]
        order, common = merge([(p, keys) for p, keys, _ in runs])
        held = Suffixes.joined([s for _, _, s in runs]).take(order)
        return frame(*repeated(held, common))

    def frame(row, start, end) -> pd.DataFrame:
        return pd.DataFrame({"row": row, "start": start, "end": end})

    def met(kind: int, blocks: list[bytes]) -> pd.DataFrame:
        if kind == 2:
            return frame(*distinct_windows(Windows.joined([Windows.decoded(b) for b in blocks]))[1])
        return found(blocks)

    now, of, held = -1, 0, []
    for batch in batches:
        for part, kind, block in zip(batch["part"], batch["kind"], batch["block"]):
            if kind == 1:
                yield frame(*np.frombuffer(zstandard.ZstdDecompressor().decompress(block), np.int64).reshape(3, -1))
                continue
            if part != now and held:
                yield met(of, held)
                held = []
            now, of = part, kind
            held.append(block)
    if held:
        yield met(of, held)


# -- step 4: cut

def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text, starts, ends in zip(*[batch.column(c).to_pylist() for c in ("text", "_start", "_end")]):
            data = (text or "").encode()
            spans, reach, kept = [], 0, []
            if starts:
                start, end = np.array(starts, np.int64), np.array(ends, np.int64)
                _, start, end = united(np.zeros(len(start), np.int64), start, end)
                spans = list(zip(start.tolist(), end.tolist()))
            for a, b in spans:
                kept.append(data[reach:a])
                reach = b
            left = b"".join([*kept, data[reach:]])
            rows.append((len(data), len(data) - len(left), len(spans), hashlib.sha256(left).hexdigest(),
                         [{"start": a, "end": b} for a, b in spans]))
        others = batch.drop_columns(["_start", "_end"])
        made = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(RESULT_TYPES)]
        yield pa.RecordBatch.from_arrays([*others.columns, *made], names=[*others.schema.names, *RESULT])


RESULT = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
RESULT_TYPES = [pa.int64(), pa.int64(), pa.int64(), pa.string(),
                pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]


def repeated_spans(docs: DataFrame) -> DataFrame:
    """Spans (row, start, end) in bytes of the repeated strings of ``docs`` (row, doc, text)."""
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = int(total // BUCKET_BYTES) + 8
    sampled = max(1, int(total // 16 // SAMPLE))
    exchanged = docs.select("row", "text").mapInArrow(_anchor_rows(buckets, sampled), EXCHANGE)
    shared = saved(exchanged.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInPandas(
        _shared, EXCHANGE), "shared")
    names = saved(shared.where("kind < 2").groupBy("batch").applyInPandas(
        _of_rows, "row long, names binary"), "names")
    n_suffixes = (names.agg(F.sum(F.octet_length("names"))).first()[0] or 0) // 8
    if not n_suffixes:
        return spark.createDataFrame([], "row long, start long, end long")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n_suffixes // RANGE_SUFFIXES)
    # about SAMPLE anchors, chosen by hash
    grams = sorted({bytes(r["names"])[i:i + GRAM] for r in shared.where("kind = 2").select("names").toLocalIterator()
                    for i in range(0, len(r["names"]), GRAM)})
    splitters = [grams[len(grams) * k // ranges] for k in range(1, ranges)] if len(grams) >= ranges else grams
    splitters = sorted(set(s.rstrip(b"\0") for s in splitters) - {b""})
    # at most one in RANGE_SUFFIXES anchors, about
    drawn = shared.where("kind = 3").select("names").mapInPandas(_spread, "name long, n long").groupBy("name").agg(
        F.sum("n").alias("n")).where(F.col("n") >= DRAWN).toPandas()
    hot = np.sort(drawn["name"].to_numpy(np.int64).view(np.uint64))
    hot_parts = int(drawn["n"].sum()) * RATE * (LEFT + 1) // 2 // HOT_WINDOWS + 1 if len(hot) else 0
    # rows alike are one, whose spans are all theirs; the join leaves them side by side
    alone = docs.join(names.dropDuplicates(["row"]), "row").dropDuplicates(["row"])
    runs = alone.select("doc", "row", "names", "text").mapInArrow(
        _runs(buckets, splitters, hot, hot_parts), "part long, kind long, block binary")
    return runs.repartition(len(splitters) + 1 + hot_parts, "part").sortWithinPartitions("part").mapInPandas(
        _merged, "row long, start long, end long")


def without_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text and others) with n_bytes, n_removed, n_spans, kept_sha256 and the spans."""
    marked = docs.withColumn("_row", F.xxhash64("doc_id", "text"))
    unique = marked.where(F.octet_length("text") >= SPAN).select(
        F.col("_row").alias("row"), F.coalesce(F.col("doc_id").cast("long"), F.lit(int(LAST))).alias("doc"), "text")
    spans = saved(repeated_spans(unique), "spans")
    of_row = spans.groupBy(F.col("row").alias("_row")).agg(F.collect_list(F.struct("start", "end")).alias("s")).select(
        "_row", F.col("s.start").alias("_start"), F.col("s.end").alias("_end"))
    joined = marked.join(of_row, "_row", "left").select(*docs.columns, "_start", "_end")
    schema = T.StructType(list(docs.schema.fields))
    for name in RESULT[:3]:
        schema = schema.add(name, "long")
    schema = schema.add("kept_sha256", "string").add(
        "spans", T.ArrayType(T.StructType().add("start", "long").add("end", "long")))
    return joined.mapInArrow(_cut, schema)


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
