"""Repeated strings against brute force, on texts with shared passages, copies and edge cases."""

import hashlib
import random
import time

import numpy as np
import pytest

from tablesync.llm import suffixes as sx

SCHEMA = "doc_id long, text string"


def brute(rows):
    """(doc_id, n_bytes, n_removed, n_spans, sha256) of every row, window by window."""
    first = {}
    for doc, text in rows:
        data = (text or "").encode()
        for i in range(len(data) - sx.SPAN + 1):
            window = data[i:i + sx.SPAN]
            order = sx.LAST if doc is None else doc
            first[window] = min(first.get(window, order), order)
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for i in range(len(data) - sx.SPAN + 1):
            if first[data[i:i + sx.SPAN]] < (sx.LAST if doc is None else doc):
                gone[i:i + sx.SPAN] = True
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((doc, len(data), len(data) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def run(spark, rows, schema=SCHEMA):
    got = sx.without_repeats(spark.createDataFrame(rows, schema)).select("doc_id", *sx.RESULT[:4])
    return sorted((tuple(r) for r in got.collect()), key=repr)


def text_of(rng, n, alphabet="abcd ef"):
    return "".join(rng.choice(alphabet) for _ in range(n))


def test_passages_copies_and_long_runs(spark):
    rng = random.Random(1)
    passage, other = text_of(rng, 120), text_of(rng, 70)
    rows = [(i, text_of(rng, rng.randint(0, 200))) for i in range(20)]
    rows += [(100 + i, text_of(rng, 30) + passage + text_of(rng, 30)) for i in range(12)]
    rows += [(50 + i, passage[i:] + other + passage) for i in range(5)]
    rows += [(200 + i, "a" * (60 + i)) for i in range(6)]  # every window alike
    rows += [(300, "ab" * 200), (301, "ba" * 150), (302, "x" + "ab" * 49)]
    rows += [(400 + i, rows[0][1] + other + "é" * 60) for i in range(4)]
    assert run(spark, rows) == brute(rows)


def test_edge_cases(spark):
    rng = random.Random(2)
    shared = text_of(rng, 50)
    rows = [(1, None), (2, ""), (3, shared[:49]), (4, shared), (5, shared + "x"), (5, shared + "x"), (5, "y" + shared),
            (None, shared), (None, "z" + shared), (6, shared[:49])]
    assert run(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


def test_other_columns_stay(spark):
    rows = [(1, "a" * 60, "p", 1), (2, "a" * 60, "q", 2)]
    got = sx.without_repeats(spark.createDataFrame(rows, "doc_id long, text string, row string, doc long"))
    assert sorted((r["doc_id"], r["row"], r["doc"], r["n_removed"]) for r in got.collect()) == [
        (1, "p", 1, 0), (2, "q", 2, 60)]


def test_a_text_longer_than_a_piece(spark, monkeypatch):
    monkeypatch.setattr(sx, "PIECE", 64)
    rng = random.Random(3)
    b = np.frombuffer(text_of(rng, 1000).encode(), np.uint8)
    by_piece = [x.tolist() for x in sx.anchors(b)]
    monkeypatch.setattr(sx, "PIECE", 1 << 20)
    whole = [x.tolist() for x in sx.anchors(b)]

    def windows(found):
        return {(w, h, p) for h, p, lo, hi in zip(*found) for w in range(lo, hi + 1)}

    assert windows(by_piece) == windows(whole)
    assert {w for w, _, _ in windows(whole)} == set(range(len(b) - sx.SPAN + 1))


@pytest.mark.parametrize("n_runs", [1, 2, 3, 7])
def test_merge_is_a_sort_and_knows_prefixes(n_runs):
    rng = random.Random(n_runs)
    runs = []
    for _ in range(n_runs):
        keys = sorted(text_of(rng, sx.SPAN, "ab").encode()[:8] * 6 + b"zz" for _ in range(rng.randint(0, 40)))
        right = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, sx.SPAN)
        runs.append((sx.prefixes(right), keys))
    flat = [k for _, keys in runs for k in keys]
    if not flat:
        return
    order, common = sx.merge(runs)
    merged = [flat[i] for i in order]
    assert merged == sorted(flat) and sorted(order.tolist()) == list(range(len(flat)))
    for a, b, c in zip(merged, merged[1:], common[1:].tolist()):
        assert a[:c] == b[:c] and (c == sx.SPAN or a[c] != b[c])


def test_a_hot_phrase_in_changing_surroundings(spark, monkeypatch):
    monkeypatch.setattr(sx, "RATE", 1)
    monkeypatch.setattr(sx, "HOT_RUN", 60)
    monkeypatch.setattr(sx, "HOT_WINDOWS", 500)
    rng = random.Random(9)
    phrase = "a phrase of the header that very many texts have in them"
    around = [text_of(rng, 12) for _ in range(12)]
    rows = [(i, f"{text_of(rng, 30)}{rng.choice(around)}{phrase}{rng.choice(around)}{text_of(rng, 30)}") for i in range(300)]
    rows += [(None, rows[7][1]), (5, rows[8][1]), (400, phrase * 40), (401, phrase * 3 + "\0" * 60), (402, "x" + "\0" * 70)]
    assert run(spark, rows) == brute(rows)
    docs = spark.createDataFrame([(i, i, t) for i, (_, t) in enumerate(rows)], "row long, doc long, text string")
    plan = sx.repeated_spans(docs)
    assert plan.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions")) + 1


def test_windows_are_those_of_the_suffixes():
    b = np.random.default_rng(5).integers(97, 100, 2000).astype(np.uint8)
    hashes, *_ = sx.anchors(b)
    w = sx.windows(sx.suffixes(b, np.unique(sx.bucketed(hashes, 8)), 8, 5, 6))
    assert sorted(w.start.tolist()) == list(range(len(b) - sx.SPAN + 1))
    assert all((b[at:at + sx.SPAN] == row).all() for at, row in zip(w.start.tolist(), w.data))
    back = sx.Windows.decoded(w.coded())
    assert (back.data == w.data).all() and (back.start == w.start).all()


def test_a_run_is_read_as_written():
    rng = np.random.default_rng(4)
    b = rng.integers(97, 100, 3000).astype(np.uint8)
    hashes, *_ = sx.anchors(b)
    s = sx.suffixes(b, np.unique(sx.bucketed(hashes, 8)), 8, 5, 6)
    s = s.take(np.argsort(np.ascontiguousarray(s.right).view(f"S{sx.SPAN}").reshape(-1), kind="stable"))
    shared, keys, back = sx.decoded(sx.coded(s))
    assert b"".join(keys) == s.right.tobytes()
    assert (back.left == s.left).all() and (back.place == s.place).all() and (back.low == s.low).all()


def test_united_spans():
    row = np.array([2, 1, 1, 1, 2])
    start, end = np.array([5, 0, 60, 50, 40]), np.array([55, 50, 110, 100, 90])
    assert [x.tolist() for x in sx.united(row, start, end)] == [[1, 2], [0, 5], [110, 90]]


def test_batches_with_equal_first_rows(spark):
    rng = random.Random(21)
    first = (None, text_of(rng, 80))
    shared = text_of(rng, 60)
    one = [first, (2, text_of(rng, 30) + shared), (5, text_of(rng, 90)), (6, text_of(rng, 90))]
    other = [first, (3, text_of(rng, 90)), (4, shared + text_of(rng, 40)), (7, text_of(rng, 90))]
    parts = [one, other, one[:2] + other[2:]]
    docs = spark.createDataFrame(parts[0], SCHEMA).coalesce(1)
    for part in parts[1:]:
        docs = docs.union(spark.createDataFrame(part, SCHEMA).coalesce(1))
    got = sx.without_repeats(docs).select("doc_id", *sx.RESULT[:4]).collect()
    assert sorted(map(tuple, got), key=repr) == brute([r for part in parts for r in part])


def test_many_copies_of_a_row_take_linear_time(spark):
    rng = random.Random(22)
    text = text_of(rng, 200)
    rows = [(None, text)] * 5000 + [(1, text[:120]), (2, text_of(rng, 150))]
    start = time.perf_counter()
    got = run(spark, rows)
    assert time.perf_counter() - start < 20 and len(got) == len(rows)
    assert set(got) == set(brute([rows[0], *rows[5000:]]))
