"""Manifest: the tree against a plain one, proofs, shapes of trees, tampering, hot groups."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tablesync.llm import merkle
from tests.compare import differences, open_tables

SF = "/root/testdata/sf0.01"
MANIFEST = merkle.manifest
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def grow(nodes, fanout):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h("".join(levels[-1][i:i + fanout])) for i in range(0, len(levels[-1]), fanout)])
    return levels


def climb(levels, i, node, fanout):
    """Siblings from the bottom up, and what the node folds to."""
    proof = []
    for level in levels[:-1]:
        lo = i - i % fanout
        run = level[lo:lo + fanout]
        others = run[:i - lo] + run[i - lo + 1:]
        proof += others
        node = h("".join(others[:i - lo] + [node] + others[i - lo:]))
        i //= fanout
    return proof, node


def brute(rows, fanout=2):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        own = sorted((r for r in rows if r[2] == lang), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[lang] = own, grow([leaf(r) for r in own], fanout)
    upper = grow([trees[lang][1][-1][0] for lang in langs], fanout)
    root, out = upper[-1][0], []
    for place, lang in enumerate(langs):
        own, levels = trees[lang]
        for i, row in enumerate(own):
            shown = row
            if row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                shown = (*row[:3], row[3] + 1, row[4])
            low, sub = climb(levels, i, leaf(shown), fanout)
            high, top = climb(upper, place, sub, fanout)
            out.append((row[0], leaf(row), levels[-1][0], root, h("".join(low + high)), top, top == root))
    return sorted(out, key=repr)


def made(spark, rows, tmp_path, monkeypatch, fanout=2, depth=2):
    path = f"{tmp_path}/{len(rows)}-{fanout}-{depth}"
    spark.createDataFrame(rows, SCHEMA).withColumns(
        {"rank": F.lit("x"), "tree": F.lit(1), "path": F.lit(None)}).repartition(3).write.parquet(f"{path}/documents.parquet")
    monkeypatch.setattr(merkle, "manifest", lambda leaves: MANIFEST(leaves, fanout, depth))
    return sorted((tuple(r) for r in merkle.op11(spark, path).collect()), key=repr)


def test_manifest_matches_sql(spark):
    assert differences(merkle.op11(spark, SF), open_tables(SF), merkle.ORACLE) is None


@pytest.mark.parametrize("fanout, depth", [(2, 1), (2, 2), (3, 2)])
def test_shapes_of_trees(spark, tmp_path, monkeypatch, fanout, depth):
    sizes = {None: 1, "": 2, "a": 3, "é": 5, "Z": 9, "zz": 23}
    rows, k = [], 0
    for lang, n in sizes.items():
        for _ in range(n):
            rows.append((k, f"s{k % 3}", lang, k if k % 5 else None, "täxt" * (k % 4) if k % 6 else None))
            k += 1
    assert made(spark, rows, tmp_path, monkeypatch, fanout, depth) == brute(rows, fanout)


def test_ties_and_copies(spark, tmp_path, monkeypatch):
    rows = [(None, "s", "en", 3, "same")] * 13 + [(7, "s", "en", 3, "x")] * 2 + [(7, "s", "en", 3, "y")] + [
        (None, None, None, None, None)] * 2 + [(2, "s", "de", 1, "z" * 300_000)]
    got = made(spark, rows, tmp_path, monkeypatch)
    assert got == brute(rows) and len(got) == len(rows)


def test_one_row_and_no_row(spark, tmp_path, monkeypatch):
    one = [(1, "s", "en", 2**63 - 1, "t")]
    got = made(spark, one, tmp_path, monkeypatch)
    assert got == brute(one) and got[0][1] == got[0][2] == got[0][3] and got[0][4] == h("")
    assert made(spark, [], tmp_path, monkeypatch) == []


def test_alike_segments_are_one_record(spark):
    nodes = spark.createDataFrame([("t", 0, h("a"), 64)], "tree string, rank long, node string, copies long")
    store = merkle.Store(nodes, 2, 2)
    assert [p.count() for p in store.passes] == [1, 1, 1]
    assert store.all_roots().first()["root"] == grow([h("a")] * 64, 2)[-1][0]


def test_a_tampered_sibling_or_leaf_breaks_the_proof():
    levels = grow([h(str(i)) for i in range(11)], 2)
    path = merkle.segment_path(levels, 5, 2)
    assert merkle.folded(h("5"), path) == levels[-1][0]
    assert merkle.folded(h("6"), path) != levels[-1][0]
    assert merkle.folded(h("5"), [path[0][:-1] + "x", *path[1:]]) != levels[-1][0]
