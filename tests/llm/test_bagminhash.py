"""Near duplicates: unbiased signatures, classes against brute force, hot groups, edge cases."""

import itertools
import random

import numpy as np

from pyspark.sql import functions as F

from tablesync.llm import bagminhash as bm
from tablesync.llm.common import components
from tablesync.llm.common import words as words_of

SCHEMA = "doc_id long, text string"


def brute(rows):
    """Smallest doc_id of the class of every row."""
    bags = [bm.multiset(text) for _, text in rows]
    top = list(range(len(rows)))

    def find(i):
        while top[i] != i:
            i = top[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if len(bags[i][0]) and len(bags[j][0]) and bm.overlap(bags[i], bags[j]) >= 0.8:
            top[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted({(doc, least[find(i)]) for i, (doc, _) in enumerate(rows)})


def classes(spark, rows):
    got = bm.near_duplicates(spark.createDataFrame(rows, SCHEMA)).select("doc_id", "class_id")
    return sorted(tuple(r) for r in got.collect())


def words(rng, n):
    return [f"w{rng.randint(0, 500)}" for _ in range(n)]


def changed(rng, text, n):
    out = list(text)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"x{rng.randint(0, 10**6)}"
    return out


def test_signatures_are_unbiased_for_weights():
    rng = np.random.default_rng(5)
    a = np.sort(rng.integers(0, 1 << 62, 200).astype(np.uint64)), rng.integers(1, 12, 200)
    b = a[0][50:], np.maximum(1, a[1][50:] + rng.integers(-3, 3, 150))
    s = bm.signatures([a, b], 20_000)
    assert abs((s[0] == s[1]).mean() - bm.overlap(a, b)) < 0.012
    again = bm.signatures([b, a], 20_000)
    assert (s[0] == again[1]).all() and np.isfinite(s).all()


def test_shared_elements_count_pairs(monkeypatch):
    monkeypatch.setattr(bm, "COLUMNS", 7)
    rng = np.random.default_rng(6)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40)).astype(np.uint64)) for _ in range(9)]
    got = bm.shared_elements(sets[:4], sets[4:])
    assert got.tolist() == [[len(np.intersect1d(a, b)) for b in sets[4:]] for a in sets[:4]]
    a, b = bm.multiset("a b c d e a b c d e x"), bm.multiset("a b c d e a b c d e y")
    x, y = bm.elements(a), bm.elements(b)
    assert len(np.intersect1d(x, y)) / len(np.union1d(x, y)) == bm.overlap(a, b)


def test_a_dense_group_below_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(bm, "PART", 10)
    rng = random.Random(9)
    base = words(rng, 60)
    rows = [(k, " ".join(changed(rng, base, 3))) for k in range(70)]  # alike at 0.5 to 0.7
    rows += [(100 + k, " ".join(changed(rng, rows[k][1].split(), 1))) for k in range(0, 70, 7)]
    assert classes(spark, rows) == brute(rows)


def test_overlap_counts_multiples():
    a, b = bm.multiset("a b c d e a b c d e"), bm.multiset("A b, c d e!")
    assert bm.overlap(a, b) == 1 / 6 and bm.overlap(a, a) == 1.0


def test_classes_equal_brute_force(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(words(rng, rng.randint(1, 150)))) for i in range(40)]
    for g in range(6):
        base = words(rng, 120)
        rows += [(1000 + 20 * g + k, " ".join(changed(rng, base, k % 4))) for k in range(12)]
    rows += [(2000 + k, rows[3][1]) for k in range(5)]
    chain = words(rng, 100)
    for k in range(6):  # each near the next, the ends far apart
        rows.append((3000 + k, " ".join(chain)))
        chain = changed(rng, chain, 2)
    rng.shuffle(rows)
    assert classes(spark, rows) == brute(rows)


def test_a_hot_group_of_copies_and_near_copies(spark):
    rng = random.Random(2)
    base = words(rng, 200)
    rows = [(k, " ".join(base)) for k in range(300)] + [(300 + k, " ".join(changed(rng, base, 2))) for k in range(150)]
    rows += [(1000 + k, " ".join(words(rng, 60))) for k in range(20)]
    got = dict(classes(spark, rows))
    assert {got[k] for k in range(450)} == {0} and all(got[1000 + k] == 1000 + k for k in range(20))


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "One, two"), (6, "two one"), (7, "one two"),
            (7, "one two"), (8, "w " * 30_000), (9, "w " * 30_000)]
    assert classes(spark, rows) == [(1, 1), (2, 2), (3, 3), (4, 4), (5, 4), (6, 6), (7, 4), (8, 8), (9, 8)]


def test_empty_table(spark):
    assert classes(spark, []) == []


def test_null_ids_join_classes(spark):
    got = bm.near_duplicates(spark.createDataFrame([(None, "a b c"), (3, "a b c"), (None, None)], SCHEMA))
    assert sorted(((r["doc_id"], r["class_id"]) for r in got.collect()), key=repr) == sorted(
        [(None, 3), (3, 3), (None, None)], key=repr)


def test_the_stage_keeps_one_of_each_class(spark):
    rows = [(1, "a b c d e f", "en", "s", 1), (2, "a b c d e f", "de", "t", 2), (3, None, None, None, None),
            (4, "", "en", "s", 0), (5, "other words are here now", None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = bm.stage(spark, docs, "")
    assert kept.schema == docs.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3, 4, 5]


def test_the_stage_tells_classes_apart_without_ids(spark):
    one, two, three = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(None, one), (None, two), (None, two + " more"), (-1, three), (7, one + " x y"),  # ids that are null or look like it
            (5, "p q r s t u"), (5, "k l m n o p"),  # an id on two texts
            (9, "v w x y z"), (9, "v w x y z"), (9, "v w x y z"),  # a row three times
            (None, None), (None, None), (6, None), (8, "...")]  # without words
    kept = sorted(bm.stage(spark, spark.createDataFrame(rows, SCHEMA), "").collect(), key=repr)
    assert len(kept) == 9 and len({r["text"] for r in kept} & {two, two + " more"}) == 1
    assert {r["text"] for r in kept} >= {one, three, "p q r s t u", "k l m n o p", "v w x y z", "..."}
    assert sorted(repr(r["doc_id"]) for r in kept if r["text"] is None) == ["6", "None"]


def test_components_of_random_graphs(spark):
    rng = random.Random(3)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1060)]
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for a, b in edges:
        top[max(find(a), find(b))] = min(find(a), find(b))
    got = [tuple(r) for r in components(spark.createDataFrame(edges, "a long, b long")).collect()]
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted(got) == sorted((x, find(x)) for x in linked)


def test_the_stage_keeps_columns_of_any_name(spark):
    rows = [(1, "a b c d e f", 7, 8), (2, "a b c d e f", 7, 9), (3, "g h i j k l", 7, 10)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row long, `class` long")
    kept = bm.stage(spark, docs, "")
    assert kept.schema == docs.schema and sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_a_pair_at_the_threshold_agrees_enough():
    rng = random.Random(4)
    for _ in range(60):
        text = words(rng, 400)
        a, b = bm.multiset(" ".join(text)), bm.multiset(" ".join(changed(rng, text, 8)))
        m = bm.marks(bm.signatures([a, b]))
        agree = bm.agreeing(m[:1], m[1:])[0, 0]
        assert agree == (m[0] == m[1]).sum()
        assert agree >= bm.least_agreeing(bm.overlap(a, b))


def test_blocks_over_several_batches(spark, monkeypatch):
    monkeypatch.setattr(bm, "PART", 7)
    monkeypatch.setattr(bm, "PART_BYTES", 3000)
    monkeypatch.setattr(bm, "DENSE", 0)
    rng = random.Random(12)
    base = words(rng, 70)
    rows = [(k, " ".join(changed(rng, base, 3))) for k in range(60)]
    rows += [(100 + k, " ".join(changed(rng, rows[k][1].split(), 1))) for k in range(0, 60, 5)]
    want = brute(rows)
    assert classes(spark, rows) == want
    monkeypatch.setattr(bm, "DENSE", 10**6)
    assert classes(spark, rows) == want


def test_words_are_those_of_all_shingle_operators(spark):
    text = "हिन्दी naïve été x_1 ½² ① A-b ไทย 😀 e\u0301a İx"
    got = spark.createDataFrame([(text,)], "t string").select(words_of(F.col("t")).alias("w")).first()["w"]
    assert len(bm.word_hashes(text)) == len(got)
    assert [bm.word_hashes(w)[0] for w in got if "i" not in w] == [
        h for h, w in zip(bm.word_hashes(text).tolist(), got) if "i" not in w]
    assert len({int(bm.word_hashes(w)[0]) for w in ("ab", "ba", "a", "b", "aa", "abc", "bca", "cab")}) == 8
