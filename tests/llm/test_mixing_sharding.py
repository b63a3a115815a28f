"""Mixing against its SQL and a loop for the targets; shards: sizes, slots, groups, links."""

import random
from collections import Counter, defaultdict

import pytest

from tablesync.llm import mixing, sharding
from tablesync.llm.common import running
from tests.compare import differences, open_tables

SF = "/root/testdata/sf0.01"
ROW = "doc_id long, source string, size long, rate double"


def targets(sizes):
    """Targets by resharing the excess until none is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    left, open_, out = 1.5 * sum(sizes.values()), set(order), {}
    while True:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total > 2 * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = 2.0 * sizes[s]
        left, open_ = left - sum(out[s] for s in over), open_ - over


def mixed(spark, rows):
    return [r.asDict() for r in mixing.mix(spark.createDataFrame(rows, ROW)).collect()]


def test_mix_matches_sql(spark):
    assert differences(mixing.op8(spark, SF), open_tables(SF), mixing.ORACLE) is None


@pytest.mark.parametrize("seed", range(3))
def test_targets_and_taken(spark, seed):
    rng = random.Random(seed)
    names = [None, "", "B", "a", "é", "z", "𝒳", "～"][: 3 + 2 * seed]
    rows = [(i, rng.choice(names) if rng.random() < 0.7 else names[-1], rng.randint(0, 40), rng.choice([None, 1.0, 4.0]))
            for i in range(400)]
    got = mixed(spark, rows)
    assert sorted((r["doc_id"], r["size"]) for r in got) == sorted((r[0], r[2]) for r in rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
    want = targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-3)
        assert r["size"] == 0 and r["taken"] == 0 or r["taken"] // r["size"] in (0, 1, 2) and r["taken"] % r["size"] == 0
    for source in sizes:
        assert abs(taken[source] - want[source]) <= 20.001
    assert sorted(got, key=repr) == sorted(mixed(spark, rows[::-1]), key=repr)


def test_higher_rates_are_taken_more_often(spark):
    rows = [(i, "a", 10, 8.0 if i % 2 else 1.0) for i in range(600)] + [(1000 + i, "b", 10, 1.0) for i in range(200)]
    got = mixed(spark, rows)
    extra = Counter(r["doc_id"] % 2 for r in got if r["source"] == "b" and r["taken"] > 0)
    by_rate = Counter()
    for r in got:
        if r["source"] == "a":
            by_rate[r["doc_id"] % 2] += r["taken"]
    assert by_rate[1] > by_rate[0] and extra


def test_mix_edge_cases(spark):
    assert mixed(spark, []) == []
    assert [r["taken"] for r in mixed(spark, [(None, None, 0, None)])] == [0]
    got = mixed(spark, [(None, "s", 5, 1.0), (None, "s", 5, 1.0), (3, "t", 7, None)])
    assert all(r["taken"] <= 2 * r["size"] for r in got) and len(got) == 3


def test_word_counts(spark):
    df = spark.createDataFrame([(None,), ("",), ("a\x0bb\x0c c\r\nd",), ("a b c",), ("x\x00y \x1f",)], "text string")
    assert [r[0] for r in df.select(mixing.word_count(df["text"])).collect()] == [0, 0, 4, 1, 2]


def test_the_mixing_stage_repeats_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = {r["doc_id"]: r["taken"] // r["size"] if r["size"] else 0 for r in mixing.op8(spark, SF).collect()}
    out = mixing.stage(spark, docs, SF)
    assert out.schema == docs.schema
    counts = Counter(r["doc_id"] for r in out.select("doc_id").collect())
    assert {d: n for d, n in plan.items() if n} == dict(counts)


def test_running_totals_over_ranges(spark):
    rng = random.Random(4)
    rows = [(rng.choice([0] * 5 + [1, 2]), i, rng.randint(0, 9)) for i in range(2000)]
    got = running(spark.createDataFrame(rows, "g int, k int, n long"), ["k"], ["n"], by=["g"]).collect()
    ahead = defaultdict(int)
    want = set()
    for g, k, n in sorted(rows, key=lambda r: (r[0], r[1])):
        want.add((g, k, n, ahead[g]))
        ahead[g] += n
    assert {tuple(r) for r in got} == want


def placed(spark, rows, shards=16):
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string, label int")
    return [r.asDict() for r in sharding.place_documents(docs, shards).collect()]


def rules_hold(got, shards=16):
    sizes, slots = defaultdict(int), defaultdict(list)
    for r in got:
        sizes[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert set(sizes) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [sizes[s] for s in range(shards)]


def test_shards_are_even_and_groups_whole(spark):
    rng = random.Random(5)
    rows = [(i, "w" * rng.randint(0, 60), "x", 1) for i in range(1500)]
    rows = [(i, f"{i} {t}", a, b) for i, t, a, b in rows]
    for g in range(40):
        rows += [(5000 + 50 * g + k, f"copy {g}", "x", 1) for k in range(rng.randint(2, 9))]
    got = placed(spark, rows)
    sizes = rules_hold(got)
    mean = sum(sizes) / 16
    assert len(got) == len(rows) and max(abs(s - mean) for s in sizes) <= 62 + sharding.SNAP * mean
    where = defaultdict(set)
    for r in got:
        where[r["text_crc32"]].add(r["shard"])
    split = sum(len(s) > 1 for s in where.values())
    assert split <= 15
    assert {r["law"] for r in got} == {"bytes"} and {r["grown_shard"] for r in got} == {None}


def test_a_group_with_a_third_of_the_rows_fills_few_shards(spark):
    rows = [(i, "the same text", "x", 1) for i in range(700)] + [(1000 + i, f"text no {i:05d}", "x", 1) for i in range(1400)]
    got = placed(spark, rows)
    sizes = rules_hold(got)
    assert max(sizes) - min(sizes) <= 2 * 20
    hot = Counter(r["shard"] for r in got if r["doc_id"] < 1000)
    assert sum(n for _, n in hot.most_common(8)) > 0.6 * 700  # by hash alone half of it would be there


def test_shard_edge_cases(spark):
    assert placed(spark, []) == []
    got = placed(spark, [(1, None, "x", 1), (None, "", None, None), (None, "é", "x", 1), (1, None, "x", 1), (2, "é", "x", 2)])
    rules_hold(got)
    assert sorted((r["size"], r["text_crc32"]) for r in got) == [(1, 0), (1, 0), (1, 0), (3, 2055256646), (3, 2055256646)] \
        or [r["size"] for r in got].count(3) == 2


def test_links_between_different_documents(spark):
    """Pairs that are linked meet in a shard, under the quota."""
    rng = random.Random(6)
    nodes = spark.createDataFrame([(i, 10) for i in range(400)], "id long, size long")
    pairs = [(i, i + 1, 1.0) for i in range(0, 400, 2)]
    links = spark.createDataFrame(pairs, "a long, b long, weight double")
    label = {r["id"]: r["label"] for r in sharding.propagate(nodes, links, 8).collect()}
    assert all(label[a] == label[b] for a, b, _ in pairs)
    held = Counter(label.values())
    assert max(held.values()) <= (1 + sharding.SLACK) * 50 + 1 and rng


def test_admission_keeps_quotas():
    flows = {(0, 1): 50, (1, 2): 30, (2, 1): 10}
    held = {0: 100, 1: 100, 2: 100}
    part = sharding.admission(flows, held, 110.0, 3)
    after = {s: held[s] + sum(n * part[t] * ((t == s) - (f == s)) for (f, t), n in flows.items()) for s in held}
    assert all(v <= 110.0 + 1e-6 for v in after.values()) and 0 < part[2] <= 1.0


def test_reruns_agree_with_null_and_repeated_ids(spark, tmp_path):
    rng = random.Random(8)
    rows = [(rng.choice([None, None, 7, 8, i]), "w " * rng.randint(0, 30) + str(i % 50), "en", rng.choice("st"), 1)
            for i in range(500)]
    found = []
    for n in (1, 5):
        path = f"{tmp_path}/{n}"
        rng.shuffle(rows)
        spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(
            n).write.parquet(f"{path}/documents.parquet")
        spark.createDataFrame([(7, 1, 0), (7, 0, 0), (None, 1, 0)], "doc_id long, quality long, toxic long").write.parquet(
            f"{path}/labels.parquet")
        found.append((sorted(map(repr, mixing.op8(spark, path).collect())), sorted(map(repr, mixing.stage(
            spark, spark.read.parquet(f"{path}/documents.parquet"), path).collect()))))
    assert found[0] == found[1]


def test_the_mixing_stage_keeps_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    named = docs.selectExpr("*", "7 AS _mark", "doc_id AS mark", "'c' AS copies", "1 AS `a.b`")
    out = mixing.stage(spark, named, SF)
    assert out.schema == named.schema and out.where("mark <> doc_id OR _mark <> 7").count() == 0
