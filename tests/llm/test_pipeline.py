"""The pipeline: order of the stages, each on what the one before kept, against a plain version."""

import re
from collections import defaultdict

import corpus_pipeline
from tablesync.llm import bagminhash as bm
from tablesync.llm import queries

SF = "/root/testdata/sf0.001"


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language", "near_duplicates", "decontamination", "mixing", "sharding"]
    assert len(queries.QUERIES) == 13 and set(queries.ORACLE) <= set(queries.QUERIES)


def test_stages_against_a_plain_version(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stage = dict(corpus_pipeline.STAGES)
    columns = docs.columns

    def step(name, frame):
        path = f"{tmp_path}/{name}"
        stage[name](spark, frame, SF).write.parquet(path)
        return spark.read.parquet(path)

    spoken = step("language", docs)
    letters = {r["doc_id"] for r in docs.collect() if re.search(r"[^\W\d_]", r["text"] or "")}
    assert {r["doc_id"] for r in spoken.collect()} == letters and spoken.columns == columns

    alone = step("near_duplicates", spoken)
    rows = sorted((r["doc_id"], bm.multiset(r["text"])) for r in spoken.select("doc_id", "text").collect())
    classes: list[list[int]] = []
    for i, (_, bag) in enumerate(rows):
        near = [c for c in classes if any(bm.overlap(rows[j][1], bag) >= 0.8 for j in c)]
        classes = [c for c in classes if c not in near] + [sorted([i, *[j for c in near for j in c]])]
    assert {r["doc_id"] for r in alone.collect()} == {rows[c[0]][0] for c in classes}

    clean = step("decontamination", alone)

    def runs(text):
        w = re.findall(r"\w+", text.lower())
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    items = [runs(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {r["doc_id"]: runs(r["text"]) for r in alone.collect()}
    assert {r["doc_id"] for r in clean.collect()} == {
        d for d, s in held.items() if not any(i and len(i & s) >= 0.8 * len(i) for i in items)}

    mixed = step("mixing", clean)
    counts, sources = defaultdict(int), defaultdict(int)
    for r in clean.collect():
        sources[r["source"]] += len(r["text"].split())
    for r in mixed.collect():
        counts[r["source"]] += len(r["text"].split())
    assert all(counts[s] <= 2 * n for s, n in sources.items()) and mixed.columns == columns
    assert 1.2 < sum(counts.values()) / sum(sources.values()) < 1.8

    shards = step("sharding", mixed)
    assert sorted(r["doc_id"] for r in shards.collect()) == sorted(r["doc_id"] for r in mixed.collect())


def test_run_gives_shards(spark):
    got = corpus_pipeline.run(spark, SF)
    assert {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"} <= set(got.columns)
    assert got.count() > 0
