import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesync.plans import changes as ch
from tablesync.plans.upsert import upsert_latest
from tests.helpers import Crash, at, crash, fetch, new_path, new_table, rows
from tests.test_latest import relaxed

DAY1, DAY2 = at("2024-01-01"), at("2024-01-02")
contents = st.dictionaries(st.integers(0, 12), st.sampled_from([None, "a", "b"]), max_size=12)


def frame(spark, content):
    return rows(spark, *[(k, DAY1, v) for k, v in content.items()])


def diff(old, new):
    out = {(k, DAY1, v, "inserted" if k not in old else "updated") for k, v in new.items() if k not in old or old[k] != v}
    return out | {(k, DAY1, v, "deleted") for k, v in old.items() if k not in new}


@relaxed
@given(contents, contents)
def test_snapshots_changes_and_replicas(spark, tmp_path, first, second):
    table = new_table(spark, tmp_path)
    ch.upsert_full_snapshot(table, frame(spark, first), ["at"], "a", allow_empty=True)
    result = ch.upsert_full_snapshot(table, frame(spark, second), ["at"], "b", allow_empty=True)
    want = diff(first, second)
    assert (fetch(table.read()) if table.current() else []) == fetch(frame(spark, second))
    assert (result.inserted, result.updated, result.deleted) == tuple(
        sum(r[3] == kind for r in want) for kind in ch.KINDS)
    assert result.published == bool(want)
    if first and want:
        found = ch.version_changes(table, "a", "b", new_path(tmp_path, "changes"))
        assert set(fetch(found.select("k", "at", "v", "change"))) == want
        replica = new_table(spark, tmp_path, n_buckets=3)
        upsert_latest(replica, frame(spark, first), ["at"], "first")
        ch.apply_changes(replica, found, "second")
        assert fetch(replica.read()) == fetch(frame(spark, second))


def test_only_buckets_with_changes_are_written(spark, tmp_path):
    table = new_table(spark, tmp_path, n_buckets=8)
    old = {k: "a" for k in range(40)}
    ch.upsert_full_snapshot(table, frame(spark, old), ["at"], "a")
    result = ch.upsert_full_snapshot(table, frame(spark, {k: v for k, v in old.items() if k != 7}), ["at"], "b")
    assert (result.deleted, result.touched_buckets) == (1, 1)
    assert list(table.current().buckets.values()).count("a") >= 7 - 1
    assert 7 not in {r[0] for r in fetch(table.read())}


def test_the_join_exchanges_neither_table(spark, tmp_path, monkeypatch):
    table, plans = new_table(spark, tmp_path, n_buckets=4), []
    put = {k: "a" for k in range(40)}
    ch.upsert_full_snapshot(table, frame(spark, put), ["at"], "a")
    ch.upsert_full_snapshot(table, frame(spark, {**put, 3: "b"}), ["at"], "b")
    write = ch.overwrite

    def watched(df, path, **kw):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        write(df, path, **kw)

    monkeypatch.setattr(ch, "overwrite", watched)
    ch.version_changes(table, "a", "b", new_path(tmp_path))
    assert "FullOuter" in plans[0] and "Exchange" not in plans[0]
    ch.upsert_full_snapshot(table, frame(spark, {**put, 5: "b"}), ["at"], "c")
    assert "FullOuter" in plans[1] and plans[1].count("Exchange") == 1, "the snapshot alone is dealt out"


def test_repeats_and_empty_snapshots(spark, tmp_path):
    table = new_table(spark, tmp_path)
    ch.upsert_full_snapshot(table, rows(spark, (1, DAY1, "a"), (1, DAY2, "b"), (None, DAY1, "n")), ["at"], "a")
    assert fetch(table.read()) == [(1, DAY2, "b")]
    assert fetch(spark.read.parquet(f"{table.path}/rejects/load_id=a").select("v")) == [("n",)]
    assert not ch.upsert_full_snapshot(table, rows(spark, (2, DAY1, "x")), ["at"], "a").published
    assert not ch.upsert_full_snapshot(table, rows(spark, (1, DAY2, "b")), ["at"], "same").published
    with pytest.raises(ValueError, match="allow_empty"):
        ch.upsert_full_snapshot(table, rows(spark, (None, DAY1, "n")), ["at"], "b")
    assert ch.upsert_full_snapshot(table, rows(spark, (None, DAY1, "n")), ["at"], "b", allow_empty=True).deleted == 1
    assert table.read().count() == 0


def test_a_table_with_repeated_keys(spark, tmp_path):
    table = new_table(spark, tmp_path)
    table.publish("a", rows(spark, (1, DAY1, "a"), (1, DAY2, "b"), (2, DAY1, "c")))
    with pytest.raises(ValueError, match="may repeat"):
        ch.version_changes(table, "a", "a", new_path(tmp_path))
    result = ch.upsert_full_snapshot(table, rows(spark, (1, DAY2, "b"), (3, DAY1, "d")), ["at"], "b")
    assert (result.inserted, result.updated, result.deleted) == (1, 0, 1)
    assert fetch(table.read()) == [(1, DAY2, "b"), (3, DAY1, "d")]


def test_crash_before_the_control_row(spark, tmp_path, monkeypatch):
    table = new_table(spark, tmp_path)
    ch.upsert_full_snapshot(table, frame(spark, {1: "a", 2: "b"}), ["at"], "a")
    with monkeypatch.context() as broken:
        broken.setattr(type(table), "_write_commit", crash)
        with pytest.raises(Crash):
            ch.upsert_full_snapshot(table, frame(spark, {2: "c"}), ["at"], "b")
    assert fetch(table.read()) == fetch(frame(spark, {1: "a", 2: "b"}))
    ch.upsert_full_snapshot(table, frame(spark, {2: "c"}), ["at"], "b")
    assert fetch(table.read()) == fetch(frame(spark, {2: "c"}))


def test_new_columns(spark, tmp_path):
    table = new_table(spark, tmp_path)
    ch.upsert_full_snapshot(table, frame(spark, {1: "a", 2: "b"}), ["at"], "a")
    wider = frame(spark, {1: "a", 2: "b"}).withColumn("w", F.when(F.col("k") == 1, "new"))
    assert ch.upsert_full_snapshot(table, wider, ["at"], "b").updated == 1
    assert fetch(table.read().select("k", "w")) == [(1, "new"), (2, None)]
    assert fetch(ch.version_changes(table, "a", "b", new_path(tmp_path)).select("k", "change")) == [(1, "updated")]
    with pytest.raises(TypeError, match="changed their types"):
        ch.upsert_full_snapshot(table, wider.withColumn("w", F.lit(1)), ["at"], "c")
