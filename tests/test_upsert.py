import glob
import json
import os

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesync.operators.latest import latest
from tablesync.plans import merchant, upsert
from tablesync.plans.upsert import merge, upsert_latest
from tablesync.sources.tables import overwrite
from tablesync.sources.versions import VersionedTable, _bucket_map, _by_load, _runs
from tests.helpers import Crash, at, crash, fetch, new_path, new_table, plan_of, rows
from tests.test_latest import batches, expected, relaxed
from workload.standins import merchant_src

DAY1, DAY2, DAY3 = at("2024-01-01"), at("2024-01-02"), at("2024-01-03")


def put(table, load_id, df, **kw):
    return upsert_latest(table, df, ["at"], load_id, watermark="at", **kw)


@relaxed
@given(st.lists(batches, min_size=1, max_size=3))
def test_any_split_gives_the_latest_of_the_whole(spark, tmp_path, loads):
    table = new_table(spark, tmp_path)
    for n, values in enumerate(loads):
        put(table, f"load-{n}", rows(spark, *values))
    whole = expected([v for values in loads for v in values])
    assert (fetch(table.read()) if table.current() else []) == whole


def test_only_touched_buckets_are_written_again(spark, tmp_path):
    table = new_table(spark, tmp_path, n_buckets=8)
    put(table, "a", rows(spark, *[(k, DAY1, "a") for k in range(50)]))
    before = table.current().buckets
    result = put(table, "b", rows(spark, (7, DAY2, "b")))
    after = table.current().buckets
    assert result.touched_buckets == 1
    assert [b for b in after if after[b] != before[b]] == [b for b in after if after[b] == "b"]
    assert len([b for b in after if after[b] == "b"]) == 1
    assert fetch(table.read()) == sorted(
        [(k, DAY1, "a") for k in range(50) if k != 7] + [(7, DAY2, "b")], key=repr
    )


def test_replay_and_empty_increment_change_nothing(spark, tmp_path):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, (1, DAY1, "a")))
    first = table.current()
    assert not put(table, "a", rows(spark, (1, DAY3, "never"))).published
    assert not put(table, "b", rows(spark, (1, DAY3, "x")).where("k > 1")).published
    assert table.current() == first
    assert fetch(table.read()) == [(1, DAY1, "a")]
    assert glob.glob(f"{table.path}/staging/load_id=*") == []


def test_rejects(spark, tmp_path):
    table = new_table(spark, tmp_path)
    result = put(table, "a", rows(spark, (1, DAY1, "a"), (None, DAY2, "b"), (None, None, "c")))
    assert (result.row_count, result.rejected) == (3, 2)
    assert {r["v"] for r in spark.read.parquet(f"{table.path}/rejects/load_id=a").collect()} == {"b", "c"}
    only_rejects = put(table, "b", rows(spark, (None, DAY3, "d")))
    assert (only_rejects.rejected, only_rejects.touched_buckets) == (1, 0)
    assert fetch(table.read()) == [(1, DAY1, "a")]
    assert table.current().watermark == str(DAY3), "they are not read again"


def test_first_load_of_rejects_only(spark, tmp_path):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, (None, DAY1, "a")))
    assert table.read().count() == 0
    put(table, "b", rows(spark, (1, DAY2, "b")))
    assert fetch(table.read()) == [(1, DAY2, "b")]


def test_watermark_never_goes_back(spark, tmp_path):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, (1, DAY2, "a")))
    put(table, "b", rows(spark, (1, DAY1, "late"), (2, DAY1, "late")))
    assert table.current().watermark == str(DAY2)
    assert fetch(table.read()) == [(1, DAY2, "a"), (2, DAY1, "late")]


def test_crash_before_the_control_row(spark, tmp_path, monkeypatch):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, (1, DAY1, "a"), (2, DAY1, "a")))
    fresh = rows(spark, (1, DAY2, "b"), (3, DAY2, "b"))
    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_write_commit", crash)
        with pytest.raises(Crash):
            put(table, "b", fresh)
    assert fetch(table.read()) == [(1, DAY1, "a"), (2, DAY1, "a")]
    assert table.current().watermark == str(DAY1)
    put(table, "b", fresh)
    assert fetch(table.read()) == [(1, DAY2, "b"), (2, DAY1, "a"), (3, DAY2, "b")]
    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "_write_commit", crash)
        with pytest.raises(Crash):
            put(table, "never", fresh)
    table.retire()
    assert sorted(os.listdir(f"{table.path}/data")) == ["load_id=a", "load_id=b"]
    assert os.listdir(f"{table.path}/staging") == []
    assert fetch(table.read()) == [(1, DAY2, "b"), (2, DAY1, "a"), (3, DAY2, "b")]
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("tablesync_")]


def test_crash_while_rows_are_written(spark, tmp_path, monkeypatch):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, (1, DAY1, "a")))
    fails = F.when(F.col("k") == 1, F.raise_error(F.lit("boom")))
    boom = rows(spark, (1, DAY2, "b")).withColumn("v", fails.cast("string"))
    with pytest.raises(Exception, match="boom"):
        put(table, "b", boom)
    assert fetch(table.read()) == [(1, DAY1, "a")]
    put(table, "b", rows(spark, (1, DAY2, "b")))
    assert fetch(table.read()) == [(1, DAY2, "b")]


def test_merge_shuffles_only_the_increment_and_that_once(spark, tmp_path):
    table = new_table(spark, tmp_path, n_buckets=16)
    put(table, "a", spark.range(20000).selectExpr("id AS k", "timestamp_ntz'2024-01-01' AS at", "'a' AS v"))
    staged = new_path(tmp_path, "staged")
    overwrite(rows(spark, (1, DAY2, "b"), (1, DAY3, "c"), (30000, DAY2, "d")), staged)
    commit, session = table.current(), table.bucket_session()
    assert session.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    fresh = table.placed(latest(session.read.parquet(staged), ["k"], ["at"]))
    with table.bucketed(commit, commit.buckets, session) as base:
        merged = merge(base, fresh, ["k"], ["at"])
        plan = plan_of(merged)
        assert plan.count("Exchange") == 1
        assert plan.index("Bucketed: true") < plan.index("Exchange"), "it belongs to the increment"
        assert plan.index("Exchange") < plan.index("Partial"), "a hot key is cut below it"
        assert merged.count() == 20001
    assert spark.conf.get("spark.sql.adaptive.enabled") == "true"


def test_bucket_directories_match_sparks_buckets(spark, tmp_path):
    table = new_table(spark, tmp_path, n_buckets=8)
    put(table, "a", spark.range(1000).selectExpr("id AS k", "timestamp_ntz'2024-01-01' AS at", "'a' AS v"))
    files = glob.glob(f"{table.path}/data/load_id=a/bucket=*/*.parquet")
    assert len(files) == 8
    for file in files:
        assert int(file.split("bucket=")[1].split("/")[0]) == int(file.rsplit("_", 1)[1].split(".")[0])


def test_new_columns_only_when_allowed(spark, tmp_path):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, (1, DAY1, "a"), (2, DAY1, "a")))
    wider = rows(spark, (1, DAY2, "b", 5), schema="k bigint, at timestamp_ntz, v string, w int")
    with pytest.raises(Exception, match="w"):
        put(table, "b", wider)
    put(table, "b", wider, allow_new_columns=True)
    assert fetch(table.read()) == [(1, DAY2, "b", 5), (2, DAY1, "a", None)]
    narrow = rows(spark, (2, DAY3), schema="k bigint, at timestamp_ntz")
    put(table, "c", narrow, allow_new_columns=True)
    assert fetch(table.read()) == [(1, DAY2, "b", 5), (2, DAY3, None, None)]


def test_new_column_does_not_shuffle_the_table(spark, tmp_path):
    table = new_table(spark, tmp_path, n_buckets=16)
    put(table, "a", rows(spark, (1, DAY1, "a"), (2, DAY1, "a")))
    wider = rows(spark, (1, DAY2, "b", 5), schema="k bigint, at timestamp_ntz, v string, w int")
    staged = new_path(tmp_path, "staged")
    overwrite(wider, staged)
    commit, session = table.current(), table.bucket_session()
    fresh = table.placed(latest(session.read.parquet(staged), ["k"], ["at"]))
    with table.bucketed(commit, commit.buckets, session, wider.schema.fields[-1:]) as base:
        merged = merge(base, fresh, ["k"], ["at"], allow_new_columns=True)
        assert plan_of(merged).count("Exchange") == 1


@pytest.mark.parametrize("name", ["bucket", "Load_ID"])
def test_reserved_names(spark, tmp_path, name):
    table = new_table(spark, tmp_path)
    clash = rows(spark, (1, DAY1, "a")).withColumn(name, F.lit(7))
    with pytest.raises(ValueError, match="cannot be columns"):
        put(table, "a", clash)
    with pytest.raises(ValueError, match="cannot be columns"):
        table.publish("a", clash)


def test_watermark_must_be_a_point_in_time(spark, tmp_path):
    with pytest.raises(TypeError, match="k is bigint, no point in time"):
        upsert_latest(new_table(spark, tmp_path), rows(spark, (1, DAY1, "a")), ["at"], "a", watermark="k")


def test_composite_and_text_keys(spark, tmp_path):
    table = new_table(spark, tmp_path, key=("k", "v"))
    put(table, "a", rows(spark, (1, DAY1, "x"), (1, DAY1, "y")))
    put(table, "b", rows(spark, (1, DAY2, "y"), (2, DAY2, "x")))
    assert fetch(table.read()) == [(1, DAY1, "x"), (1, DAY2, "y"), (2, DAY2, "x")]


def test_opening_with_another_layout_is_refused(spark, tmp_path):
    table = new_table(spark, tmp_path, n_buckets=4)
    put(table, "a", rows(spark, (1, DAY1, "a")))
    with pytest.raises(ValueError, match="bucketed by"):
        VersionedTable(spark, table.path, ["k"], 8).read()


def test_a_committed_load_is_never_written_over(spark, tmp_path):
    table = new_table(spark, tmp_path)
    table.publish("a", rows(spark, (1, DAY1, "a")))
    again = table.placed(rows(spark, (1, DAY2, "b")))
    with pytest.raises(ValueError, match="is committed"):
        table.publish_placed("a", again, table.current())
    table.publish("a", rows(spark, (1, DAY2, "b")))
    assert fetch(table.read()) == [(1, DAY1, "a")]


def test_replace_drop_column_and_retire(spark, tmp_path):
    table = new_table(spark, tmp_path)
    table.publish("a", rows(spark, (1, DAY1, "a"), (1, DAY2, "b"), (2, DAY1, "a")))
    table.replace("b", lambda df: latest(df, ["k"], ["at"]))
    table.replace("c", lambda df: df.drop("v"), row_by_row=True)
    table.replace("c", lambda df: df.where("false"))
    assert fetch(table.read()) == [(1, DAY2), (2, DAY1)]
    assert table.retire(keep=2) == 2
    assert fetch(table.read()) == [(1, DAY2), (2, DAY1)]
    assert fetch(table.read_version(table.find("b"))) == [(1, DAY2, "b"), (2, DAY1, "a")]
    table.replace("d", lambda df: df.where("false"))
    assert table.read().count() == 0 and table.read().columns == ["k", "at"]


def test_upsert_into_repeated_keys_makes_the_whole_table_unique(spark, tmp_path):
    table = new_table(spark, tmp_path, n_buckets=8)
    base = [(k % 10, at(f"2024-01-{k % 9 + 1:02d}"), f"v{k}") for k in range(60)] + [(None, DAY1, "none")]
    table.publish("a", rows(spark, *base))
    assert not table.current().unique_keys
    fresh = [(3, at("2024-02-01"), "new"), (77, DAY1, "new")]
    put(table, "b", rows(spark, *fresh))
    assert table.current().unique_keys
    assert fetch(table.read()) == expected(base + fresh)
    table.replace("c", lambda df: df.withColumn("v", F.upper("v")), row_by_row=True)
    assert table.current().unique_keys
    put(table, "d", rows(spark, (5, at("2024-03-01"), "X")))
    assert table.read().count() == 11


def test_two_writers_are_noticed(spark, tmp_path, monkeypatch):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, (1, DAY1, "a")))
    stale = table.current()
    put(table, "b", rows(spark, (1, DAY2, "b")))
    with monkeypatch.context() as patch:
        patch.setattr(VersionedTable, "current", lambda self: stale)
        put(table, "c", rows(spark, (1, DAY3, "c")))
    with pytest.raises(RuntimeError, match="at the same time"):
        table.read()


def test_merchant_sync_over_three_days(spark, tmp_path):
    source = merchant_src(spark, "/root/testdata/sf0.001")
    table = new_table(spark, tmp_path, key=merchant.KEY)
    with pytest.raises(ValueError, match="full load"):
        merchant.sync_merchants(source, table, "day-0")
    previous = "1900-01-01"
    for n, mark in enumerate(["1997-01-01", "2000-01-01", "2100-01-01"]):
        part = source.where(F.col("mt_update_dt") <= F.lit(mark).cast("timestamp_ntz"))
        result = merchant.sync_merchants(part, table, f"day-{n}", first_load=n == 0)
        lost = part.where(F.col("mrch_sales_manager_key").try_cast("bigint").isNull())
        fresh = lost.where(F.col("mt_update_dt") > F.lit(previous).cast("timestamp_ntz"))
        assert result.lost["lost_sales_manager_key"] == fresh.count() > 0
        assert result.lost["lost_mrch_show_pdp"] == 0
        assert merchant.sync_merchants(part, table, f"day-{n}").lost == {}
        previous = table.current().watermark
    whole = latest(merchant.MERCHANT.apply(source), merchant.KEY, [merchant.UPDATED_AT])
    assert fetch(table.read()) == fetch(whole)
    assert not merchant.sync_merchants(source, table, "day-3").published
    assert not merchant.sync_merchants(source, table, "day-4", overlap="1 hour").rejected
    assert fetch(table.read()) == fetch(whole)


def test_an_increment_is_staged_in_files_a_task_can_sort(spark, tmp_path, monkeypatch):
    table = new_table(spark, tmp_path)
    monkeypatch.setattr(upsert, "STAGED_ROWS", 10)
    with monkeypatch.context() as broken:
        broken.setattr(type(table), "_write_commit", crash)
        with pytest.raises(Crash):
            put(table, "a", rows(spark, *[(k, DAY1, "a") for k in range(95)]).coalesce(1))
    files = glob.glob(f"{table.path}/staging/load_id=a/*.parquet")
    assert sorted(spark.read.parquet(f).count() for f in files) == [5, *[10] * 9]
    put(table, "a", rows(spark, *[(k, DAY1, "a") for k in range(95)]).coalesce(1))
    assert table.read().count() == 95
    assert table.bucket_session().conf.get("spark.sql.files.maxPartitionBytes") == str(16 << 20)


def test_columns_are_dropped_without_a_write(spark, tmp_path):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, *[(k, DAY1, "a") for k in range(20)]).withColumn("w", F.col("k") * 2))
    files = sorted(glob.glob(f"{table.path}/data/**/*.parquet", recursive=True))
    table.drop_columns("dropped", ["w"])
    table.drop_columns("dropped", ["v"])
    assert sorted(glob.glob(f"{table.path}/data/**/*.parquet", recursive=True)) == files
    assert table.read().columns == ["k", "at", "v"] and table.read().count() == 20
    assert table.current().watermark == str(DAY1) and table.current().unique_keys
    put(table, "b", rows(spark, (3, DAY2, "b"), (99, DAY2, "c")))
    assert "w" not in table.read().columns and table.read().count() == 21
    wider = rows(spark, (4, DAY3, "d")).withColumn("w", F.lit(7).cast("bigint"))
    with pytest.raises(ValueError, match="replace the table first"):
        put(table, "c", wider, allow_new_columns=True)
    table.replace("rewritten", lambda df: df, row_by_row=True)
    put(table, "d", wider, allow_new_columns=True)
    assert fetch(table.read().where("w IS NOT NULL").select("k", "w")) == [(4, 7)]
    for names in (["k"], ["nothing"]):
        with pytest.raises(ValueError, match="cannot be dropped"):
            table.drop_columns("no", names)


def test_a_reader_is_given_a_path_per_load(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("tablesync.sources.versions.FEW_BUCKETS", 2)
    table = new_table(spark, tmp_path, n_buckets=16)
    put(table, "007", rows(spark, *[(k, DAY1, "a") for k in range(200)]))
    put(table, "b", rows(spark, *[(k, DAY2, "b") for k in range(0, 9)]))
    put(table, "c", rows(spark, (3, DAY3, "c")))
    commit = table.current()
    assert set(commit.buckets.values()) == {"007", "b", "c"}
    want = [(k, DAY3 if k == 3 else DAY2 if k < 9 else DAY1, "c" if k == 3 else "b" if k < 9 else "a") for k in range(200)]
    assert fetch(table.read()) == sorted(want, key=repr)
    assert "InMemoryFileIndex(3 paths)" in plan_of(table.read())
    control = spark.read.parquet(f"{table.path}/commits/load_id=007").first()["buckets"]
    assert control == '{"007": [[0, 15]]}'
    old = dict(sorted(commit.buckets.items()))
    assert _bucket_map(json.dumps(old)) == _bucket_map(json.dumps({n: _runs(u) for n, u in _by_load(old).items()})) == old
    table.retire()
    assert fetch(table.read()) == sorted(want, key=repr)
