"""Rows that must not be lost or skipped, and a control plane that stays bounded."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import convert
from tablesync.operators.increment import between, newer_than, newest
from tablesync.operators.latest import latest
from tablesync.plans.backup import backup_window
from tablesync.plans.registry import Registry
from tablesync.plans.upsert import upsert_latest
from tablesync.sources.files import exists
from tablesync.sources.versions import VersionedTable, bucket_bitmaps, buckets_for, buckets_in
from tests.helpers import at, fetch, new_path, new_table, rows

DAY1, DAY2 = at("2024-01-01"), at("2024-01-02")
DAILY = "day date, id bigint"


def daily(spark, *values):
    return spark.createDataFrame([(at(d).date(), i) for d, i in values], DAILY)


# bucket layout


def test_buckets_follow_the_size():
    assert buckets_for(0) == 1
    assert buckets_for(10 << 40) == 10240
    assert buckets_for(64 << 40) == 65536


def test_a_bucket_stays_small_enough_for_a_task():
    assert [buckets_for(gb << 30) for gb in (1, 6, 60)] == [256, 1536, 10_000]
    assert buckets_for(1 << 40) == 10_000
    assert buckets_for(6 << 30, bucket_bytes=1 << 30) == 6


def test_more_buckets_than_spark_allows_are_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="maxBuckets"):
        VersionedTable(spark, new_path(tmp_path), ["k"], buckets_for(200 << 40))


def test_bitmaps_tell_the_buckets(spark):
    held = [0, 7, 8, 32767, 32768, 70001]
    df = spark.createDataFrame([(b,) for b in held * 3] + [(None,)], "b int")
    found = df.agg(*bucket_bitmaps(F.col("b"), 80_000)).first().asDict()
    assert buckets_in(found) == held
    assert all(len(v) == 4096 for v in found.values())
    assert buckets_in(df.where("false").agg(*bucket_bitmaps(F.col("b"), 10)).first().asDict()) == []


def test_rebucket_keeps_rows_and_watermark(spark, tmp_path):
    table = new_table(spark, tmp_path, n_buckets=3)
    base = rows(spark, *[(k, DAY1, f"v{k}") for k in range(50)])
    upsert_latest(table, base, ["at"], "a", watermark="at")
    wide = table.rebucket("wide", 11)
    assert wide.n_buckets == 11 and fetch(wide.read()) == fetch(base)
    assert wide.current().watermark == "2024-01-01 00:00:00" and wide.current().unique_keys
    assert fetch(table.rebucket("wide", 11).read()) == fetch(base)
    fresh = rows(spark, (3, DAY2, "new"), (99, DAY2, "new"))
    upsert_latest(wide, fresh, ["at"], "b", watermark="at")
    assert fetch(wide.read()) == fetch(latest(base.union(fresh), ["k"], ["at"]))
    with pytest.raises(ValueError, match="bucketed"):
        table.read()


def test_struct_fields_of_any_name_are_merged(spark, tmp_path):
    table = new_table(spark, tmp_path)
    schema = "k bigint, at timestamp_ntz, v struct<`a-b`: int, `c d`: array<struct<`e.f`: string>>>"
    first = spark.createDataFrame([(1, DAY1, (1, [("x",)])), (2, DAY1, (2, []))], schema)
    upsert_latest(table, first, ["at"], "a")
    upsert_latest(table, spark.createDataFrame([(1, DAY2, (5, None))], schema), ["at"], "b")
    assert sorted(r["v"]["a-b"] for r in table.read().collect()) == [2, 5]


# retire


def test_retire_never_drops_the_current_version(spark, tmp_path):
    table = new_table(spark, tmp_path)
    table.publish("a", rows(spark, (1, DAY1, "a")))
    for keep in (0, -1):
        with pytest.raises(ValueError):
            table.retire(keep=keep)
    assert fetch(table.read()) == [(1, DAY1, "a")]


def test_retire_leaves_a_table_without_versions_alone(spark, tmp_path):
    table = new_table(spark, tmp_path)
    rows(spark, (1, DAY1, "a")).write.parquet(f"{table.path}/data/load_id=in-flight")
    assert table.retire() == 0
    assert exists(spark, f"{table.path}/data/load_id=in-flight")


def test_retire_again_finds_nothing(spark, tmp_path):
    table = new_table(spark, tmp_path, n_buckets=4)
    for n in range(6):
        upsert_latest(table, rows(spark, *[(k, at(f"2024-01-{n + 1:02d}"), f"v{n}") for k in range(n, 20)]), ["at"], f"load-{n}")
    before = fetch(table.read())
    table.retire()
    assert table.retire() == 0 and table.commits().count() == 1
    assert fetch(table.read()) == before


# instants and bounds


def test_text_watermarks_are_instants(spark):
    df = spark.createDataFrame([(1, "2024-01-01T05:00:00+03:00"), (2, "2024-01-01T03:00:00Z"), (3, "2024-01-01 02:30:00"),
                                (4, "soon"), (5, None), (6, "2024-01-01")], "id int, at string")
    assert df.where("id = 1").agg(newest(df, "at")).first()[0] == "2024-01-01 02:00:00"
    assert [r["id"] for r in newer_than(df, "at", "2024-01-01 02:00:00").orderBy("id").collect()] == [2, 3]
    assert [r["id"] for r in newer_than(df, "at", "2024-01-01T05:00:00+03:00").orderBy("id").collect()] == [2, 3]


@pytest.mark.parametrize("closed, want", [("neither", [16]), ("low", [16]), ("high", [16]), ("both", [16])])
def test_bounds_with_a_time_of_day(spark, closed, want):
    df = daily(spark, *[(f"2024-01-{d}", d) for d in (14, 15, 16, 17)])
    got = between(df, "day", "2024-01-15 12:00", "2024-01-16 12:00", closed)
    assert sorted(r["id"] for r in got.collect()) == want


def test_an_upper_bound_with_a_time_keeps_its_day(spark):
    df = daily(spark, *[(f"2024-01-{d}", d) for d in (15, 16, 17)])
    assert sorted(r["id"] for r in between(df, "day", None, "2024-01-16 12:00").collect()) == [15, 16]


# casts


def test_lenient_casts_of_text_cut_fractions(spark):
    df = spark.createDataFrame([("1.5",), ("12.0",), ("-1.5",), (" 7 ",), ("1e3",), ("1e30",), ("x",), (None,)], "v string")
    assert [r[0] for r in df.select(convert(F.col("v"), "bigint", True, T.StringType())).collect()] == [1, 12, -1, 7, 1000, None, None, None]


# backup and publish


def test_late_rows_do_not_erase_stored_ones(spark, tmp_path):
    registry, sink = Registry(spark, new_path(tmp_path)), new_path(tmp_path)

    def run(source, as_of, load, **more):
        return backup_window(source, sink, "day", as_of, registry, "t", load, **more)

    run(daily(spark, ("2024-01-01", 1), ("2024-01-01", 1), ("2024-01-01", 2)), "2024-01-03", "a", first_load=True)
    run(daily(spark, ("2024-01-01", 1), ("2024-01-01", 3), ("2024-01-02", 4)), "2024-01-04", "b", closed="low")
    stored = spark.read.parquet(sink)
    assert sorted(r["id"] for r in stored.collect()) == [1, 1, 2, 3, 4]
    run(daily(spark), "2024-01-05", "c", closed="low")
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 1, 2, 3, 4]


def test_rows_half_set_aside_are_set_aside_again(spark, tmp_path):
    registry, sink = Registry(spark, new_path(tmp_path)), new_path(tmp_path)

    def run(source, as_of, load, **more):
        return backup_window(source, sink, "day", as_of, registry, "t", load, **more)

    run(daily(spark, ("2024-01-01", 1), ("2024-01-01", 2)), "2024-01-03", "a", first_load=True)
    os.makedirs(f"{sink}/_kept/load_id=b/_temporary/0/task_1")  # a run that died in its first write
    run(daily(spark, ("2024-01-01", 3), ("2024-01-02", 4)), "2024-01-04", "b", closed="low")
    assert sorted(r["id"] for r in spark.read.parquet(sink).collect()) == [1, 2, 3, 4]


def test_a_bound_that_would_be_ignored_is_an_error(spark, tmp_path):
    registry, sink = Registry(spark, new_path(tmp_path)), new_path(tmp_path)
    backup_window(daily(spark, ("2024-01-01", 1)), sink, "day", "2024-01-03", registry, "t", "a", first_load=True)
    with pytest.raises(ValueError, match="leave low out"):
        backup_window(daily(spark), sink, "day", "2024-01-04", registry, "t", "b", low="2023-12-01")


def test_publish_sets_the_watermark(spark, tmp_path):
    table = new_table(spark, tmp_path)
    table.publish("a", rows(spark, (1, DAY2, "a")), watermark="2024-01-02")
    assert table.publish("b", rows(spark, (1, DAY1, "a"))).watermark is None
    assert table.publish("c", rows(spark, (1, DAY2, "a")), watermark="2024-01-02").watermark == "2024-01-02"
