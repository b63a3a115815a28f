import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tablesync.plans import history
from tablesync.plans.history import as_of, extend_history, intervals
from tablesync.sources.files import exists
from tests.helpers import Crash, at, crash, fetch, new_table, rows
from tests.test_latest import relaxed

DAYS = [at(f"2024-01-0{d}") for d in range(1, 8)]
version = st.tuples(st.sampled_from([None, 1, 2]), st.sampled_from([None, *DAYS]), st.sampled_from([None, "a", "b"]))
loads = st.lists(st.lists(version, max_size=8), min_size=1, max_size=3)


def expected(batches):
    """The last load's value per key and day; runs of equal values joined."""
    held = {}
    for batch in batches:
        best = {}
        for k, day, v in batch:
            if k is not None and day is not None:
                known = best.get((k, day))
                best[k, day] = max(known, (v is not None, v or "")) if known else (v is not None, v or "")
        held.update(best)
    out = []
    for key in {k for k, _ in held}:
        runs = []
        for day in sorted(d for k, d in held if k == key):
            value = held[key, day][1] if held[key, day][0] else None
            if not runs or runs[-1][0] != value:
                runs.append((value, day))
        ends = [day for _, day in runs[1:]] + [None]
        out += [(key, v, day, end) for (v, day), end in zip(runs, ends)]
    return sorted(out, key=repr)


def put(table, load_id, df):
    return extend_history(table, df, "at", ["v"], load_id)


@relaxed
@given(loads)
def test_any_split_gives_one_history(spark, tmp_path, batches):
    table = new_table(spark, tmp_path)
    for n, batch in enumerate(batches):
        put(table, f"load-{n}", rows(spark, *batch))
    got = fetch(intervals(table.read())) if table.current() else []
    assert got == expected(batches)


def test_reruns_and_known_versions_add_nothing(spark, tmp_path):
    table = new_table(spark, tmp_path)
    first = rows(spark, (1, DAYS[0], "a"), (1, DAYS[2], "b"), (2, DAYS[1], "c"))
    put(table, "a", first)
    before = fetch(table.read())
    assert not put(table, "a", rows(spark, (1, DAYS[5], "z"))).published
    put(table, "b", first)
    assert fetch(table.read()) == before
    assert fetch(intervals(table.read())) == [
        (1, "a", DAYS[0], DAYS[2]), (1, "b", DAYS[2], None), (2, "c", DAYS[1], None)]


def test_a_late_version_splits_an_interval(spark, tmp_path):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, (1, DAYS[0], "a"), (1, DAYS[4], "a")))
    assert fetch(intervals(table.read())) == [(1, "a", DAYS[0], None)]
    put(table, "b", rows(spark, (1, DAYS[2], "b")))
    assert fetch(intervals(table.read())) == [
        (1, "a", DAYS[0], DAYS[2]), (1, "a", DAYS[4], None), (1, "b", DAYS[2], DAYS[4])]
    assert table.current().watermark == str(DAYS[4])
    for moment, value in ((DAYS[0], "a"), (DAYS[3], "b"), (DAYS[6], "a")):
        assert fetch(as_of(table.read(), moment)) == [(1, value)]
    assert fetch(as_of(table.read(), "2023-12-31")) == []


def test_a_hot_key_and_the_shuffles(spark, tmp_path, monkeypatch):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, (2, DAYS[0], "x")))
    plans = []
    write = type(table)._write_rows

    def watched(self, load_id, df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return write(self, load_id, df)

    monkeypatch.setattr(type(table), "_write_rows", watched)
    hot = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins="id")).alias("at"),
        (F.col("id") % 4).cast("string").alias("v"))
    put(table, "b", hot)
    assert plans[0].count("Exchange") == 1, "the increment alone is dealt out"
    got = intervals(table.read()).where("k = 1")
    assert got.count() == hot.where("k = 1").count()
    assert got.where("valid_to IS NULL").count() == 1
    assert got.where("valid_to <= valid_from").count() == 0


def small_slices(patch, rows_of_a_slice, rows_of_a_bucket):
    patch.setattr(history, "SLICE_ROWS", rows_of_a_slice)
    patch.setattr(history, "WIDE_ROWS", rows_of_a_bucket)


@relaxed
@given(loads)
def test_slices_give_the_same_history(spark, tmp_path, batches):
    table = new_table(spark, tmp_path, n_buckets=2)
    with pytest.MonkeyPatch.context() as patch:
        small_slices(patch, 1, 1)
        for n, batch in enumerate(batches):
            put(table, f"load-{n}", rows(spark, *batch))
    got = fetch(intervals(table.read())) if table.current() else []
    assert got == expected(batches)


def test_several_tasks_share_a_hot_key(spark, tmp_path, monkeypatch):
    small_slices(monkeypatch, 500, 2_000)
    table = new_table(spark, tmp_path)
    hot = spark.range(6_000).select(
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id") % 900).alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(mins="id")).alias("at"),
        # long runs of one value, one of them over several slices, and NULLs
        F.when(F.col("id") < 4_000, F.when(F.col("id") % 700 < 600, "a")).otherwise("b").alias("v"))
    tasks = []
    write = type(table)._write_rows

    def watched(self, load_id, df):
        sizes = df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
        tasks.append((sizes, df.columns))
        return write(self, load_id, df)

    monkeypatch.setattr(type(table), "_write_rows", watched)
    late = F.col("at") < F.lit("2024-01-03").cast("timestamp_ntz")
    put(table, "late", hot.where(~late))
    put(table, "all", hot)
    once = new_table(spark, tmp_path)
    small_slices(monkeypatch, 10_000, 10_000)
    put(once, "all", hot)
    assert fetch(table.read()) == fetch(once.read())
    assert table.read().columns == once.read().columns
    assert tasks[1][0] < 2_000 < tasks[2][0], "rows of the largest task, in slices and by bucket"
    assert not exists(spark, f"{table.path}/slices/load_id=all")


def test_rejects_and_clashes(spark, tmp_path):
    table = new_table(spark, tmp_path)
    assert put(table, "a", rows(spark, (None, DAYS[0], "n"), (1, None, "p"), (1, DAYS[0], "a"))).rejected == 1
    assert fetch(spark.read.parquet(f"{table.path}/rejects/load_id=a").select("v")) == [("n",)]
    with pytest.raises(ValueError, match="columns of the history"):
        extend_history(table, rows(spark).withColumn("changed", F.lit(1)), "at", ["changed"], "b")


def test_crash_before_the_control_row(spark, tmp_path, monkeypatch):
    table = new_table(spark, tmp_path)
    put(table, "a", rows(spark, (1, DAYS[0], "a")))
    with monkeypatch.context() as broken:
        broken.setattr(type(table), "_write_commit", crash)
        with pytest.raises(Crash):
            put(table, "b", rows(spark, (1, DAYS[1], "b")))
    assert fetch(intervals(table.read())) == [(1, "a", DAYS[0], None)]
    put(table, "b", rows(spark, (1, DAYS[1], "b")))
    assert fetch(intervals(table.read())) == [(1, "a", DAYS[0], DAYS[1]), (1, "b", DAYS[1], None)]
