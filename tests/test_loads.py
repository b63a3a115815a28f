import glob
import itertools
import os

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.plans import installs, offers
from tablesync.plans.backup import backup_window, last_stored
from tablesync.plans.registry import Registry
from tablesync.plans.staged import StagedLoad
from tablesync.sources import files, tables
from tests.helpers import ROW, Crash, at, crash, fetch, new_path, plan_of, rows
from tests.test_latest import relaxed

DAY1, DAY2, DAY3 = at("2024-01-01"), at("2024-01-02"), at("2024-01-03")


@pytest.fixture
def registry(spark, tmp_path):
    return Registry(spark, new_path(tmp_path, "registry"))


@pytest.fixture
def load(spark, tmp_path):
    schema = rows(spark, schema=ROW).schema
    root = new_path(tmp_path, "load")
    return StagedLoad("target", f"{root}/target", f"{root}/staging", "at", lambda df: df, schema)


def test_registry(spark, registry):
    assert registry.watermark("t") is None
    assert registry.history().count() == 0 and registry.current().count() == 0
    registry.record("t", "007", "2024-01-02 03:04:05.000006", 5)
    registry.record("t", "008", "2024-01-03", 6)
    registry.record("u", "1", DAY1, 7)
    registry.record("t", "008", "2024-01-03", 6)
    assert registry.progress("t").loads == ["007", "008"]
    assert registry.committed("t", "008") and not registry.committed("t", "009") and not registry.committed("u", "008")
    assert registry.watermark("v") is None
    assert registry.watermark("t") == "2024-01-03 00:00:00"
    got = fetch(registry.current().drop("committed_at"))
    assert got == [("t", "008", DAY3, 6), ("u", "1", DAY1, 7)]
    assert registry.history().count() == 3
    with pytest.raises(ValueError, match="before the stored"):
        registry.record("t", "009", "2024-01-02", 1)
    with pytest.raises(ValueError, match="name a directory"):
        registry.record("t/u", "1", DAY1, 1)


def test_staged_load(spark, registry, load):
    source = rows(spark, (1, DAY1, "a"), (2, None, "none"))
    with pytest.raises(ValueError, match="full load"):
        load.run(source, registry, "1")
    first = load.run(source, registry, "1", full_load=True)
    assert (first.inserted, first.row_count, first.max_value) == (True, 1, str(DAY1))
    source = rows(spark, (1, DAY1, "a"), (3, DAY1, "tied late"), (4, DAY2, "b"))
    assert load.run(source, registry, "2").row_count == 1
    assert not load.run(source, registry, "2").inserted
    assert not load.run(source, registry, "3").inserted
    assert fetch(load.read(spark, registry)) == [(1, DAY1, "a"), (4, DAY2, "b")]
    assert registry.progress("target").loads == ["1", "2"]
    assert glob.glob(f"{load.staging}/*") == []


@pytest.mark.parametrize("same_load", [True, False])
def test_crash_between_insert_and_registry(spark, registry, load, monkeypatch, same_load):
    load.run(rows(spark, (1, DAY1, "a")), registry, "1", full_load=True)
    source = rows(spark, (1, DAY1, "a"), (2, DAY2, "b"))
    with monkeypatch.context() as patch:
        patch.setattr(Registry, "record", crash)
        with pytest.raises(Crash):
            load.run(source, registry, "2")
    assert fetch(load.read(spark, registry)) == [(1, DAY1, "a")]
    load.run(source, registry, "2" if same_load else "3")
    assert fetch(load.read(spark, registry)) == [(1, DAY1, "a"), (2, DAY2, "b")]
    assert load.sweep(spark, registry) == (0 if same_load else 1)
    assert fetch(load.read(spark, registry)) == [(1, DAY1, "a"), (2, DAY2, "b")]


def test_failed_insert_keeps_the_watermark(spark, registry, load):
    strict = StagedLoad(
        load.name, load.target, load.staging, "at",
        lambda df: df.withColumn("v", F.col("v").cast("bigint").cast("string")), load.target_schema,
    )
    source = rows(spark, (1, DAY1, "7"))
    strict.run(source, registry, "1", full_load=True)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        strict.run(rows(spark, (2, DAY2, "x")), registry, "2")
    assert registry.watermark("target") == str(DAY1)
    strict.run(rows(spark, (2, DAY2, "8")), registry, "2")
    assert fetch(load.read(spark, registry)) == [(1, DAY1, "7"), (2, DAY2, "8")]


def test_text_watermark_column(spark, registry, tmp_path):
    schema = "snap string, n int"
    df = rows(spark, ("2024-01-01T00:00:00", 1), ("2024-01-02T10:00:00", 2), schema=schema)
    root = new_path(tmp_path, "text")
    job = StagedLoad("text", f"{root}/target", f"{root}/staging", "snap", lambda d: d, df.schema)
    job.run(df, registry, "1", full_load=True)
    assert registry.watermark("text") == "2024-01-02 10:00:00"
    later = rows(
        spark, ("2024-01-02T10:00:00", 2), ("2024-01-02T10:00:01", 3), ("2024-01-03", 4), ("soon", 5), schema=schema
    )
    assert job.run(later, registry, "2").row_count == 2
    assert registry.watermark("text") == "2024-01-03 00:00:00"
    assert job.run(later, registry, "3").row_count == 0


days = st.lists(st.one_of(st.none(), st.integers(1, 9)), max_size=12)


@relaxed
@given(st.lists(days, min_size=1, max_size=4))
def test_staged_loads_add_up(spark, tmp_path, batches):
    """Each run sees all rows so far; a row is loaded once, when it is the newest."""
    registry = Registry(spark, new_path(tmp_path, "registry"))
    root = new_path(tmp_path, "load")
    schema = rows(spark, schema=ROW).schema
    job = StagedLoad("t", f"{root}/target", f"{root}/staging", "at", lambda df: df, schema)
    seen, want, mark = [], [], 0
    for n, batch in enumerate(batches):
        seen += [(len(seen) + i, day) for i, day in enumerate(batch)]
        due = [(k, day) for k, day in seen if day is not None and day > mark]
        source = rows(spark, *[(k, at(f"2024-01-{d:02d}") if d else None, "v") for k, d in seen], schema=ROW)
        assert job.run(source, registry, f"{n}", full_load=True).row_count == len(due)
        want += due
        mark = max([mark, *[day for _, day in due]])
    assert fetch(job.read(spark, registry)) == sorted(
        [(k, at(f"2024-01-{d:02d}"), "v") for k, d in want], key=repr
    )


def test_zoned_timestamps(spark, registry, load, tmp_path):
    zoned = "k bigint, at timestamp, v string"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    moments = spark.sql(
        "SELECT * FROM VALUES (1L, timestamp'2024-01-01 10:00:00.000001Z', 'a'), "
        "(2L, timestamp'2024-01-01 10:00:00.000002Z', 'b') AS t(k, at, v)"
    )
    root = new_path(tmp_path, "zoned")
    job = StagedLoad("zoned", f"{root}/target", f"{root}/staging", "at", lambda d: d, rows(spark, schema=zoned).schema)
    job.run(moments.where("k = 1"), registry, "1", full_load=True)
    assert registry.watermark("zoned") == "2024-01-01 10:00:00.000001"
    assert job.run(moments, registry, "2").row_count == 1
    assert {r["k"] for r in job.read(spark, registry).collect()} == {1, 2}
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert job.run(moments, registry, "3").row_count == 0
        late = moments.union(spark.sql("SELECT 3L, timestamp'2024-01-01 10:00:00.000003Z', 'c'"))
        assert job.run(late, registry, "4").row_count == 1
        assert registry.watermark("zoned") == "2024-01-01 10:00:00.000003"
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def events(spark, *days):
    day = F.col("day").cast("date")
    values = [(n, d, f"r{n}") for n, d in enumerate(days)]
    return rows(spark, *values, schema="id int, day string, v string").withColumn("day", day)


def test_backups_are_disjoint_and_complete(spark, registry, tmp_path):
    sink = new_path(tmp_path, "sink")
    source = events(spark, *[f"2024-01-{d:02d}" for d in range(1, 21)] * 3)
    found = []
    for n, as_of in enumerate(["2024-01-06", "2024-01-07", "2024-01-07", "2024-01-15", "2024-01-31"]):
        run = backup_window(source, sink, "day", as_of, registry, "events", f"{n}", first_load=n == 0)
        if run.row_count:
            found.append((run.first_day, run.last_day))
    assert found == [
        ("2024-01-01", "2024-01-04"),
        ("2024-01-05", "2024-01-05"),
        ("2024-01-06", "2024-01-13"),
        ("2024-01-14", "2024-01-20"),
    ]
    assert fetch(spark.read.parquet(sink).select("id", "day", "v")) == fetch(source)
    assert all(one[1] < other[0] for one, other in itertools.pairwise(found))


@pytest.mark.parametrize("first", [True, False])
def test_backup_crash_is_made_good(spark, registry, tmp_path, monkeypatch, first):
    sink = new_path(tmp_path, "sink")
    source = events(spark, "2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04")
    if not first:
        installs_run = backup_window(source, sink, "day", "2024-01-03", registry, "e", "0", first_load=True)
        assert installs_run.last_day == "2024-01-01"
    with monkeypatch.context() as patch:
        patch.setattr(Registry, "record", crash)
        with pytest.raises(Crash):
            backup_window(source, sink, "day", "2024-01-05", registry, "e", "1", first_load=first)
    files.drop_if_exists(spark, f"{sink}/day=2024-01-02")
    run = backup_window(source, sink, "day", "2024-01-05", registry, "e", "1", first_load=first)
    assert run.last_day == "2024-01-03"
    assert fetch(spark.read.parquet(sink).select("id")) == [(0,), (1,), (2,)]


def test_backup_failure_raises(spark, registry, tmp_path):
    bad = events(spark, "2024-01-01").withColumn("v", F.raise_error(F.lit("boom")).cast("string"))
    with pytest.raises(Exception, match="boom"):
        backup_window(bad, new_path(tmp_path), "day", "2024-02-01", registry, "e", "1", first_load=True)
    assert registry.progress("e").loads == []


def test_late_rows_of_the_last_day(spark, registry, tmp_path):
    sink = new_path(tmp_path, "sink")
    backup_window(events(spark, "2024-01-01"), sink, "day", "2024-01-03", registry, "e", "1", first_load=True)
    late = events(spark, "2024-01-01", "2024-01-01", "2024-01-02")
    run = backup_window(late, sink, "day", "2024-01-04", registry, "e", "2", closed="low")
    assert run.row_count == 3
    assert spark.read.parquet(sink).count() == 3


def test_empty_sink_needs_a_bound(spark, registry, tmp_path):
    source = events(spark, "2024-01-01")
    with pytest.raises(ValueError, match="first load"):
        backup_window(source, new_path(tmp_path), "day", "2024-01-09", registry, "e", "1")
    assert last_stored(source.where("false"), "day") is None
    run = backup_window(source, new_path(tmp_path), "day", "2024-01-01", registry, "e", "1", first_load=True)
    assert run.row_count == 0 and registry.watermark("e") is None


def test_skewed_day_is_written_by_several_tasks(spark, tmp_path):
    """Rows of one day, all alike, still do not end up in a single task."""
    path = new_path(tmp_path, "skew")
    same = spark.range(0, 400000, 1, 8).selectExpr(
        "date_add(date'2024-01-01', cast(if(id % 3 = 0, id % 5 + 1, 0) as int)) AS day", "uuid() AS v"
    )
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1MB")
    try:
        tables.append_partitions(same, path, "day")
    finally:
        spark.conf.set(setting, before)
    assert len(glob.glob(f"{path}/day=2024-01-01/*.parquet")) > 3
    assert spark.read.parquet(path).count() == 400000


def test_scan_of_an_absent_table(spark, tmp_path):
    schema = rows(spark, schema=ROW).schema
    assert tables.scan_parquet(spark, new_path(tmp_path), schema).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.scan_parquet(spark, new_path(tmp_path))


def test_offers_and_installs_jobs_are_wired(spark, registry, tmp_path):
    assert installs.DAY == "install_date"
    job = offers.offers_load(new_path(tmp_path, "offers"))
    assert job.read(spark, registry).schema == offers.OFFERS_SCHEMA


def test_any_source_format(spark, tmp_path):
    path = new_path(tmp_path, "orc")
    df = rows(spark, (1, DAY1, "a"), (2, DAY3, "b"))
    tables.append(df, path, "orc", {"compression": "zlib"})
    later = F.col("at") > F.lit(str(DAY2)).cast("timestamp_ntz")
    got = tables.scan_source(spark, "orc", path, {"mergeSchema": "false"}, later)
    assert fetch(got) == [(2, DAY3, "b")]
    assert "GreaterThan(at," in plan_of(got)


@pytest.mark.parametrize("file_format,options", [("orc", {}), ("csv", {"header": "true", "sep": "|"})])
def test_staged_load_in_another_format(spark, tmp_path, file_format, options):
    df = spark.sql("SELECT id, timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id AS int)) AS at FROM range(20)")
    job = StagedLoad(file_format, f"{tmp_path}/target", f"{tmp_path}/staging", "at", lambda d: d, df.schema, file_format, options)
    registry = Registry(spark, f"{tmp_path}/registry")
    assert job.run(df.where("id < 12"), registry, "1", full_load=True).row_count == 12
    assert job.run(df, registry, "2").row_count == 8 and not job.run(df, registry, "2").inserted
    assert sorted(map(tuple, job.read(spark, registry).collect())) == sorted(map(tuple, df.collect()))
    assert list((tmp_path / "target" / "load_id=1").glob(f"*.{file_format}"))


def files_under(path):
    return sum(1 for f in glob.glob(f"{path}/**/*.parquet", recursive=True))


def test_the_registry_is_folded(spark, registry, monkeypatch):
    monkeypatch.setattr("tablesync.plans.registry.FOLD", 4)
    counts = []
    for n in range(13):
        registry.record("t", f"load-{n:02}", f"2024-01-{n + 1:02}", n)
        counts.append(files_under(f"{registry.path}/table_name=t") + files_under(f"{registry.path}/_folded"))
        assert registry.watermark("t") == f"2024-01-{n + 1:02} 00:00:00"
        assert registry.committed("t", "load-00") and registry.committed("t", f"load-{n:02}")
    assert max(counts[4:]) <= 4 and counts[-1] == 2
    registry.record("u", "one", DAY1, 1)
    registry.record("t", "load-00", "2024-01-13", 99)
    assert registry.progress("t").loads == [f"load-{n:02}" for n in range(13)]
    assert registry.history().count() == 14
    assert fetch(registry.history().where("load_id = 'load-00'").select("row_count")) == [(99,)]
    assert fetch(registry.current().select("table_name", "watermark")) == [
        ("t", at("2024-01-13")), ("u", DAY1)]
    assert not registry.committed("t", "load-99") and not registry.committed("u", "load-01")


@pytest.mark.parametrize("step", ["overwrite", "drop_if_exists", "drop_others"])
def test_a_fold_that_dies_loses_nothing(spark, registry, monkeypatch, step):
    for n in range(3):
        registry.record("t", f"{n}", f"2024-01-0{n + 1}", n)
    registry.fold("t")
    registry.record("t", "3", "2024-01-04", 3)
    before = fetch(registry.history().drop("committed_at"))
    with monkeypatch.context() as broken:
        broken.setattr(f"tablesync.plans.registry.{step}", crash)
        with pytest.raises(Crash):
            registry.fold("t")
    assert fetch(registry.history().drop("committed_at")) == before
    assert registry.progress("t").loads == ["0", "1", "2", "3"]
    registry.fold("t")
    assert fetch(registry.history().drop("committed_at")) == before
    assert files_under(registry.path) == 1


def test_a_half_written_fold_is_not_read(spark, registry):
    registry.record("t", "0", DAY1, 1)
    registry.fold("t")
    rows(spark, (1, DAY3, "x")).write.parquet(f"{registry.path}/_folded/table_name=t/fold=2")
    assert drop_marks(f"{registry.path}/_folded/table_name=t/fold=2")
    assert registry.watermark("t") == str(DAY1)
    registry.record("t", "1", DAY2, 1)
    registry.fold("t")
    assert registry.progress("t").loads == ["0", "1"]


def drop_marks(path):
    """As a write that died leaves it."""
    marks = glob.glob(f"{path}/_SUCCESS")
    for mark in marks:
        os.remove(mark)
    return marks


def test_a_target_by_day_is_pruned_by_a_join(spark, registry, tmp_path):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("day", T.DateType())])
    root = new_path(tmp_path, "by-day")
    job = StagedLoad("d", f"{root}/target", f"{root}/staging", "at", lambda df: df.select(
        "k", F.col("at").cast("date").alias("day")), schema, day="day")
    source = rows(spark, *[(k, at(f"2024-01-0{1 + k % 5}"), "v") for k in range(50)])
    job.run(source, registry, "1", full_load=True)
    job.run(source.union(rows(spark, (99, at("2024-01-06"), "w"))), registry, "2")
    rows(spark, (7, DAY1, "x")).write.parquet(f"{root}/target/load_id=died/day=2024-01-01")
    stored = job.read(spark, registry)
    assert stored.count() == 51 and stored.columns == ["k", "day"]
    assert fetch(stored.where("k = 99")) == [(99, at("2024-01-06").date())]
    wanted = spark.createDataFrame([(DAY2.date(), 1), (DAY3.date(), 2)], "day date, n int").where("n < 2")
    joined = stored.join(F.broadcast(wanted), "day")
    plan = plan_of(joined)
    assert "dynamicpruning" in plan and "NOT (load_id" in plan or "NOT load_id" in plan
    assert fetch(joined.select("k")) == sorted([(k,) for k in range(50) if k % 5 == 1], key=repr)


def test_load_id_cannot_be_a_column(tmp_path):
    schema = T.StructType([T.StructField("load_id", T.StringType())])
    with pytest.raises(ValueError, match="load_id"):
        StagedLoad("d", f"{tmp_path}/t", f"{tmp_path}/s", "at", lambda df: df, schema)
