import glob

import pytest
from pyspark.sql import functions as F

from tablesync.plans import arrival
from tablesync.plans.arrival import Arrivals, sync_arrivals
from tablesync.sources import catalogue
from tests.helpers import ROW, Crash, at, crash, fetch, new_path, new_table, rows

DAY1, DAY2, DAY3 = at("2024-01-01"), at("2024-01-02"), at("2024-01-03")


def deliver(spark, arrivals, *values):
    rows(spark, *values).coalesce(1).write.mode("append").parquet(arrivals.source)


@pytest.fixture
def arrivals(spark, tmp_path):
    return Arrivals(new_path(tmp_path, "source"), rows(spark, schema=ROW).schema, new_path(tmp_path, "home"), files_per_batch=1)


def test_late_rows_are_new_when_they_come(spark, arrivals, tmp_path):
    table = new_table(spark, tmp_path)
    deliver(spark, arrivals, (1, DAY1, "a"), (2, DAY3, "b"))
    assert sync_arrivals(arrivals, table, ["at"], "1").row_count == 2
    deliver(spark, arrivals, (1, DAY2, "late"), (3, DAY1, "later"), (2, DAY1, "older"))
    assert sync_arrivals(arrivals, table, ["at"], "2").row_count == 3
    assert fetch(table.read()) == [(1, DAY2, "late"), (2, DAY3, "b"), (3, DAY1, "later")]
    assert not sync_arrivals(arrivals, table, ["at"], "3").published
    assert arrivals.pending(spark) == []


def test_a_committed_load_takes_no_files(spark, arrivals, tmp_path):
    table = new_table(spark, tmp_path)
    deliver(spark, arrivals, (1, DAY1, "a"))
    sync_arrivals(arrivals, table, ["at"], "1")
    deliver(spark, arrivals, (2, DAY1, "b"))
    assert not sync_arrivals(arrivals, table, ["at"], "1").published
    assert sync_arrivals(arrivals, table, ["at"], "2").row_count == 1
    assert len(fetch(table.read())) == 2


def test_a_stream_that_dies_between_batches(spark, arrivals, tmp_path):
    table = new_table(spark, tmp_path)
    for k in (1, 2):
        deliver(spark, arrivals, (k, DAY1, "a"))
    bad = f"{arrivals.source}/z-broken.parquet"
    with open(bad, "w") as file:
        file.write("no parquet")
    with pytest.raises(Exception, match="broken"):
        sync_arrivals(arrivals, table, ["at"], "1")
    assert table.current() is None and arrivals.pending(spark) == ["1"]
    with pytest.raises(ValueError, match="finish load"):
        sync_arrivals(arrivals, table, ["at"], "2")
    good = new_path(tmp_path, "good")
    rows(spark, (3, DAY1, "a")).coalesce(1).write.parquet(good)
    with open(bad, "wb") as file, open(glob.glob(f"{good}/part-*")[0], "rb") as whole:
        file.write(whole.read())
    drop_checksums(arrivals.source)
    assert sync_arrivals(arrivals, table, ["at"], "1").row_count == 3
    assert fetch(table.read().select("k")) == [(1,), (2,), (3,)]


def drop_checksums(path):
    for name in glob.glob(f"{path}/.z-broken*"):
        open(name, "w").close()


@pytest.mark.parametrize("step", ["upsert_latest", "done"])
def test_a_run_that_dies_after_landing(spark, arrivals, tmp_path, monkeypatch, step):
    table = new_table(spark, tmp_path)
    deliver(spark, arrivals, (1, DAY1, "a"))
    with monkeypatch.context() as broken:
        broken.setattr(arrival if step == "upsert_latest" else Arrivals, step, crash)
        with pytest.raises(Crash):
            sync_arrivals(arrivals, table, ["at"], "1")
    deliver(spark, arrivals, (2, DAY1, "b"))
    sync_arrivals(arrivals, table, ["at"], "1")
    sync_arrivals(arrivals, table, ["at"], "2")
    assert fetch(table.read().select("k")) == [(1,), (2,)]


def test_repeated_rows_land_once(spark, tmp_path):
    arrivals = Arrivals(new_path(tmp_path, "source"), rows(spark, schema=ROW).schema, new_path(tmp_path, "home"),
                        unique=["k"], at="at", within="10 days")
    deliver(spark, arrivals, (1, DAY1, "a"), (1, DAY1, "a"), (2, DAY2, "b"))
    assert sorted(r["k"] for r in arrivals.land(spark, "1").collect()) == [1, 2]
    arrivals.done(spark, "1")
    deliver(spark, arrivals, (2, DAY2, "again"), (3, DAY1, "late"))
    assert [r["k"] for r in arrivals.land(spark, "2").collect()] == [3]
    with pytest.raises(ValueError, match="within"):
        Arrivals("s", arrivals.schema, "h", unique=["k"])


# tables of the catalogue


@pytest.fixture
def name(spark, tmp_path):
    yield "spark_catalog.default.tablesync_test"
    spark.sql("DROP TABLE IF EXISTS spark_catalog.default.tablesync_test")


def test_columns_meet_by_name_and_are_checked(spark, tmp_path, name):
    df = rows(spark, (1, DAY1, "a"))
    catalogue.create_table(df, name, new_path(tmp_path))
    catalogue.append_table(df.select("v", "k", "at"), name)
    assert fetch(spark.table(name)) == [(1, DAY1, "a")]
    for wrong in (df.withColumn("x", F.lit(1)), df.drop("v"), df.withColumn("k", F.lit("text"))):
        with pytest.raises(Exception, match="INCOMPATIBLE_DATA_FOR_TABLE|INSERT_COLUMN_ARITY_MISMATCH|have no"):
            catalogue.append_table(wrong, name)
    assert spark.table(name).count() == 1


def test_partitions_and_loads_are_replaced(spark, tmp_path, name):
    df = rows(spark, (1, DAY1, "a"), (2, DAY1, "b"))
    catalogue.create_table(df, name, new_path(tmp_path), ["v"])
    catalogue.append_table(df, name)
    catalogue.replace_table_partitions(rows(spark, (3, DAY2, "b")), name, "v")
    assert fetch(spark.table(name).select("k", "v")) == [(1, "a"), (3, "b")]
    assert spark.conf.get(catalogue.OVERWRITE).lower() == "static"


def test_a_load_is_a_partition(spark, tmp_path, name):
    df = rows(spark, (1, DAY1, "a"))
    catalogue.create_table(df.withColumn("load_id", F.lit("x")), name, new_path(tmp_path), ["load_id"])
    catalogue.publish_load(df, name, "one")
    catalogue.publish_load(rows(spark, (2, DAY1, "b")), name, "two")
    catalogue.publish_load(rows(spark, (2, DAY1, "c")), name, "two")
    assert fetch(spark.table(name).select("k", "v", "load_id")) == [(1, "a", "one"), (2, "c", "two")]
    catalogue.publish_load(df.where("false"), name, "two")
    assert fetch(spark.table(name).select("load_id")) == [("one",)]
    with pytest.raises(ValueError, match="names the load"):
        catalogue.publish_load(df.withColumn("load_id", F.lit("y")), name, "one")
