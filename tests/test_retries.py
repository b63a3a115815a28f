"""Tasks that fail part-way and run again neither lose nor repeat rows or counts."""

import pytest
from pyspark import TaskContext
from pyspark.sql import functions as F

from tablesync.plans.backup import backup_window
from tablesync.plans.registry import Registry
from tablesync.plans.staged import StagedLoad
from tablesync.plans.upsert import upsert_latest
from tests.helpers import new_path, new_table


def fail_once(batches):
    context = TaskContext.get()
    for batch in batches:
        yield batch.head(len(batch) // 2)
        if context.attemptNumber() == 0 and context.partitionId() % 2 == 1:
            raise RuntimeError("lost")
        yield batch.tail(len(batch) - len(batch) // 2)


@pytest.fixture
def flaky(spark):
    """8,000 rows of 1,000 keys and 20 days, half of whose tasks fail the first time."""
    source = spark.range(0, 8000, 1, 8).select(
        (F.col("id") % 1000).alias("k"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 20).cast("int")).alias("day"),
        F.col("id").alias("v"),
    )
    return source.mapInPandas(fail_once, source.schema)


def test_upsert(spark, tmp_path, flaky):
    table = new_table(spark, tmp_path)
    result = upsert_latest(table, flaky, ["day"], "a", watermark="day", ties=["v"])
    assert (result.row_count, table.current().row_count) == (8000, 8000)
    assert table.read().agg(F.count("*"), F.sum("k"), F.min("v")).first()[:2] == (1000, 499500)


def test_backup(spark, tmp_path, flaky):
    sink, registry = new_path(tmp_path), Registry(spark, new_path(tmp_path))
    run = backup_window(flaky, sink, "day", "2024-03-01", registry, "t", "a", first_load=True)
    assert run.row_count == 8000
    assert spark.read.parquet(sink).agg(F.count("*"), F.sum("v")).first()[:] == (8000, 31996000)


def test_staged_load(spark, tmp_path, flaky):
    root, registry = new_path(tmp_path), Registry(spark, new_path(tmp_path))
    job = StagedLoad("t", f"{root}/target", f"{root}/staging", "day", lambda df: df, flaky.schema)
    run = job.run(flaky, registry, "a", full_load=True)
    assert (run.row_count, run.value_count) == (8000, 8000)
    assert job.read(spark, registry).agg(F.count("*"), F.sum("v")).first()[:] == (8000, 31996000)
