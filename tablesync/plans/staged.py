"""Staged load: extract, stage, reconcile, typed insert, commit."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.increment import extract_increment, newest
from tablesync.operators.metrics import reconcile_aggregates
from tablesync.plans.registry import Registry
from tablesync.sources.files import drop_if_exists, drop_other_loads, loads_in
from tablesync.sources.tables import empty, gathered, overwrite
from tablesync.sources.versions import check_name

LOAD_ID = "load_id"


@dataclass(frozen=True)
class LoadResult:
    """``value_count`` counts rows with a watermark value; it gates the insert."""

    inserted: bool
    row_count: int
    value_count: int
    min_value: str | None
    max_value: str | None


@dataclass(frozen=True)
class StagedLoad:
    """A target table that grows by one directory per load.

    The registry row is written after the insert and under the target's name. Until then
    the load's directory is not part of the table, and a repeat starts over from the
    same watermark. Both hold files of ``file_format``, any that Spark writes to a path. With
    ``day``, a column of the target, a load has a directory per value of it, which prunes reads.
    """

    name: str
    target: str
    staging: str
    column: str
    insert: Callable[[DataFrame], DataFrame]
    target_schema: T.StructType
    file_format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)
    day: str | None = None

    def __post_init__(self) -> None:
        if LOAD_ID in self.target_schema.names:
            raise ValueError(f"{LOAD_ID} is a directory of the target and cannot be a column")

    def run(
        self,
        source: DataFrame,
        registry: Registry,
        load_id: str,
        full_load: bool = False,
    ) -> LoadResult:
        spark = source.sparkSession
        staging = f"{self.staging}/load_id={check_name(load_id)}"
        if registry.committed(self.name, load_id):
            drop_if_exists(spark, staging)
            return LoadResult(False, 0, 0, None, None)

        fresh = extract_increment(source, self.column, registry.watermark(self.name), full_load)
        seen = Observation()
        measured = fresh.observe(
            seen,
            *reconcile_aggregates(self.column, as_text=True),
            newest(fresh, self.column).alias("watermark"),
        )
        overwrite(measured, staging, self.file_format, self.options)
        found = seen.get
        if found["value_count"]:
            staged = self._scan(spark, fresh.schema, [staging])
            self._insert(staged, load_id, found["row_count"])
            registry.record(self.name, load_id, found["watermark"], found["row_count"])
        drop_if_exists(spark, staging)
        return LoadResult(
            bool(found["value_count"]),
            found["row_count"],
            found["value_count"],
            found["min_value"],
            found["max_value"],
        )

    def read(self, spark: SparkSession, registry: Registry) -> DataFrame:
        """The rows of the committed loads: one path, whose other directories are pruned.

        What is compared on the driver are names of directories, one per load.
        """
        committed = registry.progress(self.name).loads
        if not committed:
            return empty(spark, self.target_schema)
        others = sorted(set(loads_in(spark, self.target)) - set(committed))
        named = T.StructType([*self.target_schema.fields, T.StructField(LOAD_ID, T.StringType())])
        return self._scan(spark, named, [self.target]).where(~F.col(LOAD_ID).isin(others)).select(
            *self.target_schema.names)

    def sweep(self, spark: SparkSession, registry: Registry) -> int:
        """Between loads, drop what loads that died have left behind."""
        drop_if_exists(spark, self.staging)
        return drop_other_loads(spark, self.target, registry.progress(self.name).loads)

    def _scan(self, spark: SparkSession, schema: T.StructType, paths: list[str]) -> DataFrame:
        return spark.read.format(self.file_format).options(**self.options).schema(schema).load(paths)

    def _insert(self, staged: DataFrame, load_id: str, expected: int) -> None:
        seen = Observation()
        rows = self.insert(staged)
        if self.day is not None:
            rows = gathered(rows, self.day)
        rows = rows.observe(seen, F.count(F.lit(1)).alias("row_count"))
        overwrite(rows, f"{self.target}/{LOAD_ID}={load_id}", self.file_format, self.options, self.day)
        if seen.get["row_count"] != expected:
            raise RuntimeError(f"{self.name}: {expected} rows staged, {seen.get['row_count']} inserted")
