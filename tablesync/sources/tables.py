"""Scans and sinks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.sources.files import exists


def scan_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet directory. With a schema, an absent directory is an empty table."""
    if schema is None:
        return spark.read.parquet(path)
    if not exists(spark, path):
        return empty(spark, schema)
    return spark.read.schema(schema).parquet(path)


def scan_source(
    spark: SparkSession,
    source_format: str,
    path: str | None = None,
    options: Mapping[str, str] | None = None,
    predicate: Column | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Any Spark data source. The predicate is a column, so Catalyst hands it to the source.

    A source of text, which has no types of its own, should be given its schema.
    """
    reader = spark.read.format(source_format).options(**(options or {}))
    df = (reader if schema is None else reader.schema(schema)).load(path)
    return df if predicate is None else df.where(predicate)


def one_row(spark: SparkSession, schema: T.StructType, values: Mapping[str, object]) -> DataFrame:
    """A row of constants, which Spark plans without shipping anything from Python."""
    return spark.range(0, 1, 1, 1).select(*[
        (v if isinstance(v := values.get(f.name), Column) else F.lit(v)).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ])


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return one_row(spark, schema, {}).where(F.lit(False))


def append(
    df: DataFrame, path: str | None, source_format: str = "parquet", options: Mapping[str, str] | None = None
) -> None:
    """Append to a directory, or to whatever table the format and its options name."""
    df.write.format(source_format).options(**(options or {})).mode("append").save(path)


def overwrite(
    df: DataFrame,
    path: str | None,
    source_format: str = "parquet",
    options: Mapping[str, str] | None = None,
    directories: str | None = None,
) -> None:
    """The same, replacing what is there; ``directories`` is a column that has one per value."""
    writer = df.write.format(source_format).options(**(options or {})).mode("overwrite")
    (writer.partitionBy(directories) if directories else writer).save(path)


def append_partitions(df: DataFrame, path: str, column: str) -> None:
    """Append to a directory per value of ``column``."""
    gathered(df, column).write.mode("append").partitionBy(column).parquet(path)


def replace_partitions(df: DataFrame, path: str, column: str) -> None:
    """Write whole directories and leave all others alone, so that a repeat adds nothing."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(path)
    )


def gathered(df: DataFrame, column: str) -> DataFrame:
    """Bring the rows of a partition value together before a partitioned write.

    Otherwise every task adds a small file to every directory. Rebalancing, unlike
    ``repartition``, lets a hot value be split over several tasks by size, even when its
    rows are all alike, and packs small values together.
    """
    return df.hint("rebalance", column)
