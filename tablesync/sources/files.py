"""Whole-directory operations on the file system that Spark itself uses."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import SparkSession

LOAD = "load_id="


def _open(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _open(spark, path)
    return fs.exists(target)


def drop_if_exists(spark: SparkSession, path: str) -> bool:
    """Drop a table directory; tells whether there was one. A failure raises."""
    fs, target = _open(spark, path)
    if not fs.exists(target):
        return False
    if not fs.delete(target, True):
        raise OSError(f"could not drop {path}")
    return True


def drop_on_exit(spark: SparkSession, path: str) -> None:
    """Make a directory that goes away with the session's JVM."""
    fs, target = _open(spark, path)
    fs.mkdirs(target)
    fs.deleteOnExit(target)


def size_bytes(spark: SparkSession, path: str) -> int:
    fs, target = _open(spark, path)
    return fs.getContentSummary(target).getLength() if fs.exists(target) else 0


def directories(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """What follows ``prefix`` in the names of the directories here."""
    fs, target = _open(spark, path)
    names = [entry.getPath().getName() for entry in fs.listStatus(target)] if fs.exists(target) else []
    return [name.removeprefix(prefix) for name in names if name.startswith(prefix)]


def loads_in(spark: SparkSession, path: str) -> list[str]:
    """The loads that have a ``load_id=...`` directory here."""
    return directories(spark, path, LOAD)


def drop_others(spark: SparkSession, path: str, prefix: str, keep: Collection[str]) -> int:
    """Drop the directories named ``prefix`` and something that is not among those to keep."""
    names = set(directories(spark, path, prefix))
    return sum(drop_if_exists(spark, f"{path}/{prefix}{name}") for name in names - set(keep))


def drop_other_loads(spark: SparkSession, path: str, keep: Collection[str]) -> int:
    """Drop the ``load_id=...`` directories whose load is not among those to keep."""
    return drop_others(spark, path, LOAD, keep)
