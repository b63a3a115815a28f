"""Bounded incremental backup into a directory per day."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablesync.functions.columns import literal_text
from tablesync.operators.increment import Point, between, newest, yesterday
from tablesync.operators.mapping import quoted
from tablesync.operators.metrics import max_value, scalar_text
from tablesync.plans.registry import Registry
from tablesync.sources.files import drop_if_exists, exists
from tablesync.sources.tables import gathered, overwrite, replace_partitions, scan_parquet
from tablesync.sources.versions import check_name


@dataclass(frozen=True)
class BackupResult:
    row_count: int
    low: str | None
    first_day: str | None
    last_day: str | None


def backup_window(
    source: DataFrame,
    sink: str,
    column: str,
    as_of: Point,
    registry: Registry,
    name: str,
    load_id: str,
    low: Point | None = None,
    first_load: bool = False,
    closed: str = "neither",
) -> BackupResult:
    """Copy the days after the last stored one and before the day before ``as_of``.

    The lower bound is the registry's. Until it has one, state it: as ``low``, which for
    a sink filled by other means is its ``last_stored`` day, or as ``first_load`` for
    every day there is. Once the registry has a bound, a stated one is an error.
    ``closed="low"`` reads the last stored day again, for rows that came late: stored rows
    that the source no longer shows are kept, so the day never loses any.

    The days of the window are written as whole directories. A run that died half-way
    is made good by the next one, whose window starts at the same bound. With
    ``closed="low"`` the last stored day is replaced as a directory, too: a reader at that
    moment may miss it, and what only the sink had is kept aside until the load is recorded.
    """
    stored = registry.watermark(name)
    if registry.committed(name, load_id):
        return BackupResult(0, stored, None, None)
    if low is not None and stored is not None:
        raise ValueError(f"{name}: the registry's bound is {stored}; leave low out")
    low = stored or (literal_text(low) if low is not None else None)
    if low is None and not first_load:
        raise ValueError(f"no watermark for {name}; state a lower bound or ask for a first load")

    window = between(source, column, low, yesterday(as_of), closed)
    aside = f"{sink}/_kept/load_id={check_name(load_id)}"
    if closed in ("low", "both") and low is not None and exists(source.sparkSession, sink):
        window = window.unionByName(_only_stored(window, source, sink, column, low, aside))
    seen = Observation()
    day = quoted(column)
    rows = gathered(window, column).observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        F.min(day).cast("string").alias("first_day"),
        F.max(day).cast("string").alias("last_day"),
        newest(window, column).alias("watermark"),
    )
    replace_partitions(rows, sink, column)
    found = dict(seen.get)
    watermark = found.pop("watermark")
    result = BackupResult(low=low, **found)
    if result.row_count:
        registry.record(name, load_id, watermark, result.row_count)
    drop_if_exists(source.sparkSession, aside)
    return result


def _only_stored(window: DataFrame, source: DataFrame, sink: str, column: str, low: str, aside: str) -> DataFrame:
    """Rows of the last stored day that the window does not bring again.

    They are set aside before the day is replaced; a run that died in between is repeated
    with what its first try has set aside. What a run left that died while setting aside has
    no mark of success and is written again: the day was not replaced by then.
    """
    spark = source.sparkSession
    stored = between(scan_parquet(spark, sink, source.schema), column, low, low, "both").select(*source.columns)
    if exists(spark, f"{aside}/_SUCCESS"):
        return scan_parquet(spark, aside, source.schema)
    overwrite(stored.exceptAll(between(window, column, low, low, "both")), aside,
              options={"mapreduce.fileoutputcommitter.marksuccessfuljobs": "true"})
    return scan_parquet(spark, aside, source.schema)


def last_stored(stored: DataFrame, column: str) -> str | None:
    """Greatest value of the partition column. No data column is read."""
    return scalar_text(max_value(stored, column))
