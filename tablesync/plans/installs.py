"""Installs: a backup of the event table, a directory per install day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tablesync.operators.increment import Point
from tablesync.plans.backup import BackupResult, backup_window
from tablesync.plans.registry import Registry

NAME = "installs"
DAY = "install_date"


def backup_installs(
    source: DataFrame,
    sink: str,
    as_of: Point,
    registry: Registry,
    load_id: str,
    low: Point | None = None,
    first_load: bool = False,
    closed: str = "neither",
) -> BackupResult:
    return backup_window(source, sink, DAY, as_of, registry, NAME, load_id, low, first_load, closed)
