"""Writing into tables of the catalogue, whatever format they have.

Columns meet the table's by name, and Spark checks names and types before it writes: a column
too many, one missing or one that would lose something in a cast is an error, not a NULL.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from tablesync.sources.tables import gathered
from tablesync.sources.versions import check_name, ddl, literal, quote

OVERWRITE = "spark.sql.sources.partitionOverwriteMode"


def create_table(
    df: DataFrame, name: str, location: str | None = None, directories: Sequence[str] = (), table_format: str = "parquet"
) -> None:
    """An empty table with the columns of ``df``, unless there is one. With a location, files outlive it."""
    columns = ", ".join(f"{quote(f.name)} {ddl(f.dataType)}" for f in df.schema.fields)
    parts = f" PARTITIONED BY ({', '.join(quote(c) for c in directories)})" if directories else ""
    place = f" LOCATION {literal(location)}" if location else ""
    df.sparkSession.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING {table_format}{parts}{place}")


def append_table(df: DataFrame, name: str) -> None:
    """Add rows. A load that is tried again adds them again: see ``publish_load``."""
    _insert(df, name, f"INSERT INTO {name} BY NAME")


def replace_table_partitions(df: DataFrame, name: str, column: str) -> None:
    """Replace the partitions that occur in ``df`` and leave all others alone."""
    with _dynamic(df.sparkSession):
        _insert(gathered(df, column), name, f"INSERT OVERWRITE {name} BY NAME")


def publish_load(df: DataFrame, name: str, load_id: str, column: str = "load_id") -> None:
    """Make ``df`` the rows of a load, in a table whose only partition column is ``column``.

    A load that is tried again, or that has no rows any more, replaces what it had.
    """
    if column in df.columns:
        raise ValueError(f"{column} names the load and cannot be a column of its rows")
    part = f"{quote(column)} = {literal(check_name(load_id))}"
    _insert(df, name, f"INSERT OVERWRITE {name} PARTITION ({part}) BY NAME", [column])


def _insert(df: DataFrame, name: str, into: str, stated: Sequence[str] = ()) -> None:
    """Spark would fill columns that are missing with NULL, so these are looked for here."""
    given = {c.lower() for c in (*df.columns, *stated)}
    missing = [c for c in df.sparkSession.table(name).columns if c.lower() not in given]
    if missing:
        raise ValueError(f"{name}: the rows have no {missing}")
    df.sparkSession.sql(f"{into} SELECT * FROM {{rows}}", rows=df)


@contextmanager
def _dynamic(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(OVERWRITE)
    spark.conf.set(OVERWRITE, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(OVERWRITE, before)
