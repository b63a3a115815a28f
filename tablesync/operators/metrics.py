"""Counts and bounds of a table, as one-row aggregates or observed during a write.

An observation is taken by the tasks that write, above the last shuffle. There each
partition counts once even when a lost executor makes tasks run again, which counts
taken below a shuffle do not promise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablesync.functions.columns import parse_timestamp
from tablesync.operators.mapping import quoted

ISO_SECONDS = "yyyy-MM-dd'T'HH:mm:ss"


def max_value(df: DataFrame, column: str, alias: str = "max_value") -> DataFrame:
    """One row with the greatest value, NULL for an empty table."""
    return df.agg(F.max(quoted(column)).alias(alias))


def max_parsed(df: DataFrame, column: str, pattern: str = ISO_SECONDS, alias: str = "max_value") -> DataFrame:
    """One row with the latest timestamp of a text, date or timestamp column."""
    return df.agg(latest_timestamp(df, column, pattern).alias(alias))


def latest_timestamp(df: DataFrame, column: str, pattern: str = ISO_SECONDS) -> Column:
    """The aggregate behind ``max_parsed``; text that does not parse is passed over."""
    return F.max(parse_timestamp(quoted(column), df.schema[column].dataType, pattern))


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def reconcile(df: DataFrame, column: str) -> DataFrame:
    """One row: all rows, rows with a value, greatest and least value."""
    return df.agg(*reconcile_aggregates(column))


def reconcile_aggregates(column: str, as_text: bool = False) -> list[Column]:
    highest, lowest = F.max(quoted(column)), F.min(quoted(column))
    if as_text:
        highest, lowest = highest.cast("string"), lowest.cast("string")
    return [
        F.count(F.lit(1)).alias("row_count"),
        F.count(quoted(column)).alias("value_count"),
        highest.alias("max_value"),
        lowest.alias("min_value"),
    ]


def missing_values(df: DataFrame, column: str, alias: str = "row_count") -> DataFrame:
    """How many rows a watermark on this column can never load."""
    return row_count(df.where(quoted(column).isNull()), alias)


def scalar_text(one_row: DataFrame) -> str | None:
    """The single value of a one-row aggregate, as text that a cast reads back."""
    return one_row.select(quoted(one_row.columns[0]).cast("string")).first()[0]
