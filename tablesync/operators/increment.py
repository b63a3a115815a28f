"""Which rows are new: watermark filters and bounded windows.

Each filter compares the bare column with a literal of the column's own type, so that it
reaches the Parquet reader as a pushed filter, or prunes directories when the column is a
partition column.
"""

from __future__ import annotations

from datetime import date, datetime, time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import literal_text, utc_clock, utc_instant
from tablesync.operators.mapping import quoted

Point = str | date | datetime

#: Text that names a zone after a time of day: Z, an offset or a zone's name.
ZONE = r"\d{1,2}:\d{2}.*(?:[A-Za-z]|[+-]\d{1,2}(?::?\d{2}){0,2})\s*$"

def newer_than(df: DataFrame, column: str, watermark: Point, overlap: str | None = None) -> DataFrame:
    """Rows strictly after the watermark; rows without a value never qualify.

    ``overlap`` (an interval such as ``"2 hours"``) moves the bound back to read late
    rows again. Use it only where repeated rows are harmless, as in an upsert.
    """
    value, bound = _sides(df, column, watermark)
    if overlap is not None:
        bound = bound - F.expr(f"INTERVAL {overlap}")
    return df.where(value > bound)


def between(df: DataFrame, column: str, low: Point | None, high: Point | Column, closed: str = "neither") -> DataFrame:
    """Rows with ``low < column < high``; ``closed`` is neither, low, high or both.

    ``low=None`` leaves the lower end open to everything. ``high`` may be an expression.
    A date lies before a bound with a time of day on the same date, and not at or after it.
    """
    if closed not in ("neither", "low", "high", "both"):
        raise ValueError(f"closed={closed!r}")
    value, upper = _sides(df, column, high)
    cut_high, cut_low = _loses_time(df, column, high), _loses_time(df, column, low)
    test = value <= upper if closed in ("high", "both") or cut_high else value < upper
    if low is not None:
        _, lower = _sides(df, column, low)
        test &= value >= lower if closed in ("low", "both") and not cut_low else value > lower
    return df.where(test)


def extract_increment(
    df: DataFrame,
    column: str,
    watermark: Point | None,
    full_load: bool = False,
    overlap: str | None = None,
) -> DataFrame:
    """The part of ``df`` that is newer than the stored watermark.

    Without a watermark there is no increment: the first load must be asked for with
    ``full_load``. It takes every row that has a value, since rows without one could
    never be told apart from loaded ones later.
    """
    if watermark is not None:
        return newer_than(df, column, watermark, overlap)
    if not full_load:
        raise ValueError(f"no watermark for {column}; ask for a full load to start one")
    return df.where(_comparable(df, column)[0].isNotNull())


def newest(df: DataFrame, column: str) -> Column:
    """Aggregate: the watermark that these rows leave behind, as ISO text, in UTC for instants.

    It is the greatest of the very values that the filters compare, so a row that was
    loaded can never be newer than the watermark.
    """
    value, dtype = _comparable(df, column)
    if not isinstance(dtype, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{column} is {dtype.simpleString()}, no point in time")
    last = F.max(value)
    return (utc_clock(last) if isinstance(dtype, T.TimestampType) else last).cast("string")


def yesterday(as_of: Point) -> Column:
    """The day before the job's own date, which the caller states."""
    return F.date_sub(F.lit(literal_text(as_of)).cast("date"), 1)


def without_point(df: DataFrame, column: str) -> Column:
    """Rows that no watermark can ever load: no value, or text that is no point in time."""
    return _comparable(df, column)[0].isNull()


def _comparable(df: DataFrame, column: str) -> tuple[Column, T.DataType]:
    """The column as it is compared, and its type.

    Text counts as timestamps: a zone in it is turned into UTC, as in the bounds, and text
    without a zone is UTC.
    """
    dtype = df.schema[column].dataType
    if isinstance(dtype, T.StringType):
        dtype = T.TimestampNTZType()
        text = quoted(column)
        moment = utc_clock(text.try_cast("timestamp"))
        return F.when(text.rlike(ZONE), moment).otherwise(text.try_cast(dtype)), dtype
    return quoted(column), dtype


def _loses_time(df: DataFrame, column: str, bound: Point | Column | None) -> bool:
    """Whether a bound has a time of day and the column, a date, has none."""
    if bound is None or isinstance(bound, Column) or not isinstance(df.schema[column].dataType, T.DateType):
        return False
    return datetime.fromisoformat(literal_text(bound)).time() != time()


def _sides(df: DataFrame, column: str, bound: Point | Column) -> tuple[Column, Column]:
    """The column and the bound as values of one type. A bound without a zone is UTC in every session."""
    value, dtype = _comparable(df, column)
    limit = bound if isinstance(bound, Column) else F.lit(literal_text(bound))
    if isinstance(dtype, T.TimestampType) and not isinstance(df.select(limit).schema[0].dataType, T.TimestampType):
        limit = utc_instant(limit)
    return value, limit.cast(dtype)
