"""Column expressions. All of them stay in the JVM and inside whole-stage codegen."""

from __future__ import annotations

from datetime import date, datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

FRACTIONAL = (T.DoubleType, T.FloatType, T.DecimalType)


def prefixed_hex(column: Column) -> Column:
    """``0x`` and the upper-case hex digits of a binary, string or integer; NULL stays NULL."""
    return F.concat(F.lit("0x"), F.hex(column))


def date_key(column: Column) -> Column:
    """``yyyymmdd`` as a bigint, for a date or a timestamp.

    Arithmetic on the date parts gives the digits of the ISO text without building it.
    """
    day = column.cast("date")
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("bigint")


def day_diff(left: Column, right: Column) -> Column:
    """``left - right`` in days, negative when ``right`` is the later day."""
    return F.datediff(left.cast("date"), right.cast("date")).cast("bigint")


def to_int64(column: Column, dtype: T.DataType) -> Column:
    """Strict cast to bigint. Fractional input is rounded half away from zero first."""
    if isinstance(dtype, FRACTIONAL):
        column = F.round(column)
    return column.cast("bigint")


def convert(column: Column, to_type: str, lenient: bool, dtype: T.DataType | None = None) -> Column:
    """Cast that raises on bad input, or gives NULL when ``lenient``.

    Lenient casts of text to bigint, where ``dtype`` tells that it is text, cut the fraction
    off, as casts of numbers do; what does not fit is NULL.
    """
    if lenient and to_type == "bigint" and isinstance(dtype, T.StringType):
        return column.try_cast("decimal(38,10)").try_cast("bigint")
    return column.try_cast(to_type) if lenient else column.cast(to_type)


def parse_timestamp(column: Column, dtype: T.DataType, pattern: str) -> Column:
    """Timestamp of a text column; dates and timestamps ignore the pattern."""
    if isinstance(dtype, T.StringType):
        return F.try_to_timestamp(column, F.lit(pattern))
    if isinstance(dtype, T.DateType):
        return column.cast("timestamp_ntz")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return column
    raise TypeError(f"{dtype.simpleString()} is no point in time")


def utc_clock(instant: Column) -> Column:
    """A TIMESTAMP as the date and time it is in UTC, whatever zone the session is in.

    A cast would go through the session's clock, which shows one hour of autumn twice.
    """
    micros = F.unix_micros(instant)
    rest = F.pmod(micros, F.lit(60_000_000))
    minutes = ((micros - rest) / 60_000_000).cast("int")
    seconds = rest.cast("decimal(18,6)") / F.lit(1_000_000).cast("decimal(7,0)")
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(
        mins=minutes, secs=seconds.cast("decimal(18,6)"))


def utc_instant(clock: Column) -> Column:
    """The TIMESTAMP at which it is this date and time in UTC, whatever zone the session is in."""
    return F.concat(clock.cast("timestamp_ntz").cast("string"), F.lit("Z")).cast("timestamp")


def literal_text(value: str | date | datetime) -> str:
    """A point in time as ISO text, typed only by the column that it meets.

    A Python ``datetime`` literal would go through the zone of the driver process. Text
    is checked here, and a zone in it is turned into UTC.
    """
    if isinstance(value, date) and not isinstance(value, datetime):
        return value.isoformat()
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    return str(moment)
