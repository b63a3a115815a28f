from datetime import date

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions import columns as c


def value(spark, expression):
    return spark.range(1).select(expression.alias("x")).first()[0]


@pytest.mark.parametrize(
    ("column", "want"),
    [
        ("unhex('0AFF')", "0x0AFF"),
        ("'ab'", "0x6162"),
        ("bigint(255)", "0xFF"),
        ("cast(null as string)", None),
    ],
)
def test_prefixed_hex(spark, column, want):
    assert value(spark, c.prefixed_hex(F.expr(column))) == want


@pytest.mark.parametrize(
    "column", ["date'2024-01-02'", "timestamp'2024-01-02 23:59:59'", "timestamp_ntz'2024-01-02 00:00:00'"]
)
def test_date_key(spark, column):
    assert value(spark, c.date_key(F.expr(column))) == 20240102


def test_date_key_equals_the_iso_digits(spark):
    first = F.lit("1900-01-01").cast("date")
    days = spark.range(0, 60000, 37).select(F.date_add(first, F.col("id").cast("int")).alias("d"))
    digits = F.replace(F.col("d").cast("string"), F.lit("-"), F.lit("")).cast("bigint")
    assert days.where(c.date_key(F.col("d")) != digits).count() == 0


def test_day_diff_is_negative_for_a_later_right_side(spark):
    assert value(spark, c.day_diff(F.lit("2024-01-02"), F.lit("2024-01-05"))) == -3


@pytest.mark.parametrize(("number", "want"), [(1.5, 2), (2.5, 3), (-1.5, -2), (0.4, 0)])
def test_fractions_round_away_from_zero(spark, number, want):
    assert value(spark, c.to_int64(F.lit(number), T.DoubleType())) == want
    exact = T.DecimalType(10, 2)
    assert value(spark, c.to_int64(F.lit(number).cast(exact), exact)) == want


@pytest.mark.parametrize(("text", "to_type"), [("x", "boolean"), ("bad", "date"), ("1.5x", "bigint")])
def test_bad_casts(spark, text, to_type):
    assert value(spark, c.convert(F.lit(text), to_type, lenient=True)) is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        value(spark, c.convert(F.lit(text), to_type, lenient=False))


def test_parse_timestamp(spark):
    pattern = "yyyy-MM-dd'T'HH:mm:ss"
    text = c.parse_timestamp(F.lit("2024-01-02T03:04:05"), T.StringType(), pattern)
    assert value(spark, text.cast("string")) == "2024-01-02 03:04:05"
    assert value(spark, c.parse_timestamp(F.lit("2024-01-02"), T.StringType(), pattern)) is None
    day = c.parse_timestamp(F.lit("2024-01-02").cast("date"), T.DateType(), pattern)
    assert value(spark, day.cast("string")) == "2024-01-02 00:00:00"


def test_literal_text():
    assert c.literal_text("2000-01-01T00:00:00Z") == "2000-01-01 00:00:00"
    assert c.literal_text("2000-01-01T02:00:00+02:00") == "2000-01-01 00:00:00"
    assert c.literal_text("2024-01-02") == "2024-01-02 00:00:00"
    assert c.literal_text("2024-01-02 03:04:05.5") == "2024-01-02 03:04:05.500000"
    assert c.literal_text(date(2024, 1, 2)) == "2024-01-02"
    with pytest.raises(ValueError):
        c.literal_text("None")
