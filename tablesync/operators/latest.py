"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.mapping import quoted

RANK = "__latest_rank"


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str], ties: Sequence[str] | None = None) -> DataFrame:
    """The row of each key that comes last by ``order``, NULL keys left out.

    ``ties`` settles equal rows; by default every remaining column that can be ordered
    takes part, so the choice does not depend on the layout of the input. The rank never
    reaches the output. Catalyst cuts each key to one row per map task before the
    shuffle, so a hot key costs no more than any other.
    """
    return last_of_each(with_key(df, key), key, order, ties)


def last_of_each(
    df: DataFrame, key: Sequence[str], order: Sequence[str], ties: Sequence[str] | None = None
) -> DataFrame:
    """``latest`` for rows that are known to have a key."""
    if ties is None:
        used = {*key, *order}
        ties = [f.name for f in df.schema.fields if f.name not in used and orderable(f.dataType)]
    by_recency = [quoted(c).desc() for c in (*order, *ties)]
    window = Window.partitionBy(*[quoted(k) for k in key]).orderBy(*by_recency)
    ranked = df.withColumn(RANK, F.row_number().over(window))
    return ranked.where(F.col(RANK) == 1).drop(RANK)


def has_key(key: Sequence[str]) -> Column:
    test = F.lit(True)
    for name in key:
        test &= quoted(name).isNotNull()
    return test


def with_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.where(has_key(key))


def without_key(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.where(~has_key(key))


def orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return orderable(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return all(orderable(f.dataType) for f in dtype.fields)
    return not isinstance(dtype, (T.MapType, T.VariantType, T.CalendarIntervalType))
