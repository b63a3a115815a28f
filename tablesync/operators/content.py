"""Which keys of two copies of a table differ.

Rows are reduced to checksums that do not depend on their order: the number of rows and the sum of
their hashes, counted positive in the source and negative in the sink, so equal contents add up to
nothing. Sums are taken per bucket of keys first; where they are not zero the buckets are split further,
and only the keys of the last buckets that differ are compared by themselves. Every step is an
aggregation, combined within each task: no row is shuffled, and a hot key is one number per task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.operators.mapping import quoted
from tablesync.session import scratch_dir

#: Buckets per level. Tasks send at most so many rows in the first step.
LEVELS = (4096, 4096)
#: Differing buckets that are sent to every task, as pairs of small numbers; beyond, a level is not split.
MOST_BUCKETS = 100_000

SIDE, HASH = "__side", "__hash"
RESULT = ("rows_in_source", "rows_in_sink", "difference")


def differing_keys(
    source: DataFrame,
    sink: DataFrame,
    key: Sequence[str],
    columns: Sequence[str] | None = None,
    levels: Sequence[int] = LEVELS,
) -> DataFrame:
    """The keys whose rows differ, with how many rows each side has and what differs.

    ``difference`` is ``missing`` (the sink has no row of the key), ``extra`` (the source has
    none) or ``changed``. ``columns`` limits what is compared, by default every column of both.
    Rows are compared as a bag per key: order does not matter, repeated rows do. NULL is a value
    like any other, in keys too.
    """
    columns = _compared(source, sink, key, columns)
    both = _signed(source, 1, key, columns, levels).unionByName(_signed(sink, -1, key, columns, levels))
    at: list[str] = []
    for level, _ in enumerate(levels):
        at.append(_at(level))
        path = scratch_dir(source.sparkSession, "differing")
        both.groupBy(*at).agg(*_sums()).where(_unequal()).select(*at).write.parquet(path)
        found = source.sparkSession.read.schema(both.select(*at).schema).parquet(path)
        n = found.count()
        if n <= MOST_BUCKETS:
            both = both.join(F.broadcast(found), at, "left_semi")
        if n == 0 or n > MOST_BUCKETS:
            break
    side = F.col(SIDE)
    names = [quoted(k) for k in key]
    per_key = both.groupBy(*names).agg(
        *_sums(), F.count_if(side > 0).alias(RESULT[0]), F.count_if(side < 0).alias(RESULT[1]))
    what = F.when(F.col(RESULT[1]) == 0, "missing").when(F.col(RESULT[0]) == 0, "extra").otherwise("changed")
    return per_key.where(_unequal()).select(*names, RESULT[0], RESULT[1], what.alias(RESULT[2]))


def row_hash(df: DataFrame, columns: Sequence[str], seed: int = 0) -> Column:
    """A hash of some columns in which NULLs count by their place."""
    values = [_hashable(quoted(c), df.schema[c].dataType) for c in columns]
    return F.xxhash64(F.lit(seed), *values, *[quoted(c).isNull() for c in columns])


def _hashable(value: Column, dtype: T.DataType) -> Column:
    return F.array_sort(F.map_entries(value)) if isinstance(dtype, T.MapType) else value


def _compared(source: DataFrame, sink: DataFrame, key: Sequence[str], columns: Sequence[str] | None) -> list[str]:
    clashes = sorted({*RESULT, SIDE, HASH} & set(key))
    if clashes:
        raise ValueError(f"{clashes} are columns of the result and cannot be keys")
    if columns is None:
        if set(source.columns) != set(sink.columns):
            raise ValueError(f"columns of one side only: {sorted(set(source.columns) ^ set(sink.columns))}")
        columns = [c for c in source.columns if c not in key]
    for name in (*key, *columns):
        one, other = source.schema[name].dataType, sink.schema[name].dataType
        if one.simpleString() != other.simpleString():
            raise TypeError(f"{name}: {one.simpleString()} is not {other.simpleString()}")
    return list(columns)


def _at(level: int) -> str:
    return f"__at_{level}"


def _signed(df: DataFrame, side: int, key: Sequence[str], columns: Sequence[str], levels: Sequence[int]) -> DataFrame:
    places = [F.pmod(row_hash(df, key, 1 + n), F.lit(size)).cast("int").alias(_at(n)) for n, size in enumerate(levels)]
    return df.select(
        *[quoted(k) for k in key], F.lit(side).cast("long").alias(SIDE),
        row_hash(df, [*key, *columns]).alias(HASH), *places)


def _sums() -> list[Column]:
    """Both halves of the hashes apart, so that no sum overflows."""
    side, value = F.col(SIDE), F.col(HASH)
    return [
        F.sum(side).alias("__rows"),
        F.sum(side * F.shiftright(value, 32)).alias("__high"),
        F.sum(side * value.bitwiseAND(0xFFFFFFFF)).alias("__low"),
    ]


def _unequal() -> Column:
    return (F.col("__rows") != 0) | (F.col("__high") != 0) | (F.col("__low") != 0)
