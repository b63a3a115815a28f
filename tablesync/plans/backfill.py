"""Days that a backup lacks: found as gaps between its directories, and copied again."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from tablesync.functions.columns import literal_text
from tablesync.operators.increment import Point, between
from tablesync.operators.mapping import quoted
from tablesync.plans.registry import Registry
from tablesync.session import scratch_dir
from tablesync.sources.tables import gathered, overwrite, replace_partitions, scan_parquet

#: Days that are sent to every task of the source's scan; there are as many as the backup has gaps for.
MOST_DAYS = 100_000


@dataclass(frozen=True)
class BackfillResult:
    """The days that were written, and those between the bounds that the source has not got either."""

    row_count: int
    days: int
    first_day: str | None
    last_day: str | None
    absent: int


def stored_ranges(stored: DataFrame, column: str) -> DataFrame:
    """Unbroken runs of days: first_day, last_day, n_days and, but for the last, gap_days to the next.

    Days that follow each other keep their distance to their number in the order, which names the
    run. If the column is a directory, no file is opened. The window runs over one row per day.
    """
    days = stored.select(quoted(column).cast("date").alias("day")).where("day IS NOT NULL").distinct()
    run = F.date_sub("day", F.row_number().over(Window.orderBy("day")))
    ranges = days.withColumn("run", run).groupBy("run").agg(
        F.min("day").alias("first_day"), F.max("day").alias("last_day"), F.count(F.lit(1)).alias("n_days"))
    following = F.lead("first_day").over(Window.orderBy("first_day"))
    return ranges.select("first_day", "last_day", "n_days",
                         (F.datediff(following, "last_day") - 1).cast("bigint").alias("gap_days"))


def gap_days(stored: DataFrame, column: str, low: Point | None = None, high: Point | None = None) -> DataFrame:
    """The days, as ``column``, that are missing between the first and the last stored one.

    ``low`` and ``high`` widen the range to days before and after it; both count as within it.
    """
    ends = stored.select(quoted(column).cast("date").alias("day"))
    for bound in (low, high):
        if bound is not None:
            ends = ends.union(stored.sparkSession.range(1).select(F.lit(literal_text(bound)).cast("date")))
    span = ends.agg(F.min("day").alias("low"), F.max("day").alias("high")).where("low IS NOT NULL")
    every = span.select(F.explode(F.sequence("low", "high")).alias("day"))
    held = stored.select(quoted(column).cast("date").alias("day"))
    return every.join(held.distinct(), "day", "left_anti").select(F.col("day").alias(column))


def short_days(source: DataFrame, stored: DataFrame, column: str) -> DataFrame:
    """The days on which the backup has fewer rows than the source, though it has some."""
    one, other = (df.groupBy(quoted(column).cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
                  for df in (source, stored))
    return one.alias("s").join(other.alias("t"), "day").where("s.n > t.n").select(F.col("day").alias(column))


def backfill(
    source: DataFrame,
    sink: str,
    column: str,
    registry: Registry,
    name: str,
    load_id: str,
    low: Point | None = None,
    recount: bool = False,
) -> BackfillResult:
    """Copy the days again that lie before the watermark and are not in the sink.

    Days are looked for from the first stored one, or from ``low``, up to the registry's watermark. With
    ``recount`` days with fewer rows than the source count as missing, too: rows are counted on both sides.
    The source is joined with the missing days, which prunes its directories if it is laid out by
    day. Days are written whole, so a run that died is repeated, and the watermark stays as it is.
    """
    spark = source.sparkSession
    mark = registry.watermark(name)
    if mark is None:
        raise ValueError(f"{name} has no watermark: run its backup first")
    if registry.committed(name, load_id):
        return BackfillResult(0, 0, None, None, 0)
    stored = scan_parquet(spark, sink, source.schema)
    missing = gap_days(stored, column, low, mark[:10])
    if recount:
        bounds = F.col(column) <= F.lit(mark[:10]).cast("date")
        if low is not None:
            bounds &= F.col(column) >= F.lit(literal_text(low)).cast("date")
        missing = missing.union(short_days(source, stored, column).where(bounds))
    path = scratch_dir(spark, "missing-days")  # kept, as the write changes what is missing
    overwrite(missing.select(F.col(column).cast(source.schema[column].dataType).alias(column)), path)
    days = spark.read.parquet(path)
    n_days, first, last = days.agg(F.count(F.lit(1)), F.min(column).cast("string"), F.max(column).cast("string")).first()
    # the bounds reach any reader; a filtered side of the join also lets Spark prune directories by it
    source, days = (between(df, column, first, last, "both") if n_days else df.where(F.lit(False)) for df in (source, days))
    rows = source.join(F.broadcast(days) if n_days <= MOST_DAYS else days, column, "left_semi")
    seen, day = Observation(), quoted(column)
    found = gathered(rows.select(*[quoted(c) for c in source.columns]), column).observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        F.min(day).cast("string").alias("first_day"),
        F.max(day).cast("string").alias("last_day"),
    )
    replace_partitions(found, sink, column)
    measured = seen.get
    absent = gap_days(scan_parquet(spark, sink, source.schema), column, low, mark[:10]).count()
    if measured["row_count"]:
        registry.record(name, load_id, mark, measured["row_count"])
    return BackfillResult(
        measured["row_count"], n_days - absent, measured["first_day"], measured["last_day"], absent)
