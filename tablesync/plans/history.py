"""History of a dimension: when each version of a key held.

The table keeps every version it was given, under its key and ``valid_from``. ``changed`` marks
those that differ from the version before; ``valid_to`` is where the next of these begins, NULL for the
one that still holds. Versions may arrive in any order and any number of times: a late one falls
between those already there, and the intervals around it are closed anew.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import ExitStack
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablesync.functions.columns import literal_text
from tablesync.operators.increment import Point
from tablesync.operators.latest import last_of_each, with_key, without_key
from tablesync.operators.mapping import quoted, union_rows
from tablesync.plans.upsert import NOTHING, UpsertResult, later, stage
from tablesync.sources.files import drop_if_exists
from tablesync.sources.tables import overwrite, scan_parquet
from tablesync.sources.versions import BUCKET, Commit, VersionedTable

VALID_FROM, VALID_TO, CHANGED = "valid_from", "valid_to", "changed"
#: Which of two versions with one key and one point came later.
ARRIVED = "__arrived"
#: A bucket of more rows than ``WIDE_ROWS`` is put in order by several tasks, of about ``SLICE_ROWS`` each.
SLICE_ROWS, WIDE_ROWS = 500_000, 1_500_000
SLICE = "__slice"


def extend_history(
    table: VersionedTable,
    versions: DataFrame,
    at: str,
    tracked: Sequence[str],
    load_id: str,
    ties: Sequence[str] = (),
) -> UpsertResult:
    """Add versions (the table's key, ``at`` and ``tracked``) to a history.

    Of several versions with one key and one point, the one that a later load brought counts, and
    within a load the last by ``ties`` and the tracked columns. Only the increment is shuffled, into
    the table's buckets; the union with the buckets it touches is ordered there, a bucket by a task.
    Wide buckets, as a key with very many versions makes them, are shuffled and cut into slices by key
    and time, so several tasks share a key.

    Versions without a key are set aside as rejects, those without a point are left out. A load that
    was committed before changes nothing, and versions that are known already change no row.
    """
    staging = f"{table.path}/staging/load_id={load_id}"
    if table.find(load_id) is not None:
        drop_if_exists(table.spark, staging)
        drop_if_exists(table.spark, f"{table.path}/slices/load_id={load_id}")
        return NOTHING
    clashes = sorted({VALID_FROM, VALID_TO, CHANGED} & {*table.key, *tracked})
    if clashes:
        raise ValueError(f"{clashes} are columns of the history")
    wanted = [*table.key, at, *tracked, *[t for t in ties if t not in (at, *tracked, *table.key)]]
    pointed = versions.select(*[quoted(c) for c in wanted]).where(quoted(at).isNotNull())
    staged, size = stage(table, pointed, staging, at)
    if size["rejected"]:
        overwrite(without_key(staged, table.key), f"{table.path}/rejects/load_id={load_id}")
    if not size["row_count"]:
        drop_if_exists(table.spark, staging)
        return NOTHING

    before, session = table.current(), table.bucket_session()
    fresh = with_key(scan_parquet(session, staging, staged.schema), table.key)
    fields = _fields(staged.schema, table.key, at, tracked)
    mark = T.StructField(ARRIVED, T.IntegerType())

    def arrived(rows: DataFrame) -> DataFrame:
        last = last_of_each(rows, [*table.key, at], [*ties, *[c for c in tracked if c not in ties]], [])
        return table.placed(last.select(
            *[quoted(f.name if f.name != VALID_FROM else at).alias(f.name) for f in fields[:-2]],
            *[F.lit(None).cast(f.dataType).alias(f.name) for f in fields[-2:]])).withColumn(ARRIVED, F.lit(1))

    def held(base: DataFrame, rows: DataFrame) -> DataFrame:
        return last_of_each(union_rows(base, rows), [*table.key, VALID_FROM], [ARRIVED], [])

    wide = _wide_buckets(table, fresh, _part(before, size["buckets"]))
    narrow = sorted(set(size["buckets"]) - set(wide))
    slices, parts = f"{table.path}/slices/load_id={load_id}", []
    with ExitStack() as in_use:
        if narrow or not wide:
            rest = fresh.where(~table.bucket_of().isin(list(wide))) if wide else fresh
            rows = arrived(rest.repartition(table.n_buckets, *[quoted(k) for k in table.key]))
            if before is not None:
                rows = held(in_use.enter_context(table.bucketed(before, narrow, session, [mark])), rows)
            parts.append(closed(rows, table.key, tracked).drop(ARRIVED))
        if wide:
            n_slices = math.ceil(sum(wide.values()) / SLICE_ROWS)
            spread = _spread_session(table, n_slices)
            rows = arrived(with_key(scan_parquet(spread, staging, staged.schema), table.key).where(
                table.bucket_of().isin(list(wide))))
            if before is not None:
                base = table.placed(table.read_version(_part(before, wide), spread))
                rows = held(base.withColumn(ARRIVED, F.lit(None).cast(mark.dataType)), rows)
            ordered = [BUCKET, *table.key, VALID_FROM]
            cut = rows.select(*[quoted(c) for c in (*ordered, *tracked)]).repartitionByRange(
                n_slices, *[quoted(c) for c in ordered])
            overwrite(cut.withColumn(SLICE, F.spark_partition_id()), slices)
            whole = closed_by_slice(session.read.parquet(slices), table.key, tracked, n_slices)
            parts.append(whole.select(*[quoted(f.name) for f in fields], BUCKET))
        table.publish_placed(
            load_id, reduce(union_rows, parts), before, replaces=size["buckets"],
            watermark=later(size["watermark"], before.watermark if before else None), row_count=size["row_count"])
    drop_if_exists(table.spark, slices)
    drop_if_exists(table.spark, staging)
    return UpsertResult(True, size["row_count"], size["rejected"], len(size["buckets"]))


def _part(version: Commit | None, buckets: Sequence[int]) -> Commit | None:
    """Some buckets of a version."""
    if version is None:
        return None
    return replace(version, buckets={b: version.buckets[b] for b in buckets if b in version.buckets})


def _wide_buckets(table: VersionedTable, fresh: DataFrame, before: Commit | None) -> dict[int, int]:
    """The rows of each bucket that has more than one task should put in order."""
    key = [quoted(k) for k in table.key]
    rows = fresh.select(*key)
    if before is not None:
        rows = rows.union(table.read_version(before, fresh.sparkSession).select(*key))
    counts = table.placed(rows).groupBy(BUCKET).agg(F.count(F.lit(1)).alias("n"))
    return {row[BUCKET]: row["n"] for row in counts.where(F.col("n") > WIDE_ROWS).collect()}


def _spread_session(table: VersionedTable, n: int) -> SparkSession:
    """A session like the table's own whose shuffles have ``n`` partitions."""
    session = table.bucket_session()
    session.conf.set("spark.sql.shuffle.partitions", n)
    return session


def closed(versions: DataFrame, key: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """``versions``, one per key and ``valid_from``, with ``changed`` and ``valid_to``.

    The next change is looked up by a running value from the end, so a key with very many
    versions costs no more than as many keys with one.
    """
    group = Window.partitionBy(*[quoted(k) for k in key])
    forward = group.orderBy(VALID_FROM)
    backward = group.orderBy(F.desc(VALID_FROM)).rowsBetween(Window.unboundedPreceding, -1)
    same = F.lit(True)
    for name in tracked:
        same &= quoted(name).eqNullSafe(F.lag(quoted(name)).over(forward))
    begins = F.row_number().over(forward) == 1
    marked = versions.withColumn(CHANGED, begins | ~same)
    following = F.last(F.when(F.col(CHANGED), F.col(VALID_FROM)), ignorenulls=True).over(backward)
    return marked.withColumn(VALID_TO, F.when(F.col(CHANGED), following))


def closed_by_slice(slices: DataFrame, key: Sequence[str], tracked: Sequence[str], n_slices: int) -> DataFrame:
    """``closed`` for rows that lie in slices of their order by bucket, key and ``valid_from``.

    Each slice is closed by itself. Only its first and last key can go on in another slice: for these, a row per
    slice tells what comes before and after, and mends the first row and the last interval.
    """
    named = [quoted(k) for k in key]
    cell, begins, ongoing, after = [SLICE, *key], "__begins", "__ongoing", "__after"
    dealt = slices.repartitionById(n_slices, F.col(SLICE))
    whole = F.struct(BUCKET, *named)
    rims = slices.groupBy(SLICE).agg(F.array(F.min(whole), F.max(whole)).alias("rim"))
    rims = rims.select(SLICE, F.explode("rim").alias("rim")).select(
        SLICE, *[F.col("rim").getField(k).alias(k) for k in key]).distinct()

    values = F.struct(F.lit(True), *[quoted(c) for c in tracked])
    by_time = Window.partitionBy(*named).orderBy(SLICE)
    rim = closed(dealt.join(F.broadcast(rims), cell, "left_semi"), cell, tracked)
    ends = rim.groupBy(*[quoted(c) for c in cell]).agg(
        F.min(VALID_FROM).alias(begins),
        F.min_by(VALID_TO, VALID_FROM).alias("__inner"),
        F.min_by(values, VALID_FROM).alias("__head"),
        F.max_by(values, VALID_FROM).alias("__tail"))
    goes_on = (F.row_number().over(by_time) > 1) & F.col("__head").eqNullSafe(F.lag("__tail").over(by_time))
    first_change = F.when(F.col(ongoing), F.col("__inner")).otherwise(F.col(begins))
    ends = ends.withColumn(ongoing, goes_on).withColumn("__change", first_change).withColumn(
        after, F.first("__change", ignorenulls=True).over(by_time.rowsBetween(1, Window.unboundedFollowing)))
    ends = ends.select(*[quoted(c) for c in cell], begins, ongoing, after)

    rows = closed(dealt, cell, tracked).join(F.broadcast(ends), cell, "left")
    resumed = F.coalesce(F.col(ongoing) & (F.col(VALID_FROM) == F.col(begins)), F.lit(False))
    rows = rows.withColumn(CHANGED, F.col(CHANGED) & ~resumed)
    return rows.withColumn(VALID_TO, F.when(F.col(CHANGED), F.coalesce(VALID_TO, after))).drop(
        SLICE, begins, ongoing, after)


def intervals(history: DataFrame) -> DataFrame:
    """The rows of a history as intervals, from ``valid_from`` up to but not at ``valid_to``."""
    return history.where(F.col(CHANGED)).drop(CHANGED)


def as_of(history: DataFrame, moment: Point) -> DataFrame:
    """The rows that held at a moment, without their intervals. The bounds reach the reader."""
    bound = F.lit(literal_text(moment)).cast(history.schema[VALID_FROM].dataType)
    held = (F.col(VALID_FROM) <= bound) & (F.col(VALID_TO).isNull() | (F.col(VALID_TO) > bound))
    return intervals(history).where(held).drop(VALID_FROM, VALID_TO)


def _fields(schema: T.StructType, key: Sequence[str], at: str, tracked: Sequence[str]) -> list[T.StructField]:
    moment = schema[at].dataType
    return [*[schema[k] for k in key], *[schema[c] for c in tracked], T.StructField(VALID_FROM, moment),
            T.StructField(VALID_TO, moment), T.StructField(CHANGED, T.BooleanType())]
