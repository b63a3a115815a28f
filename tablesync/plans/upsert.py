"""Upsert, latest row wins."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import ExitStack
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tablesync.operators.increment import newest
from tablesync.operators.latest import has_key, last_of_each, latest, without_key
from tablesync.operators.mapping import union_rows
from tablesync.sources.files import drop_if_exists
from tablesync.sources.tables import overwrite, scan_parquet
from tablesync.sources.versions import VersionedTable, bucket_bitmaps, buckets_in


@dataclass(frozen=True)
class UpsertResult:
    """What a load did. ``lost`` counts values that a lenient mapping turned into NULL."""

    published: bool
    row_count: int
    rejected: int
    touched_buckets: int
    lost: Mapping[str, int] = field(default_factory=dict)


#: Rows of a staged file at most; a file is read whole when it has one group of rows.
STAGED_ROWS = 500_000
NOTHING = UpsertResult(False, 0, 0, 0)


def upsert_latest(
    table: VersionedTable,
    increment: DataFrame,
    order: Sequence[str],
    load_id: str,
    watermark: str | None = None,
    ties: Sequence[str] | None = None,
    allow_new_columns: bool = False,
) -> UpsertResult:
    """Merge an increment into the table, keeping the latest row of each key.

    The increment is computed once and staged, and that write also tells its size, its
    greatest ``watermark`` value and the buckets its keys fall in. Only those buckets are
    read from the table and written again.

    Only the increment is shuffled, straight into the table's buckets, where its keys
    are made unique; the cut to one row per key ahead of that shuffle takes care of hot
    keys. The table lies by bucket already, so the two meet without another shuffle and
    with at most two rows of a key.

    A table that was published with repeated keys is made unique as a whole the first
    time, by shuffling both.

    Rows without a key go to ``rejects/load_id=<load>`` next to the data, and count as
    loaded. An empty increment, or a load that was committed before, changes nothing.
    """
    done = table.find(load_id)
    staging = f"{table.path}/staging/load_id={load_id}"
    if done is not None:
        drop_if_exists(table.spark, staging)
        return NOTHING

    staged, size = stage(table, increment, staging, watermark)
    if size["rejected"]:
        overwrite(without_key(staged, table.key), f"{table.path}/rejects/load_id={load_id}")
    if not size["row_count"]:
        drop_if_exists(table.spark, staging)
        return NOTHING

    before = table.current()
    session = table.bucket_session()
    staged = scan_parquet(session, staging, increment.schema)
    replaces = size["buckets"]
    with ExitStack() as in_use:
        if before is not None and not before.unique_keys:
            staged = union_rows(table.read_version(before, session), staged, allow_new_columns)
            replaces = None
        rows = table.placed(latest(staged, table.key, order, ties))
        if before is not None and before.unique_keys:
            known = before.schema.names
            new = [f for f in increment.schema.fields if allow_new_columns and f.name not in known]
            base = in_use.enter_context(table.bucketed(before, size["buckets"], session, new))
            rows = merge(base, rows, table.key, order, ties, allow_new_columns)
        table.publish_placed(
            load_id,
            rows,
            before,
            replaces=replaces,
            watermark=later(size["watermark"], before.watermark if before else None),
            row_count=size["row_count"],
            unique_keys=True,
        )
    drop_if_exists(table.spark, staging)
    return UpsertResult(True, size["row_count"], size["rejected"], len(size["buckets"]))


def merge(
    base: DataFrame,
    fresh: DataFrame,
    key: Sequence[str],
    order: Sequence[str],
    ties: Sequence[str] | None = None,
    allow_new_columns: bool = False,
) -> DataFrame:
    """The latest row per key of two inputs whose rows all have a key.

    When both are hash-partitioned alike by the key, so is their union, and the window
    needs no exchange. A filter on the key would hide that from Spark.
    """
    return last_of_each(union_rows(base, fresh, allow_new_columns), key, order, ties)


def stage(table: VersionedTable, increment: DataFrame, path: str, watermark: str | None) -> tuple[DataFrame, dict]:
    """Write an increment once, to files a task can sort; that write measures it."""
    keyed = has_key(table.key)
    mark = newest(increment, watermark) if watermark else F.max(F.lit(None)).cast("string")
    seen = Observation()
    measured = increment.observe(
        seen,
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(~keyed).alias("rejected"),
        *bucket_bitmaps(F.when(keyed, table.bucket_of()), table.n_buckets),
        mark.alias("watermark"),
    )
    overwrite(measured, path, options={"maxRecordsPerFile": str(STAGED_ROWS)})
    return scan_parquet(table.spark, path, increment.schema), {**seen.get, "buckets": buckets_in(seen.get)}


def later(one: str | None, other: str | None) -> str | None:
    """The later of two watermarks, either of which may be missing."""
    return max((w for w in (one, other) if w is not None), key=datetime.fromisoformat, default=None)
